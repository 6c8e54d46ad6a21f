"""Mixing sources to target weights, in DataFrame operations only.

Every source gets a target in words: its weight's share of the mix, at most ``most`` times its own size, the excess
shared out anew by weight. Its documents are put into one permuted order by a hash. The mix draws whole passes of
that order and then as much of one more pass as the target leaves. The drawn sequence is cut into blocks of equal words.
A splitting tree hands the blocks out: at each node the left half of the output shards gets its exact number of
blocks by a multivariate hypergeometric draw from the sources' quotas, the right half the rest, down to single
shards. A source's quota in a shard is met by its next undrawn blocks, so the blocks of all shards are disjoint, and
inside a shard the documents are shuffled by a hash.

Prefix sums over a source run over 65,536 slices of the hash range first and then inside slices, so a source
of any share of the rows is spread evenly. The driver sees one row for each source and at most ``most_blocks`` quotas; beyond
that, blocks grow instead of their number.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsledger.llm.common import WORD, fresh, text_hash
from obsledger.session import cut_lineage

SLICE_BITS = 16


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sizes`` (source, source_size) with source_no, weight and target.

    Weights are dealt to the sources by code point, null last, and repeat. Filling up every source to
    min(most * size, level * weight) with one level is where sharing the excess anew ends.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    values = F.array(*[F.lit(float(w)) for w in weights])
    numbered = sizes.withColumn("source_no", F.row_number().over(in_order) - 1)
    numbered = numbered.withColumn("weight", F.get(values, F.col("source_no") % len(weights)))
    capped = numbered.withColumn("cap", most * F.col("source_size")).withColumn("fill", F.col("cap") / F.col("weight"))
    before = Window.orderBy("fill", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    leveled = capped.withColumn("level", level)
    common = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "source_no", "level"))).over(everything)
    return leveled.withColumn("target", F.least(F.col("cap"), F.coalesce(common["level"] * F.col("weight"), F.col("cap")))).select(
        "source", "source_size", "source_no", "weight", "target")


def split_quotas(blocks: dict[int, int], shards: int, seed: int) -> list[tuple[int, int, int]]:
    """(source, shard, blocks) with exact sums: shards differ by at most one block, sources give what they have."""
    draw, out = np.random.default_rng(seed), []
    total = sum(blocks.values())
    edge = [total * k // shards for k in range(shards + 1)]
    stack = [(0, shards, {s: n for s, n in sorted(blocks.items()) if n})]
    while stack:
        lo, hi, quota = stack.pop()
        if hi - lo == 1:
            out.extend((s, lo, n) for s, n in quota.items())
            continue
        mid = (lo + hi) // 2
        want, left, rest = edge[mid] - edge[lo], {}, sum(quota.values())
        for s, n in quota.items():  # one source after the other, each given what the earlier ones took
            took = int(draw.hypergeometric(n, rest - n, want)) if rest - n and want else min(n, want)
            left[s], want, rest = took, want - took, rest - n
        stack.append((mid, hi, {s: n - left[s] for s, n in quota.items() if n > left[s]}))
        stack.append((lo, mid, {s: n for s, n in left.items() if n}))
    return out


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0,
        block_words: int = 20_000, shard_blocks: int = 64, most_blocks: int = 1_000_000, seed: int = 1,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with what the mix takes of every row, and the names of the added columns.

    Added: size (words of the text, 0 for null), source_size and target (of the row's source; null is a source),
    taken (size times the copies drawn), copies and shards (the output shard of each copy). Names that ``docs``
    has already are given an underscore, so the names are returned too. A document is copied at most ``most`` times,
    rounded up where a part of a pass is drawn; a source's taken words miss its target by half a document at most. Sources whose size is 0
    have target 0 and give no copies. Repeated rows are separate documents; with equal hashes their order is
    arbitrary, which changes no count. Reruns agree, as all draws hang on hashes of (doc_id, text) and on ``seed``.
    No rows give no rows. ``docs`` is read twice.
    """
    spark = docs.sparkSession
    wanted = ["size", "source_size", "target", "taken", "copies", "shards"]
    free = [n if n.lower() not in {c.lower() for c in docs.columns} else fresh(docs, n)[0] for n in wanted]
    name = dict(zip(wanted, free))
    copies = range(math.ceil(most))
    u, part, no, run, start, block, shard, of, slot, *own = fresh(
        docs.toDF(*docs.columns), "u", "part", "no", "run", "start", "block", "shard", "of", "slot",
        *[f"{kind}{copy}" for copy in copies for kind in ("no", "block", "shard", "at")])
    size = name["size"]
    keyed = docs.withColumn(size, F.coalesce(F.regexp_count(docs[text].cast("string"), F.lit(WORD)), F.lit(0)).cast("long"))
    keyed = keyed.withColumn(u, F.xxhash64(docs[doc_id], text_hash(docs[text].cast("string")), F.lit(seed)).bitwiseAND((1 << 62) - 1))
    keyed = keyed.withColumn(part, F.shiftright(F.col(u), 62 - SLICE_BITS).cast("int"))

    slices = cut_lineage(keyed.groupBy(F.col(f"`{source}`").alias("source"), F.col(part).alias("part")).agg(F.sum(size).alias("size")))
    sources = cut_lineage(targets(slices.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    wants = {r.source_no: r.target for r in sources.select("source_no", "target").collect()}
    total = sum(wants.values())
    words = max(block_words, math.ceil(total / most_blocks))
    blocks = {s: math.ceil(t / words) for s, t in wants.items()}
    shards = max(1, math.ceil(sum(blocks.values()) / shard_blocks))
    quotas = spark.createDataFrame(split_quotas(blocks, shards, seed), "source_no int, shard int, n long")
    ahead = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(ahead), F.lit(0))
    drawn = quotas.withColumn("first", first).select(
        F.col("source_no").alias(no), F.col("shard").alias(shard),
        F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias(block))

    up_to = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("source", "part", F.coalesce(F.sum("size").over(up_to), F.lit(0)).alias("before"))
    offsets = offsets.join(sources, offsets["source"].eqNullSafe(sources["source"])).select(
        offsets["source"].alias(of), F.col("part").alias(slot), F.col("before").alias(start),
        F.col("source_size").alias(name["source_size"]), F.col("target").alias(name["target"]), F.col("source_no").alias(no))
    joined = keyed.join(offsets, keyed[source].eqNullSafe(offsets[of]) & (keyed[part] == offsets[slot])).drop(of, slot)
    inside = Window.partitionBy(source, part).orderBy(u).rowsBetween(Window.unboundedPreceding, -1)
    placed = joined.withColumn(run, F.col(start) + F.coalesce(F.sum(size).over(inside), F.lit(0)))
    whole, goal = F.col(name["source_size"]), F.col(name["target"])
    passes = F.when(whole > 0, F.floor(goal / whole)).otherwise(0).cast("int")
    extra = F.when((whole > 0) & (F.col(run) + F.col(size) / 2 < goal - passes * whole), 1).otherwise(0)
    placed = placed.withColumn(name["copies"], (passes + extra).cast("int"))
    placed = placed.withColumn(name["taken"], F.col(size) * F.col(name["copies"]))
    held = []
    for copy in copies:
        of_no, of_block, of_shard, drawn_at = own[4 * copy:4 * copy + 4]
        at = F.least(F.floor((F.lit(copy) * whole + F.col(run)) / words), F.ceil(goal / words) - 1).cast("long")
        looked_up = drawn.select(F.col(no).alias(of_no), F.col(block).alias(of_block), F.col(shard).alias(of_shard))
        placed = placed.withColumn(drawn_at, F.when(F.col(name["copies"]) > copy, at))
        placed = placed.join(looked_up, (F.col(no) == F.col(of_no)) & (F.col(drawn_at) == F.col(of_block)), "left")
        held.append(of_shard)
    placed = placed.withColumn(name["shards"], F.filter(F.array(*held), lambda s: s.isNotNull()))
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"`{name[n]}`") for n in wanted]), name


def mixed_rows(docs: DataFrame, seed: int = 1, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The mix itself: rows of ``docs``, one for each copy drawn, dealt out by shard and shuffled inside it."""
    decided, name = mix(docs, seed=seed, doc_id=doc_id, text=text, **how)
    shard, turn, order = fresh(decided, "shard", "turn", "order")
    copies = decided.select(*[F.col(f"`{c}`") for c in docs.columns], F.posexplode(name["shards"]).alias(turn, shard))
    shuffled = copies.withColumn(order, F.xxhash64(F.col(doc_id), text_hash(F.col(text).cast("string")), F.col(turn), F.lit(seed + 1)))
    return shuffled.repartition(shard).sortWithinPartitions(shard, order).select(*[F.col(f"`{c}`") for c in docs.columns])
