"""Near duplicates by SimHash, found with the generalised pigeonhole principle.

A fingerprint is one or more words of 64 bits. The 64 bits of a word are dealt into parts, correlated bits together.
With thresholds t_i of at least -1 that sum to (distance - parts + 1), two words within the distance differ in at
most t_i bits of some part i; -1 skips a part. A dynamic programme picks the thresholds (and the number of parts)
with the least estimated cost of candidates and probes, from bit statistics of all fingerprints. A fingerprint
probes each part's values within t_i bits, and the candidates it meets are verified by the distance of their whole
fingerprints.

Equal fingerprints are one node, so copies cost nothing. Buckets are compared in blocks inside a task, which gives
back a spanning forest of the verified links and never the pairs. Part values shared by more than ``bucket_rows``
nodes are split: for distances up to 2 their fingerprints write down all values within one bit of themselves and
meet there (two fingerprints within 2 bits always do, and such a midpoint has at most 65 neighbours, so the work
stays in proportion to the rows); for larger distances the bucket becomes a grid of blocks, each a group of its own.

With a least Jaccard similarity (``least``) the plan is fixed instead, whatever the rows are: all bits of all words are
dealt twice into parts of 12, and nodes that share one part's value meet. A pair's fate depends on no other row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.common import text_hash, trimmed, utf8
from obsledger.llm.components import components
from obsledger.session import cut_lineage

BITS = 64
GOLDEN = 0x9E3779B97F4A7C15


def mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Hashes for the fingerprint's word of that number; word 0 takes them as they are."""
    if not word:
        return hashes
    h = hashes + np.uint64(word * GOLDEN % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: bytes | None, shingle: int = 3) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of ASCII-lower-cased words' shingles, some at a time; fewer words than a shingle: all as one."""
    from itertools import repeat

    import xxhash
    split = (text or b"").lower().split()
    n = max(1, len(split) - shingle + 1) if split else 0
    for at in range(0, n, 1 << 18):
        stop = min(at + (1 << 18), n)
        some = [b" ".join(split)] if n == 1 else map(b" ".join, zip(*(split[at + k:stop + k] for k in range(shingle))))
        yield np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(42)), np.uint64, stop - at)


def distinct_shingles(text: bytes | None, shingle: int = 3) -> np.ndarray:
    """Hashes of the different shingles, ascending."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, shingle)]))


def majority(parts: Iterable[np.ndarray], words: int) -> list[int]:
    """Words whose bits are 1 if set in over half of the hashes; none: all bits 0."""
    counts, n = np.zeros(BITS * words, np.int64), 0
    for hashes in parts:
        for at in range(0, len(hashes), 1 << 18):
            some = hashes[at:at + (1 << 18)]
            raw = np.stack([mixed(some, w) for w in range(words)], axis=1).astype(">u8").view(np.uint8)
            counts += np.unpackbits(raw.reshape(-1, 8 * words), axis=1).sum(axis=0, dtype=np.int64)
            n += len(some)
    bits = np.packbits(counts * 2 > n).tobytes()
    return [int.from_bytes(bits[8 * w:8 * w + 8], "big") for w in range(words)]


def fingerprint(text: bytes | None, shingle: int = 3, words: int = 1) -> list[int]:
    """SimHash of the shingles, repeats included. A bit is 1 if it is set in over half of their hashes."""
    return majority(shingle_hashes(text, shingle), words)


def set_fingerprint(text: bytes | None, shingle: int, words: int) -> list[int]:
    """SimHash of the different shingles, and behind it a number for their set (0 if there are none)."""
    hashes = distinct_shingles(text, shingle)
    return [*majority([hashes], words), int(mixed(hashes, 7).sum(dtype=np.uint64))]


def apart(least: float) -> float:
    """Chance that a bit of two texts' fingerprints differs at a Jaccard similarity of ``least``, at most."""
    return math.acos(2 * least / (1 + least)) / math.pi


def bit_limit(least: float, words: int) -> int:
    """Bits apart that a pair at ``least`` stays within, but for 3.5 standard deviations."""
    q, n = apart(least), BITS * words
    return min(n, math.ceil(n * q + 3.5 * math.sqrt(n * q * (1 - q))))


def fixed_parts(words: int, width: int = 12, deals: int = 2) -> np.ndarray:
    """Bit numbers of each part: ``deals`` dealings of all bits, each in another order."""
    n = BITS * words
    orders = [np.arange(n) * step % n for step in (1, 37, 83, 155)[:deals]]  # odd steps reach every bit
    return np.concatenate([order[:n // width * width].reshape(-1, width) for order in orders])


def recall(least: float, parts: np.ndarray) -> float:
    """Estimated share of pairs at a Jaccard similarity of ``least`` that share a part's value, bits independent."""
    return 1 - (1 - (1 - apart(least)) ** parts.shape[1]) ** len(parts)


def names(words: int) -> list[str]:
    return [f"f{w}" for w in range(words)]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1,
                 sets: bool = False) -> DataFrame:
    """(doc_id, text_hash, f0, f1, ...) of every row; text_hash is Spark's hash of the text, to name rows by.

    ``sets``: of the different shingles, with a column shingles that numbers their set.
    """
    kind, made = docs.schema[doc_id].dataType.simpleString(), names(words) + ["shingles"] * sets

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([set_fingerprint(t, shingle, words) if sets else fingerprint(t, shingle, words)
                               for t in utf8(batch.column(2))], np.uint64).reshape(-1, len(made))
            columns = [pa.array(np.ascontiguousarray(prints[:, w]).view(np.int64)) for w in range(len(made))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "text_hash", *made])

    value = docs[text].cast("string")
    return docs.select(docs[doc_id], text_hash(value).alias("text_hash"), value).mapInArrow(
        trimmed(hashed), f"doc_id {kind}, text_hash long, " + ", ".join(f"{n} long" for n in made))


def bit_pairs(prints: DataFrame) -> np.ndarray:
    """64 x 64 matrix: values of the only column with both bits set, over all rows (4096 sums reach the driver)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            raw = batch.column(0).to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1)[:, ::-1].astype(np.float32)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel())], ["k", "c"])

    sums = prints.mapInArrow(count, "k long, c double").groupBy("k").agg(F.sum("c").alias("c"))
    out = np.zeros(BITS * BITS)
    for k, c in sums.collect():
        out[k] = c
    return out.reshape(BITS, BITS)


def grouped_bits(pairs: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """Bits dealt into ``parts`` of nearly equal width; each part grows by the bit most correlated with it."""
    p = np.diag(pairs) / max(rows, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs((pairs / max(rows, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        part = [max(left, key=lambda b: tie[b, left].sum())]
        left.remove(part[0])
        while len(part) < width:
            part.append(max(left, key=lambda b: tie[b, part].sum()))
            left.remove(part[-1])
        out.append(sorted(part))
    return out


def candidate_counts(p: np.ndarray, rows: int, part: list[int], most: int) -> list[float]:
    """Estimated pairs that differ in at most e bits of the part, e = 0 to ``most``."""
    mismatch, chance = 2 * p[part] * (1 - p[part]), np.zeros(len(part) + 1)
    chance[0] = 1
    for q in mismatch:
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
    return list(np.cumsum(chance[:most + 1]) * rows * rows / 2)


PROBE_COST = 200  # what sending and sorting a probe costs, in comparisons of two fingerprints


def allocate(p: np.ndarray, rows: int, parts: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """Least estimated cost and thresholds (one for each part, -1 to distance) that sum to distance - parts + 1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in parts:
        pairs, after = candidate_counts(p, rows, part, distance), {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, min(distance, len(part)) + 1):
                probes = PROBE_COST * rows * sum(math.comb(len(part), e) for e in range(t + 1))
                new = cost + (pairs[t] + probes if t >= 0 else 0.0)
                if used + t not in after or new < after[used + t][0]:
                    after[used + t] = (new, [*chosen, t])
        best = after
    return best[distance - len(parts) + 1]


def plan(pairs: np.ndarray, rows: int, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to probe, for the cheapest number of parts."""
    p, found = np.diag(pairs) / max(rows, 1), []
    for parts in range(1, distance + 2):
        groups = grouped_bits(pairs, rows, parts)
        cost, thresholds = allocate(p, rows, groups, distance)
        found.append((cost, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def flips(bits: list[int], most: int) -> list[int]:
    """Masks that change 0 to ``most`` of the bits."""
    return [signed(sum(1 << b for b in some)) for e in range(most + 1) for some in combinations(bits, e)]


def forest(words: np.ndarray, probes: np.ndarray, homes: np.ndarray, most: int, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Rows, and for each the least row it is connected with by links between ``probes`` and ``homes`` (row numbers).

    Two rows are linked if all their words together differ in at most ``most`` bits. Unlinked rows are left out.
    """
    left, right = [], []
    for at in range(0, len(probes), block):
        some = words[probes[at:at + block]]
        total = np.bitwise_count(some[:, :1] ^ words[homes, 0][None, :]).astype(np.uint16)
        for w in range(1, words.shape[1]):
            total += np.bitwise_count(some[:, w:w + 1] ^ words[homes, w][None, :])
        i, j = np.nonzero(total <= most)
        i, j = probes[at + i], homes[j]
        other = i != j
        left.append(i[other])
        right.append(j[other])
    i, j = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(words))
    while len(i):
        least, before = np.minimum(label[i], label[j]), label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    linked = np.unique(np.concatenate([i, j]))
    return linked, label[linked]


def meetings(words: np.ndarray, node: np.ndarray, probes: np.ndarray, homes: np.ndarray, most: int,
             block: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, sort) node by node: sort 0 connects the rows within ``most`` bits, 1 to 4 are some of those pairs.

    Of each probe's near homes these are the nearest, that of the least node, and two drawn by a hash of the pair.
    """
    root, out = np.arange(len(words)), []
    mark = [mixed(node.astype(np.uint64), w) for w in (1, 2)]
    for at in range(0, len(probes), block):
        rows = probes[at:at + block]
        total = np.zeros((len(rows), len(homes)), np.uint16)
        for w in range(words.shape[1]):
            total += np.bitwise_count(words[rows, w][:, None] ^ words[homes, w][None, :])
        near = (total <= most) & (node[rows][:, None] != node[homes][None, :])
        some = near.any(axis=1)
        if not some.any():
            continue
        rows, near, total = rows[some], near[some], total[some]
        scores = [total.astype(np.uint64), np.broadcast_to(node[homes].astype(np.uint64), near.shape)]
        for k, score in enumerate(scores + [(m[rows][:, None] ^ m[homes][None, :]) * np.uint64(GOLDEN) for m in mark]):
            to = homes[np.where(near, score, np.uint64((1 << 64) - 1)).argmin(axis=1)]
            out.append((node[rows], node[to], np.full(len(rows), k + 1)))
        i, j = np.nonzero(near)
        i, j = rows[i], homes[j]
        while True:
            a, b = root[i], root[j]
            other = a != b
            if not other.any():
                break
            i, j, a, b = i[other], j[other], a[other], b[other]
            up = np.arange(len(words))
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
            while (up[up] != up).any():
                up = up[up]
            root = up[root]
    moved = np.flatnonzero(root != np.arange(len(words)))
    out.append((node[moved], node[root[moved]], np.zeros(len(moved), np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out))


def across(words: np.ndarray, node: np.ndarray, label: np.ndarray, probes: np.ndarray, homes: np.ndarray, most: int,
           block: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, 5): all pairs of a probe and a home within ``most`` bits whose labels differ."""
    out = [(np.zeros(0, np.int64),) * 2]
    for at in range(0, len(probes), block):
        rows = probes[at:at + block]
        total = np.zeros((len(rows), len(homes)), np.uint16)
        for w in range(words.shape[1]):
            total += np.bitwise_count(words[rows, w][:, None] ^ words[homes, w][None, :])
        i, j = np.nonzero((total <= most) & (label[rows][:, None] != label[homes][None, :]) & (node[rows][:, None] < node[homes][None, :]))
        out.append((node[rows[i]], node[homes[j]]))
    a, b = (np.concatenate(x) for x in zip(*out))
    return a, b, np.full(len(a), 5)


def bucket_links(rows: DataFrame, words: int, most: int, how: str = "forest") -> DataFrame:
    """(a, b): a spanning forest of the links inside each key; rows: key, node, role (0 home, 1 probe, 2 both), f0, ...

    ``how``: "meetings" or "across" (by a column label) give (a, b, sort) of those functions instead.
    """

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(part: pa.Table) -> Iterator[pa.RecordBatch]:
            part = part.combine_chunks()
            key, node, role = (part.column(c).to_numpy() for c in ("key", "node", "role"))
            prints = np.stack([part.column(n).to_numpy() for n in names(words)], axis=1).view(np.uint64)
            cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            label = part.column("label").to_numpy() if how == "across" else None
            a, b, sort = [], [], []
            for g in np.flatnonzero(np.diff(cuts) > 1):
                lo, hi = cuts[g], cuts[g + 1]
                probes, homes = np.flatnonzero(role[lo:hi] > 0), np.flatnonzero(role[lo:hi] != 1)
                if not (len(probes) and len(homes)):
                    continue
                if how == "forest":
                    linked, least = forest(prints[lo:hi], probes, homes, most)
                    other = linked != least
                    a.append(node[lo + linked[other]])
                    b.append(node[lo + least[other]])
                    continue
                found = (meetings(prints[lo:hi], node[lo:hi], probes, homes, most) if how == "meetings"
                         else across(prints[lo:hi], node[lo:hi], label[lo:hi], probes, homes, most))
                for to, what in zip((a, b, sort), found):
                    to.append(what)
                if sum(map(len, a)) > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, sort)], ["a", "b", "sort"])
                    a, b, sort = [], [], []
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, sort) if x],
                                                 ["a", "b", "sort"][:2 if how == "forest" else 3])

        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:  # rows come sorted by key: what the last key of a batch misses follows
            if not len(batch):
                continue
            waiting.append(batch)
            size += len(batch)
            if size < 200_000:
                continue
            part = pa.Table.from_batches(waiting)
            key = part.column("key").to_numpy()
            stop = int(np.searchsorted(key, key[-1]))
            if stop:
                yield from settled(part.slice(0, stop))
                waiting = part.slice(stop).combine_chunks().to_batches()
                size -= stop
        if waiting:
            yield from settled(pa.Table.from_batches(waiting))

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(
        match, "a long, b long" if how == "forest" else "a long, b long, sort long")


def near_links(nodes: DataFrame, words: int, distance: int, most: int, bucket_rows: int) -> DataFrame:
    """Links (a, b) that connect the nodes found near; ``nodes`` (node, f0, ...) hold distinct fingerprints.

    Two nodes are near if some word of them is within ``distance`` bits and all words together within ``most``.
    """
    count, keyed = max(1, nodes.count()), None
    for w, name in enumerate(names(words)):
        for k, (bits, t) in enumerate(plan(bit_pairs(nodes.select(name)), count, distance)):
            value = F.col(name).bitwiseAND(F.lit(signed(sum(1 << b for b in bits))))
            masks = F.array(*map(F.lit, flips(bits, t)))
            one = nodes.select("*", F.posexplode(masks).alias("turn", "mask")).select(
                F.xxhash64(F.lit(w), F.lit(k), value.bitwiseXOR(F.col("mask"))).alias("key"), "node",
                F.when(F.col("turn") == 0, 2).otherwise(1).cast("byte").alias("role"), *names(words))
            keyed = one if keyed is None else keyed.union(one)
    homes = keyed.where("role = 2").groupBy("key").count()
    crowded = cut_lineage(homes.where(F.col("count") > bucket_rows))
    if crowded.isEmpty():
        return bucket_links(keyed, words, most)
    calm = keyed.join(crowded, "key", "left_anti")
    if words == 1 and most <= 2:
        links = bucket_links(calm, words, most)
        busy = keyed.join(crowded, "key", "left_semi").select("node", "f0").distinct()
        near = F.explode(F.transform(F.array(*map(F.lit, flips(list(range(BITS)), (most + 1) // 2))),
                                     lambda m: F.col("f0").bitwiseXOR(m)))
        met = busy.select("node", "f0", near.alias("mid")).groupBy("mid").agg(F.collect_list(F.struct("node", "f0")).alias("all"))
        first = met.where(F.size("all") > 1)
        if most == 2:
            pairs = first.select(F.array_min("all")["node"].alias("a"), F.explode("all.node").alias("b"))
        else:
            pairs = first.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y")).where(
                F.bit_count(F.col("x.f0").bitwiseXOR(F.col("y.f0"))) <= most).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        return links.union(pairs.where("a != b"))
    return bucket_links(gridded(keyed, crowded, words, bucket_rows), words, most)


def fixed_keys(nodes: DataFrame, words: int) -> DataFrame:
    """key, node, role, f0, ... (and label, if there is one) for every node and part of ``fixed_parts``."""
    parts, more = fixed_parts(words), names(words) + ["label"] * ("label" in nodes.columns)
    worth = 1 << np.arange(parts.shape[1])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch.slice(at, 1000)
                raw = np.stack([some.column(n).to_numpy() for n in names(words)], axis=1)
                bits = np.unpackbits(raw.astype(">i8").view(np.uint8).reshape(len(some), -1), axis=1)
                keys = (bits[:, parts] @ worth + np.arange(len(parts)) * (1 << parts.shape[1])).ravel()
                each = np.repeat(np.arange(len(some)), len(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int64)), pa.array(some.column("node").to_numpy()[each]), pa.array(np.full(len(keys), 2, np.int8)),
                     *[pa.array(some.column(n).to_numpy()[each]) for n in more]], ["key", "node", "role", *more])

    return nodes.select("node", *more).mapInArrow(deal, "key long, node long, role byte, " + ", ".join(f"{n} long" for n in more))


def fixed_links(nodes: DataFrame, words: int, most: int, bucket_rows: int, how: str = "forest") -> DataFrame:
    """Links (a, b) that connect the nodes which share a part of ``fixed_parts`` and differ in at most ``most`` bits."""
    keyed = fixed_keys(nodes, words)
    crowded = cut_lineage(keyed.groupBy("key").count().where(F.col("count") > bucket_rows))
    return bucket_links(keyed if crowded.isEmpty() else gridded(keyed, crowded, words, bucket_rows), words, most, how)


def alike(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (a, b) whose texts' sets of shingles have a Jaccard similarity of ``least`` or more; texts: node, text."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[int, np.ndarray] = {}

            def of(node: int, text: bytes | None, sets: dict[int, np.ndarray] = sets) -> np.ndarray:
                if node not in sets:
                    if len(sets) >= 500:
                        sets.clear()
                    sets[node] = distinct_shingles(text, shingle)
                return sets[node]

            good = []
            for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), utf8(batch.column(3))):
                one, two = of(a, x), of(b, y)
                both = len(np.intersect1d(one, two, assume_unique=True))
                good.append(both >= least * (len(one) + len(two) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return joined.mapInArrow(verified, "a long, b long")


def verified_links(docs: DataFrame, doc_id: str, text: str, classes: DataFrame, words: int, shingle: int, least: float,
                   most: int, bucket_rows: int) -> DataFrame:
    """Links (a, b) with the components of all pairs that meet, differ in at most ``most`` bits and are ``least`` alike.

    First up to four pairs a node are verified; their components become labels. Where nodes connected by meeting have
    more than one label, all their pairs of different labels are verified, too. classes: node, f0, ..., least (of ids).
    """
    columns = names(words)
    met = cut_lineage(fixed_links(classes.select("node", *columns), words, most, bucket_rows, "meetings").groupBy("a", "sort").agg(
        F.collect_set(F.when(F.col("sort") == 0, F.col("b"))).alias("to"),
        F.min_by("b", F.when(F.col("sort") != 2, F.xxhash64(F.least("a", "b"), F.greatest("a", "b"), F.col("sort"))).otherwise(F.col("b"))).alias("b")))
    group = components(met.where("sort = 0").select("a", F.explode("to").alias("b")), "a", "b")
    h, i, j, n = (f"_{x}_of_node" for x in "hijn")
    named = classes.join(group, "node", "left_semi").select(
        F.col("least.d").alias(i), F.col("least.h").alias(j), F.col("node").alias(n))
    hashed = docs.select(docs[doc_id].alias("d"), text_hash(docs[text].cast("string")).alias(h), docs[text].cast("string").alias("t"))
    texts = cut_lineage(hashed.join(named, hashed["d"].eqNullSafe(named[i]) & (hashed[h] == named[j]))
                        .dropDuplicates(["d", h, n]).select(F.col(n).alias("node"), F.col("t").alias("text")))
    pairs = met.where("sort > 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = cut_lineage(alike(pairs, texts, shingle, least))
    label = components(links, "a", "b").toDF("node", "own")
    labelled = cut_lineage(group.join(label, "node", "left").select("node", F.col("root").alias("met"), F.coalesce("own", "node").alias("label")))
    open_ = labelled.groupBy("met").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("met")
    left = cut_lineage(classes.select("node", *columns).join(labelled.join(open_, "met", "left_semi"), "node").select("node", *columns, "label"))
    rest = fixed_links(left, words, most, bucket_rows, "across").select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
    return links.union(cut_lineage(alike(rest, texts, shingle, least)))


def gridded(keyed: DataFrame, crowded: DataFrame, words: int, bucket_rows: int) -> DataFrame:
    """``keyed`` with the keys of ``crowded`` (key, count) as grids of blocks."""
    # AQE keeps this join's skew apart: one side has a row for each crowded key
    calm, grid = keyed.join(crowded, "key", "left_anti"), keyed.join(crowded, "key").withColumn("n", F.ceil(F.col("count") / bucket_rows).cast("int"))
    every, columns = F.explode(F.sequence(F.lit(0), F.col("n") - 1)), [c for c in keyed.columns if c != "key"]
    as_home = grid.where("role = 2").withColumn("role", F.lit(0).cast("byte")).withColumn(
        "h", F.pmod(F.xxhash64("node", F.lit(1)), "n").cast("int")).withColumn("p", every)
    as_probe = grid.withColumn("role", F.lit(1).cast("byte")).withColumn(
        "p", F.pmod(F.xxhash64("node", F.lit(2)), "n").cast("int")).withColumn("h", every)
    cells = as_home.select(F.xxhash64("key", "h", "p").alias("key"), *columns).union(
        as_probe.select(F.xxhash64("key", "h", "p").alias("key"), *columns))
    return calm.union(cells)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1,
                    distance: int = 2, most: int | None = None, bucket_rows: int = 4000, least: float | None = None) -> DataFrame:
    """(doc_id, text_hash, f0, ..., component_id, first): one row for each row of ``docs``.

    Documents are linked if some word of their fingerprints differs in at most ``distance`` bits and all words together in
    at most ``most`` (default: ``distance``). component_id is the least doc_id reachable by links, the row's own
    included (null only if all ids of the component are null). Texts without words, null ones too, have fingerprint 0 and
    are linked like any other. With ``least`` (a Jaccard similarity), fingerprints are of the different shingles, and
    documents that meet by the fixed plan are linked if their sets of shingles are that alike. Repeated rows give repeated results. ``first`` holds for rows with the component's
    least (doc_id, text_hash), the one document that stays. No rows give no rows.
    """
    columns = names(words)
    keys = columns + ["shingles"] * (least is not None)
    prints = cut_lineage(fingerprints(docs, doc_id, text, shingle, words, least is not None))
    ranked = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
    classes = prints.groupBy(*keys).agg(F.min(ranked).alias("least"))
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()) if words > 1
                          else classes.withColumn("node", F.col("f0")))
    if least is None:
        links = near_links(classes.select("node", *columns), words, distance, distance if most is None else most, bucket_rows)
    else:
        links = verified_links(docs, doc_id, text, classes, words, shingle, least, bit_limit(least, words) if most is None else most, bucket_rows)
    roots = components(links, "a", "b").toDF("linked", "root")
    rooted = classes.join(roots, classes["node"] == roots["linked"], "left").select(
        *keys, "least", F.coalesce("root", "node").alias("root"))
    best = rooted.groupBy("root").agg(F.min("least").alias("best"))
    named = rooted.join(best, "root").select(*keys, "best")
    joined = prints.join(named, keys)
    return joined.select("doc_id", "text_hash", *columns, F.col("best.d").alias("component_id"),
                         (ranked == F.col("best")).alias("first"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the least doc_id, of equal ids the least text hash."""
    from obsledger.llm.common import keep_rows
    found = near_duplicates(docs, doc_id, text, **how)
    return keep_rows(docs, found.where("first").select("doc_id", "text_hash"), doc_id, text)
