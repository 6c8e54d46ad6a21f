"""Best-fit packing with certificates: bound, exchange, repack.

Items are dealt out evenly over groups that fit a task. Each group is packed by best-fit decreasing, and
dual-feasible functions give a lower bound of its bins: where both agree, no packing of that group is better. The
items of open bins of groups with a gap, and of the emptiest bin of every other group, are dealt out anew among
groups and packed again; a new packing counts only if it has fewer bins. This ends when the bins equal the bound of
all items, when nothing is gained, or after ``rounds`` exchanges. The driver sees counts of lengths (at most one
for each possible length) and of bins.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.common import fresh
from obsledger.session import cut_lineage


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs; ``counts[x]`` items have length x (0 to capacity).

    Three families of dual-feasible functions: the identity; sizes above C - a as C, below a as 0; and
    (k + 1) x / C rounded down unless whole.
    """
    x = np.arange(capacity + 1)
    best = math.ceil(int(counts @ x) / capacity)
    above, weight = np.cumsum(counts[::-1])[::-1], np.concatenate([[0], np.cumsum(counts * x)])
    for a in range(1, capacity // 2 + 1):
        large = int(above[capacity - a + 1])
        best = max(best, large + math.ceil((int(weight[capacity - a + 1]) - int(weight[a])) / capacity))
    for k in range(1, 33):
        scaled = (k + 1) * x
        value = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)  # times C / k
        best = max(best, math.ceil(int(counts @ value) / (capacity * k)))
    return best


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, taken in the given (decreasing) order into the fullest bin that has room; fills."""
    bins, offsets, fills = [0] * len(lengths), [0] * len(lengths), []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for k, size in enumerate(lengths):
        fit = mask >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                mask ^= 1 << room
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bins[k], offsets[k] = b, fills[b]
        fills[b] += size
        rest = room - size
        if not free[rest]:
            mask |= 1 << rest
        free[rest].append(b)
    return bins, offsets, fills


def pack(items: DataFrame, capacity: int, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece"),
         group_rows: int = 20_000, rounds: int = 4) -> DataFrame:
    """``items`` with sequence_id, offset (gapless from 0 in each sequence) and certified (its group's count is proven least).

    Lengths are whole numbers from 0 to ``capacity``; anything else, null too, raises. Items of length 0 take no room.
    Repeated rows are separate items; equal lengths are taken in the order of the ``order`` columns, so that reruns
    on the same rows agree up to the dealing. No items give no rows. Columns with the names of the results are
    replaced.
    """
    out = ["sequence_id", "offset", "certified"]
    items = cut_lineage(items.drop(*out))
    grouped, loose_name, kept_name = fresh(items, "group", "loose", "kept")
    sizes = items.groupBy(length).count().collect()
    if any(r[0] is None or not 0 <= r[0] <= capacity for r in sizes):
        raise ValueError(f"lengths must be from 0 to {capacity}")
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in sizes:
        counts[size] = n
    target, rows = lower_bound(counts, capacity), int(counts.sum())
    names = [f.name for f in items.schema.fields]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    schema = f"{kinds}, sequence_id long, offset long, certified boolean, {loose_name} boolean, {kept_name} boolean"
    keys = [(length, "descending"), *[(c, "ascending") for c in order]]

    def packed(turn: int):
        def pack_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            table = table.sort_by(keys)
            lengths = table.column(length).to_pylist()
            bins, offsets, fills = best_fit(lengths, capacity)
            had = len(set(table.column("sequence_id").to_pylist())) if turn else math.inf
            bound = lower_bound(np.bincount(np.array(lengths, np.int64), minlength=capacity + 1), capacity)
            sure = len(fills) <= bound
            filled = np.array(fills, np.int64)
            loose = (filled < capacity) & (not sure)
            loose[int(filled.argmin())] = fills[int(filled.argmin())] < capacity
            kept = len(fills) >= had  # no gain: the old places stay
            out = table.select(names)
            if kept:
                out = out.append_column("sequence_id", table.column("sequence_id"))
                out = out.append_column("offset", table.column("offset"))
                sure = had <= bound
                flags = pa.array([not sure] * len(lengths))
            else:
                base = (turn << 58) | (int(key[0].as_py()) << 26)
                out = out.append_column("sequence_id", pa.array([base + b for b in bins], pa.int64()))
                out = out.append_column("offset", pa.array(offsets, pa.int64()))
                flags = pa.array(loose[np.array(bins, np.int64)])
            out = out.append_column("certified", pa.array([sure] * len(lengths)))
            out = out.append_column(loose_name, flags)
            return out.append_column(kept_name, pa.array([kept] * len(lengths)))
        return pack_group

    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, math.ceil(rows / group_rows))))
    placed = cut_lineage(items.withColumn(grouped, group).groupBy(grouped).applyInArrow(packed(0), schema))
    settled, bins_settled = [], 0
    is_loose, first = F.col(loose_name), F.col("offset") == 0
    for turn in range(1, rounds + 1):
        # items of length 0 may count as sequences here, which costs an exchange at most
        fixed, loose, n_loose = placed.agg(
            F.count(F.when(~is_loose & first, 1)), F.count(F.when(is_loose & first, 1)),
            F.count(F.when(is_loose, 1))).first()
        if loose < 2 or bins_settled + fixed + loose <= target:
            break
        settled.append(placed.where(~is_loose))
        bins_settled += fixed
        groups = max(1, math.ceil(n_loose / group_rows))
        group = F.pmod(F.xxhash64(F.col("sequence_id"), F.lit(turn)), F.lit(groups))
        placed = cut_lineage(placed.where(is_loose).withColumn(grouped, group).groupBy(grouped)
                             .applyInArrow(packed(turn), schema))
        if placed.where(~F.col(kept_name)).isEmpty():
            break
    for part in settled:
        placed = placed.unionByName(part)
    return placed.select(*names, *out)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, **how) -> DataFrame:
    """Whole documents as sequences: ids of each text and a final 0, cut only where longer than ``capacity``.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified; see ``tokens.pieces`` for null
    and repeated rows (an empty or null text is one id long).
    """
    from obsledger.llm.tokens import pieces
    return pack(pieces(docs, vocabulary, capacity), capacity, **how)
