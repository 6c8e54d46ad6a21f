"""Document fingerprints from improbable features.

Every 64-byte window of a text has an entropy; over all windows of all texts, rare entropies are counted out and rank
highest. A window that is the rarest within 32 places on either side (the leftmost of equals) is a feature. Features go, in
order, into chained Bloom filters of 2048 bits, five bits each, 128 features to a filter. The chain of
filters in hex is the fingerprint. Short texts have more features, so that a part of them keeps some: below 512 bytes the
rarest 16-byte windows within 8 places (equals by hash), below 96 bytes all 8-byte windows, below 24 all of 3 bytes. Likeness is the overlap of bits beyond what chance gives, as a share of the most
that is possible, between each filter and its best partner.

Entropies are sums of whole numbers, so equal texts have equal fingerprints wherever they are computed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.common import text_hash, utf8

WINDOW, REACH, LEVELS = 64, 32, 1000
BITS, HASHES, PER_FILTER = 2048, 5, 128
SHORT = ((16, 8, 512), (8, 0, 96), (3, 0, 24))  # window, reach (0: every window) and the size texts stay below
TILE = 128 << 10
ONE = 1 << 20
_F = np.array([0] + [round(c * math.log2(c) * ONE) for c in range(1, WINDOW + 1)], np.int64)
GAIN = np.diff(_F)  # what one more of a byte adds to the sum of c log c, by how many there are
ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def levels(raw: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Entropy level, 0 to LEVELS, of the window at every place but the last ``window`` - 1."""
    n = len(raw)
    if n < window:
        return np.zeros(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)  # equal bytes up to window - 1 places away
    for d in range(1, window):
        same = (raw[d:] == raw[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    change = GAIN[before]
    change[window:] -= GAIN[after[:n - window]]
    sums = np.cumsum(change)[window - 1:]
    whole = window * ONE * int(math.log2(window))
    return (whole - sums) * LEVELS // whole


def streams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Joined bytes of some texts at a time, with each one's number and first place."""
    at = 0
    while at < len(texts):
        stop, size = at + 1, len(texts[at])
        while stop < len(texts) and size < TILE:
            size += len(texts[stop])
            stop += 1
        sizes = np.array([len(t) for t in texts[at:stop]])
        yield np.frombuffer(b"".join(texts[at:stop]), np.uint8), np.arange(at, stop), np.cumsum(sizes) - sizes
        at = stop


def _inside(n: int, start: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """For each window place: text (index into ``start``), and whether the window lies in one text."""
    ends = np.append(start[1:], n)
    owner = np.repeat(np.arange(len(start)), ends - start)[:max(0, n - window + 1)]
    return owner, np.arange(len(owner)) + window <= ends[owner]


def _peaks(ranks: np.ndarray, reach: int) -> np.ndarray:
    """Places above 0 with the most within ``reach`` on either side, the leftmost of equals."""
    padded = np.concatenate([np.zeros(reach, np.int64), ranks, np.zeros(reach, np.int64)])
    most = padded
    for k in range(int(math.log2(reach))):
        half = 1 << k
        most = np.maximum(most[:-half], most[half:])  # over 2 * half places from here on
    return np.flatnonzero((ranks > most[:len(ranks)]) & (ranks >= most[reach + 1:reach + 1 + len(ranks)]) & (ranks > 0))


def _short_features(texts: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features that SHORT adds, and the number of the text of each."""
    hashes, text = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for window, reach, below in SHORT:
        some = np.array([k for k, t in enumerate(texts) if window <= len(t) < below], np.int64)
        if not len(some):
            continue
        sizes = np.array([len(texts[k]) for k in some])
        raw = np.frombuffer(b"".join(texts[k] for k in some), np.uint8)
        owner, valid = _inside(len(raw), np.cumsum(sizes) - sizes, window)
        words = np.zeros((len(owner), 16), np.uint8)
        words[:, :window] = np.lib.stride_tricks.sliding_window_view(raw, window)
        words = words.view(np.uint64) + np.uint64(window)
        words = (words ^ (words >> np.uint64(31))) * ODD[:2]
        made = (words ^ (words >> np.uint64(29))).sum(axis=1, dtype=np.uint64)
        if reach:
            level = levels(raw, window)
            ties = ((made * ODD[2]) >> np.uint64(32)).astype(np.int64)
            chosen = _peaks(np.where(valid & (level > 0), (rank[level] + 1 << 32) + ties, 0), reach)
        else:
            chosen = np.flatnonzero(valid)
        hashes.append(made[chosen])
        text.append(some[owner[chosen]])
    return np.concatenate(hashes), np.concatenate(text)


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[bytes]:
    """Chained filters of each text, 256 bytes each; ``rank`` by level, rare ones high. Empty texts have none.

    Level 0 (one byte all over) is no feature. A text without features is a feature as a whole.
    """
    out = [b""] * len(texts)
    for raw, number, start in streams(texts):
        owner, valid = _inside(len(raw), start)
        level = levels(raw)
        ranks = np.where(valid & (level > 0), rank[level] + 1, 0) if len(level) else level
        chosen = np.zeros(0, np.int64)
        if len(ranks):
            chosen = _peaks(ranks, REACH)
        hashes, text = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(chosen):
            words = raw[chosen[:, None] + np.arange(WINDOW)].view(np.uint64)
            words = (words ^ (words >> np.uint64(31))) * ODD
            hashes, text = (words ^ (words >> np.uint64(29))).sum(axis=1), owner[chosen]
        more, whose = _short_features([texts[k] for k in number], rank)
        if len(more):
            hashes, text = np.concatenate([hashes, more]), np.concatenate([text, whose])
            order = np.argsort(text, kind="stable")
            hashes, text = hashes[order], text[order]
        bare = np.setdiff1d(np.arange(len(number)), text)
        bare = [b for b in bare.tolist() if texts[number[b]]]
        if bare:
            whole = [int.from_bytes(hashlib.blake2b(texts[number[b]], digest_size=8).digest(), "little") for b in bare]
            hashes, text = np.concatenate([hashes, np.array(whole, np.uint64)]), np.concatenate([text, np.array(bare)])
            order = np.argsort(text, kind="stable")
            hashes, text = hashes[order], text[order]
        if not len(text):
            continue
        hashes = (hashes ^ (hashes >> np.uint64(32))) * ODD[0]
        counts = np.bincount(text, minlength=len(number))
        filters = -(-counts // PER_FILTER)
        place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        row = np.repeat(np.cumsum(filters) - filters, counts) + place // PER_FILTER
        bits = np.zeros((int(filters.sum()), BITS), bool)
        for j in range(HASHES):
            bits[row, ((hashes >> np.uint64(9 + 11 * j)) & np.uint64(BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits, axis=1).tobytes()
        cuts = (np.concatenate([[0], np.cumsum(filters)]) * (BITS // 8)).tolist()
        for k, n in enumerate(number.tolist()):
            out[n] = packed[cuts[k]:cuts[k + 1]]
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> float:
    """Mean, by bits, over filters of ``a`` of the best normalised overlap with a filter of ``b``."""
    na, nb, total = a.sum(axis=1), b.sum(axis=1), 0.0
    for at in range(0, len(a), 256):
        best = np.zeros(len(a[at:at + 256]))
        for to in range(0, len(b), 1024):
            both = a[at:at + 256] @ b[to:to + 1024].T
            chance = np.outer(na[at:at + 256], nb[to:to + 1024]) / BITS
            most = np.minimum.outer(na[at:at + 256], nb[to:to + 1024])
            best = np.maximum(best, ((both - chance) / np.maximum(most - chance, 1e-9)).max(axis=1))
        total += float((np.clip(best, 0, 1) * na[at:at + 256]).sum())
    return total / float(na.sum())


def likeness(left: list[bytes], right: list[bytes]) -> list[float]:
    """0 to 1 for each pair of fingerprints; 1 if equal (two empty ones too), 0 if only one is empty."""
    out = [1.0 if a == b else 0.0 for a, b in zip(left, right)]
    size = BITS // 8
    single = [k for k, (a, b) in enumerate(zip(left, right)) if len(a) == len(b) == size and a != b]
    if single:
        a, b = (np.frombuffer(b"".join(side[k] for k in single), np.uint64).reshape(len(single), -1) for side in (left, right))
        both, na, nb = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a & b, a, b))
        chance, most = na * nb / BITS, np.minimum(na, nb)
        for k, s in zip(single, np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0, 1).tolist()):
            out[k] = s
    for k, (x, y) in enumerate(zip(left, right)):
        if x != y and x and y and len(x) + len(y) > 2 * size:
            a, b = (np.unpackbits(np.frombuffer(z, np.uint8).reshape(-1, size), axis=1).astype(np.float32) for z in (x, y))
            out[k] = (_scores(a, b) + _scores(b, a)) / 2
    return out


def rarity(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Rank of every entropy level over all windows of all texts (the rarest highest, of equals the higher level), and all bytes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = np.zeros(LEVELS + 1, np.int64), 0
        for batch in batches:
            texts = [t for t in utf8(batch.column(0)) if t]
            size += sum(map(len, texts))
            for raw, _, start in streams(texts):
                _, valid = _inside(len(raw), start)
                total += np.bincount(levels(raw)[valid], minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, LEVELS + 1)), pa.array(np.concatenate([[size], total]))], ["level", "n"])

    sums = docs.select(docs[text].cast("string")).mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    counts = dict(sums.collect())
    by_level = np.array([counts.get(k, 0) for k in range(LEVELS + 1)])
    rank = np.empty(LEVELS + 1, np.int64)
    rank[np.lexsort((np.arange(LEVELS + 1), -by_level))] = np.arange(LEVELS + 1)
    return rank, counts.get(-1, 0)


def edited_pairs(docs: DataFrame, part_bytes: int = 8 << 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike it is to that and to the next document.

    Returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row. The
    next document is the one with the next smaller id, after the smallest the largest; rows with equal ids follow by the
    hash of their text, null ids (whole numbers otherwise) come last. The edited text replaces the last third (rounded
    down, in code points) by the first as many of the next document, or all of it if it is shorter. Null texts are empty, and an empty text's fingerprint is
    empty. One row alone is its own next. No rows give no rows.

    Documents are dealt into ranges of ids of about ``part_bytes``, by approximate quantiles; the first document of each
    range goes to the range before it, too. The driver holds two numbers for each range.
    """
    rank, size = rarity(docs, text)
    parts = max(1, math.ceil(size / part_bytes))
    low = -(1 << 63)
    base = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[doc_id].cast("long"), F.lit(low)).alias("place"),
                       F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    shares = [k / parts for k in range(1, parts)]
    found = base.agg(F.percentile_approx("place", shares, max(10_000, 10 * parts))).first()[0] if shares else None
    bounds = np.unique(np.array(found or [], np.int64))

    def own(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, places, side="right")

    def firsts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, int] = {}
        for batch in batches:
            places = batch.column(0).to_numpy(zero_copy_only=False)
            for p, at in zip(own(places).tolist(), places.tolist()):
                best[p] = max(best.get(p, low), at)
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array(list(best.values()), pa.int64())], ["part", "first"])

    first = sorted((r.part, r.first) for r in base.select("place").mapInArrow(firsts_of, "part long, first long")
                   .groupBy("part").agg(F.max("first").alias("first")).collect())
    # the largest id of a range is next to the smallest of the range above; that of the topmost to the smallest of all
    guests = sorted((at, first[(k + 1) % len(first)][0]) for k, (_, at) in enumerate(first))
    guest_place, guest_part = (np.array([g[j] for g in guests], np.int64) for j in (0, 1))

    @F.udf("array<long>", useArrow=True)
    def ranges(place: int) -> list[int]:
        out = [int(np.searchsorted(bounds, place, side="right"))]
        k = int(np.searchsorted(guest_place, place))
        return out + [int(guest_part[k])] if k < len(guest_place) and guest_place[k] == place else out

    dealt = base.select("doc_id", "place", "text", text_hash(F.col("text")).alias("h"), F.posexplode(ranges("place")).alias("guest", "part"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("guest", "ascending"), ("place", "descending"), ("h", "ascending")]).combine_chunks()
        n = sum(1 for g in table.column("guest").to_pylist() if not g)
        texts = table.column("text").to_pylist()[:n + 1]
        edited = [a[:len(a) - len(a) // 3] + b[:len(a) // 3] for a, b in zip(texts, texts[1:])]
        prints = fingerprints([t.encode() for t in texts], rank)
        raw = [t.encode() for t in edited]
        changed = fingerprints(raw, rank)
        return pa.table({
            "doc_id": table.column("doc_id").slice(0, n), "n_chars": pa.array([len(t) for t in texts[:n]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in raw], pa.string()),
            "fingerprint": pa.array([p.hex() for p in prints[:n]], pa.string()),
            "edited_fingerprint": pa.array([p.hex() for p in changed], pa.string()),
            "near_edited": pa.array(likeness(prints[:n], changed), pa.float64()),
            "near_next": pa.array(likeness(prints[:n], prints[1:]), pa.float64())})

    kind = docs.schema[doc_id].dataType.simpleString()
    return dealt.groupBy("part").applyInArrow(compare, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                              "edited_fingerprint string, near_edited double, near_next double")
