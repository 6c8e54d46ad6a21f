"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``k`` consecutive words. Its minimiser is the least-ranked ``m``-word gram in it, by a hash of the gram;
frequent grams are ranked behind all others, so that a common line does not gather the windows of every document
around it. Consecutive windows with one minimiser travel as one packed string (their words, joined by blanks) to the
bucket of the minimiser, and equal windows always meet in one bucket. A map task sends each distinct string once,
with its earliest place, so copies of a document or passage collapse before the shuffle. In the bucket all windows
are sorted by a rolling hash, neighbours with equal hashes are compared byte by byte, and the earliest place of each
window is kept.

What comes back to a document are its first-seen windows, not its repeated ones: a passage that a third of all
documents share sends back one row. A document's removed words are those covered by its other windows.

The texts are read twice without a shuffle (gram counts, strings) and shuffled once to meet their windows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.llm.common import give_back, process_cache, text_hash, trimmed, utf8
from obsledger.session import cut_lineage

TILE = 1 << 20  # bytes of text that are hashed at a time
HELD = 40 << 20  # bytes of packed strings that a map task gathers before it sends them
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LAST = (1 << 64) - 1
MARK_BITS = 22
BLANKS = bytes(32 if 9 <= b <= 13 else b for b in range(256))


def tidy(text: bytes | None) -> bytes:
    """The words of a text, parted by one blank."""
    text = (text or b"").translate(BLANKS).strip(b" ")
    return b" ".join(text.split()) if b"  " in text else text


def tiles(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Consecutive texts of about TILE bytes together (a longer one alone): first, after the last."""
    at = 0
    while at < len(texts):
        stop, size = at + 1, len(texts[at])
        while stop < len(texts) and size + len(texts[stop]) < TILE:
            size += len(texts[stop]) + 1
            stop += 1
        yield at, stop
        at = stop


class Words:
    """Words of tidy texts that are not empty: bounds in the joined bytes, text number, and prefix sums that hash any span."""

    def __init__(self, texts: list[bytes]):
        self.joined = b" ".join(texts)
        raw = np.frombuffer(self.joined, np.uint8)
        up, self.down = _powers(len(raw))
        blanks = np.flatnonzero(raw == 32)
        self.start, self.end = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(raw)]])
        self.begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
        self.first = np.searchsorted(self.start, self.begin)  # each text's first word
        self.owner = np.repeat(np.arange(len(texts)), np.diff(np.append(self.first, len(self.start))))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        powered = up[:len(raw)] * raw
        powered += up[:len(raw)]
        np.cumsum(powered, out=self.sums[1:])

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rolling hash of the bytes from the first to the last word."""
        a = self.start[first]
        return (self.sums[self.end[last]] - self.sums[a]) * self.down[a]

    def windows(self, k: int) -> np.ndarray:
        """First words of all windows of ``k`` words inside one text."""
        return np.flatnonzero(self.owner[:max(0, len(self.owner) - k + 1)] == self.owner[k - 1:])

    def grams(self, m: int) -> np.ndarray:
        """63-bit names of the ``m``-word grams at every word but the last m - 1; some cross texts."""
        at = np.arange(len(self.start) - m + 1)
        h = self.hashes(at, at + m - 1) * BASE
        h = (h ^ (h >> np.uint64(29))) * INVERSE
        return (h ^ (h >> np.uint64(32))) >> np.uint64(1)


def minimisers(grams: np.ndarray, k: int, m: int, hot: np.ndarray, marks: np.ndarray | None) -> np.ndarray:
    """Least gram of each window; ``hot`` (sorted names, ``marks`` by their top bits) are ranked last, told by the top bit."""
    if len(hot):
        maybe = np.flatnonzero(marks[grams >> np.uint64(63 - MARK_BITS)])
        at = np.searchsorted(hot, grams[maybe])
        at[at == len(hot)] = 0
        grams[maybe[hot[at] == grams[maybe]]] |= np.uint64(1) << np.uint64(63)
    span, width = grams, 1
    while 2 * width <= k - m + 1:
        span, width = np.minimum(span[:-width], span[width:]), 2 * width
    rest = k - m + 1 - width
    return np.minimum(span[:-rest], span[rest:]) if rest else span


def true_runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """First and past-the-last positions of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2].tolist(), edges[1::2].tolist()


class HeavyGrams:
    """Gram counts of a task in bounded memory: a gram seen only once among ``most`` places is forgotten there."""

    def __init__(self, most: int = 1 << 21):
        self.most, self.total, self.size = most, 0, 0
        self.names, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []

    def add(self, grams: np.ndarray) -> None:
        self.waiting.append(grams)
        self.size += len(grams)
        if self.size > self.most:
            self.settle()

    def settle(self) -> None:
        if not self.size:
            return
        names, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.total, self.waiting, self.size = self.total + self.size, [], 0
        names, counts = names[counts > 1], counts[counts > 1]
        self.names, at = np.unique(np.concatenate([self.names, names]), return_inverse=True)
        self.counts = np.bincount(at, weights=np.concatenate([self.counts, counts])).astype(np.int64)
        if len(self.names) > self.most:
            often = self.counts > np.median(self.counts)
            self.names, self.counts = self.names[often], self.counts[often]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the rolling hash's base and of its inverse; the usual length is kept by the worker."""
    def tables(size: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for base in (BASE, INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            out.append(np.cumprod(table, dtype=np.uint64))
        return out[0], out[1]

    if n >= 2 * TILE:
        return tables(n + 1)
    cache = process_cache("powers")
    if "tables" not in cache:
        cache["tables"] = tables(2 * TILE)
    return cache["tables"]


def first_windows(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each text's windows, and for every window whether it is seen first; texts come in the order of their places."""
    found = []
    for at, stop in tiles(texts):
        words = Words(texts[at:stop])
        first = words.windows(k)
        begin = words.begin[words.owner[first]]
        found.append((words.owner[first] + at, words.start[first] - begin, words.end[first + k - 1] - begin,
                      words.hashes(first, first + k - 1)))
    owner, a, b, value = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(value, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = value[order[1:]] == value[order[:-1]]
    first = np.ones(len(order), bool)
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    repeats = np.flatnonzero(same)
    x, y = order[repeats], order[head[repeats]]
    first[x] = False
    spans = zip(*(c.tolist() for c in (owner[x], a[x], b[x], owner[y], a[y], b[y])))
    unequal = [q for q, (o, s, e, p, t, f) in zip(repeats.tolist(), spans) if texts[o][s:e] != texts[p][t:f]]
    for r in {int(head[q]) for q in unequal}:  # different windows with one hash: settle it by content
        stop, seen = r + 1, set()
        while stop < len(order) and same[stop]:
            stop += 1
        for w in order[r:stop].tolist():
            window = texts[owner[w]][a[w]:b[w]]
            first[w] = window not in seen
            seen.add(window)
    return np.searchsorted(owner, np.arange(len(texts) + 1)), first


def kept_words(words: list[bytes], firsts: list[tuple[int, int]], k: int) -> list[bytes]:
    """``words`` without those in a window that is not among ``firsts`` (start, number of windows)."""
    n = len(words) - k + 1
    if n <= 0 or sum(c for _, c in firsts) == n:
        return words
    sums, repeated = np.zeros(n + 1, np.int64), np.ones(n, bool)
    for s, c in firsts:
        repeated[s:s + c] = False
    np.cumsum(repeated, out=sums[1:])
    j = np.arange(len(words))
    covered = sums[np.minimum(j, n - 1) + 1] > sums[np.maximum(0, j - k + 1)]
    return [w for w, c in zip(words, covered.tolist()) if not c]


def _pack(columns: list[tuple[list, type]], tail: bytes = b"") -> bytes:
    n = np.int64(len(columns[0][0]))
    return b"".join([n.tobytes(), *(np.array(values, kind).tobytes() for values, kind in columns), tail])


def _unpack(raw: bytes, kinds: list[type]) -> tuple[list[list], int]:
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at).tolist())
        at += n * np.dtype(kind).itemsize
    return out, at


# place of the document, 32 bits of its text's hash (to tell rows of one id apart), word number
PLACE = [np.uint64, np.uint32, np.uint32]
LOW = (1 << 32) - 1


def shard_of(place: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Number that spreads documents over result groups, copies of a text too."""
    return (place ^ (h.astype(np.uint64) << np.uint64(20))) & np.uint64((1 << 62) - 1)


def remove_repeats(docs: DataFrame, k: int = 20, m: int = 4, hot_share: float = 1e-6, bucket_bytes: int = 8 << 20,
                   shard_bytes: int = 8 << 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of every document without those in a window of ``k`` words that also starts earlier.

    Returns for each row: other (struct of all columns but the text), text (unchanged if nothing is removed, else the
    kept words joined by one blank), n_words, n_removed, kept_sha256 (of the kept words joined by one blank). Earlier
    is a smaller doc_id (whole numbers; nulls after all others; of equal ids with different texts, the smaller hash of the text)
    or an earlier start in the document. Windows are those of the input. Null texts have no words and stay null.
    Rows that repeat a doc_id and its text are one document and get equal results. Documents of fewer than ``k``
    words lose nothing. No rows give no rows.

    Grams with about ``hot_share`` of all places or more are ranked last; there are at most 2 / hot_share of them, 8
    bytes each, sent to all tasks. Buckets hold about ``bucket_bytes`` of packed text, result groups ``shard_bytes``.
    """
    spark = docs.sparkSession
    value, number = docs[text].cast("string"), docs[doc_id].cast("long")
    other = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("other")
    base = docs.select(other, number.alias("doc_id"), text_hash(value).alias("text_hash"), value.alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, size = HeavyGrams(), 0
        for batch in batches:
            texts = [t for t in map(tidy, utf8(batch.column(0))) if t]
            size += sum(map(len, texts))
            for at, stop in tiles(texts):
                words = Words(texts[at:stop])
                if len(words.start) >= k:
                    inside = words.owner[:len(words.owner) - m + 1] == words.owner[m - 1:]
                    heavy.add(words.grams(m)[inside])
        heavy.settle()
        often = heavy.counts >= max(16, heavy.total * hot_share / 2)
        names = np.concatenate([np.array([-1, -2], np.int64), heavy.names[often].astype(np.int64)])
        counts = np.concatenate([np.array([heavy.total, size], np.int64), heavy.counts[often]])
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts)], ["gram", "n"])

    counted = cut_lineage(base.select("text").mapInArrow(trimmed(count), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    totals = {r[0]: r[1] for r in counted.where("gram < 0").collect()}
    least = max(64, hot_share * totals.get(-1, 0) / 2)
    hot = counted.where((F.col("gram") >= 0) & (F.col("n") >= least)).select("gram").collect()
    ranked_last = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in hot], np.uint64)))
    del hot
    buckets = max(1, math.ceil(3.2 * totals.get(-2, 0) / bucket_bytes))
    shards = max(1, math.ceil(totals.get(-2, 0) / shard_bytes))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=3).compress
        held: dict[int, dict[bytes, tuple]] = {}
        size, last, marks = 0, ranked_last.value, None
        if len(last):
            marks = np.zeros(1 << MARK_BITS, bool)
            marks[last >> np.uint64(63 - MARK_BITS)] = True

        def blobs() -> pa.RecordBatch:
            out = [squeeze(_pack([*zip(zip(*own.values()), PLACE), ([len(p) for p in own], np.uint32)], b"".join(own)))
                   for own in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(out, pa.binary())],
                                              ["bucket", "blob"])

        for batch in batches:
            rows = [(LAST if i is None else i + (1 << 63), h & LOW, t) for i, h, t in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), map(tidy, utf8(batch.column(2)))) if t]
            for at, stop in tiles([t for _, _, t in rows]):
                words = Words([t for _, _, t in rows[at:stop]])
                inside = words.windows(k)
                if not len(inside):
                    continue
                minima = minimisers(words.grams(m), k, m, last, marks)[inside]
                owner = words.owner[inside]
                cuts = np.flatnonzero((minima[1:] != minima[:-1]) | (owner[1:] != owner[:-1])) + 1
                start, final = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(minima)]]) - 1
                mixed = minima[start] * BASE
                bucket = (mixed ^ (mixed >> np.uint64(31))) % np.uint64(buckets)
                first, text = inside[start], owner[start]
                columns = (bucket, text + at, first - words.first[text], words.start[first], words.end[inside[final] + k - 1])
                joined = words.joined
                for key, d, s, x, y in zip(*(c.tolist() for c in columns)):
                    own, packed = held.setdefault(key, {}), joined[x:y]
                    place, h, _ = rows[d]
                    had = own.get(packed)
                    if had is None:
                        size += y - x
                        own[packed] = (place, h, s)
                    elif (place, h, s) < had:
                        own[packed] = (place, h, s)
                if size > HELD:
                    yield blobs()
                    held, size = {}, 0
        if held:
            yield blobs()

    def sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        expand, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        earliest: dict[bytes, tuple] = {}
        for batch in batches:
            for blob in batch.column(batch.schema.get_field_index("blob")).to_pylist():
                raw = expand(blob)
                (*places, sizes), at = _unpack(raw, [*PLACE, np.uint32])
                for place, n in zip(zip(*places), sizes):
                    packed, at = raw[at:at + n], at + n
                    had = earliest.get(packed)
                    if had is None or place < had:
                        earliest[packed] = place
        held = sorted(earliest, key=earliest.__getitem__)
        bounds, first = first_windows(held, k)
        new = np.add.reduceat(first.astype(np.int64), bounds[:-1])
        columns = list(zip(*map(earliest.__getitem__, held)))
        place, h, s = (np.array(c, kind) for c, kind in zip(columns, PLACE))
        whole = np.flatnonzero(new == np.diff(bounds))
        rows, starts, counts = [whole], [s[whole]], [new[whole]]
        for e in np.flatnonzero((new > 0) & (new < np.diff(bounds))).tolist():
            x, y = true_runs(first[bounds[e]:bounds[e + 1]])
            rows.append(np.full(len(x), e))
            starts.append((s[e] + np.array(x)).astype(np.uint32))
            counts.append(np.array(y) - np.array(x))
        row, start, count = (np.concatenate(c) for c in (rows, starts, counts))
        shard = shard_of(place[row], h[row]) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        names, cuts = np.unique(shard[order], return_index=True)
        blobs = []
        for part in np.split(order, cuts[1:]):
            blobs.append(squeeze(_pack([(place[row[part]], np.uint64), (h[row[part]], np.uint32),
                                        (start[part], np.uint32), (count[part], np.uint32)])))
        yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(blobs, pa.binary())], ["shard", "blob"])
        give_back()

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard
        expand, firsts = zstandard.ZstdDecompressor().decompress, {}
        for blob in right.column("blob").to_pylist():
            columns, _ = _unpack(expand(blob), [*PLACE, np.uint32])
            for place, h, s, n in zip(*columns):
                firsts.setdefault((place, h), []).append((s, n))
        texts, n_words, n_removed, digests = [], [], [], []
        rows = zip(left.column("doc_id").to_pylist(), left.column("text_hash").to_pylist(),
                   utf8(left.column("text").combine_chunks()))
        for number, h, t in rows:
            words = (t or b"").split()
            kept = kept_words(words, firsts.get((LAST if number is None else number + (1 << 63), h & LOW), []), k)
            rest = b" ".join(kept)
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(rest).hexdigest())
            texts.append(t if len(kept) == len(words) else rest)
        kind = left.schema.field("text").type
        raw = pa.array(texts, pa.large_binary() if pa.types.is_large_string(kind) else pa.binary())
        give_back()
        return pa.table([left.column("other"), raw.cast(kind), pa.array(n_words, pa.int64()),
                         pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
                        names=["other", "text", "n_words", "n_removed", "kept_sha256"])

    firsts = (base.select("doc_id", "text_hash", "text").mapInArrow(trimmed(send), "bucket long, blob binary")
              .groupBy("bucket").applyInArrow(sort_bucket, "shard long, blob binary"))
    # the same number as shard_of gives
    mixed = F.coalesce("doc_id", F.lit((1 << 63) - 1)).bitwiseXOR(
        F.shiftleft(F.col("text_hash").bitwiseAND(LOW), 20)).bitwiseAND((1 << 62) - 1)
    shard = F.pmod(mixed, F.lit(shards).cast("long"))
    schema = T.StructType([base.schema["other"], T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    return base.withColumn("shard", shard).groupBy("shard").cogroup(firsts.groupBy("shard")).applyInArrow(settle, schema)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = None, **how) -> DataFrame:
    """``docs`` with repeated windows removed from the texts, and ``n_chars``, if named, set anew where that happened.

    Every document stays, with an empty text if nothing is left of it.
    """
    found = remove_repeats(docs, doc_id=doc_id, text=text, **how)
    changed = F.col("n_removed") > 0

    def column(name: str):
        if name == text:
            return F.col("text").alias(name)
        old = F.col("other")[name]
        if name == n_chars:
            kind = docs.schema[name].dataType
            return F.when(changed, F.length("text").cast(kind)).otherwise(old).alias(name)
        return old.alias(name)

    return found.select(*map(column, docs.columns))
