"""Phrases of 2 to 5 words that occur together more often than their parts suggest, counted exactly per language.

First the words are counted. Frequent ones get numbers, the most frequent the least; rare ones cannot be part of a frequent
phrase and end a run of words. Then every place in a run puts its next five words into a burst trie: a shallow trie
of word numbers over hash containers of counts, where a container that grows too large bursts into one for each next word. When
the trie is full, whole subtrees leave it as sorted runs, cut by the range of prefixes they belong to; each range merges its runs
and sums the counts of all prefixes. A prefix is the first two words; where these make up a large share of all words (64 words
at most can), it reaches on to the third, fourth and fifth word, so that no range takes one phrase's every occurrence, and the
sums of such prefixes are added up over the ranges.

The workers get the numbers of at most ``LEXICON`` words. If more are frequent, the others are named by 64-bit hashes, under a
salt for which a count shows that no two words share one. What is counted does not depend on it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsledger.llm.common import trimmed, utf8
from obsledger.session import cut_lineage

LEXICON = 1 << 18  # words whose numbers are sent to the workers
LONGEST = 5
BURST = 4096  # phrases in a container before it bursts
FULL = 700_000  # phrases in a trie before subtrees leave it
HOT = 64  # a word with more than this part of all words lengthens the prefix
RANGE = 2_000_000  # words counted by one range of prefixes
STEP = 2 << 20  # bytes of text worked on at once
GAP = b"\xff"  # stands for the end of a piece; no UTF-8 text holds it
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + GAP * 10)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Language and words (pieces parted by GAP) of a batch's texts, some megabytes at a time."""
    by_lang: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
        if text:
            by_lang.setdefault(lang, []).append(text)
            sizes[lang] += len(text)
            if sizes[lang] > STEP:
                yield lang, _words(by_lang.pop(lang))
                sizes[lang] = 0
    for lang, texts in by_lang.items():
        yield lang, _words(texts)


def _words(texts: list[bytes]) -> list[bytes]:
    return b"\n".join(texts).translate(FOLD).replace(GAP, b" \xff ").split()


def _plain(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].cast("string").alias("text"))


def count_words(docs: DataFrame, lang: str = "lang", text: str = "text", most: int = 400_000) -> DataFrame:
    """(lang, word, n): occurrences of each word; the row whose word is null holds all of the language's.

    A-Z are lower-cased, pieces end at ``. , ; : ! ?`` and line ends, blanks and tabs part words. A null language is ``und``; null
    and empty texts have no words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                found.pop(GAP, None)
                words, n = list(found), list(found.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(n) + 1), pa.string()), pa.array([*words, None], pa.binary()).cast(pa.string()),
                     pa.array([*n, sum(n)], pa.int64())], ["lang", "word", "n"])
            counts.clear()

        for batch in batches:
            for lang, words in _chunks(batch):
                counts.setdefault(lang, Counter()).update(words)
                if sum(map(len, counts.values())) > most:
                    yield from emptied()
        yield from emptied()

    return _plain(docs, lang, text).mapInArrow(trimmed(run), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Inner(dict):
    """Node of the shallow part: number of the next word -> container (a Counter of the remaining words) or Inner."""


class BurstTrie:
    """Counts of five-word suffixes, as rows of word numbers padded with zeros."""

    def __init__(self, width: int, burst: int = BURST):
        self.kind, self.width, self.burst = np.dtype(f">u{width}"), width, burst
        self.root, self.size = Inner(), 0

    def add(self, rows: np.ndarray) -> None:
        if len(rows):
            self._insert(self.root, rows[np.argsort(rows[:, 0], kind="stable")], 0)

    def _insert(self, node: Inner, rows: np.ndarray, depth: int) -> None:
        """``rows`` in order of their word at ``depth``."""
        words = rows[:, depth]
        cuts = [0, *(np.flatnonzero(words[1:] != words[:-1]) + 1).tolist(), len(rows)]
        size = (rows.shape[1] - 1 - depth) * self.width
        raw = rows[:, depth + 1:].astype(self.kind).tobytes()
        for word, a, b in zip(words[cuts[:-1]].tolist(), cuts, cuts[1:]):
            child = node.get(word)
            if type(child) is Inner:
                part = rows[a:b]
                self._insert(child, part[np.argsort(part[:, depth + 1], kind="stable")], depth + 1)
                continue
            if child is None:
                child = node[word] = Counter()
            before = len(child)
            child.update([raw[p:p + size] for p in range(a * size, b * size, size)])
            self.size += len(child) - before
            if len(child) > self.burst and depth + 3 < rows.shape[1]:
                node[word] = self._burst(child)

    def _burst(self, container: Counter) -> Inner:
        inner, width = Inner(), self.width
        for suffix, n in container.items():
            word = int.from_bytes(suffix[:width], "big")
            child = inner.get(word)
            if child is None:
                child = inner[word] = Counter()
            child[suffix[width:]] = n
        return inner

    def _weight(self, node) -> int:
        return sum(map(self._weight, node.values())) if type(node) is Inner else len(node)

    def _entries(self, node, prefix: bytes, keys: list[bytes], counts: list) -> None:
        if type(node) is Inner:
            for word, child in node.items():
                self._entries(child, prefix + word.to_bytes(self.width, "big"), keys, counts)
        else:
            keys.append(b"".join(map(prefix.__add__, node)))
            counts.extend(node.values())

    def take(self, left: int) -> tuple[np.ndarray, np.ndarray]:
        """Remove whole subtrees, the largest first, until ``left`` phrases stay; their rows and counts."""
        weights = sorted(((self._weight(child), word) for word, child in self.root.items()), reverse=True)
        keys: list[bytes] = []
        counts: list[int] = []
        for weight, word in weights:
            if self.size <= left:
                break
            self._entries(self.root.pop(word), word.to_bytes(self.width, "big"), keys, counts)
            self.size -= weight
        return np.frombuffer(b"".join(keys), self.kind).reshape(-1, LONGEST), np.array(counts, np.int64)


def prefix_lengths(rows: np.ndarray, hot: int) -> np.ndarray:
    """Words of each row that name its range: two, and one more for each further word while all so far are hot."""
    lengths, all_hot = np.full(len(rows), 2), np.ones(len(rows), bool)
    for j in range(LONGEST - 1):
        all_hot &= (rows[:, j] > 0) & (rows[:, j] <= hot)
        if j:
            lengths += all_hot
    return lengths


def _ranges(rows: np.ndarray, hot: int, ranges: int) -> np.ndarray:
    lengths, h = prefix_lengths(rows, hot), np.full(len(rows), 0x9E3779B97F4A7C15, np.uint64)
    for j in range(LONGEST):
        mixed = (h ^ rows[:, j].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h = np.where(j < lengths, mixed ^ (mixed >> np.uint64(29)), h)
    return ((h >> np.uint64(20)) % np.uint64(ranges)).astype(np.int32)


def _text_keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings, whose order is that of the numbers."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1] * rows.itemsize}").ravel()


def _packed(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run, byte by byte column-wise: neighbours are alike, so it compresses well."""
    planes = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1).T
    return pa.Codec("zstd", 1).compress(planes.tobytes() + counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def _unpacked(run: bytes, n: int, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    size = LONGEST * kind.itemsize
    raw = np.frombuffer(pa.Codec("zstd").decompress(run, n * (size + 8), asbytes=True), np.uint8).reshape(-1, n)
    return np.ascontiguousarray(raw[:size].T).view(kind), np.ascontiguousarray(raw[size:].T).view("<i8").ravel()


def _suffixes(numbers: np.ndarray) -> np.ndarray:
    """The next five words of each place that has at least two; zeros stand behind the end of a run."""
    padded, rows = np.concatenate([numbers, np.zeros(LONGEST, numbers.dtype)]), []
    alive = np.ones(len(numbers), bool)
    for j in range(LONGEST):
        word = padded[j:j + len(numbers)]
        alive = alive & (word > 0)
        rows.append(np.where(alive, word, 0))
    return np.stack(rows, 1)[rows[1] > 0]


class Numbers(dict):
    """Word -> number; a word without one gets its hash if ``salt`` is given."""

    def __init__(self, lang: str, words: dict, salt: str | None):
        super().__init__(words)
        self.seed = None
        if salt is not None:
            import xxhash
            self.hash = xxhash.xxh64_intdigest
            self.seed = self.hash(lang.encode(), self.hash(salt.encode(), 42))

    def __missing__(self, word: bytes) -> int:
        return 0 if word == GAP else self.hash(word, self.seed) | 1 << 63

    def of(self, words: list[bytes], kind: str) -> np.ndarray:
        found = map(self.get, words, repeat(0)) if self.seed is None else map(self.__getitem__, words)
        return np.fromiter(found, kind, len(words))


def _merged(rows: np.ndarray, counts: np.ndarray, least: int, hot: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, phrases, counts) of all prefixes of at least ``least``; all prefixes of all hot words, which other ranges share."""
    order = np.argsort(_text_keys(rows), kind="stable")  # merges the sorted runs
    rows, counts = rows[order], counts[order]
    starts = np.ones(len(rows), bool)
    starts[1:] = rows[1:, 0] != rows[:-1, 0]
    for length in range(2, LONGEST + 1):
        starts[1:] |= rows[1:, length - 1] != rows[:-1, length - 1]
        at = np.flatnonzero(starts)
        sums, found = np.add.reduceat(counts, at), rows[at]
        shared = prefix_lengths(found, hot) > length
        keep = (found[:, length - 1] > 0) & ((sums >= least) | shared)
        yield length, found[keep][:, :length], sums[keep]


def count_phrases(docs: DataFrame, least: int = 100, lang: str = "lang", text: str = "text", lexicon: int = LEXICON,
                  full: int = FULL, burst: int = BURST, per_range: int = RANGE) -> tuple[DataFrame, DataFrame, int]:
    """(words, phrases, width): frequent words (key, lang, word, f, n) and frequent phrases (key, f) of 2 to 5 words.

    A key is the numbers of its words, ``width`` bytes each. Both hold exact counts of at least ``least``; n is the number of
    all words of the language.
    """
    spark = docs.sparkSession
    counted = cut_lineage(count_words(docs, lang, text))
    totals = counted.where(F.col("word").isNull()).select("lang", F.col("n").alias("all"))
    everything = totals.agg(F.sum("all")).first()[0] or 0
    frequent = counted.where((F.col("n") >= least) & F.col("word").isNotNull())
    top = frequent.orderBy(F.col("n").desc(), "lang", "word").limit(lexicon).toArrow()
    complete = frequent.count() <= lexicon
    width, salt = (4, None) if complete else (8, 0)
    hot = sum(n * HOT > everything for n in top.column("n").to_pylist())
    numbered = spark.createDataFrame(
        pa.table([top.column("lang"), top.column("word"), pa.array(range(1, top.num_rows + 1), pa.int64())], ["lang", "word", "number"]),
        "lang string, word string, number long")
    named = (counted.where(F.col("word").isNotNull()) if salt is not None else frequent).join(numbered, ["lang", "word"], "left")
    while salt is not None:  # never taken twice unless two of all words share a hash
        hashed = F.xxhash64(F.lit(str(salt)), "lang", "word").bitwiseOR(F.lit(-1 << 63))
        named = named.withColumn("number", F.coalesce("number", hashed))
        if named.groupBy("number").count().where("count > 1").isEmpty():
            break
        salt += 1
        named = counted.where(F.col("word").isNotNull()).join(numbered, ["lang", "word"], "left")
    key = F.unhex(F.lpad(F.hex("number"), 2 * width, "0"))
    words = named.where(F.col("n") >= least).join(totals, "lang").select(
        key.alias("key"), "lang", "word", F.col("n").alias("f"), F.col("all").alias("n"))

    lists: dict[str, dict[bytes, int]] = {}
    for k, (a, b) in enumerate(zip(top.column("lang").to_pylist(), top.column("word").to_pylist()), 1):
        lists.setdefault(a, {})[b.encode("utf-8")] = k
    shared = spark.sparkContext.broadcast(lists)  # at most ``lexicon`` words
    ranges, kind = max(1, -(-everything // per_range)), np.dtype(f">u{width}")
    salted = None if salt is None else str(salt)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, Numbers] = {}
        trie = BurstTrie(width, burst)

        def runs(left: int) -> Iterator[pa.RecordBatch]:
            rows, counts = trie.take(left)
            at = _ranges(rows, hot, ranges)
            order = np.lexsort((_text_keys(rows), at))
            rows, counts, at = rows[order], counts[order], at[order]
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)] if len(at) else [0]
            for k in range(0, len(cuts) - 1, 64):
                pairs = list(zip(cuts[k:k + 64], cuts[k + 1:k + 65]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[[a for a, _ in pairs]], pa.int32()), pa.array([b - a for a, b in pairs], pa.int64()),
                     pa.array([_packed(rows[a:b], counts[a:b]) for a, b in pairs], pa.binary())], ["at", "size", "run"])

        for batch in batches:
            for lang, words in _chunks(batch):
                if lang not in numbers:
                    numbers[lang] = Numbers(lang, shared.value.get(lang, {}), salted)
                trie.add(_suffixes(numbers[lang].of(words, f"u{width}")))
                if trie.size > full:
                    yield from runs(full // 2)
        yield from runs(0)

    def merge(table: pa.Table) -> pa.Table:
        parts = [_unpacked(run, n, kind) for n, run in zip(table.column("size").to_pylist(), table.column("run").to_pylist())]
        keys, counts = [], []
        for length, found, sums in _merged(np.concatenate([p[0] for p in parts]).astype(kind), np.concatenate([p[1] for p in parts]), least, hot):
            raw, size = np.ascontiguousarray(found).tobytes(), length * width
            keys += [raw[p:p + size] for p in range(0, len(raw), size)]
            counts.append(sums)
        return pa.table([pa.array(keys, pa.binary()), pa.array(np.concatenate(counts), pa.int64())], ["key", "f"])

    runs = _plain(docs, lang, text).mapInArrow(trimmed(collect), "at int, size long, run binary").repartition(ranges, "at")
    sums = runs.groupBy("at").applyInArrow(merge, "key binary, f long")
    phrases = sums.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return cut_lineage(words), cut_lineage(phrases), width


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, within: int = 100, lang: str = "lang", text: str = "text",
                 **limits) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    A candidate is a phrase of 2 to 5 words with a = its count >= ``least``. It is dropped if a longer candidate around
    it has ``within`` percent of its count (one word longer is enough: longer ones have no more). Cut after its first k words
    it scores floor(1000 a n / (l r)), l and r the counts of both parts; the lowest cut counts, of equals the first. Order: score, a
    descending, then phrase by bytes. Numbers are exact (38 digits). Rows repeated in ``docs`` count as often; a null language is
    ``und``; null and empty texts add nothing; empty tables give no rows; other columns are ignored.
    """
    words, phrases, width = count_phrases(docs, least, lang, text, **limits)
    size = F.length("key")
    longer = phrases.where(size >= 3 * width).select(
        F.explode(F.array(F.substring("key", F.lit(1), size - width), F.substring("key", F.lit(width + 1), size - width))).alias("key"), F.col("f").alias("g"))
    around = longer.groupBy("key").agg(F.max("g").alias("g"))
    kept = phrases.join(around, "key", "left").where(F.col("g").isNull() | (100 * F.col("g") < within * F.col("f"))).select("key", F.col("f").alias("a"))
    parts = phrases.union(words.select("key", "f"))
    cut = F.col("k") * width
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), (size / width).cast("int") - 1))).select(
        "key", "a", "k", F.substring("key", F.lit(1), cut).alias("first"), F.substring("key", cut + 1, size - cut).alias("rest"),
        F.substring("key", F.lit(1), F.lit(width)).alias("word_key"))
    scored = (cuts.join(parts.toDF("first", "l"), "first").join(parts.toDF("rest", "r"), "rest")
              .join(words.select(F.col("key").alias("word_key"), "lang", "n"), "word_key"))
    exact = "decimal(38,0)"
    product = F.lit(1000).cast(exact) * F.col("a").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")
    scored = scored.withColumn("top", product.cast(exact)).withColumn("under", F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)"))
    scored = scored.withColumn("score", F.expr("top div under"))
    best = scored.groupBy("key").agg(F.min(F.struct("score", "k", "a", "l", "r", "n", "lang")).alias("best")).select("key", "best.*")
    spelled = best.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), (size / width).cast("int") - 1),
                                                          lambda j: F.substring("key", j * width + 1, F.lit(width)))).alias("place", "word_key"))
    texts = (spelled.join(words.select(F.col("key").alias("word_key"), "word"), "word_key").groupBy("key")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda p: p["word"]), " ").alias("phrase")))
    found = best.join(texts, "key").withColumn("part", F.xxhash64("key") % 64)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    for keys in (["lang", "part"], ["lang"]):  # a language's phrases are cut in parts first
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
