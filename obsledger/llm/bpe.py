"""Byte-pair encoding of whole texts by a priority queue of merges, and decoding by the vocabulary's strings.

A word starts as a doubly linked list of one symbol a byte. All neighbouring pairs that the vocabulary merges wait in a
heap, ordered by rank and then place. The least one is taken; if one of its symbols has been merged meanwhile the entry
is stale and skipped, otherwise the two become one and the pairs to its left and right are queued. A word of n bytes
needs O(n log n) steps, however long it is.

Equal to the ``tokenizers`` library with the same file for lower-casing word-end vocabularies: normal form C, lower case,
then words, single digits and runs of other marks. Texts are parted here; chunks with unusual characters (outside
ASCII and the Latin letters below U+0180) are normalized and parted by the library's own tables, since letters differ
between Unicode versions. Merging is done here for all of them. The vocabulary file is opened on the workers where it lies.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from obsledger.llm.common import fresh, process_cache, trimmed
from obsledger.llm.tokens import Memory

WORDS = 400_000  # distinct words that a worker remembers between texts
STEP = 1 << 20  # characters worked on at once
LOW = (1 << 32) - 1
UNUSUAL = re.compile("[^\t\n\r\x20-~\xa1-įı-ſ]")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"  # fixed value: the vocabulary's own pattern


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def plain_pattern() -> re.Pattern:
    """The same pattern for lower-case characters below U+0180, its classes written out: the plain engine is faster."""
    letters, digits = ("".join(c for c in map(chr, range(0x180)) if regex.match(kind, c)) for kind in (r"\p{L}", r"\p{N}"))
    return re.compile(PATTERN.replace(r"\p{L}+", f"[{letters}]+").replace(r"|\p{N}|", f"|[{digits}]|").replace(r"\p{L}\p{N}", letters + digits))


class Vocabulary:
    """Merges and strings of a vocabulary file, with a bounded memory of words."""

    def __init__(self, path: str, words: int = WORDS):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, self.suffix = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        top = max(chain(ids.values(), self.special.values()))
        strings = [""] * (top + 1)
        for token, i in chain(ids.items(), self.special.items()):
            strings[i] = token
        self.strings = pa.array(strings, pa.string())
        symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.inner = [ids[s] for s in symbols]
        self.last = [ids[s + self.suffix] for s in symbols]
        self.merges: dict[int, int] = {}  # pair of ids -> rank and the merged symbol's id, 32 bits each
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merges[ids[a] << 32 | ids[b]] = rank << 32 | ids[a + b]
        self.library = Tokenizer.from_file(path)
        marks = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.marks = re.compile(f"({marks})") if marks else None
        self.parts = plain_pattern()
        self.chunks = re.compile(r"[^\t\n\r ]+")
        self.words, self.memory = words, Memory(words)

    def merge(self, word: str) -> list[int]:
        """Ids of one word: the queue of merges over the linked symbols.

        An entry is one number, rank before new id before place, so the heap compares ranks first and then places.
        """
        raw, get = word.encode("utf-8"), self.merges.get
        inner = self.inner
        ids = [inner[b] for b in raw]
        n = len(ids)
        ids[-1] = self.last[raw[-1]]
        queue, at, left = [], 0, ids[0]
        for right in ids[1:]:
            found = get(left << 32 | right)
            if found is not None:
                queue.append(found << 32 | at)
            left = right
            at += 1
        if not queue:
            return ids
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heapq.heappop(queue)
            at = entry & LOW
            right = after[at]
            if right >= n or ids[at] < 0 or get(ids[at] << 32 | ids[right]) != entry >> 32:
                continue  # stale: a symbol is gone or has grown
            new = entry >> 32 & LOW
            ids[at], ids[right] = new, -1
            following = after[at] = after[right]
            if following < n:
                before[following] = at
                found = get(new << 32 | ids[following])
                if found is not None:
                    heapq.heappush(queue, found << 32 | at)
            previous = before[at]
            if previous >= 0:
                found = get(ids[previous] << 32 | new)
                if found is not None:
                    heapq.heappush(queue, found << 32 | previous)
        return [i for i in ids if i >= 0]

    def split(self, text: str) -> list[str]:
        """Words of a text without special tokens; chunks with unusual characters stay whole and as they are."""
        if not UNUSUAL.search(text):
            return self.parts.findall(text.lower())
        out: list[str] = []
        for chunk in self.chunks.findall(text):
            out += [chunk] if UNUSUAL.search(chunk) else self.parts.findall(chunk.lower())
        return out

    def ids_of(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        if not UNUSUAL.search(word):
            return self.merge(word)
        normal = self.library.normalizer.normalize_str(word) if self.library.normalizer else word
        parts = [bytes(self.byte_of[c] for c in part).decode("utf-8", "surrogatepass")
                 for part, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return list(chain.from_iterable(map(self.merge, parts)))

    def tokens(self, text: str) -> list[str]:
        """Memory keys of a text: words, unusual chunks, and special tokens."""
        if self.marks is None or "<|" not in text:
            return self.split(text)
        return [w for k, part in enumerate(self.marks.split(text)) for w in ([part] if k % 2 else self.split(part))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin (one more for the end)."""
        keys = [self.tokens(t) for t in texts]
        memory = self.memory
        if len(memory) > self.words:
            memory.shrink(self.words // 2)
        count = np.fromiter(map(len, keys), np.int64, len(keys))
        at = np.fromiter(map(memory.__getitem__, chain.from_iterable(keys)), np.int64, int(count.sum()))
        if memory.unknown:
            first = len(memory) - len(memory.unknown)
            found = [self.ids_of(w) for w in memory.unknown]
            memory.unknown = []
            memory.add(np.arange(first, first + len(found)), np.fromiter(chain.from_iterable(found), "<u4"),
                       np.fromiter(map(len, found), np.int64, len(found)))
        ids, stops = memory.gather(at)
        return ids, np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(count)])]

    def decode(self, ids: pa.Array, starts: np.ndarray) -> pa.Array:
        """Texts of runs of ids: their strings, joined by one space when the file names no decoder."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), self.strings.take(ids)), " ")


def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary of a file."""
    cache = process_cache("bpe")
    if path not in cache:
        cache.clear()
        cache[path] = Vocabulary(path)
    return cache[path]


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about STEP bytes together, or one row of more."""
    start = size = 0
    for k, own in enumerate(sizes):
        size += own
        if size >= STEP:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str | None = None, decoded: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text in a further column ``ids`` (array of int; default: a free name).

    ``decoded`` names one more column for the text decoded from these ids, made in the same pass. A null or empty text has
    no ids. Rows are kept as they are: repeated rows, null keys and columns of any name stay. No rows give no rows. Special
    tokens in a text give their own id; truncation and padding are not applied.
    """
    more = [ids or fresh(docs, "ids")[0], *([decoded] if decoded else [])]
    if taken := set(more) & set(docs.columns):
        raise ValueError(f"there are columns {sorted(taken)} already")
    place = docs.columns.index(text)
    fields = [StructField(more[0], ArrayType(IntegerType())), *[StructField(n, StringType()) for n in more[1:]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
            for a, b in _slices(sizes):
                part = batch.slice(a, b - a)
                found, starts = words.encode([t or "" for t in part.column(place).to_pylist()])
                numbers = pa.array(found.astype(np.int32))
                out = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), numbers)]
                if decoded:
                    out.append(words.decode(numbers, starts))
                yield pa.RecordBatch.from_arrays([*part.columns, *out], [*part.schema.names, *more])

    return docs.mapInArrow(trimmed(run), StructType([*docs.schema.fields, *fields]))


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of an array of ids in a further column; null or no ids give an empty text.

    Ids outside the vocabulary end the job with an error; special tokens are kept.
    """
    if text in rows.columns:
        raise ValueError(f"there is a column {text} already")
    place = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            lists = batch.column(place)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            out = words.decode(lists.flatten(), np.concatenate([[0], np.cumsum(lengths)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, text])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(text, StringType())]))


def digest(ids: Column) -> Column:
    """SHA-256 of decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)
