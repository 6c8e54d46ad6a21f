"""Token ids of whole texts, cut into pieces; shared by packing and by the training-order files.

The vocabulary file is a parameter and is opened on the workers. Ids equal those of one call of the
``tokenizers`` library on the whole text: that tokenizer drops white space and never joins what white space
parts, so chunks between blanks are encoded once for each worker and looked up afterwards.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from obsledger.llm.common import process_cache, trimmed

CHUNKS = 600_000  # entries that a worker remembers, unless told otherwise
# Below U+0250 all Unicode versions agree on letters, and (but for U+0130) lower-casing maps letters to single letters.
ODD = re.compile("[İɐ-\U0010ffff]")
LETTERS = "a-zªµºß-öø-ÿāăąćĉċčďđēĕėęěĝğġģĥħĩīĭįıĳĵķĸĺļľŀłńņňŋōŏőœŕŗřśŝşšţťŧũūŭůűųŵŷźżžſ"
MARKS = ".,;:!?|"
PLAIN = re.compile(f"[{LETTERS}]+[{MARKS}]*")


class Memory(dict):
    """Chunk -> number; unknown chunks get the next number and are noted."""

    def __init__(self, entries: int):
        super().__init__({"": 0})
        self.unknown: list[str] = []
        self.ids, self.used = np.zeros(1 << 20, "<u4"), 0  # ids of all chunks, one after the other
        self.start, self.size = np.zeros(entries, np.int64), np.zeros(entries, np.int64)

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.unknown.append(chunk)
        return number

    def shrink(self, n: int) -> None:
        """Forget all but the first ``n`` chunks; frequent ones come early."""
        for chunk in list(self)[n:]:
            del self[chunk]
        self.used = int((self.start[:n] + self.size[:n]).max())

    def add(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), "<u4")])
        if len(self) > len(self.start):  # more chunks in one batch of texts than are kept between batches
            more = np.zeros(2 * len(self) - len(self.start), np.int64)
            self.start, self.size = np.concatenate([self.start, more]), np.concatenate([self.size, more])
        self.ids[self.used:self.used + len(ids)] = ids
        self.start[numbers] = self.used + np.cumsum(sizes) - sizes
        self.size[numbers] = sizes
        self.used += len(ids)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered chunks, one after the other, and where each one's ids end."""
        sizes = self.size[numbers]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        return self.ids[np.arange(total) + np.repeat(self.start[numbers] - (stops - sizes), sizes)], stops


class Encoder:
    """Encode texts to little-endian unsigned 32-bit ids, with a bounded memory of chunks."""

    def __init__(self, path: str, entries: int = CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # the word route needs ids of words that never span white space, and word ends that can be seen in the vocabulary
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.by_word = str(self.tokenizer.model).startswith("BPE") and bool(self.tokenizer.model.end_of_word_suffix)
        self.ends = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        if self.by_word:
            suffix = self.tokenizer.model.end_of_word_suffix
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        # plain words need no normalizing and no pattern; a lighter pipeline serves if it agrees on a sample
        self.light = self.tokenizer
        if self.by_word:
            light = Tokenizer(self.tokenizer.model)
            light.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            sample = " ".join("abcdefghijklmnopqrstuvwxyzàéîõüßþœșž"[a:b] for a in range(36) for b in range(a + 1, 37, 5))
            if self._ids(sample).tolist() == light.encode(sample).ids:
                self.light = light
        self.entries, self.memory = entries, Memory(entries)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self) -> None:
        """Encode the unknown chunks. A word and the marks behind it are encoded apart: the tokenizer parts them anyway."""
        # flat lists: millions of small tuples would keep the garbage collector busy
        memory, words, odd, marked = self.memory, [], [], []
        unknown, first = memory.unknown, len(memory) - len(memory.unknown)
        for number, chunk in enumerate(unknown, first):  # words and marks not met alone are appended
            if not PLAIN.fullmatch(chunk):
                odd.append(number)
            elif chunk[-1] in MARKS:
                word = chunk.rstrip(MARKS)
                marked += number, memory[word], memory[chunk[len(word):]]
            else:
                words.append(number)
        memory.unknown = []
        for at in range(0, len(words), 2000):
            numbers = words[at:at + 2000]
            text = " ".join([unknown[n - first] for n in numbers])
            ids = np.array(self.light.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1 if len(ids) else np.zeros(0, np.int64)
            if len(stops) == len(numbers) and stops[-1] == len(ids):
                memory.add(np.array(numbers), ids, np.diff(stops, prepend=0))
            else:
                odd += numbers
        for at in range(0, len(odd), 2000):
            numbers = odd[at:at + 2000]
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast([unknown[n - first] for n in numbers], add_special_tokens=False)]
            memory.add(np.array(numbers), np.array(list(chain.from_iterable(encoded)), "<u4"),
                       np.fromiter(map(len, encoded), np.int64, len(encoded)))
        if marked:
            parts = np.array(marked).reshape(-1, 3)
            ids, stops = memory.gather(parts[:, 1:].ravel())
            memory.add(parts[:, 0], ids, np.diff(stops[1::2], prepend=0))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes."""
        if not self.by_word:
            return [self._ids(t).tobytes() for t in texts]
        parted = [(t if ODD.search(t) else t.lower()).replace("\n", " ").split(" ") for t in texts]
        if len(self.memory) > self.entries * 2 // 3 and len(self.memory) + sum(map(len, parted)) // 4 > self.entries:
            self.memory.shrink(self.entries // 2)
        memory, words = self.memory, np.fromiter(map(len, parted), np.int64, len(parted))
        at = np.fromiter(map(memory.__getitem__, chain.from_iterable(parted)), np.int64, int(words.sum()))
        if memory.unknown:
            self.learn()
        ids, stops = memory.gather(at)
        raw = ids.tobytes()
        cuts = [0, *(4 * np.concatenate([[0], stops])[np.cumsum(words)]).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


def encoder(path: str, entries: int = CHUNKS) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    cache = process_cache("encoders")
    if (path, entries) not in cache:
        cache.clear()
        cache[path, entries] = Encoder(path, entries)
    return cache[path, entries]


def pieces(docs: DataFrame, path: str, most: int, end_id: int = 0, doc_id: str = "doc_id", text: str = "text",
           width: int = 0, more: tuple[str, Callable] | None = None, entries: int = CHUNKS) -> DataFrame:
    """Pieces of at most ``most`` ids: doc_id, piece, start, length, ids_crc32 and, with a ``width``, ids in so many bytes each.

    ``more`` adds columns in the same pass: their schema, and a function of a batch's ids and piece numbers. A document's
    ids are those of its text (null: none) and then ``end_id``; so each row of ``docs``, repeated or
    not, gives at least one piece. A null id stays null. No rows give no pieces. A worker remembers ``entries`` chunks.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * bool(width) + (f", {more[0]}" if more else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(path, entries).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            at, piece, start, length, crc, raw = [], [], [], [], [], []
            encoded = (e for n in range(0, len(texts), 500) for e in encode(texts[n:n + 500]))
            for row, whole in enumerate(encoded):
                whole += last
                if width:
                    own = np.frombuffer(whole, "<u4")
                    if int(own.max()) >> (8 * width):
                        raise ValueError(f"id {own.max()} needs more than {width} bytes")
                    narrow = own.astype(f"<u{width}").tobytes()
                for k, a in enumerate(range(0, len(whole), 4 * most)):
                    part = whole[a:a + 4 * most]
                    at.append(row)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if width:
                        raw.append(narrow[a // 4 * width:a // 4 * width + len(part) // 4 * width])
            columns = [ids.take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if width:
                columns.append(pa.array(raw, pa.binary()))
                names.append("ids")
            if more:
                columns += map(pa.array, more[1](columns[0], columns[1].to_numpy()))
                names += [part.split()[0] for part in more[0].split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(docs[doc_id], docs[text].cast("string")).mapInArrow(trimmed(cut), schema)
