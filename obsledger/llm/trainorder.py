"""Token ids as binary files in training order.

A sequence's number is its document's id times the most pieces that any document can have, plus its piece; a keyed Feistel
network over the next power of four, walked until it lands inside the range of numbers, permutes them. Equal ranges of permuted numbers are
the shards: each is sorted and written by one task, at a fixed stride (a header and ids padded with 0). A sequence's global slot is
its place in that order, without gaps: the records of the shards before, and its place in its own. So the place of any slot is a
product, and a reader resumes by seeking. The ids are shuffled once and kept nowhere else.

A shard is written under a temporary name and then renamed; retries write the same bytes.

Record: doc_id (int64, the least one for null), piece (int32), number of ids (int32), ids (uint16, or uint32 if the
vocabulary needs it), all little-endian.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsledger.llm.tokens import pieces
from obsledger.session import checkpoint_dir, cut_lineage

ROUNDS = 6
NO_ID = -(1 << 63)


def _round_keys(key: int) -> np.ndarray:
    return np.random.default_rng(key).integers(0, 1 << 63, ROUNDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _network(x: np.ndarray, half: int, keys: np.ndarray, back: bool = False) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask

    def mixed(v: np.ndarray, k: np.uint64) -> np.ndarray:
        h = (v + k) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (h ^ (h >> np.uint64(32))) & mask

    for k in keys[::-1] if back else keys:
        left, right = (right ^ mixed(left, k), left) if back else (right, left ^ mixed(right, k))
    return (left << np.uint64(half)) | right


def permute(numbers: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """Slot of each number in a keyed permutation of 0 to n - 1; ``back`` gives the number of each slot."""
    x, keys = numbers.astype(np.uint64), _round_keys(key)
    half = max(1, math.ceil(math.ceil(math.log2(max(n, 2))) / 2))
    x = _network(x, half, keys, back)
    while (out := np.flatnonzero(x >= n)).size:  # at most 4 times as many values as numbers: a few steps
        x[out] = _network(x[out], half, keys, back)
    return x.astype(np.int64)


def stride(ids: int, width: int) -> int:
    return 16 + ids * width


def _file_system(uri: str):
    from pyarrow import fs
    uri = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    return fs.FileSystem.from_uri(uri)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def write_in_order(docs: DataFrame, vocabulary: str, folder: str | None = None, most: int = 512, shard_bytes: int = 16 << 20,
                   key: int = 20, width: int = 2, entries: int = 1_000_000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents' pieces of at most ``most`` ids; one row for each with its slot, shard and byte offset.

    Returns (doc_id, piece, start, length, ids_crc32, slot, shard, byte_offset). A document ends with id 0; null and empty texts
    are that id alone. Rows that repeat an id (whole numbers; null is one) are written each, in the order of their ids' checksums.
    Files of about ``shard_bytes`` lie in ``folder``, or in a new folder beside the checkpoints, and are complete when this returns.
    ``width`` 2 refuses ids above 65535. A worker remembers the ids of ``entries`` chunks of text. No rows give no rows and no files.
    """
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/training-order-{uuid.uuid4().hex}"
    size = F.octet_length(docs[text].cast("string"))
    low, high, longest, total = docs.agg(F.min(docs[doc_id]), F.max(docs[doc_id]), F.max(size), F.sum(size)).first()
    # an id stands for a byte at least, so this many pieces are enough for any document
    fold, low, high = ((longest or 0) + 1) // most + 1, low or 0, high or 0
    span = (high - low + 2) * fold
    if span >= 1 << 62:
        raise ValueError("ids too far apart for one permutation; number the documents first")
    shards = max(1, math.ceil((total or 0) / 2.5 * width / shard_bytes))

    def placed(ids: pa.Array, piece: np.ndarray) -> list[np.ndarray]:
        number = ids.cast(pa.int64()).fill_null(high + 1).to_numpy() - low
        order = permute(number * fold + piece, span, key)
        return [order, np.searchsorted(edges, order, side="right") - 1]

    edges = np.array([span * k // shards for k in range(shards)], np.int64)
    kind = docs.schema[doc_id].dataType.simpleString()
    named = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    cut = pieces(docs, vocabulary, most, doc_id=doc_id, text=text, width=width, more=("order long, shard long", placed), entries=entries)

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("ids_crc32", "ascending")]).combine_chunks()
        record = np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("length", "<i4"), ("ids", f"S{most * width}")])
        out = np.zeros(table.num_rows, record)
        out["doc_id"] = [NO_ID if i is None else i for i in table.column("doc_id").to_pylist()]
        out["piece"], out["length"] = table.column("piece").to_numpy(), table.column("length").to_numpy()
        out["ids"] = table.column("ids").to_numpy()  # shorter ones are padded with zero bytes
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        name = shard_name(table.column("shard")[0].as_py())
        passing = f"{base}/.{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(passing) as stream:
            stream.write(out.tobytes())
        system.move(passing, f"{base}/{name}")
        return table.drop_columns(["ids", "order"]).append_column("place", pa.array(np.arange(table.num_rows)))

    written = cut_lineage(cut.groupBy("shard").applyInArrow(write, f"{named}, shard long, place long"))
    counts = written.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("shard").alias("s"), F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("before"))
    # one row for each shard of shard_bytes
    return written.join(F.broadcast(bases), F.col("shard") == F.col("s")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("slot"), "shard",
        (F.col("place") * stride(most, width)).alias("byte_offset"))


def read_from(folder: str, slot: int = 0, most: int = 512, width: int = 2) -> Iterator[tuple]:
    """(slot, doc_id, piece, ids) from a slot on, shard by shard: the sequential reader of one training process."""
    from pyarrow import fs
    system, base = _file_system(folder)
    record, at = stride(most, width), 0
    files = sorted((f for f in system.get_file_info(fs.FileSelector(base)) if f.base_name.startswith("shard-")), key=lambda f: f.path)
    for file in files:
        n = file.size // record
        if slot < at + n:
            with system.open_input_file(file.path) as stream:
                stream.seek((slot - at) * record)
                while raw := stream.read(record):
                    doc, (piece, length) = int(np.frombuffer(raw, "<i8", 1)[0]), np.frombuffer(raw, "<i4", 2, 8).tolist()
                    yield slot, None if doc == NO_ID else doc, piece, np.frombuffer(raw, f"<u{width}", length, 16).tolist()
                    slot += 1
        at += n
