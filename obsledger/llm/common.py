"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPLIT = r"[\x20\x09-\x0D]+"


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names starting with ``bases`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for base in bases:
        name = f"_{base}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def process_cache(name: str) -> dict:
    """A dict that stays in a Python worker from one task to the next; callers bound its size.

    A worker serves one operator after the other, so it keeps the dict of the last name only.
    """
    holder = sys.modules.get("_obsledger_process_cache")
    if holder is None:
        holder = sys.modules["_obsledger_process_cache"] = types.ModuleType("_obsledger_process_cache")
    if getattr(holder, "held", (None,))[0] != name:
        holder.held = (name, {})
    return holder.held[1]


def give_back() -> None:
    """Return freed memory to the system: idle workers of earlier steps stay beside those of the present one."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(work: Callable) -> Callable:
    """The same function over batches, giving back memory when a task is done."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()
    return run


def utf8(column: pa.Array) -> list:
    """Values of a string column as bytes, None where null."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def text_hash(text: Column) -> Column:
    """64-bit hash of a text; a null text hashes like no other text is likely to."""
    return F.xxhash64(text, text.isNull())


def keep_rows(docs: DataFrame, winners: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` named in ``winners`` (its two columns: id, text hash), one row for each name.

    The texts are shuffled once; the reduction to one row uses the partitioning of the join.
    """
    h, i, j = fresh(docs, "h", "i", "j")
    named = winners.toDF(i, j)
    hashed = docs.withColumn(h, text_hash(docs[text]))
    kept = hashed.join(named, hashed[doc_id].eqNullSafe(named[i]) & (hashed[h] == named[j]), "left_semi")
    return kept.dropDuplicates([doc_id, h]).select(*[F.col(f"`{c}`") for c in docs.columns])
