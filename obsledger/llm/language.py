"""Language identification by compression.

For every language a raw-content dictionary is put together from a bounded sample of labelled texts. A text is cut
into blocks, each block is compressed with each dictionary, and the language with the smallest total wins. A narrow
margin between the best two rejects.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.llm.common import process_cache

UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id is held out of nothing."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def dictionary(texts: list[str], size: int) -> bytes:
    """Blocks from all texts in turn, then the frequent words, most frequent last: near content is cheapest to name."""
    counts = Counter(w for t in texts for w in t.split())
    frequent = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:4000]]
    tail = " ".join(reversed(frequent)).encode()[-size // 4:]
    raw, parts, total, turn = [t.encode() for t in texts], [], 0, 0
    while total < size - len(tail) and any(len(r) > 256 * turn for r in raw):
        for r in raw:
            part = r[256 * turn:256 * turn + 256]
            if part and total < size - len(tail):
                parts.append(part)
                total += len(part)
        turn += 1
    return b" ".join([*reversed(parts), b" " + tail])


def learn(docs: DataFrame, sample_rows: int = 400, size: int = 96 << 10, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", learn_from: Column | None = None) -> dict[str, bytes]:
    """Dictionaries of ``size`` bytes by language, from about ``sample_rows`` texts of each, drawn by a hash of the id.

    Only rows with a text, a language and ``learn_from`` (default: not ``held_out``) count. Languages are the distinct
    values of ``lang``; the driver holds one dictionary for each.
    """
    fit = ~held_out(docs[doc_id]) if learn_from is None else learn_from
    usable = docs.where(fit & docs[lang].isNotNull() & (F.length(F.trim(docs[text])) > 0)).select(
        docs[lang].alias("lang"), F.xxhash64(docs[doc_id], docs[text]).alias("h"), docs[text].alias("text"))
    totals = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # a share of the hash range that holds about sample_rows rows of the language
    share = F.least(F.lit(1.0), sample_rows / F.col("n"))
    drawn = usable.join(F.broadcast(totals), "lang").where(
        F.pmod("h", F.lit(1 << 40)) < share * float(1 << 40)).select("lang", "h", "text")
    texts: dict[str, list] = {}
    for r in drawn.collect():
        texts.setdefault(r.lang, []).append((r.h, r.text))
    return {k: dictionary([t for _, t in sorted(v)], size) for k, v in sorted(texts.items())}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = 0.01, block: int = 2048, level: int = 9,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, lang) of every row.

    lang_pred is the language whose dictionary compresses the whole text smallest (ties: the first by name), ``und``
    if the text is null or has no letter, or if there are no dictionaries. score, from 0 to 1, is that language's share of
    evidence: 1 / (1 + exp(-saved / 8)) for the bytes saved against the second best, 0 for ``und``. lang is lang_pred, but ``und`` where the
    saving is below ``margin`` of the smallest size. Repeated rows get equal results. No rows give no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    key = hash(tuple(sorted(dictionaries.items())))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        cache = process_cache("language")
        if cache.get("key") != (key, level):
            cache.clear()
            cache["key"], cache["of"] = (key, level), {}
            for name, raw in dictionaries.items():
                made = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                made.precompute_compress(level=level)
                cache["of"][name] = zstandard.ZstdCompressor(level=level, dict_data=made, write_content_size=False, write_dict_id=False)
        of = cache["of"]
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                if not of or not t or not any(map(str.isalpha, t)):
                    out.append((UNKNOWN, 0.0, UNKNOWN))
                    continue
                raw = t.encode("utf-8", "surrogatepass")
                blocks = [raw[a:a + block] for a in range(0, len(raw), block)]
                sizes = {name: sum(map(len, map(c.compress, blocks))) for name, c in of.items()}
                best, *others = sorted(sizes, key=sizes.__getitem__)
                saved = sizes[others[0]] - sizes[best] if others else sizes[best]
                out.append((best, float(1 / (1 + np.exp(-min(saved, 400) / 8))),
                            best if saved >= margin * sizes[best] else UNKNOWN))
            pred, score, lang = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(lang, pa.string())], ["doc_id", "lang_pred", "score", "lang"])

    return docs.select(docs[doc_id], docs[text].cast("string")).mapInArrow(
        judged, f"doc_id {kind}, lang_pred string, score double, lang string")
