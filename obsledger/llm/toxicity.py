"""Toxicity by ordinal regression: cumulative links with shared weights over ordered thresholds.

P(severity > j) = sigmoid(w . x - t_j) with t_0 < t_1 < ...; x holds log(1 + count) of the words and leading
characters of words that labelled documents prove to be tied to toxic ones. The expected severity is the sum of
these probabilities. Labels say toxic or not; toxic documents are graded by how many flagged words they hold (grade 2
from the median on), so that a model of severity can be learned.

The model is fitted on at most ``sample_rows`` labelled rows; feature counts are aggregated on the executors, and
the driver sees the sparse rows of the sample and at most ``max_features`` features. Scoring is one pass without a
shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.common import process_cache, text_hash, trimmed
from obsledger.session import cut_lineage

EDGE = " .,;:!?|\"'`()[]{}<>-–—…*_«»“”‘’¡¿/\\#"
HEADS = (4, 5, 6)
WORDS = 300_000  # words whose features a worker remembers


def features(word: str) -> list[str]:
    """Features of one word: itself and its first 4, 5 and 6 characters, if it has more."""
    word = word.lower().strip(EDGE)
    return [f"={word}", *(f"^{word[:n]}" for n in HEADS if len(word) > n)] if word else []


@dataclass
class Severity:
    """A fitted model; without features every text has severity 0."""

    index: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    name: str = ""

    def counts(self, text: str, cache: dict) -> Counter:
        """Feature number -> count over the whole text."""
        words = text.split()
        missing = {w for w in words if w not in cache}
        if missing:
            if len(cache) > WORDS:
                cache.clear()
                missing = set(words)
            get = self.index.get
            for w in missing:
                cache[w] = tuple(i for i in map(get, features(w)) if i is not None) or None
        out: Counter = Counter()
        for found in filter(None, map(cache.__getitem__, words)):
            out.update(found)
        return out

    def above(self, counts: Counter) -> np.ndarray:
        """P(severity > j) for every threshold."""
        at = sum(self.weights[i] * np.log1p(c) for i, c in counts.items())
        return 1 / (1 + np.exp(np.clip(self.thresholds - at, -500, 500)))


def fit_ordinal(rows: list[tuple[list[int], list[float]]], grades: np.ndarray, n_features: int, ridge: float = 1.0,
                steps: int = 800, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the cumulative-link model, by full-batch Adam steps."""
    at = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    col = np.array([i for index, _ in rows for i in index], np.int64)
    val = np.array([v for _, values in rows for v in values], float)
    levels = int(grades.max())
    share = [np.clip((grades > j).mean(), 1e-6, 1 - 1e-6) for j in range(levels)]
    start = np.array([np.log((1 - s) / s) for s in share])
    # thresholds are the first one and logarithms of the gaps, which keeps them ordered
    params = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    mean, square, n = np.zeros_like(params), np.zeros_like(params), len(rows)
    low, high = np.maximum(grades - 1, 0), np.minimum(grades, levels - 1)
    for step in range(1, steps + 1):
        w, gaps = params[:n_features], np.exp(params[n_features + 1:])
        t = params[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        u = np.bincount(at, weights=w[col] * val, minlength=n)[:, None] - t
        s = 1 / (1 + np.exp(-np.clip(u, -30, 30)))
        upper = np.where(grades > 0, s[np.arange(n), low], 1.0)
        lower = np.where(grades < levels, s[np.arange(n), high], 0.0)
        p = np.maximum(upper - lower, 1e-12)
        d_up = np.where(grades > 0, upper * (1 - upper), 0) / p
        d_low = np.where(grades < levels, lower * (1 - lower), 0) / p
        slope = d_up - d_low
        g_t = np.bincount(low, weights=d_up, minlength=levels)[:levels] - np.bincount(high, weights=d_low, minlength=levels)[:levels]
        g_w = -np.bincount(col, weights=slope[at] * val, minlength=n_features) + ridge * w
        tail = np.cumsum(g_t[::-1])[::-1]
        grad = np.concatenate([g_w, tail[:1], tail[1:] * gaps]) / n
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
        params = params - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return params[:n_features], params[n_features] + np.concatenate([[0], np.cumsum(np.exp(params[n_features + 1:]))])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, max_features: int = 20_000,
        least_tie: float = 20.0, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Severity:
    """Fit on at most ``sample_rows`` labelled documents, drawn by a hash of their id.

    Labels without an id or a value are ignored, of several labels for one id the most toxic counts. A feature is
    used if documents with it are toxic more often than others by a likelihood ratio of ``least_tie`` or more. With
    no toxic or no other labelled document the model is empty.
    """
    named = labels.select(labels[doc_id].alias("i"), labels[toxic].alias("y")).where("i IS NOT NULL AND y IS NOT NULL")
    drawn = named.groupBy("i").agg(F.max("y").cast("int").alias("y")).orderBy(F.xxhash64("i"), "i").limit(sample_rows)
    value = docs[text].cast("string")
    # the drawn labels are at most sample_rows pairs of numbers
    sample = cut_lineage(docs.select(docs[doc_id].alias("i"), value.alias("t")).where("t IS NOT NULL")
                         .join(F.broadcast(drawn), "i").select("t", "y"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic_docs, other = Counter(), Counter()
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {f for w in set(t.split()) for f in features(w)}
                (toxic_docs if y > 0 else other).update(own)
                (toxic_docs if y > 0 else other).update([""])
        names = list(toxic_docs.keys() | other.keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic_docs[f] for f in names], pa.int64()),
                                          pa.array([other[f] for f in names], pa.int64())], ["f", "a", "b"])

    tallied = cut_lineage(sample.mapInArrow(trimmed(tally), "f string, a long, b long").groupBy("f")
                          .agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a >= 3 OR f = ''"))
    totals = tallied.where("f = ''").first()
    if totals is None or not totals.a or not totals.b:
        return Severity()
    # twice the log likelihood ratio of the feature's two shares against one common share
    a, b, rest_a, rest_b, total = F.col("a"), F.col("b"), totals.a - F.col("a"), totals.b - F.col("b"), totals.a + totals.b

    def part(n, row, column):
        return F.when(n > 0, n * F.log(n * total / (row * column))).otherwise(0.0)

    tie = 2 * (part(a, a + b, F.lit(totals.a)) + part(b, a + b, F.lit(totals.b))
               + part(rest_a, rest_a + rest_b, F.lit(totals.a)) + part(rest_b, rest_a + rest_b, F.lit(totals.b)))
    chosen = (tallied.where((F.col("f") != "") & (a * totals.b > b * totals.a)).withColumn("tie", tie)
              .where(F.col("tie") >= least_tie).orderBy(F.desc("tie"), "f").limit(max_features).select("f").collect())
    if not chosen:
        return Severity()
    model = Severity({r.f: i for i, r in enumerate(chosen)})

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            found = [model.counts(t, cache) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(1), pa.array([list(c.keys()) for c in found], pa.list_(pa.int32())),
                pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], ["y", "i", "c"])

    rows = sample.mapInArrow(vectors, "y int, i array<int>, c array<int>").collect()
    words = {i for f, i in model.index.items() if f[0] == "="}
    hits = np.array([sum(c for i, c in zip(r.i, r.c) if i in words) + 0.5 * bool(r.i) for r in rows])
    is_toxic = np.array([r.y > 0 for r in rows])
    grades = np.where(is_toxic, 1 + (hits >= max(1.0, np.median(hits[is_toxic]))), 0)
    model.weights, model.thresholds = fit_ordinal([(r.i, list(np.log1p(r.c))) for r in rows], grades, len(chosen))
    model.name = repr((model.weights.sum(), model.thresholds.tolist(), len(chosen)))
    return model


def score(docs: DataFrame, model: Severity, doc_id: str = "doc_id", text: str = "text", limit: float = 0.5) -> DataFrame:
    """(doc_id, text_hash, severity, grade, p_toxic, rejected) of every row.

    severity is the expected grade, p_toxic the probability of any grade above 0, rejected p_toxic >= ``limit``.
    Texts that are null or have no words have severity 0 and are not rejected; so has everything under an empty
    model. Repeated rows get equal results. No rows give no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = process_cache("toxicity " + model.name)
        for batch in batches:
            out = []
            for t in batch.column(2).to_pylist():
                if not t or not len(model.thresholds) or not t.strip():
                    out.append((0.0, 0, 0.0, False))
                    continue
                above = model.above(model.counts(t, cache))
                p = -np.diff(np.concatenate([[1.0], above, [0.0]]))
                out.append((float(above.sum()), int(p.argmax()), float(above[0]), bool(above[0] >= limit)))
            severity, grade, chance, rejected = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(severity, pa.float64()), pa.array(grade, pa.int32()),
                pa.array(chance, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "text_hash", "severity", "grade", "p_toxic", "rejected"])

    value = docs[text].cast("string")
    return docs.select(docs[doc_id], text_hash(value).alias("text_hash"), value).mapInArrow(
        scored, f"doc_id {kind}, text_hash long, severity double, grade int, p_toxic double, rejected boolean")


def without_toxic(docs: DataFrame, model: Severity, text: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows that ``score`` rejects; every other row stays as it is, repeated ones too."""
    at = docs.columns.index(text)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = process_cache("toxicity " + model.name)
        for batch in batches:
            keep = [not t or not t.strip() or not len(model.thresholds)
                    or model.above(model.counts(t, cache))[0] < limit for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(trimmed(passed), docs.schema)
