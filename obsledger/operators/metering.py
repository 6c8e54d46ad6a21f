"""Metric rows of a job: seconds of its steps, rows they scored, sizes of models, and measures found on the way."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsledger.roles import METRIC_SCHEMA


class Meter:
    """Collects (run_id, model_name, metric, value) rows of one run."""

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark, self.run_id = spark, run_id
        self._rows: list[tuple[str, str, str, float]] = []
        self._seen: list[tuple[str, str, Observation]] = []

    def value(self, model: str, metric: str, number: float | None) -> None:
        """Add one measure; a missing one is left out."""
        if number is not None:
            self._rows.append((self.run_id, model, metric, float(number)))

    def values(self, model: str, measures: Mapping[str, float | None]) -> None:
        for metric, number in measures.items():
            self.value(model, metric, number)

    def step(self, model: str, metric: str, action: Callable):
        """Run ``action`` and add the seconds it took. It must do its work, not only plan it."""
        start = time.perf_counter()
        result = action()
        self.value(model, metric, time.perf_counter() - start)
        return result

    def watch(self, df: DataFrame, model: str, metric: str = "rows_scored") -> DataFrame:
        """The same rows; their number is counted as they pass the first action that reads them."""
        seen = Observation()
        self._seen.append((model, metric, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def size(self, model: str, parameters: DataFrame, metric: str = "model_size") -> None:
        """Bytes of a model's parameter rows, written as JSON lines."""
        size = parameters.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 1)).first()[0]
        self.value(model, metric, size or 0)

    def rows(self) -> DataFrame:
        """All rows so far. Every watched frame must have been read by an action: its count is waited for."""
        read = [(self.run_id, model, metric, float(seen.get["n"])) for model, metric, seen in self._seen]
        return self.spark.createDataFrame([*self._rows, *read], METRIC_SCHEMA)
