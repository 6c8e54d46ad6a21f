"""Label newly arriving observation files with stored naive Bayes parameters.

Scoring is stateless: every row needs the fitted parameters only, which are a
two-row frame read once per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from obsledger.models.bayes import predict_bayes


def arriving(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def score_arriving(rows: DataFrame, params: DataFrame, features: Sequence[str], out_path: str,
                   progress: str | None = None) -> StreamingQuery:
    """Append scored rows to parquet, processing all files present, then stop.

    The query's progress is kept in the folder ``progress``, by default beside
    the batches, so a later session goes on where this one stopped.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        scored = predict_bayes(batch, params, features)
        scored.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")  # a repeated batch replaces itself

    place = progress or f"{out_path}/_progress"
    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", place)
                .trigger(availableNow=True).start())
