"""Storing results exactly once: rows are staged under an attempt, and one small file publishes them under a key.

Writing is in two steps. The rows of an attempt go to a folder of their own; then a commit file names the key and the attempt. Readers
see published attempts only, and of each key the one published first, so a step that is retried, run twice at a time or
lost in the middle leaves the same table. A key stands for its rows: the same key must always be given the same result.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMIT = "key string, attempt string, published double"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(key, attempt) of what counts: each key's first published attempt."""
    try:
        found = spark.read.schema(COMMIT).option("recursiveFileLookup", True).json(f"{path}/commits")
    except AnalysisException:  # nothing is published yet
        return spark.createDataFrame([], "key string, attempt string")
    return found.groupBy("key").agg(F.min_by("attempt", F.struct("published", "attempt")).alias("attempt"))


def stage(df: DataFrame, path: str) -> str:
    """Write rows under a new attempt, which no reader sees yet; returns its name."""
    attempt = uuid.uuid4().hex
    df.write.parquet(f"{path}/rows/attempt={attempt}")
    return attempt


def publish(spark: SparkSession, path: str, key: str, attempt: str) -> None:
    """Make an attempt count for ``key``, unless another one does already. One file appears, whole or not at all."""
    row = spark.createDataFrame([(key, attempt, time.time())], COMMIT)
    row.coalesce(1).write.json(f"{path}/commits/{attempt}")


def append_once(df: DataFrame, path: str, key: str) -> bool:
    """Append rows under ``key``; a key that is there already is left as it is and costs no work. True if rows were added."""
    spark = df.sparkSession
    if not commits(spark, path).where(F.col("key") == key).isEmpty():
        return False
    publish(spark, path, key, stage(df, path))
    return True


def read_committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All published rows, with the key they were stored under as ``commit_key``; folders of other attempts are not read."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = commits(spark, path).toDF("commit_key", "attempt")
    try:
        rows = spark.read.schema(StructType([*schema.fields, *StructType.fromDDL("attempt string").fields])).option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    except AnalysisException:
        return spark.createDataFrame([], StructType([*schema.fields, *StructType.fromDDL("commit_key string").fields]))
    return rows.join(kept, "attempt").drop("attempt")
