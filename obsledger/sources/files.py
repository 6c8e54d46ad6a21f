"""File sources and sinks: CSV, parquet, JSON documents, model folders."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsledger.operators.reshape import latest_version
from obsledger.roles import OBSERVATION_SCHEMA


def read_observations(spark: SparkSession, path: str, schema: StructType | None = OBSERVATION_SCHEMA,
                      na: str = "NA") -> DataFrame:
    """CSV with a header; ``na`` is missing. Pass ``schema=None`` to infer the types (one more scan)."""
    reader = spark.read.option("header", True).option("nullValue", na)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Read parquet, CSV (with header) or JSON files."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write parquet, CSV (with header) or JSON files."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_doc(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per row."""
    df.write.mode(mode).json(path)


def read_doc(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_latest(spark: SparkSession, path: str, version: str = "version", fmt: str = "parquet") -> DataFrame:
    """Newest version of a table partitioned by ``version``: versions are read off the folders' names, only one folder's files are opened.

    Versions are compared as Spark types them (numbers, dates or text). A table without such folders is searched by value.
    """
    table = spark.read.format(fmt).load(path)
    mark = f"{version}="
    folders = {part[len(mark):] for file in table.inputFiles() for part in file.split("/") if part.startswith(mark)}
    folders.discard("__HIVE_DEFAULT_PARTITION__")
    if not folders:
        return latest_version(table, version)
    kind = table.schema[version].dataType
    named = spark.createDataFrame([(f, unquote(f)) for f in sorted(folders)], "folder string, name string")
    newest = named.orderBy(F.col("name").cast(kind).desc(), "name").first()["folder"]
    rows = spark.read.format(fmt).schema(table.schema).option("basePath", path).load(f"{path}/{mark}{unquote(newest)}")
    return rows.select(*table.columns)


def save_model(model, path: str) -> None:
    """MLlib models are written as model folders, parameter frames as parquet."""
    if isinstance(model, DataFrame):
        model.write.mode("overwrite").parquet(path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_extracts(frames: Mapping[str, DataFrame], out_dir: str) -> list[str]:
    """Dashboard extracts: one CSV folder per frame; returns the folders."""
    paths = []
    for name, df in frames.items():
        paths.append(f"{out_dir}/{name}")
        write_table(df, paths[-1], "csv")
    return paths
