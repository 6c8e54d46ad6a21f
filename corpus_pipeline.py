"""From raw documents to packed sequences: toxicity, near duplicates, repeated passages, mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all rows it is given and returns all that it keeps. The first four
return the columns of ``documents``; the last one the pieces of the packed sequences. Nulls, empty texts, repeated rows
and empty tables follow the rules that the operators state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from obsledger.llm import mixing, packing, registered, simhash, superkmer, toxicity
from obsledger.session import checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on this input's labelled rows, does not reject."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, registered.table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates.

    Near are two texts whose 64-bit SimHash fingerprints over three-word shingles differ in at most 2 bits; groups are
    connected by such pairs. All of them are found, however many rows there are.
    """
    return simhash.deduplicate(docs, shingle=3, distance=2)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of 20 words that also start earlier; every document stays."""
    return superkmer.without_repeats(docs, n_chars="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each copy drawn, dealt out by shard and shuffled there."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack_documents(docs, registered.vocabulary())


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates),
          ("substring_dedup", drop_repeated_passages), ("source_mixing", mix_sources), ("best_fit_packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}-{name}")
    return docs
