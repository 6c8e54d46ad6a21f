"""The queries of this subpackage: each operator on its whole table, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.llm import oracles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Place of the word-end vocabulary; it is read where it lies, on every executor."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())


@query("op2_lattice_near_duplicates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.lattice import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_simhash_near_duplicates")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.simhash import near_duplicates
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_toxicity_ordinal")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.toxicity import fit, score
    docs = table(spark, sf_dir, "documents")
    found = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "severity", "grade", "p_toxic", F.col("rejected").alias("toxic"), "rejected")


@query("op5_compression_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.language import held_out, identify, learn
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.col("lang").alias("lang_sure"))


@query("op6_super_kmer_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.superkmer import remove_repeats
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("other.doc_id", "n_words", "n_removed", "kept_sha256")


@query("op7_training_order")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.trainorder import write_in_order
    return write_in_order(table(spark, sf_dir, "documents"), vocabulary())


@query("op8_improbable_digest")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.digest import edited_pairs
    return edited_pairs(table(spark, sf_dir, "documents"))


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query("op9_association_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.urlrules import judge
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), RULES)


@query("op10_source_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obsledger.llm.mixing import mix
    found, _ = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "shards")


@query("op12_byte_pair_queue")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and the text decoded from them, as digests."""
    from obsledger.llm.bpe import digest, encode
    found = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(), ids="ids", decoded="decoded")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.col("ids")).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_conversation_repair", oracles.CONVERSATIONS)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and then repaired: its faults, the cheapest edits and a digest of the result."""
    from obsledger.llm.dialogue import damage, plan, with_digest
    rows = table(spark, sf_dir, "conversations")
    damaged = damage(rows)
    return with_digest(damaged, plan(damaged, rows.select("conv_id")))


@query("op11_phrase_collocations", oracles.COLLOCATIONS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language over all documents."""
    from obsledger.llm.phrases import collocations
    return collocations(table(spark, sf_dir, "documents"), least=100, top=2000)
