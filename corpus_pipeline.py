"""A training corpus from documents: toxicity, line dedup, near-duplicates, decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontamination, line_dedup, packing, simhash, toxicity
from cadenza.llm.common import hinted, settle
from cadenza.llm.suite import tokenizer_paths, toxicity_model

#: No SQL for the learned first stage and the tokens of the last.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go; the model learns from the labelled ones."""
    model = toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of equal and near-equal lines go; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs).drop("n_lines", "n_dropped", "n_near")
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: one of those with the smallest id.

    Repeated rows of one id are copies and leave one. Rows with a null id take part under a hash
    of their text, behind all ids (which must be below 2 ** 62).
    """
    hashed = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 62)) + F.lit(1 << 62)
    keyed = docs.withColumn("__key", F.coalesce("doc_id", hashed))
    found = settle(simhash.near_duplicates(keyed, "__key"), "near-duplicates")
    others = found.where("id <> component").select(F.col("id").alias("__key")).distinct()
    kept = keyed.join(others, "__key", "left_anti")
    repeated = settle(found.where("id = component").groupBy("id").count().where("count > 1").select(F.col("id").alias("__key")), "repeated")
    if not repeated.isEmpty():
        # Only the texts of repeated rows are shuffled.
        again = kept.join(hinted(repeated), "__key", "left_semi").dropDuplicates(["__key"])
        kept = kept.join(hinted(repeated), "__key", "left_anti").unionByName(again)
    return kept.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with enough words inside benchmark windows go, those with a null id too."""
    found = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = settle(found.where("contaminated").select(F.col("key").alias("__key")).distinct(), "contaminated")
    keyed = docs.withColumn("__key", decontamination.row_key("doc_id", "text"))
    return keyed.join(bad, "__key", "left_anti").select(docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents in sequences of 2048."""
    return packing.pack(docs, *tokenizer_paths()).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each settled before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
