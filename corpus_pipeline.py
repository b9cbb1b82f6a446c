"""A training corpus from raw documents: five stages, each on all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, mixing, quality, secrets
from tidemark.llm.store import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it learns from labelled documents among them."""
    machine = quality.train(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs, machine).filter(F.col("score") >= quality.REJECT_BELOW).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 80 % equal shingles connect, the one with the smallest id; of rows with the same id the smallest one.

    The documents to keep are told by id and number, so only ids are joined; rows without id have no group to stand for and stay.
    """
    found = jaccard.near_components(docs.select("doc_id", "text"))
    gone = found.filter(F.col("id").isNotNull() & (F.col("id") != F.col("component_id"))).select(F.col("id").alias("doc_id")).distinct()
    again = found.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("id").alias("doc_id"))
    rest = docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")
    least = F.min(F.struct(*[c for c in COLUMNS if c != "doc_id"])).alias("row")
    once = rest.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(least).select("doc_id", "row.*")
    return rest.join(again, "doc_id", "left_anti").unionByName(once).select(*COLUMNS)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.find_benchmark(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("not contaminated").select(*COLUMNS)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced and n_chars counted anew where one was."""
    scanned = secrets.scan_secrets(docs.select(*COLUMNS), redact="<secret>")
    return scanned.withColumn("n_chars", F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.length("text"))).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often: size, source_size, target, rate, copies, taken."""
    return mixing.mix_sources(docs.select(*COLUMNS)).filter("copies > 0").select(*COLUMNS, "size", "source_size", "target", "rate", "copies", "taken")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_clean),
    ("secrets", hide_secrets),
    ("mixing", mix),
]

#: A fitted classifier decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written to the shared folder and read again.

    Defined cases: `documents` has the columns COLUMNS, and others are left out; null, empty and white texts are scored like any other, have no near copy, passage or secret, and size 0 in the mix, which takes none of them; of rows
    with the same id the smallest stays, rows without id all do; texts that tie in a group of near copies go by the smallest id; labels or benchmark without rows fit a constant score and find nothing; an empty table gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
