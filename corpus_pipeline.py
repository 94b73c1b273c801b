"""A corpus pipeline of five operators: quality, near duplicates, benchmark, mixture, shards.

Each stage takes all rows that the one before kept, as written to Parquet, and returns the columns of
`documents`; the last adds the shard and the slot. Rows with null ids or texts pass through every
stage that does not reject them: blank texts are rejected by the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import decontamination, jaccard, mixing, sharding, weak_labels
from curbline.session import scratch_path

SHARDS = 24


def row_key() -> Column:
    """Names a row by id and text and sorts by id, nulls last."""
    shifted = F.col("doc_id").cast("decimal(20,0)") + F.expr("9223372036854775808BD")
    number = F.coalesce(F.lpad(shifted.cast("string"), 20, "0"), F.lit("~"))
    return F.concat_ws(":", number, F.md5(F.coalesce("text", F.lit(""))))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the weak-label classifier rejects."""
    labels = weak_labels.learn_labels(docs)
    return weak_labels.good_rows(docs, labels, weak_labels.learn_scorer(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the least id of every group; of rows equal in id and text, one."""
    keyed = docs.withColumn("__key", row_key())
    found, _, _ = jaccard.near_duplicates(keyed, doc_id="__key")
    kept = keyed.join(found.where("__key <> component_id").select("__key"), "__key", "left_anti")
    return kept.dropDuplicates(["__key"]).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows with a twentieth or more of their words inside benchmark windows."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.withColumn("__key", row_key())
    found = decontamination.contamination(keyed, items, doc_id="__key").where(decontamination.is_contaminated())
    return keyed.join(found.select("__key"), "__key", "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and cuts the sources to their targets; n_chars follows a text that is cut."""
    mixed = mixing.mixed_rows(docs)
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.histogram_sort(docs, SHARDS)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mixture),
    ("sharding", shards),
]

# the classifier is learned, which SQL cannot express; tests/llm/test_pipeline.py checks the rest by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
