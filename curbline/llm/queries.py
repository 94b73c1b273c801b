"""The registered queries of the corpus operators: whole tables in, the contract's columns out."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import (
    decontamination,
    infilling,
    jaccard,
    language,
    licenses,
    merkle,
    mixing,
    pii,
    pivots,
    quality_rules,
    repeats,
    sharding,
    weak_labels,
)
from curbline.session import freeze


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.is_contaminated().alias("contaminated"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.coalesce(F.array_max("matches.dice"), F.lit(0.0)).alias("dice"),
    )


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), keep_first=False)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.learn(docs))
    kinds = F.array(*[F.lit(kind) for kind in pii.KINDS])

    def joined(spans: str) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
        )

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op5_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = weak_labels.learn_labels(docs)
    return weak_labels.classify(docs, labels, weak_labels.learn_scorer(docs, labels))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = docs.where(F.col("doc_id").isNotNull() & ~language.held_out("doc_id"))
    found = language.identify(docs, language.learn(learned))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "text", sharding.text_bytes("text").alias("size"))
    sized = sized.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    placed = sharding.histogram_sort(sized, 24, size=F.col("size"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count("text").alias("size"), F.xxhash64("text").alias("tie"))
    return mixing.mix(freeze(sized), tie="tie").select("doc_id", "size", "source_size", "target", "taken")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    report = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = quality_rules.cascade(docs, quality_rules.estimate(docs), report)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select(
        "doc_id", *report, failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept")
    )


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _, _ = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pivots.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op12_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infilling.infill(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infilling.restore(), 256).alias("restored_sha256"),
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    # a null id is not tampered with
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    leaf = merkle.leaf_hash([*fields, "text"])
    leaves = docs.select(
        "doc_id",
        "lang",
        leaf.alias("leaf"),
        F.when(hit, merkle.leaf_hash([*fields, lowered])).otherwise(leaf).alias("changed"),
    )
    found = merkle.fold(merkle.build(leaves, "leaf", "lang", "doc_id"), "changed")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_licenses": op2_licenses,
    "op3_repeats": op3_repeats,
    "op4_pii": op4_pii,
    "op5_weak_labels": op5_weak_labels,
    "op6_language": op6_language,
    "op7_sharding": op7_sharding,
    "op8_mixing": op8_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_jaccard": op10_jaccard,
    "op11_pivot_search": op11_pivot_search,
    "op12_infilling": op12_infilling,
    "op13_manifest": op13_manifest,
}
