"""The pipeline against brute force after each stage, and over odd rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_decontamination import brute as hits
from test_jaccard import brute as groups

import corpus_pipeline as cp

SF_DIR = "/root/testdata/sf0.001"


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}

    good = cp.quality(spark, docs, SF_DIR).cache()
    kept = sorted(good.collect(), key=lambda r: r["doc_id"])
    ids = {r["doc_id"] for r in kept}
    clean_labels = [doc for doc, quality in labels.items() if quality]
    assert len(ids.intersection(clean_labels)) >= 0.97 * len(clean_labels)
    assert sum(doc in ids for doc, quality in labels.items() if not quality) <= 1

    single = cp.near_duplicates(spark, good, SF_DIR).cache()
    of = groups([r["text"] for r in kept])
    assert {r["doc_id"] for r in single.collect()} == {kept[i]["doc_id"] for i, (_, least) in of.items() if i == least}

    clean = cp.benchmark(spark, single, SF_DIR).cache()
    expected = set()
    for r in single.collect():
        n, hit, _ = hits(r["text"], items)
        if not (hit and 20 * hit >= n):
            expected.add(r["doc_id"])
    assert {r["doc_id"] for r in clean.collect()} == expected

    mixed = cp.mixture(spark, clean, SF_DIR).cache()
    sizes, by_source = Counter(), defaultdict(int)
    for r in clean.collect():
        sizes[r["source"]] += len(r["text"].split())
    for r in mixed.collect():
        by_source[r["source"]] += len(r["text"].split())
    total = sum(sizes.values())
    assert abs(sum(by_source.values()) - total) <= len(sizes)
    assert all(by_source[s] <= 3 * sizes[s] for s in sizes)

    rows = cp.shards(spark, mixed, SF_DIR).collect()
    assert Counter(r["text"] for r in rows) == Counter(r["text"] for r in mixed.collect())
    assert {r["shard"] for r in rows} <= set(range(cp.SHARDS))


@pytest.mark.parametrize("name, stage", cp.STAGES)
def test_odd_rows(spark, odd, empty, folder_of, name, stage):
    items = spark.createDataFrame([(1, "a b c"), (None, None)], "item_id long, text string")
    folder = folder_of(benchmark=items)
    rows = stage(spark, odd.withColumn("size_", F.lit(1)), folder)
    assert rows.count() <= 3 * odd.count()
    assert stage(spark, empty, folder).count() == 0


def test_mixture_passes_clashing_columns(spark, odd):
    added = ("size", "source_size", "target", "copies", "part", "taken")
    docs = odd.withColumns({name: F.lit(f"own {name}") for name in added})
    rows = cp.mixture(spark, docs, SF_DIR)
    assert rows.columns == docs.columns
    found = rows.collect()
    assert found and all(r[name] == f"own {name}" for r in found for name in added)
    assert Counter(r["text"] for r in found) == Counter(r["text"] for r in cp.mixture(spark, odd, SF_DIR).collect())
