"""Sharding and mixing: laws, edge cases, and no Python in their plans."""

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from curbline.llm import mixing, queries, sharding

SF_DIR = "/root/testdata/sf0.001"


def shards_of(rows):
    shards = defaultdict(list)
    for row in rows:
        shards[row["shard"]].append(row)
    return shards


def test_shards_are_near_equal_and_gapless(spark):
    rows = queries.op7_sharding(spark, "/root/testdata/sf0.01").collect()
    documents = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(documents)
    largest = max(r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    shards = shards_of(rows)
    for number in range(24):
        held = sum(r["size"] for r in shards[number])
        assert abs(held - total / 24) <= largest + total / 24 * 0.01
        assert sorted(r["slot"] for r in shards[number]) == list(range(len(shards[number])))
    for r in rows:
        text = documents[r["doc_id"]]["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))


def test_hot_group_is_split_and_others_stay_together(documents):
    df = documents(*["same text"] * 300, *[f"text {i % 200}" for i in range(400)])
    rows = sharding.histogram_sort(df, 10).collect()
    shards = shards_of(rows)
    sizes = [sum(len(r["text"]) + 8 for r in shards[i]) for i in range(10)]
    assert max(sizes) - min(sizes) <= 4 * 17
    assert sum(len({r["text"] for r in held}) for held in shards.values()) <= 201 + 9


def test_shards_of_parts(documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 7)
    rows = sharding.histogram_sort(documents(*[f"text {i}" for i in range(200)]), 5).collect()
    for held in shards_of(rows).values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))


def test_sharding_of_odd_rows(odd, empty):
    clash = odd.withColumn("shard", F.lit("x")).withColumn("key", F.lit(1))
    rows = sharding.histogram_sort(clash, 4).collect()
    assert len(rows) == odd.count() and {r["shard"] for r in rows} <= set(range(4))
    assert sharding.histogram_sort(empty, 4).collect() == []


def mixed(df):
    sized = df.withColumn("size", mixing.word_count("text"))
    return mixing.mix(sized).collect()


def test_small_source_stops_at_three_epochs(spark):
    rows = [(i, "s1", 10) for i in range(100)] + [(200, "s3", 4), (201, "s3", 2)]
    rows += [(300 + i, "s2", 10) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    result = mixing.mix(df).collect()
    taken, target = defaultdict(int), {}
    for r in result:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["copies"] * r["size"] + r["part"]
    assert target["s3"] == 18 and target["s2"] == 150
    assert target["s1"] == pytest.approx(1056 - 18 - 150)
    assert taken == {"s3": 18, "s2": 150, "s1": 888}


def test_mixing_of_odd_rows(odd, empty):
    rows = mixed(odd.withColumn("taken", F.lit("x")).withColumn("key", F.lit(1)))
    assert len(rows) == odd.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert mixed(empty) == []


def test_mixed_rows_hold_the_taken_words(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    taken = {r["doc_id"]: r["taken"] for r in mixed(df)}
    rows = mixing.mixed_rows(df).select("doc_id", mixing.word_count("text").alias("n")).collect()
    found = defaultdict(int)
    for r in rows:
        found[r["doc_id"]] += r["n"]
    assert {k: v for k, v in taken.items() if v} == dict(found)


def test_rows_without_ids_are_mixed_alike_in_any_order(spark):
    pick = random.Random(5)
    # texts of equal size, with and without an id that repeats, and rows that differ in another column alone
    rows = [(None, "a", f"w{i} x{pick.random()} y z", i) for i in range(60)]
    rows += [(7, "b", f"w{i} x y z", i) for i in range(60)] + [(None, "c", "same words here", i) for i in range(60)]
    found = []
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        df = spark.createDataFrame(shuffled, "doc_id long, source string, text string, size int").repartition(seed + 1)
        found.append(sorted(map(str, mixing.mixed_rows(df).collect())))
    assert found[0] == found[1] == found[2]
    # the rows without an id do not share one key
    sized = spark.createDataFrame(rows, "doc_id long, source string, text string, own int").withColumn("size", F.lit(4).cast("long"))
    for tie in (None, "text"):
        keys = mixing.mix(sized, tie=tie)._jdf.queryExecution().analyzed().toString()
        assert ("null:" in keys) == bool(tie)
    assert "text" not in mixing.mix(sized, tie="text").columns


def test_ranges_grow_with_the_rows():
    assert [mixing.key_digits(n) for n in (0, 10**8, 4 * 10**8 + 10**7, 10**10, 10**11, 10**15)] == [3, 3, 4, 5, 5, 6]


def test_no_python_in_the_plans(spark):
    for name in ("op7_sharding", "op8_mixing"):
        plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
