import math
import random

from trips import rows_of

from curbline.operators import profile
from pyspark.sql import functions as F


def test_band_edges(spark):
    distances = [-1.0, 0.0, 5.0, 5.01, 100.0, 100.01, None]
    fares = [-1.0, 0.0, 100.0, 500.0, None, 10.0, 10.01]
    totals = [-1.0, 0.0, 100.0, 500.0, None, 20.0, 20.01]
    df = spark.createDataFrame(list(zip(distances, fares, totals)), "trip_distance double, fare_amount double, total_amount double")
    found = {(r["column"], r["band"]): r["rows"] for r in profile.range_histogram(df).collect()}
    d = lambda band: found["trip_distance", band]
    assert (d("0"), d("0~5"), d("5~10"), d("50~100"), d("100+"), d("unbanded")) == (1, 1, 1, 1, 2, 2)
    f = lambda band: found["fare_amount", band]
    assert (f("negative"), f("0~10"), f("10~20"), f("50~100"), f("100+"), f("unbanded")) == (1, 1, 1, 1, 2, 2)
    t = lambda band: found["total_amount", band]
    assert (t("negative"), t("0~20"), t("50~100"), t("100~500"), t("500+"), t("unbanded")) == (1, 1, 1, 1, 1, 2)


def brute_force_quantile(values, share):
    ordered = sorted(values)
    return ordered[math.ceil(share * len(ordered)) - 1]


def test_exact_quantiles_with_hot_values(spark):
    pick = random.Random(3)
    values = [7.25 if i % 3 == 0 else round(pick.uniform(-50, 50), 2) for i in range(5001)]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)] + [(None, None)], "a double, b double")
    found = {r["column"]: r for r in profile.quantile_summary(df, ["a", "b"]).collect()}
    for column, data in (("a", values), ("b", [float(i) for i in range(5001)])):
        row = found[column]
        assert row["count"] == 5001
        assert (row["min"], row["max"]) == (min(data), max(data))
        for label, share in profile.QUARTILES.items():
            assert row[label] == brute_force_quantile(data, share)


def test_only_values_near_a_quantile_are_shuffled(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_000).cast("double").alias("a"))
    ends = profile.sketched_ranges(df, ["a"], [0.25, 0.5], accuracy=1000).first()["ends"]
    counted = profile.bracketed_counts(df, {"a": [tuple(ends[:2]), tuple(ends[2:])]})
    rows = counted.orderBy("at", "gap").collect()
    assert sum(row["n"] for row in rows) == 200_000
    assert sum(row["gap"] for row in rows) == 3
    # two brackets of four errors of the sketch, each widened by its own error
    assert len(rows) < 2 * 8 * 200_000 / 1000
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("HashAggregate") < plan.index("Exchange")
    row = profile.quantile_summary(df, ["a"], accuracy=1000).first()
    assert (row["p25"], row["p50"], row["p75"]) == (49_999.0, 99_999.0, 149_999.0)


def test_a_quantile_outside_its_bracket_is_found_in_the_gap(spark, monkeypatch):
    values = [float(i * i % 997) for i in range(3000)]
    df = spark.createDataFrame([(v, -v) for v in values], "a double, b double")
    sketched = profile.sketched_ranges

    def wrong(*args):
        # brackets that hold no quantile: below all, between values, and above all
        ends = F.when(F.col("column") == "a", F.array(*[F.lit(x) for x in (-5.0, -4.0, 3.5, 3.6, 2000.0, 2001.0)])).otherwise(F.col("ends"))
        return sketched(*args).withColumn("ends", ends)

    monkeypatch.setattr(profile, "sketched_ranges", wrong)
    found = {row["column"]: row for row in profile.quantile_summary(df, ["a", "b"]).collect()}
    for label, share in profile.QUARTILES.items():
        assert found["a"][label] == brute_force_quantile(values, share)
        assert found["b"][label] == brute_force_quantile([-v for v in values], share)


def test_quantiles_of_nans_infinities_nulls_and_nothing(spark):
    data = [(float("nan"), float("-inf"), None), (1.0, 2.0, None), (float("nan"), float("inf"), None), (-0.0, 2.0, None)]
    df = spark.createDataFrame(data, "`a.b` double, b double, c double")
    rows = [[str(v) for v in row] for row in profile.quantile_summary(df, ["a.b", "b", "c"]).collect()]
    assert [v.replace("-0.0", "0.0") for v in rows[0]] == ["a.b", "4", "0.0", "0.0", "1.0", "nan", "nan"]
    assert rows[1] == ["b", "4", "-inf", "-inf", "2.0", "2.0", "inf"]
    assert rows[2] == ["c", "0", *["None"] * 5]
    assert [row["count"] for row in profile.quantile_summary(df.limit(0), ["a.b", "c"]).collect()] == [0, 0]


def test_approximate_quantiles_stay_in_their_bound(spark):
    df = spark.range(50_000).select(F.col("id").cast("double").alias("a"))
    row = profile.approx_quantile_summary(df, ["a"], accuracy=1000).first()
    for label, share in profile.QUARTILES.items():
        assert abs(row[label] - share * 50_000) <= 50_000 / 1000 + 1


def test_null_profile_and_frequencies(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, "x")], "a int, b string")
    assert rows_of(profile.null_profile(df)) == [("a", 3, 1), ("b", 3, 2)]
    assert [tuple(r) for r in profile.frequencies(df, "a").collect()] == [(None, 1), (1, 2)]


def test_numeric_profile(spark):
    df = spark.createDataFrame([(0.0,), (-1.5,), (4.5,), (None,)], "x double")
    assert tuple(profile.numeric_profile(df, ["x"]).first()) == ("x", 4, 1, 1, -1.5, 4.5, 1.0)


def test_duplicates_and_samples(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,)], "k int")
    assert [tuple(r) for r in profile.duplicate_keys(df, ["k"]).collect()] == [(3, 3), (1, 2)]
    assert [r["k"] for r in profile.sample_rows(df, [F.desc("k")], 2).collect()] == [3, 3]
