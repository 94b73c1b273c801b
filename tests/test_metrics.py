import math
import random

from trips import rows_of

from curbline.functions.exprs import beyond_cents, from_cents, round2, sum_cents
from curbline.operators import checks, metrics
from pyspark.sql import functions as F


def total(df, column="x"):
    value = F.col(column)
    return df.agg(from_cents(sum_cents(value), F.sum(beyond_cents(value))).alias("t")).first()[0]


def test_sum_of_cents_is_exact_in_any_order(spark):
    values = [random.Random(5).randrange(-10**7, 10**7) for _ in range(20_000)]
    rows = [(v / 100,) for v in values]
    exact = sum(values) / 100
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        assert total(spark.createDataFrame(rows, "x double").repartition(7)) == exact


def test_large_sums_are_exact_in_any_order(spark):
    pick = random.Random(7)
    cents_of = [pick.randrange(9 * 10**12, 10**13) * pick.choice([1, -1, 1]) for _ in range(300)]
    rows = [(i, 1, c / 100, 0.0, 1.0) for i, c in enumerate(cents_of)]
    schema = "PULocationID int, trip_count bigint, total_revenue double, avg_revenue double, avg_distance double"
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        found = metrics.overall_metrics(spark.createDataFrame(rows, schema).repartition(5)).first()
        assert found["total_revenue"] == sum(cents_of) / 100


def test_sum_beyond_bigint_cents_does_not_fail(spark):
    many = spark.range(200_000).select(F.lit(9e13).alias("x"))
    assert total(many) == 200_000 * 9e13


def test_sum_keeps_finer_huge_and_special_values(spark):
    frame = lambda *values: spark.createDataFrame([(v,) for v in values], "x double")
    assert total(frame(0.125, 0.125)) == 0.25
    assert total(frame(1.0, 1e300)) == 1e300
    assert math.isnan(total(frame(1.0, float("nan"))))
    assert total(frame(1.0, float("inf"))) == float("inf")
    assert total(frame(None, 2.5)) == 2.5
    assert total(frame(None)) is None


def test_round2(spark):
    values = [(1.005,), (0.285,), (-1.005,), (2.0,), (None,), (float("inf"),), (1e300,)]
    out = [row[0] for row in spark.createDataFrame(values, "x double").select(round2(F.col("x"))).collect()]
    assert out == [1.01, 0.29, -1.01, 2.0, None, float("inf"), 1e300]


def detail_frame(spark):
    rows = [
        ("2024-01-01", 1, 7, 10.0, 1.0, 5.0),
        ("2024-01-01", 1, 7, 20.0, 2.0, 10.0),
        ("2024-01-01", 2, 8, -5.0, 3.0, 2.5),
        ("2024-01-02", 1, 8, None, 4.0, 7.5),
    ]
    return spark.createDataFrame(
        rows,
        "trip_date string, pickup_hour int, PULocationID int, total_amount double, trip_distance double,"
        " trip_duration_minutes double",
    ).withColumn("trip_date", F.to_date("trip_date"))


def test_means_skip_null_measures(spark):
    daily = {str(r["trip_date"]): r for r in metrics.daily_metrics(detail_frame(spark)).collect()}
    assert daily["2024-01-01"]["total_revenue"] == 25.0
    assert daily["2024-01-01"]["avg_revenue"] == 8.33
    assert (daily["2024-01-01"]["min_duration"], daily["2024-01-01"]["max_duration"]) == (2.5, 10.0)
    assert daily["2024-01-02"]["trip_count"] == 1
    assert daily["2024-01-02"]["total_revenue"] is None
    assert daily["2024-01-02"]["avg_revenue"] is None


def test_roll_up_equals_direct(spark):
    detail = detail_frame(spark)
    partials = metrics.partial_metrics(detail, metrics.PARTIAL_KEYS)
    for keys, measures in (
        (["trip_date"], metrics.DAILY_MEASURES),
        (["pickup_hour"], metrics.HOURLY_MEASURES),
        (["PULocationID"], metrics.LOCATION_MEASURES),
    ):
        direct = metrics.grouped_metrics(detail, keys, measures)
        assert rows_of(metrics.metrics_from_partials(partials, keys, measures)) == rows_of(direct)


LOCATIONS = "PULocationID int, trip_count bigint, total_revenue double, avg_revenue double, avg_distance double"


def test_overall_mean_is_weighted(spark):
    zones = spark.createDataFrame([(1, 9, 9.0, 1.0, 1.0), (2, 1, 11.0, 11.0, 11.0)], LOCATIONS)
    assert tuple(metrics.overall_metrics(zones).first()) == (10, 20.0, 2.0, 2.0)


def test_overall_of_nothing(spark):
    empty = spark.createDataFrame([], LOCATIONS)
    assert rows_of(metrics.overall_metrics(empty)) == [(None, None, None, None)]
    assert rows_of(checks.chart_overall(metrics.overall_metrics(empty)).select("metric", "value"))[0][1] is None


def test_reconcile_sees_a_difference(spark):
    good = spark.createDataFrame([(1, 3), (2, 4)], "k int, trip_count bigint")
    bad = spark.createDataFrame([(1, 3)], "k int, trip_count bigint")
    report = spark.createDataFrame([(7,)], "total_trip_count bigint")
    rows = checks.reconcile_totals({"good": good, "bad": bad}, report, "trip_count", "total_trip_count")
    assert rows_of(rows) == [("bad", 3, 7, False), ("good", 7, 7, True)]
