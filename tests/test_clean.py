import datetime as dt

from trips import raw_frame, rows_of, trip

from curbline.functions.exprs import minutes2, nan_to_null
from curbline.operators.clean import (
    clean_detail,
    clean_exploratory,
    detail_rules,
    exploratory_rules,
    rejects_by_rule,
)
from pyspark.sql import functions as F


def test_detail_rules_at_their_edges(spark):
    within_second = (
        dt.datetime(2024, 1, 5, 10, 0, 0, 100_000),
        dt.datetime(2024, 1, 5, 10, 0, 0, 500_000),
        1,
        2.5,
        1,
        2,
        10.0,
    )
    rows = [
        trip(seconds=0),
        within_second,
        trip(seconds=86_400, distance=1.0),
        trip(seconds=86_401),
        trip(distance=100.0),
        trip(distance=100.01),
        trip(distance=0.0),
        trip(distance=-1.0),
        trip(distance=float("nan")),
        trip(distance=None),
        trip(pu=None),
        trip(do=None),
        trip(pickup=None),
        trip(seconds=None),
    ]
    kept = clean_detail(raw_frame(spark, rows))
    assert rows_of(kept.select("trip_distance", "trip_duration_minutes")) == [(1.0, 1440.0), (100.0, 10.0)]


def test_rule_sets_differ(spark):
    rows = [trip(passengers=0), trip(passengers=None), trip(total=-1.0), trip(distance=500.0), trip(pu=None), trip()]
    raw = raw_frame(spark, rows)
    assert clean_detail(raw).count() == 4
    assert clean_exploratory(raw).count() == 3


def test_derived_columns(spark):
    raw = raw_frame(spark, [trip("2024-02-29 23:59:59", seconds=100)])
    detail = clean_detail(raw).select("trip_date", "pickup_hour", "trip_duration_minutes").first()
    assert tuple(detail) == (dt.date(2024, 2, 29), 23, 1.67)
    study = clean_exploratory(raw).select("trip_duration_minutes").first()
    assert study[0] == 100 / 60


def test_minutes_round_as_decimals_do(spark):
    seconds = spark.range(1, 86_401)
    wrong = seconds.where(minutes2(F.col("id")) != F.expr("cast(round(cast(id as decimal(20,10)) / 60, 2) as double)"))
    assert wrong.count() == 0


def test_rejects_count_each_rule_once_first(spark):
    raw = raw_frame(spark, [trip(), trip(distance=-1.0, pu=None), trip(pickup=None), trip(distance=float("nan"))])
    both = rejects_by_rule(raw, {"detail": detail_rules(), "study": exploratory_rules()})
    of_detail = both.where("rule_set = 'detail'").collect()
    rejects = {row["rule"]: (row["failing"], row["first_failing"]) for row in of_detail}
    assert rejects["distance_positive"] == (1, 1)
    assert rejects["pickup_zone_present"] == (1, 0)
    assert rejects["distance_at_most_100"] == (1, 1)
    assert rejects["dropoff_after_pickup"] == (1, 0)
    rejected = sum(first for _, first in rejects.values())
    assert rejected == raw.count() - clean_detail(raw).count()
    study = both.where("rule_set = 'study'")
    assert study.agg(F.sum("first_failing")).first()[0] == raw.count() - clean_exploratory(raw).count()


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (1.5, 2), (None, 3)], "x double, n int")
    assert rows_of(nan_to_null(df)) == [(None, 1), (None, 3), (1.5, 2)]
