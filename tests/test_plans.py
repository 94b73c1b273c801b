"""The physical plans the operators count on."""

import pytest

import __spark_entry__ as entry_module
from curbline.operators.clean import clean_detail
from curbline.operators.enrich import location_zone
from curbline.operators.metrics import location_metrics
from curbline.operators.rank import borough_top, top_k
from curbline.plans import catalog
from curbline.sources import files
from trips import raw_frame, rows_of, trip

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that write tables first and return a read of them are left to their own tests.
LAZY = [
    name
    for name in sorted(entry_module.queries())
    if name.startswith(("chart_", "top", "clean_", "freq_", "null_", "numeric_", "far_", "duplicate_"))
    or name.endswith(("_metrics", "_profile", "_histogram", "_zone", "_keys", "_lookup", "_rule", "_dates"))
    and name != "stale_dates"
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry_module.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Scan ExistingRDD"):
        assert node not in text


def test_cleaning_reaches_the_scan(spark, folder):
    raw_frame(spark, [trip()]).write.parquet(f"{folder}/m")
    metrics = location_metrics(clean_detail(spark.read.parquet(f"{folder}/m")))
    text = plan(metrics)
    for pushed in ("IsNotNull(DOLocationID)", "GreaterThan(trip_distance,0.0)", "LessThanOrEqual(trip_distance,100.0)"):
        assert pushed in text
    assert "passenger_count" not in text
    assert text.count("Exchange") == 1


def test_top_k_and_group_limit(spark):
    zones = catalog.zone_table(spark, SF_DIR)
    assert "TakeOrderedAndProject" in plan(top_k(zones, "trip_count", 10, "PULocationID"))
    text = plan(borough_top(zones))
    assert text.count("WindowGroupLimit") == 2


def test_dimension_is_broadcast_by_its_size(spark):
    zones = spark.range(30).selectExpr("int(id) AS LocationID", "'z' AS Zone", "'b' AS Borough")
    locations = spark.createDataFrame(
        [(1, 1, 1.0, 1.0, 1.0)],
        "PULocationID int, trip_count bigint, total_revenue double, avg_revenue double, avg_distance double",
    )
    assert "BroadcastHashJoin" in plan(location_zone(locations, zones))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(location_zone(locations, zones))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_months_are_written_from_one_pass(spark, folder):
    """Trips without a time are in the first month, also where a task writes them under the name it uses there."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [trip("2024-02-05 10:00:00"), trip("2024-01-31 10:00:00"), trip("2024-01-01 10:00:00"), trip(None), trip(None, total=3.0)]
    trips = raw_frame(spark, rows)
    catalog.write_raw_months(trips.coalesce(1).mapInArrow(counted, trips.schema), f"{folder}/raw")
    assert seen.value == len(rows)
    months = {r["year_month"]: r["month_path"] for r in files.discover_months(spark, f"{folder}/raw").collect()}
    assert {month: spark.read.parquet(path).count() for month, path in months.items()} == {"2024-01": 4, "2024-02": 1}
    assert rows_of(files.read_raw(spark, list(months.values()))) == rows_of(trips)
