import datetime as dt
import glob
import os
import shutil

import pytest
from trips import RAW, raw_frame, rows_of, trip, whole_month

from curbline import contracts as C
from curbline.operators.clean import clean_detail
from curbline.operators.metrics import daily_metrics, hourly_metrics
from curbline.plans import incremental as inc
from curbline.plans.merge import one_exchange, plan_rows
from curbline.plans.warehouse import TABLES, run_warehouse
from curbline.session import freeze
from curbline.sinks.parquet import overwrite
from curbline.sources.files import CastLossError, list_files, list_partitions, partition_files
from curbline.streaming.detail import start_detail_stream
from pyspark.sql import functions as F


def write_month(spark, folder, month, rows):
    raw_frame(spark, rows).write.mode("overwrite").parquet(f"{folder}/raw/yellow_tripdata_{month}.parquet")


def table_files(path):
    return sorted(glob.glob(f"{path}/*/*.parquet"))


def detail_rows(spark, path):
    return rows_of(spark.read.parquet(path).select("tpep_pickup_datetime", "trip_distance", "trip_date"))


JANUARY = whole_month(2024, 1) + [trip("2024-02-01 00:10:00", distance=1.0), trip("2024-02-01 00:20:00", distance=2.0)]
FEBRUARY = whole_month(2024, 2) + [trip("2024-02-01 00:20:00", distance=2.0)]


def test_a_load_that_would_lose_values_writes_nothing(spark, folder):
    raw_frame(spark, JANUARY).coalesce(1).write.parquet(f"{folder}/raw/yellow_tripdata_2024-01.parquet")
    wrong = raw_frame(spark, FEBRUARY).withColumn("passenger_count", F.lit(1.5))
    wrong.coalesce(1).write.parquet(f"{folder}/raw/yellow_tripdata_2024-02.parquet")
    schema = raw_frame(spark, []).schema
    for load in (inc.load_months, inc.load_deliveries):
        detail = f"{folder}/{load.__name__}"
        # a group a month: the sound month stays, the other one is refused as a whole
        with pytest.raises(CastLossError, match="2024-02 passenger_count: 30 of 30 rows"):
            load(spark, f"{folder}/raw", detail, schema, group_bytes=1)
        assert {row["trip_date"].month for row in list_partitions(spark, detail).collect()} == {1, 2}
        assert list_partitions(spark, detail).count() == 32
        load(spark, f"{folder}/raw", detail, schema, allow_losses=True)
        assert list_partitions(spark, detail).count() == 60
        assert set(row["passenger_count"] for row in spark.read.parquet(detail).collect()) == {1}


def test_boundary_date_is_the_distinct_union(spark, folder):
    detail = f"{folder}/detail"
    write_month(spark, folder, "2024-01", JANUARY)
    first = inc.load_months(spark, f"{folder}/raw", detail)
    assert first.months == ["2024-01"]
    assert (len(first.new_dates), first.overlap_dates) == (32, [])
    untouched = glob.glob(f"{detail}/trip_date=2024-01-*/*.parquet")

    write_month(spark, folder, "2024-02", FEBRUARY)
    second = inc.load_months(spark, f"{folder}/raw", detail)
    assert second.months == ["2024-02"]
    assert second.overlap_dates == [dt.date(2024, 2, 1)]
    assert sorted(glob.glob(f"{detail}/trip_date=2024-01-*/*.parquet")) == sorted(untouched)
    at_once = clean_detail(raw_frame(spark, JANUARY + FEBRUARY)).dropDuplicates()
    expected = rows_of(at_once.select("tpep_pickup_datetime", "trip_distance", "trip_date"))
    assert detail_rows(spark, detail) == expected
    assert sum(1 for row in expected if row[2] == dt.date(2024, 2, 1)) == 3

    files = table_files(detail)
    third = inc.load_months(spark, f"{folder}/raw", detail)
    assert third == inc.LoadResult()
    assert table_files(detail) == files


def test_months_loaded_together_equal_one_after_the_other(spark, folder):
    write_month(spark, folder, "2024-01", JANUARY)
    write_month(spark, folder, "2024-02", FEBRUARY)
    result = inc.load_months(spark, f"{folder}/raw", f"{folder}/detail")
    assert result.months == ["2024-01", "2024-02"]
    at_once = clean_detail(raw_frame(spark, JANUARY + FEBRUARY)).dropDuplicates()
    assert detail_rows(spark, f"{folder}/detail") == rows_of(
        at_once.select("tpep_pickup_datetime", "trip_distance", "trip_date")
    )


def test_open_month_is_loaded_again_to_the_same_rows(spark, folder):
    write_month(spark, folder, "2024-01", JANUARY[:20])
    inc.load_months(spark, f"{folder}/raw", f"{folder}/detail")
    before = detail_rows(spark, f"{folder}/detail")
    again = inc.load_months(spark, f"{folder}/raw", f"{folder}/detail")
    assert again.months == ["2024-01"]
    assert detail_rows(spark, f"{folder}/detail") == before


def test_month_with_a_new_column(spark, folder):
    write_month(spark, folder, "2024-01", JANUARY)
    inc.load_months(spark, f"{folder}/raw", f"{folder}/detail")
    february = raw_frame(spark, FEBRUARY).withColumn("tip_amount", F.lit(1.5))
    february.write.parquet(f"{folder}/raw/yellow_tripdata_2024-02.parquet")
    inc.load_months(spark, f"{folder}/raw", f"{folder}/detail")
    merged = spark.read.option("mergeSchema", True).parquet(f"{folder}/detail")
    assert merged.where("trip_date = '2024-01-05'").first()["tip_amount"] is None
    assert merged.where("trip_date = '2024-02-05'").first()["tip_amount"] == 1.5


def test_boundary_keeps_columns_that_only_some_dates_have(spark, folder):
    detail = f"{folder}/detail"
    tipped = clean_detail(raw_frame(spark, [trip("2024-01-31 10:00:00")]).withColumn("tip_amount", F.lit(1.5)))
    inc.merge_into_detail(spark, tipped, detail)
    plain = [trip("2024-01-30 10:00:00"), trip("2024-02-01 10:00:00")]
    inc.merge_into_detail(spark, clean_detail(raw_frame(spark, plain)), detail)
    later = [trip(f"{day} 11:00:00") for day in ("2024-01-30", "2024-01-31", "2024-02-01")]
    inc.merge_into_detail(spark, clean_detail(raw_frame(spark, later)), detail)
    merged = spark.read.option("mergeSchema", True).parquet(detail)
    assert merged.count() == 6
    assert merged.where("tip_amount = 1.5").count() == 1


def test_coverage(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-02-01', date'2024-03-30')) AS trip_date")
    months = spark.createDataFrame([("2024-02",), ("2024-03",), ("2024-04",)], "year_month string")
    covered = {r["year_month"]: tuple(r)[1:] for r in inc.month_coverage(months, days).collect()}
    assert covered == {"2024-02": (29, 29, True), "2024-03": (30, 31, False), "2024-04": (0, 30, False)}
    assert [r["year_month"] for r in inc.plan_months(months, days).collect()] == ["2024-03", "2024-04"]
    missing = inc.missing_days(months, days)
    assert missing.count() == 31
    assert missing.where("year_month = '2024-03'").first()["trip_date"] == dt.date(2024, 3, 31)


def test_stale_dates(spark):
    schema = "trip_date string, modified string"
    listing = lambda rows: spark.createDataFrame(rows, schema).selectExpr(
        "date(trip_date) AS trip_date", "timestamp(modified) AS modified"
    )
    up = listing([("2024-01-01", "2024-05-02"), ("2024-01-02", "2024-05-01"), ("2024-01-03", "2024-05-03")])
    down = listing([("2024-01-01", "2024-05-01"), ("2024-01-02", "2024-05-01"), ("2024-01-04", "2024-05-01")])
    assert rows_of(inc.stale_dates(up, down).select("trip_date", "action")) == [
        (dt.date(2024, 1, 1), "recompute"),
        (dt.date(2024, 1, 3), "add"),
        (dt.date(2024, 1, 4), "drop"),
    ]


def daily_rows(spark, path):
    return rows_of(spark.read.parquet(path).select("trip_date", "trip_count", "total_revenue"))


def test_refresh_daily(spark, folder):
    detail, daily = f"{folder}/detail", f"{folder}/daily"
    write_month(spark, folder, "2024-01", JANUARY)
    inc.load_months(spark, f"{folder}/raw", detail)
    assert len(inc.refresh_daily(spark, detail, daily)["refreshed"]) == 32
    files = table_files(daily)
    assert inc.refresh_daily(spark, detail, daily) == {"refreshed": [], "dropped": []}
    assert table_files(daily) == files

    write_month(spark, folder, "2024-02", FEBRUARY)
    inc.load_months(spark, f"{folder}/raw", detail)
    assert len(inc.refresh_daily(spark, detail, daily)["refreshed"]) == 29
    whole = daily_metrics(spark.read.parquet(detail))
    assert daily_rows(spark, daily) == rows_of(whole.select("trip_date", "trip_count", "total_revenue"))


def test_refresh_drops_dates_gone_upstream(spark, folder):
    from curbline.sinks.parquet import drop_partitions

    detail, daily = f"{folder}/detail", f"{folder}/daily"
    inc.merge_into_detail(spark, clean_detail(raw_frame(spark, JANUARY)), detail)
    inc.refresh_daily(spark, detail, daily)
    gone = dt.date(2024, 1, 7)
    drop_partitions(spark, detail, [gone])
    assert inc.refresh_daily(spark, detail, daily) == {"refreshed": [], "dropped": [gone]}
    assert gone not in [row["trip_date"] for row in list_partitions(spark, daily).collect()]
    assert list_partitions(spark, daily).count() == 31


def test_flat_daily_table_is_rebuilt(spark, folder):
    detail, daily = f"{folder}/detail", f"{folder}/daily"
    cleaned = clean_detail(raw_frame(spark, JANUARY))
    inc.merge_into_detail(spark, cleaned, detail)
    overwrite(daily_metrics(cleaned.limit(5)), daily)
    assert inc.refresh_daily(spark, detail, daily) == {"rebuilt": [daily]}
    assert list_partitions(spark, daily).count() == 32
    assert inc.refresh_daily(spark, detail, daily) == {"refreshed": [], "dropped": []}


def test_warehouse_totals_agree_and_second_run_loads_nothing(spark, folder, tmp_path):
    write_month(spark, folder, "2024-01", JANUARY)
    write_month(spark, folder, "2024-02", FEBRUARY)
    zones = tmp_path / "zones.csv"
    zones.write_text("Location ID,Zone,Borough\n1,One,North\n1,Two,North\n")
    root = f"{folder}/wh"
    loaded, audit = run_warehouse(spark, f"{folder}/raw", root, str(zones))
    assert loaded.months == ["2024-01", "2024-02"]
    assert all(row["ok"] for row in audit.collect())
    assert audit.count() == len(TABLES)
    detail = spark.read.parquet(f"{root}/{C.DETAIL}")
    for layer in (C.DAILY, C.HOURLY, C.LOCATION, C.LOCATION_ZONE):
        assert spark.read.parquet(f"{root}/{layer}").agg(F.sum("trip_count")).first()[0] == detail.count()
    assert rows_of(spark.read.parquet(f"{root}/{C.HOURLY}")) == rows_of(hourly_metrics(detail))
    assert spark.read.parquet(f"{root}/{C.OVERALL}").first()["total_trip_count"] == detail.count()
    partials = sorted(partition_files(list_files(spark, f"{root}/{C.PARTIALS}")).collect())
    loaded, _ = run_warehouse(spark, f"{folder}/raw", root, str(zones))
    assert loaded.months == []
    assert sorted(partition_files(list_files(spark, f"{root}/{C.PARTIALS}")).collect()) == partials


def test_stream_picks_up_only_new_files(spark, folder):
    write_month(spark, folder, "2024-01", JANUARY)
    schema = raw_frame(spark, []).schema

    def run():
        query = start_detail_stream(spark, f"{folder}/raw", schema, f"{folder}/detail", f"{folder}/log")
        query.awaitTermination()
        return query

    run()
    files = table_files(f"{folder}/detail")
    run()
    assert table_files(f"{folder}/detail") == files
    write_month(spark, folder, "2024-02", FEBRUARY)
    run()
    at_once = clean_detail(raw_frame(spark, JANUARY + FEBRUARY)).dropDuplicates()
    assert detail_rows(spark, f"{folder}/detail") == rows_of(
        at_once.select("tpep_pickup_datetime", "trip_distance", "trip_date")
    )


def all_files(path):
    return sorted(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_open_month_that_was_loaded_rewrites_nothing(spark, folder):
    detail = f"{folder}/detail"
    write_month(spark, folder, "2024-01", JANUARY[:20])
    first = inc.load_deliveries(spark, f"{folder}/raw", detail)
    assert (first.months, first.groups, len(first.new_dates)) == (["2024-01"], 1, 20)
    files = all_files(detail)
    assert inc.load_deliveries(spark, f"{folder}/raw", detail) == inc.LoadResult()
    assert all_files(detail) == files


def test_file_delivered_again_is_loaded(spark, folder):
    """A month counts as whole by its days, but its file is another one."""
    detail = f"{folder}/detail"
    write_month(spark, folder, "2024-01", whole_month(2024, 1))
    write_month(spark, folder, "2024-02", whole_month(2024, 2))
    inc.load_deliveries(spark, f"{folder}/raw", detail)
    february = glob.glob(f"{detail}/trip_date=2024-02-*/*.parquet")
    write_month(spark, folder, "2024-01", [*whole_month(2024, 1), trip("2024-01-09 12:00:00", distance=7.0)])
    again = inc.load_deliveries(spark, f"{folder}/raw", detail)
    assert again.months == ["2024-01"]
    assert len(again.overlap_dates) == 31
    assert spark.read.parquet(detail).count() == 31 + 29 + 1
    assert glob.glob(f"{detail}/trip_date=2024-02-*/*.parquet") == february
    log = inc.delivered_files(spark, detail)
    assert log.agg(F.max("batch")).first()[0] == 2
    rows = {r["year_month"]: r["n"] for r in log.groupBy("year_month").agg(F.sum("rows").alias("n")).collect()}
    assert rows == {"2024-01": 31 + 32, "2024-02": 29}
    # the coverage rule sees whole months only
    assert inc.load_months(spark, f"{folder}/raw", detail) == inc.LoadResult()


def test_groups_are_bounded_and_leave_nothing_out(spark):
    listing = [(f"2024-{m:02d}", "p", f"f{m:02d}-{i}", dt.datetime(2024, 1, 1), 10 + i) for m in range(1, 13) for i in range(m % 4 + 1)]
    listing.append(("2024-06", "p", "huge", dt.datetime(2024, 1, 2), 500))
    files = spark.createDataFrame(listing, "year_month string, month_path string, path string, modified timestamp, length long")
    for group_bytes, group_files in ((50, 100), (1000, 3), (1, 1), (10_000, 1000)):
        groups = [(months, group.collect()) for months, group in inc.file_groups(files, group_bytes, group_files)]
        paths = [row["path"] for _, rows in groups for row in rows]
        assert sorted(paths) == sorted(row[2] for row in listing)
        for months, rows in groups:
            assert {row["year_month"] for row in rows} == set(months)
            # a file that begins within the bound is taken whole
            assert sum(row["length"] for row in rows) <= group_bytes + 500
            assert len(rows) <= group_files
        order = [month for months, _ in groups for month in months]
        assert order == sorted(order)


def test_load_in_groups_equals_one_load(spark, folder):
    for month in range(1, 7):
        write_month(spark, folder, f"2024-{month:02d}", [*whole_month(2024, month), trip(f"2024-{month % 6 + 1:02d}-01 09:00:00")])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    at_once = inc.load_deliveries(spark, f"{folder}/raw", f"{folder}/one")
    grouped = inc.load_deliveries(spark, f"{folder}/raw", f"{folder}/many", group_bytes=1)
    assert (at_once.groups, at_once.months) == (1, grouped.months)
    # Spark writes several part files a month here
    assert grouped.groups >= 6
    assert sorted({*grouped.new_dates, *grouped.overlap_dates}) == at_once.new_dates
    assert detail_rows(spark, f"{folder}/many") == detail_rows(spark, f"{folder}/one")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_load_that_broke_off_is_repeated(spark, folder, monkeypatch):
    write_month(spark, folder, "2024-01", JANUARY)
    write_month(spark, folder, "2024-02", FEBRUARY)
    merge, calls = inc.merge_into_detail, []

    def dies(*args, **named):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        return merge(*args, **named)

    monkeypatch.setattr(inc, "merge_into_detail", dies)
    try:
        inc.load_deliveries(spark, f"{folder}/raw", f"{folder}/detail", group_bytes=1)
    except RuntimeError:
        pass
    monkeypatch.undo()
    known = inc.delivered_files(spark, f"{folder}/detail").count()
    assert known >= 1
    inc.load_deliveries(spark, f"{folder}/raw", f"{folder}/detail")
    at_once = clean_detail(raw_frame(spark, JANUARY + FEBRUARY)).dropDuplicates()
    assert detail_rows(spark, f"{folder}/detail") == rows_of(at_once.select("tpep_pickup_datetime", "trip_distance", "trip_date"))


def keyed(spark, rows, **columns):
    frame = spark.createDataFrame([(i, *row) for i, row in rows], "id long, " + RAW)
    return frame.withColumns({name: F.lit(value) for name, value in columns.items()})


def test_newest_row_of_a_key_wins(spark, folder):
    first = keyed(spark, [(1, trip(total=1.0)), (2, trip(total=2.0)), (None, trip(total=3.0)), (None, trip(total=3.0))])
    first.write.parquet(f"{folder}/raw/yellow_tripdata_2024-01.parquet")
    inc.load_deliveries(spark, f"{folder}/raw", f"{folder}/detail", keys=["id"])
    second = keyed(spark, [(2, trip(total=20.0)), (3, trip(total=30.0)), (None, trip(total=4.0))], tip_amount=1.5)
    second.write.parquet(f"{folder}/raw/yellow_tripdata_2024-02.parquet")
    inc.load_deliveries(spark, f"{folder}/raw", f"{folder}/detail", keys=["id"])
    rows = rows_of(spark.read.option("mergeSchema", True).parquet(f"{folder}/detail").select("id", "total_amount", "tip_amount"))
    assert rows == [(None, 3.0, None), (None, 4.0, 1.5), (1, 1.0, None), (2, 20.0, 1.5), (3, 30.0, 1.5)]
    # an older file that is loaded later does not win
    older = spark.read.parquet(f"{folder}/detail").where("id = 1").drop("tip_amount")
    older = older.withColumns({"total_amount": F.lit(9.0), inc.DELIVERED: F.lit(dt.datetime(2001, 1, 1))})
    inc.merge_into_detail(spark, older, f"{folder}/detail", keys=["id"])
    assert spark.read.parquet(f"{folder}/detail").where("id = 1").first()["total_amount"] == 1.0


def test_differing_columns_can_be_refused(spark, folder):
    cleaned = clean_detail(raw_frame(spark, JANUARY))
    inc.merge_into_detail(spark, cleaned, f"{folder}/detail", same_columns=True)
    with pytest.raises(ValueError, match="tip_amount"):
        inc.merge_into_detail(spark, cleaned.withColumn("tip_amount", F.lit(1.0)), f"{folder}/detail", same_columns=True)
    inc.merge_into_detail(spark, cleaned, f"{folder}/detail", same_columns=True)
    assert spark.read.parquet(f"{folder}/detail").count() == 33


def full_row_exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]


@pytest.mark.parametrize("keys", [None, ["n"]])
def test_merge_has_one_exchange_of_whole_rows(spark, keys):
    rows = spark.range(0, 20_000, 1, 6).selectExpr(
        "if(id % 3 = 0, date'2024-01-01', date_add(date'2024-01-02', int(id % 9))) AS trip_date", "id % 7000 AS n", "id % 14000 AS m"
    )
    order = "m" if keys else None
    dates = plan_rows(rows, keys, order, slice_rows=1000).counts.select("trip_date", F.ceil(F.col("rows") / 1000).alias("slices"))
    dates = spark.createDataFrame(dates.collect(), "trip_date date, slices long")
    merged = one_exchange(rows, dates, [], keys, order)
    exchanges = full_row_exchanges(merged)
    assert len(exchanges) == 1 and "trip_date" in exchanges[0] and "__slice" in exchanges[0]
    expected = rows.dropDuplicates() if not keys else rows.groupBy("trip_date", "n").agg(F.max("m").alias("m")).select("trip_date", "n", "m")
    assert rows_of(merged) == rows_of(expected)


def test_hot_date_is_written_by_several_tasks_and_small_ones_by_one(spark, folder, monkeypatch):
    monkeypatch.setattr(inc, "SLICE_ROWS", 5000)
    times = "timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(if(id % 2 = 0, 0, int(id % 5) + 1), 0, int(id % 1400))"
    raw = spark.range(0, 60_000, 1, 6).selectExpr(
        f"{times} AS tpep_pickup_datetime", f"{times} + interval 5 minutes AS tpep_dropoff_datetime", "id AS passenger_count",
        "2.0D AS trip_distance", "1 AS PULocationID", "2 AS DOLocationID", "3.0D AS total_amount",
    )
    # tasks this small would be joined
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        inc.merge_into_detail(spark, clean_detail(raw), f"{folder}/detail")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.read.parquet(f"{folder}/detail").count() == 60_000
    assert len(glob.glob(f"{folder}/detail/trip_date=2024-01-05/*.parquet")) >= 3
    for day in range(7, 10):
        assert len(glob.glob(f"{folder}/detail/trip_date=2024-01-{day:02d}/*.parquet")) <= 2


@pytest.mark.parametrize("keys", [None, ["PULocationID"]])
def test_row_that_is_a_third_of_all_is_collapsed_where_it_is_read(spark, folder, keys):
    often = raw_frame(spark, [trip(pu=1)]).crossJoin(spark.range(0, 40_000, 1, 4)).drop("id")
    rest = spark.range(0, 2000).selectExpr(
        "timestamp_ntz'2024-01-06 00:00:00' AS tpep_pickup_datetime", "timestamp_ntz'2024-01-06 00:10:00' AS tpep_dropoff_datetime",
        "1L AS passenger_count", "2.0D AS trip_distance", "int(id + 10) AS PULocationID", "2 AS DOLocationID", "3.0D AS total_amount",
    )
    often.unionByName(rest).write.parquet(f"{folder}/raw")
    cleaned = clean_detail(spark.read.parquet(f"{folder}/raw"))
    order = "total_amount" if keys else None
    planned = plan_rows(cleaned, keys, order, slice_rows=1000)
    assert len(planned.frequent) == 1
    dates = spark.createDataFrame([(dt.date(2024, 1, 5), 40), (dt.date(2024, 1, 6), 2)], "trip_date date, slices long")
    merged = one_exchange(cleaned, dates, planned.frequent, keys, order)
    assert merged.count() == 2001
    assert len(planned.counts.collect()) == 2


def test_change_during_a_refresh_is_seen_by_the_next(spark, folder):
    detail, daily = f"{folder}/detail", f"{folder}/daily"
    inc.merge_into_detail(spark, clean_detail(raw_frame(spark, JANUARY)), detail)
    inc.refresh_daily(spark, detail, daily)
    late = dt.date(2024, 1, 8)

    def build(rows):
        built = freeze(daily_metrics(rows))
        inc.merge_into_detail(spark, clean_detail(raw_frame(spark, [trip(f"{late} 23:00:00")])), detail)
        return built

    inc.merge_into_detail(spark, clean_detail(raw_frame(spark, [trip(f"{late} 22:00:00")])), detail)
    assert inc.refresh_by_date(spark, detail, daily, build)["refreshed"] == [late]
    assert inc.refresh_daily(spark, detail, daily)["refreshed"] == [late]
    assert inc.refresh_daily(spark, detail, daily) == {"refreshed": [], "dropped": []}
    assert spark.read.parquet(daily).where(F.col("trip_date") == F.lit(late)).first()["trip_count"] == 3


def test_copied_tables_are_not_stale_and_clocks_do_not_count(spark, folder):
    detail, daily = f"{folder}/detail", f"{folder}/daily"
    inc.merge_into_detail(spark, clean_detail(raw_frame(spark, JANUARY)), detail)
    inc.refresh_daily(spark, detail, daily)
    for name in ("daily", "detail"):
        shutil.copytree(f"{folder}/{name}", f"{folder}/copy/{name}")
    assert inc.refresh_daily(spark, f"{folder}/copy/detail", f"{folder}/copy/daily") == {"refreshed": [], "dropped": []}
    # an upstream date that looks older than what was built from it
    day = dt.date(2024, 1, 3)
    inc.merge_into_detail(spark, clean_detail(raw_frame(spark, [trip(f"{day} 22:00:00")])), detail)
    for file in glob.glob(f"{detail}/trip_date={day}/*.parquet"):
        os.utime(file, (1, 1))
    assert inc.refresh_daily(spark, detail, daily)["refreshed"] == [day]


def test_dates_built_by_an_older_release_are_built_again_once(spark, folder):
    detail, daily = f"{folder}/detail", f"{folder}/daily"
    inc.merge_into_detail(spark, clean_detail(raw_frame(spark, JANUARY)), detail)
    inc.refresh_daily(spark, detail, daily)
    shutil.rmtree(f"{daily}/_built_from")
    assert len(inc.refresh_daily(spark, detail, daily)["refreshed"]) == 32
    assert inc.refresh_daily(spark, detail, daily) == {"refreshed": [], "dropped": []}


def test_stream_ignores_other_names(spark, folder):
    write_month(spark, folder, "2024-01", JANUARY)
    spark.createDataFrame([(1,)], "stray long").write.parquet(f"{folder}/raw/zones.parquet")
    schema = raw_frame(spark, []).schema
    start_detail_stream(spark, f"{folder}/raw", schema, f"{folder}/detail", f"{folder}/log").awaitTermination()
    found = spark.read.option("mergeSchema", True).parquet(f"{folder}/detail")
    assert "stray" not in found.columns and found.count() == 33
