import datetime as dt

import pytest
from trips import raw_frame, rows_of, trip

from curbline.contracts import RAW_SCHEMA
from curbline.sinks.parquet import replace_partitions
from curbline.sources import files
from pyspark.sql import functions as F
from pyspark.sql import types as T


def single_file(df, path, work):
    """A Parquet file of exactly this name, as deliveries are."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.Table.from_batches(df.toArrow().to_batches()), path)


def test_discover_months_takes_files_and_folders_and_ignores_other_names(spark, tmp_path):
    raw = raw_frame(spark, [trip()])
    single_file(raw, tmp_path / "yellow_tripdata_2024-02.parquet", tmp_path)
    raw.write.parquet(str(tmp_path / "yellow_tripdata_2024-01.parquet"))
    single_file(raw, tmp_path / "green_tripdata_2024-03.parquet", tmp_path)
    single_file(raw, tmp_path / "old_yellow_tripdata_2024-04.parquet", tmp_path)
    (tmp_path / "nested").mkdir()
    single_file(raw, tmp_path / "nested" / "yellow_tripdata_2024-05.parquet", tmp_path)
    (tmp_path / "yellow_tripdata_2024-06.csv").write_text("x")
    months = files.discover_months(spark, str(tmp_path)).collect()
    assert [m["year_month"] for m in months] == ["2024-01", "2024-02"]
    assert files.read_raw(spark, [m["month_path"] for m in months]).count() == 2


def test_discover_months_of_missing_folder(spark, folder):
    assert files.discover_months(spark, f"{folder}/none").count() == 0


def test_month_listing_reads_no_content(spark, folder):
    raw_frame(spark, [trip()]).write.parquet(f"{folder}/yellow_tripdata_2024-01.parquet")
    plan = files.discover_months(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_declared_schema_fills_missing_columns(spark, folder):
    raw_frame(spark, [trip()]).write.parquet(f"{folder}/m")
    raw = files.read_raw(spark, [f"{folder}/m"], RAW_SCHEMA)
    assert raw.columns == RAW_SCHEMA.names
    assert raw.first()["tip_amount"] is None
    assert raw.first()["PULocationID"] == 1


def dated(spark, days):
    return spark.createDataFrame([(d, i) for i, d in enumerate(days)], "trip_date date, n int")


DAYS = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]


def test_partition_listing(spark, folder):
    path = f"{folder}/t"
    assert files.list_partitions(spark, path).count() == 0
    assert files.is_partitioned(files.list_files(spark, path))
    replace_partitions(dated(spark, DAYS), path)
    assert rows_of(files.list_partitions(spark, path)) == [(d,) for d in DAYS]
    assert files.is_partitioned(files.list_files(spark, path))
    assert dict(files.list_partitions(spark, path).dtypes) == {"trip_date": "date"}
    flat = f"{folder}/flat"
    dated(spark, DAYS).write.parquet(flat)
    assert not files.is_partitioned(files.list_files(spark, flat))
    assert files.list_partitions(spark, flat).count() == 0


def test_read_partitions_prunes(spark, folder):
    replace_partitions(dated(spark, DAYS), f"{folder}/t")
    part = files.read_partitions(spark, f"{folder}/t", DAYS[:1])
    assert rows_of(part.select("trip_date")) == [(DAYS[0],)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trip_date" in plan or "PartitionFilters: [(trip_date" in plan or "PartitionFilters: [trip_date" in plan
    assert len(part.inputFiles()) >= 1


def test_months_of_other_types_are_cast(spark, folder):
    spark.sql(
        "SELECT timestamp_ntz'2022-01-05 10:00:00' AS tpep_pickup_datetime, 2.0D AS passenger_count, 7L AS PULocationID"
    ).write.parquet(f"{folder}/a")
    spark.sql("SELECT double('NaN') AS passenger_count, 8 AS pulocationid, 'x' AS extra").write.parquet(f"{folder}/b")
    raw = files.read_raw(spark, [f"{folder}/a", f"{folder}/b"], RAW_SCHEMA)
    assert [f.dataType for f in raw.schema.fields][:-1] == [f.dataType for f in RAW_SCHEMA.fields]
    assert rows_of(raw.select("passenger_count", "PULocationID", "extra")) == [(None, 8, "x"), (2, 7, None)]


def test_values_lost_in_casts_are_counted(spark, folder):
    month = f"{folder}/yellow_tripdata_2022-0%d.parquet"
    spark.sql(
        """SELECT * FROM VALUES (5000000000L, 'x', 1.9D, timestamp_ntz'2022-01-05 10:00:00', 0.1D, 1),
                                  (7L, '12', 2.0D, timestamp_ntz'2022-01-05 00:00:00', 1e300D, 2),
                                  (NULL, NULL, double('NaN'), NULL, NULL, NULL),
                                  (-1L, ' 3 ', double('inf'), NULL, 0.25D, 3) AS t(big, words, ratio, day, Near, same)"""
    ).write.parquet(month % 1)
    spark.sql("SELECT 12.345BD AS ratio, 3 AS big, 9 AS same").write.parquet(month % 2)
    schema = T.StructType.fromDDL("big int, words int, ratio decimal(10,2), day date, near float, same int, absent int")
    losses = files.cast_losses(spark, [month % 1, month % 2], schema)
    assert rows_of(losses) == [
        ("2022-01", "big", 4, 1),
        ("2022-01", "day", 4, 1),
        ("2022-01", "near", 4, 0),
        ("2022-01", "ratio", 4, 1),
        ("2022-01", "words", 4, 1),
        ("2022-02", "ratio", 1, 1),
    ]
    with pytest.raises(files.CastLossError, match="2022-01 big: 1 of 4 rows; 2022-01 day: 1 of 4"):
        files.refuse_losses(losses)


def test_files_of_the_declared_types_are_not_read_for_losses(spark, folder):
    raw_frame(spark, [trip()]).write.parquet(f"{folder}/m")
    losses = files.cast_losses(spark, [f"{folder}/m"], T.StructType.fromDDL("passenger_count bigint, total_amount double"))
    assert "FileScan" not in losses._jdf.queryExecution().executedPlan().toString()
    files.refuse_losses(losses)
    one = files.cast_losses(spark, [f"{folder}/m"], T.StructType.fromDDL("passenger_count int, total_amount double"))
    assert "ReadSchema: struct<passenger_count:bigint>" in one._jdf.queryExecution().executedPlan().toString()


def test_months_without_schema_keep_all_columns(spark, folder):
    spark.sql("SELECT 1 AS a").write.parquet(f"{folder}/a")
    spark.sql("SELECT 2 AS a, 'x' AS extra").write.parquet(f"{folder}/b")
    assert rows_of(files.read_raw(spark, [f"{folder}/a", f"{folder}/b"]).select("a", "extra")) == [(1, None), (2, "x")]


def test_load_dimension(spark, tmp_path):
    (tmp_path / "z.csv").write_text('Location ID,Zone,Borough\n56,"Corona, b",Queens\n56,"Corona, a",Queens\n1,Newark,EWR\n')
    zones = files.load_dimension(spark, str(tmp_path / "z.csv"))
    assert rows_of(zones) == [(1, "Newark", "EWR"), (56, "Corona, a", "Queens")]


def test_load_dimension_rejects_other_headers(spark, tmp_path):
    (tmp_path / "z.csv").write_text("Location ID,Borough,Zone\n1,EWR,Newark\n")
    with pytest.raises(Exception, match="header|schema"):
        files.load_dimension(spark, str(tmp_path / "z.csv")).collect()


def test_unset_columns_reach_scan_pruned(spark, folder):
    raw_frame(spark, [trip()]).write.parquet(f"{folder}/m")
    for schema in (None, RAW_SCHEMA):
        raw = files.read_raw(spark, [f"{folder}/m"], schema)
        plan = raw.where(F.col("trip_distance") > 1).select("PULocationID")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(trip_distance,1.0)" in plan
        assert "ReadSchema: struct<trip_distance:double,PULocationID:int>" in plan
