"""The registered queries: every operator run over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import contracts as C
from curbline.functions.dates import date_text, month_text
from curbline.functions.exprs import beyond_cents, from_cents, nan_to_null, round2, sum_cents
from curbline.operators import checks, clean, enrich, metrics, profile, rank
from curbline.plans import event_trips, incremental, quality, totals, warehouse
from curbline.session import fit_shuffles, scratch_path
from curbline.sinks import parquet, publish
from curbline.sources import files
from curbline.streaming.detail import start_detail_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONEY = ["trip_distance", "fare_amount", "total_amount"]
TRIP_COLUMNS = [
    "event_id",
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "total_amount",
]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    fit_shuffles(spark, int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes())))
    return df


def raw(spark, sf_dir) -> DataFrame:
    return event_trips.raw_trips(table(spark, sf_dir, "events"))


def detail(spark, sf_dir) -> DataFrame:
    return event_trips.detail(table(spark, sf_dir, "events"))


def zones(spark, sf_dir) -> DataFrame:
    return event_trips.zones(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


def zone_table(spark, sf_dir) -> DataFrame:
    return enrich.location_zone(metrics.location_metrics(detail(spark, sf_dir)), zones(spark, sf_dir))


def staged_raw(spark, sf_dir) -> DataFrame:
    """The raw trips as a written table, for queries that go over them more than once."""
    path = scratch_path(spark, "raw")
    parquet.overwrite(raw(spark, sf_dir), path)
    return spark.read.parquet(path)


def middle_day(df: DataFrame, column: str) -> dt.date:
    """The day half way between the first and the last."""
    first, last = df.agg(F.min(F.to_date(column)), F.max(F.to_date(column))).first()
    return first + dt.timedelta(days=(last - first).days // 2)


def deliveries(spark, sf_dir) -> tuple[DataFrame, DataFrame, dt.date]:
    """All raw trips in two parts that share twelve hours of the middle day."""
    trips = staged_raw(spark, sf_dir)
    day = middle_day(table(spark, sf_dir, "events"), "ts")
    midnight = dt.datetime.combine(day, dt.time())
    first = trips.where(F.col(C.TRIP.pickup) < F.lit(midnight + dt.timedelta(hours=18)))
    second = trips.where(F.col(C.TRIP.pickup) >= F.lit(midnight + dt.timedelta(hours=6)))
    return first, second, day


#: how a partitioned write names the folder of NULL
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def write_raw_months(trips: DataFrame, raw_dir: str) -> None:
    """One folder per pickup month, named as the month files are, from one pass; trips without a time are in the first."""
    spark = trips.sparkSession
    staged = scratch_path(spark, "months")
    month = month_text(F.col(C.TRIP.pickup))
    trips.withColumn("__month", month).hint("rebalance", F.col("__month")).write.partitionBy("__month").parquet(staged)
    file_system, root = parquet.file_system_of(spark, raw_dir)
    file_system.mkdirs(root)
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    folders = [status.getPath() for status in file_system.listStatus(path_class(staged))]
    months = {path.getName().removeprefix("__month="): path for path in folders if path.getName().startswith("__month=")}
    if len(months) > 1 and NO_MONTH in months:
        untimed = months.pop(NO_MONTH)
        first = months[min(months, key=lambda name: (len(name), name))]
        for status in file_system.listStatus(untimed):
            # a task names its files alike in all folders
            file_system.rename(status.getPath(), path_class(first, f"untimed-{status.getPath().getName()}"))
    for name, path in months.items():
        file_system.rename(path, path_class(f"{raw_dir}/yellow_tripdata_{name}.parquet"))


def write_zone_csv(spark, sf_dir, path: str) -> None:
    rows = event_trips.zone_rows(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))
    rows.withColumnRenamed("LocationID", "Location ID").write.option("header", True).csv(path)


def built_warehouse(spark, sf_dir) -> tuple[str, DataFrame]:
    root = scratch_path(spark, "warehouse")
    write_raw_months(staged_raw(spark, sf_dir), f"{root}/raw")
    write_zone_csv(spark, sf_dir, f"{root}/zones.csv")
    _, audit = warehouse.run_warehouse(spark, f"{root}/raw", root, f"{root}/zones.csv")
    return root, audit


# --- sources -----------------------------------------------------------------


@query
def scan_raw(spark, sf_dir):
    trips = raw(spark, sf_dir)
    path = scratch_path(spark, "yellow_tripdata_all.parquet")
    parquet.overwrite(trips, path)
    return files.read_raw(spark, [path], trips.schema)


@query
def discover_months(spark, sf_dir):
    root = scratch_path(spark, "raw")
    write_raw_months(staged_raw(spark, sf_dir), root)
    table(spark, sf_dir, "nation").write.parquet(f"{root}/zones_2024-01.parquet")
    months = files.discover_months(spark, root)
    return months.select("year_month", F.element_at(F.split("month_path", "/"), -1).alias("file_name"))


@query
def scan_partitioned(spark, sf_dir):
    path = scratch_path(spark, "detail")
    parquet.replace_partitions(detail(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def list_partitions(spark, sf_dir):
    path = scratch_path(spark, "detail")
    parquet.replace_partitions(detail(spark, sf_dir), path)
    return files.list_partitions(spark, path).withColumn("day_text", date_text(F.col(C.DATE_KEY)))


@query
def pruned_read(spark, sf_dir):
    path = scratch_path(spark, "detail")
    parquet.replace_partitions(detail(spark, sf_dir), path)
    day = middle_day(table(spark, sf_dir, "events"), "ts")
    return files.read_partitions(spark, path, [day - dt.timedelta(days=1), day, day + dt.timedelta(days=1)])


@query
def load_dimension(spark, sf_dir):
    """Suppliers, each with a second, outdated row."""
    path = scratch_path(spark, "suppliers.csv")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    outdated = suppliers.withColumn("s_name", F.concat("s_name", F.lit("_OLD")))
    suppliers.unionByName(outdated).write.option("header", True).csv(path)
    return files.load_dimension(spark, path, suppliers.schema, {"s_suppkey": "supplier_id"}, "supplier_id")


@query
def load_dimension_parts(spark, sf_dir):
    path = scratch_path(spark, "parts.csv")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    parts.write.option("header", True).csv(path)
    return files.load_dimension(spark, path, parts.schema, {"p_partkey": "part_id"}, "part_id")


# --- cleaning ----------------------------------------------------------------


@query
def clean_detail(spark, sf_dir):
    return clean.clean_detail(raw(spark, sf_dir))


@query
def clean_exploratory(spark, sf_dir):
    return clean.clean_exploratory(raw(spark, sf_dir))


@query
def rejects_by_rule(spark, sf_dir):
    rule_sets = {"detail": clean.detail_rules(), "exploratory": clean.exploratory_rules()}
    return clean.rejects_by_rule(raw(spark, sf_dir), rule_sets)


@query
def null_rows(spark, sf_dir):
    return profile.null_rows(raw(spark, sf_dir), "passenger_count", TRIP_COLUMNS)


@query
def negative_amounts(spark, sf_dir):
    columns = [
        "event_id",
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "trip_distance",
        "fare_amount",
        "total_amount",
        "payment_type",
    ]
    return profile.anomalies(raw(spark, sf_dir), F.col("total_amount") < 0, columns)


@query
def payment_type_zero(spark, sf_dir):
    columns = [
        "event_id",
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "total_amount",
    ]
    return profile.anomalies(raw(spark, sf_dir), F.col("payment_type") == 0, columns)


FAR_COLUMNS = [
    "event_id",
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "PULocationID",
    "DOLocationID",
]


@query
def negative_amounts_sample(spark, sf_dir):
    return profile.sample_rows(negative_amounts(spark, sf_dir), [F.asc("event_id")])


@query
def far_trips(spark, sf_dir):
    far = profile.anomalies(raw(spark, sf_dir), F.col("trip_distance") > 100, FAR_COLUMNS)
    return far.orderBy(F.desc("trip_distance"), "event_id")


@query
def far_trips_sample(spark, sf_dir):
    far = profile.anomalies(raw(spark, sf_dir), F.col("trip_distance") > 100, FAR_COLUMNS)
    return profile.sample_rows(far, [F.desc("trip_distance"), F.asc("event_id")])


# --- aggregates --------------------------------------------------------------


@query
def daily_metrics(spark, sf_dir):
    return metrics.daily_metrics(detail(spark, sf_dir))


@query
def hourly_metrics(spark, sf_dir):
    return metrics.hourly_metrics(detail(spark, sf_dir))


@query
def location_metrics(spark, sf_dir):
    return metrics.location_metrics(detail(spark, sf_dir))


@query
def rolled_up_hourly(spark, sf_dir):
    partials = metrics.partial_metrics(detail(spark, sf_dir), metrics.PARTIAL_KEYS)
    return metrics.metrics_from_partials(partials, ["pickup_hour"], metrics.HOURLY_MEASURES)


def maintained(spark, sf_dir, keys, measures) -> DataFrame:
    """Totals after three states of the partials: half of the dates, some with trips missing and one too many; then all."""
    trips = detail(spark, sf_dir)
    days = F.datediff(F.col(C.DATE_KEY), F.lit(middle_day(table(spark, sf_dir, "events"), "ts")))
    first = trips.where((days < 0) & ((days % 5 != 0) | (F.col("payment_type") != 1)))
    stray = trips.where(days == 0).withColumn(C.DATE_KEY, F.date_add(C.DATE_KEY, 10_000))
    root = scratch_path(spark, "maintained")
    partials = f"{root}/partials"
    for state in (first, first.unionByName(stray), trips):
        source = f"{root}/{C.DETAIL}"
        incremental.overwrite_by_date(state, source)
        build = lambda rows: metrics.partial_metrics(rows, metrics.PARTIAL_KEYS)
        incremental.refresh_by_date(spark, source, partials, build)
        found = totals.maintain_totals(spark, partials, f"{root}/totals", keys, measures)
    return metrics.finish_metrics(found, keys, measures)


@query
def maintained_hourly(spark, sf_dir):
    return maintained(spark, sf_dir, ["pickup_hour"], metrics.HOURLY_MEASURES)


@query
def maintained_locations(spark, sf_dir):
    return maintained(spark, sf_dir, ["PULocationID"], metrics.LOCATION_MEASURES)


@query
def overall_metrics(spark, sf_dir):
    return metrics.overall_metrics(zone_table(spark, sf_dir))


@query
def total_trips(spark, sf_dir):
    return metrics.total_of(zone_table(spark, sf_dir))


@query
def row_count(spark, sf_dir):
    return metrics.row_count(table(spark, sf_dir, "lineitem"))


@query
def freq_passenger_count(spark, sf_dir):
    return profile.frequencies(raw(spark, sf_dir), "passenger_count")


@query
def freq_payment_type(spark, sf_dir):
    return profile.frequencies(raw(spark, sf_dir), "payment_type")


@query
def numeric_profile(spark, sf_dir):
    return profile.numeric_profile(raw(spark, sf_dir), MONEY)


@query
def numeric_profile_lineitem(spark, sf_dir):
    return profile.numeric_profile(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(raw(spark, sf_dir))


@query
def quantile_summary(spark, sf_dir):
    return profile.quantile_summary(raw(spark, sf_dir), MONEY)


@query
def quantile_summary_lineitem(spark, sf_dir):
    return profile.quantile_summary(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query
def approx_quantile_summary(spark, sf_dir):
    return profile.approx_quantile_summary(raw(spark, sf_dir), MONEY)


@query
def range_histogram(spark, sf_dir):
    return profile.range_histogram(raw(spark, sf_dir))


@query
def quality_bands(spark, sf_dir):
    return quality.quality_report(raw(spark, sf_dir))["bands"]


@query
def quality_rejects(spark, sf_dir):
    return quality.quality_report(raw(spark, sf_dir))["rejects"]


@query
def study_clean(spark, sf_dir):
    root = scratch_path(spark, "study")
    write_raw_months(staged_raw(spark, sf_dir), f"{root}/raw")
    months = files.discover_months(spark, f"{root}/raw").collect()
    quality.study_months(spark, [row["month_path"] for row in months], f"{root}/out")
    return spark.read.parquet(f"{root}/out/clean")


@query
def duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(table(spark, sf_dir, "orders"), ["o_custkey"])


@query
def duplicate_keys_lineitem(spark, sf_dir):
    return profile.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- joins, ranks, reports ---------------------------------------------------


@query
def location_zone(spark, sf_dir):
    return zone_table(spark, sf_dir)


@query
def unmatched_keys(spark, sf_dir):
    return enrich.unmatched_keys(zone_table(spark, sf_dir))


@query
def point_lookup(spark, sf_dir):
    return enrich.rows_with_key(zone_table(spark, sf_dir), "PULocationID", 7)


@query
def location_ranks(spark, sf_dir):
    return rank.location_ranks(metrics.location_metrics(detail(spark, sf_dir)))


@query
def part_ranks(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("line_count"))
    return rank.global_ranks(counts, "line_count", "l_partkey")


@query
def part_ranks_by_range(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("line_count"))
    return rank.global_ranks(counts, "line_count", "l_partkey")


@query
def borough_top3(spark, sf_dir):
    return rank.borough_top(zone_table(spark, sf_dir))


@query
def top10_trips(spark, sf_dir):
    return warehouse.top_zones(zone_table(spark, sf_dir), "trip_count")


@query
def top10_revenue(spark, sf_dir):
    return warehouse.top_zones(zone_table(spark, sf_dir), "total_revenue")


@query
def top10_avg_revenue(spark, sf_dir):
    return warehouse.top_zones(zone_table(spark, sf_dir), "avg_revenue")


@query
def top5_hours(spark, sf_dir):
    hours = metrics.grouped_metrics(detail(spark, sf_dir), ["pickup_hour"], metrics.HOURLY_MEASURES)
    return rank.top_k(hours, "trip_count", 5, "pickup_hour")


# --- incremental -------------------------------------------------------------


def order_dates(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias(C.DATE_KEY)).distinct()


def order_months(spark, sf_dir) -> DataFrame:
    return order_dates(spark, sf_dir).select(month_text(F.col(C.DATE_KEY)).alias("year_month")).distinct()


@query
def month_coverage(spark, sf_dir):
    return incremental.month_coverage(order_months(spark, sf_dir), order_dates(spark, sf_dir))


@query
def plan_months(spark, sf_dir):
    return incremental.plan_months(order_months(spark, sf_dir), order_dates(spark, sf_dir))


@query
def missing_days(spark, sf_dir):
    return incremental.missing_days(order_months(spark, sf_dir), order_dates(spark, sf_dir))


@query
def plan_dates(spark, sf_dir):
    first, second, _ = deliveries(spark, sf_dir)
    return incremental.plan_dates(clean.clean_detail(second), clean.clean_detail(first).select(C.DATE_KEY).distinct())


@query
def merge_boundary(spark, sf_dir):
    first, second, _ = deliveries(spark, sf_dir)
    path = scratch_path(spark, "detail")
    for delivery in (first, second):
        incremental.merge_into_detail(spark, clean.clean_detail(delivery), path)
    return spark.read.parquet(path)


@query
def load_months(spark, sf_dir):
    root = scratch_path(spark, "load")
    write_raw_months(staged_raw(spark, sf_dir), f"{root}/raw")
    incremental.load_months(spark, f"{root}/raw", f"{root}/detail")
    return spark.read.parquet(f"{root}/detail")


def order_raw(spark, sf_dir) -> DataFrame:
    return event_trips.order_trips(table(spark, sf_dir, "lineitem"))


def small_groups(spark, raw_dir: str) -> int:
    """A bound on the bytes of a group that makes about three groups of the delivered files."""
    return files.discover_files(spark, raw_dir).agg(F.sum("length")).first()[0] // 3 + 1


@query
def load_many_months(spark, sf_dir):
    """All order months, in several groups; what is loaded first is a third of the months."""
    root = scratch_path(spark, "months")
    write_raw_months(order_raw(spark, sf_dir).where(F.month(C.TRIP.pickup) % 3 == 0), f"{root}/raw")
    bound = small_groups(spark, f"{root}/raw")
    incremental.load_months(spark, f"{root}/raw", f"{root}/detail", group_bytes=bound)
    write_raw_months(order_raw(spark, sf_dir).where(F.month(C.TRIP.pickup) % 3 != 0), f"{root}/raw")
    incremental.load_months(spark, f"{root}/raw", f"{root}/detail", group_bytes=2 * bound)
    return spark.read.parquet(f"{root}/detail")


@query
def load_deliveries(spark, sf_dir):
    """The log of three loads: the odd months, the even ones, and nothing new."""
    root = scratch_path(spark, "deliveries")
    for odd in (1, 0):
        write_raw_months(order_raw(spark, sf_dir).where(F.month(C.TRIP.pickup) % 2 == odd), f"{root}/raw")
        bound = small_groups(spark, f"{root}/raw")
        incremental.load_deliveries(spark, f"{root}/raw", f"{root}/detail", group_bytes=bound)
    incremental.load_deliveries(spark, f"{root}/raw", f"{root}/detail")
    logged = incremental.delivered_files(spark, f"{root}/detail").groupBy("year_month").agg(F.sum("rows").alias("raw_rows"))
    merged = spark.read.parquet(f"{root}/detail").groupBy(month_text(F.col(C.DATE_KEY)).alias("year_month"))
    return logged.join(merged.agg(F.count("*").alias("detail_rows")), "year_month", "left")


@query
def cast_losses(spark, sf_dir):
    """What the order months would lose in narrower types than they were written with."""
    root = scratch_path(spark, "losses")
    trips = order_raw(spark, sf_dir)
    write_raw_months(trips, root)
    narrow = {"passenger_count": T.ByteType(), "trip_distance": T.IntegerType(), "total_amount": T.DecimalType(6, 2)}
    schema = T.StructType([T.StructField(f.name, narrow.get(f.name, f.dataType)) for f in trips.schema.fields])
    months = files.discover_months(spark, root).select("month_path").collect()
    return files.cast_losses(spark, [row["month_path"] for row in months], schema)


@query
def merge_by_key(spark, sf_dir):
    """Trips from the middle day on are delivered again, with another amount and a new column: one row a trip."""
    root = scratch_path(spark, "keyed")
    trips = staged_raw(spark, sf_dir)
    day = middle_day(table(spark, sf_dir, "events"), "ts")
    first, again = f"{root}/first", f"{root}/again"
    write_raw_months(trips, first)
    incremental.load_deliveries(spark, first, f"{root}/detail", keys=["event_id"])
    corrected = trips.where(F.col(C.TRIP.pickup) >= F.lit(day)).withColumns(
        {"total_amount": F.col("total_amount") + 1, "tip_amount": F.lit(1.0)}
    )
    write_raw_months(corrected, again)
    incremental.load_deliveries(spark, again, f"{root}/detail", keys=["event_id"])
    merged = spark.read.option("mergeSchema", True).parquet(f"{root}/detail")
    return merged.select("event_id", C.DATE_KEY, "trip_distance", "total_amount", "tip_amount")


@query
def stream_detail(spark, sf_dir):
    root = scratch_path(spark, "stream")
    trips = staged_raw(spark, sf_dir)
    write_raw_months(trips, f"{root}/raw")
    stream = start_detail_stream(spark, f"{root}/raw", trips.schema, f"{root}/detail", f"{root}/log")
    stream.awaitTermination()
    return spark.read.parquet(f"{root}/detail")


@query
def stale_dates(spark, sf_dir):
    first, second, _ = deliveries(spark, sf_dir)
    root = scratch_path(spark, "stale")
    incremental.merge_into_detail(spark, clean.clean_detail(first), f"{root}/detail")
    incremental.refresh_daily(spark, f"{root}/detail", f"{root}/daily")
    incremental.merge_into_detail(spark, clean.clean_detail(second), f"{root}/detail")
    upstream = files.partition_files(files.list_files(spark, f"{root}/detail"))
    built = incremental.built_from(spark, f"{root}/daily")
    return incremental.stale_dates(upstream, built, state="version").select(C.DATE_KEY, "action")


@query
def refresh_daily(spark, sf_dir):
    first, second, _ = deliveries(spark, sf_dir)
    root = scratch_path(spark, "refresh")
    for delivery in (first, second):
        incremental.merge_into_detail(spark, clean.clean_detail(delivery), f"{root}/detail")
        incremental.refresh_daily(spark, f"{root}/detail", f"{root}/daily")
    return spark.read.parquet(f"{root}/daily")


# --- sinks -------------------------------------------------------------------


@query
def overwrite_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "location_zone")
    parquet.overwrite(zones(spark, sf_dir), path)
    parquet.overwrite(zone_table(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def replace_partitions(spark, sf_dir):
    """The dates from the middle day on are replaced by the stricter rule set."""
    path = scratch_path(spark, "detail")
    trips = staged_raw(spark, sf_dir)
    parquet.replace_partitions(clean.clean_detail(trips), path)
    day = middle_day(table(spark, sf_dir, "events"), "ts")
    stricter = clean.clean_exploratory(trips).where(F.col(C.DATE_KEY) >= F.lit(day))
    affected = files.list_partitions(spark, path).where(F.col(C.DATE_KEY) >= F.lit(day)).collect()
    parquet.replace_partitions(stricter, path, affected=[row[C.DATE_KEY] for row in affected])
    return spark.read.parquet(path)


@query
def upsert_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    late = F.to_date("o_orderdate") >= F.lit(middle_day(orders, "o_orderdate"))
    price = F.col("o_totalprice")
    total = round2(from_cents(sum_cents(price), F.sum(beyond_cents(price))))
    path = scratch_path(spark, "customer_totals")
    for part in (orders.where(~late), orders.where(late)):
        totals = part.groupBy("o_custkey").agg(F.count("*").alias("order_count"), total.alias("total_price"))
        parquet.upsert(totals, path, ["o_custkey"])
    return spark.read.parquet(path)


@query
def upsert_last_order(spark, sf_dir):
    """The last order of each customer, from two deliveries of orders, in a table laid out in 32 buckets."""
    orders = table(spark, sf_dir, "orders")
    late = F.to_date("o_orderdate") >= F.lit(middle_day(orders, "o_orderdate"))
    path = scratch_path(spark, "last_orders")
    for part in (orders.where(~late), orders.where(late)):
        last = part.select("o_custkey", "o_orderkey", "o_totalprice")
        parquet.upsert_buckets(last, path, ["o_custkey"], 32, order="o_orderkey")
    return spark.read.parquet(path).select("o_custkey", "o_orderkey", "o_totalprice")


@query
def publish_replace(spark, sf_dir):
    first, _, _ = deliveries(spark, sf_dir)
    sink = publish.ParquetSink(scratch_path(spark, "published"))
    publication = publish.Publication(C.HOURLY, "hourly")
    publish.publish_table(metrics.hourly_metrics(clean.clean_detail(first)), sink, publication)
    publish.publish_table(metrics.hourly_metrics(detail(spark, sf_dir)), sink, publication)
    return sink.read(spark, "hourly")


@query
def nan_to_null_columns(spark, sf_dir):
    trips = raw(spark, sf_dir)
    per_distance = F.when(F.col("trip_distance") == 0, F.lit(float("nan"))).otherwise(
        F.try_divide("fare_amount", "trip_distance")
    )
    return nan_to_null(trips.select("event_id", "payment_type", per_distance.alias("fare_per_distance")))


@query
def publish_report(spark, sf_dir):
    root, _ = built_warehouse(spark, sf_dir)
    sink = publish.ParquetSink(f"{root}/published")
    return publish.publish_report(spark, root, sink).drop("message")


@query
def publish_again(spark, sf_dir):
    """Two publishings of daily metrics and a top list: the first has the days up to the middle, the second those from it.

    The daily table keeps the days that the second lacks; the top list has no zone that left it.
    """
    first, second, _ = deliveries(spark, sf_dir)
    root = scratch_path(spark, "twice")
    sink = publish.ParquetSink(f"{root}/out")
    jobs = [publish.Publication(C.DAILY, "daily", (C.DATE_KEY,)), publish.Publication(C.TOP_TRIPS, "top")]
    for part in (first, second):
        trips = clean.clean_detail(part)
        parquet.overwrite(metrics.daily_metrics(trips), f"{root}/{C.DAILY}")
        places = enrich.location_zone(metrics.location_metrics(trips), zones(spark, sf_dir))
        parquet.overwrite(warehouse.top_zones(places, "trip_count"), f"{root}/{C.TOP_TRIPS}")
        publish.publish_report(spark, root, sink, jobs)
    daily = sink.read(spark, "daily").select(F.lit("daily").alias("published"), F.col(C.DATE_KEY).cast("string").alias("key"), "trip_count")
    top = sink.read(spark, "top").select(F.lit("top").alias("published"), F.col("PULocationID").cast("string").alias("key"), "trip_count")
    return daily.unionByName(top)


@query
def audit_outputs(spark, sf_dir):
    _, audit = built_warehouse(spark, sf_dir)
    return audit.select("dataset", "ok")


@query
def warehouse_daily(spark, sf_dir):
    root, _ = built_warehouse(spark, sf_dir)
    return spark.read.parquet(f"{root}/{C.DAILY}")


# --- checks and charts -------------------------------------------------------


@query
def reconcile_counts(spark, sf_dir):
    """All layers come from one set of partials, as in the warehouse."""
    partials = metrics.partial_metrics(detail(spark, sf_dir), metrics.PARTIAL_KEYS)
    locations = metrics.metrics_from_partials(partials, ["PULocationID"], metrics.LOCATION_MEASURES)
    layers = {
        "daily": metrics.metrics_from_partials(partials, [C.DATE_KEY], metrics.DAILY_MEASURES),
        "hourly": metrics.metrics_from_partials(partials, ["pickup_hour"], metrics.HOURLY_MEASURES),
        "location": locations,
    }
    overall = metrics.overall_metrics(enrich.location_zone(locations, zones(spark, sf_dir)))
    return checks.reconcile_totals(layers, overall, "trip_count", "total_trip_count")


@query
def reconcile_avg(spark, sf_dir):
    return checks.recheck_average(metrics.overall_metrics(zone_table(spark, sf_dir)))


@query
def chart_hourly(spark, sf_dir):
    return checks.chart_hourly(metrics.hourly_metrics(detail(spark, sf_dir)))


@query
def chart_top_trips(spark, sf_dir):
    return checks.chart_zones(warehouse.top_zones(zone_table(spark, sf_dir), "trip_count"), "trip_count")


@query
def chart_top_revenue(spark, sf_dir):
    return checks.chart_zones(warehouse.top_zones(zone_table(spark, sf_dir), "total_revenue"), "total_revenue")


@query
def chart_borough(spark, sf_dir):
    return checks.chart_borough(rank.borough_top(zone_table(spark, sf_dir)))


@query
def chart_overall(spark, sf_dir):
    return checks.chart_overall(metrics.overall_metrics(zone_table(spark, sf_dir)))
