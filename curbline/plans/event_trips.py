"""Reads the events, nation and region tables as raw trips and pickup zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.operators.clean import clean_detail
from curbline.operators.enrich import one_row_per_key


def with_next_time(events: DataFrame) -> DataFrame:
    """Each event with the time of the same user's next event.

    A user may own a large share of all rows, so the window runs per user and
    minute. Into each minute goes one marker with the time the user's next busy
    minute begins; that time sorts it after the events there, and it is dropped
    again. Of one user a task holds whole only the minutes, no more than the
    calendar has, and the events of a single minute.
    """
    rows = events.select("event_id", "user_id", "ts", "value", F.date_trunc("minute", "ts").alias("minute"))
    minutes = rows.groupBy("user_id", "minute").agg(F.min("ts").alias("first_ts"))
    next_minute = F.lead("first_ts").over(W.partitionBy("user_id").orderBy("minute"))
    markers = minutes.select("user_id", "minute", next_minute.alias("ts")).where(F.col("ts").isNotNull())
    marked = rows.withColumn("marker", F.lit(False)).unionByName(
        markers.withColumn("marker", F.lit(True)), allowMissingColumns=True
    )
    in_minute = W.partitionBy("user_id", "minute").orderBy("ts", "event_id")
    return marked.withColumn("next_ts", F.lead("ts").over(in_minute)).where(~F.col("marker"))


def raw_trips(events: DataFrame) -> DataFrame:
    """Trips with the usual dirt: NULL keys, zero, negative and far distances, negative money."""

    def less(column: str, amount: int) -> Column:
        return (F.col(column).cast("decimal(18,2)") - amount).cast("double")

    event = F.col("event_id")
    distance = F.when(event % 50 == 0, 0.0).when(event % 53 == 0, -F.col("value")).otherwise(F.col("value"))
    return with_next_time(events).select(
        "event_id",
        (F.col("user_id") % 3).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.col("next_ts").alias("tpep_dropoff_datetime"),
        F.nullif(event % 7, F.lit(6)).alias("passenger_count"),
        distance.alias("trip_distance"),
        F.nullif(F.col("user_id") % 30, F.lit(29)).alias("PULocationID"),
        F.nullif(event % 31, F.lit(30)).alias("DOLocationID"),
        (event % 5).alias("payment_type"),
        less("value", 5).alias("fare_amount"),
        less("value", 3).alias("total_amount"),
    )


def order_trips(lineitem: DataFrame) -> DataFrame:
    """Order lines as raw trips in the first days of their ship month: the first day for line 1, and so on."""
    pickup = F.date_trunc("month", "l_shipdate") + F.make_dt_interval(days=F.col("l_linenumber") - 1, hours=F.pmod("l_orderkey", F.lit(24)).cast("int"))
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        pickup.cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        (pickup + F.make_dt_interval(mins=F.col("l_quantity").cast("int"))).cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("long").alias("passenger_count"),
        (F.col("l_discount") * 100).alias("trip_distance"),
        F.pmod("l_suppkey", F.lit(30)).cast("int").alias("PULocationID"),
        F.pmod("l_partkey", F.lit(31)).cast("int").alias("DOLocationID"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def zone_rows(nation: DataFrame, region: DataFrame) -> DataFrame:
    """One row per nation, and a second one for nation 7."""
    named = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    rows = named.select(
        F.col("n_nationkey").alias("LocationID"), F.col("n_name").alias("Zone"), F.col("r_name").alias("Borough")
    )
    old = rows.where(F.col("LocationID") == 7).withColumn("Zone", F.concat("Zone", F.lit("_OLD")))
    return rows.unionByName(old)


def zones(nation: DataFrame, region: DataFrame) -> DataFrame:
    return one_row_per_key(zone_rows(nation, region), ["LocationID"])


def detail(events: DataFrame) -> DataFrame:
    """The detail layer in one go: distinct clean trips.

    Rows are made distinct before columns are derived, so the shuffle carries
    the raw columns only; the cleaning filters are still pushed below it.
    """
    return clean_detail(raw_trips(events).dropDuplicates())
