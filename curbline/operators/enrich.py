"""Joining aggregates with a dimension, and the report on keys it does not know."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.contracts import ZONE_COLUMNS
from curbline.functions.exprs import beyond_cents, from_cents, sum_cents


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One real row of each key, the smallest in the order of the other columns."""
    rest = [name for name in df.columns if name not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row")).select(*keys, "row.*")


def location_zone(locations: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone names beside the location metrics; unknown ids keep NULL names.

    Both sides are reduced to one row per id, so the join neither multiplies
    rows nor has a hot key. Whether to broadcast is left to the size Spark sees.
    """
    joined = locations.join(zones, locations["PULocationID"] == zones["LocationID"], "left")
    return joined.select(*ZONE_COLUMNS)


def unmatched_rows(location_zone: DataFrame) -> DataFrame:
    return location_zone.where(F.col("Zone").isNull() | F.col("Borough").isNull())


def unmatched_keys(location_zone: DataFrame) -> DataFrame:
    revenue, mean = F.col("total_revenue"), F.col("avg_revenue")
    return (
        unmatched_rows(location_zone)
        .groupBy("PULocationID")
        .agg(
            F.count("*").alias("record_count"),
            F.sum("trip_count").alias("trip_count"),
            from_cents(sum_cents(revenue), F.sum(beyond_cents(revenue))).alias("total_revenue"),
            F.try_divide(
                from_cents(sum_cents(mean), F.sum(beyond_cents(mean))), F.count(mean).cast("double")
            ).alias("avg_revenue"),
        )
        .orderBy(F.desc_nulls_last("trip_count"), F.asc("PULocationID"))
    )


def rows_with_key(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))
