"""Grouped trip metrics, and the additive partials they roll up from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.contracts import DATE_KEY
from curbline.functions.exprs import beyond_cents, cents, from_cents, round2, sum_cents


@dataclass(frozen=True)
class Measure:
    """What to report of a column; a statistic without an output name is left out."""

    column: str
    total: str | None = None
    mean: str | None = None
    low: str | None = None
    high: str | None = None


REVENUE = Measure("total_amount", total="total_revenue", mean="avg_revenue")
DISTANCE = Measure("trip_distance", mean="avg_distance")
DURATION = Measure("trip_duration_minutes", mean="avg_duration")
DURATION_RANGE = Measure("trip_duration_minutes", mean="avg_duration", low="min_duration", high="max_duration")

LOCATION_MEASURES = (REVENUE, DISTANCE)
HOURLY_MEASURES = (REVENUE, DISTANCE, DURATION)
DAILY_MEASURES = (REVENUE, DISTANCE, DURATION_RANGE)

PARTIAL_KEYS = (DATE_KEY, "pickup_hour", "PULocationID")


def _partial_columns(measure: Measure) -> dict[str, tuple]:
    """Name of each partial column: how a detail column fills it, how two partials combine."""
    name, value = measure.column, F.col(measure.column)
    columns = {
        f"{name}__cents": (sum_cents(value), F.sum),
        f"{name}__rest": (F.sum(beyond_cents(value)), F.sum),
        f"{name}__n": (F.count(value), F.sum),
    }
    if measure.low:
        columns[f"{name}__min"] = (F.min(value), F.min)
    if measure.high:
        columns[f"{name}__max"] = (F.max(value), F.max)
    return columns


def partial_metrics(df: DataFrame, keys, measures=DAILY_MEASURES) -> DataFrame:
    """Row counts and additive sums by key.

    Partials by (date, hour, zone) carry every aggregate, so detail rows are
    scanned once, and only for the dates that changed.
    """
    aggregates = [F.count("*").alias("trip_count")]
    for measure in measures:
        aggregates += [fill.alias(name) for name, (fill, _) in _partial_columns(measure).items()]
    return df.groupBy(*keys).agg(*aggregates)


def roll_up(partials: DataFrame, keys, measures) -> DataFrame:
    """Partials by fewer keys."""
    aggregates = [F.sum("trip_count").alias("trip_count")]
    for measure in measures:
        aggregates += [combine(F.col(name)).alias(name) for name, (_, combine) in _partial_columns(measure).items()]
    return partials.groupBy(*keys).agg(*aggregates)


def _reported(measure: Measure) -> list[Column]:
    name = measure.column
    total = from_cents(F.col(f"{name}__cents"), F.col(f"{name}__rest"))
    count = F.col(f"{name}__n")
    columns = []
    if measure.total:
        columns.append(round2(total).alias(measure.total))
    if measure.mean:
        columns.append(round2(F.try_divide(total, count.cast("double"))).alias(measure.mean))
    if measure.low:
        columns.append(round2(F.col(f"{name}__min")).alias(measure.low))
    if measure.high:
        columns.append(round2(F.col(f"{name}__max")).alias(measure.high))
    return columns


def finish_metrics(partials: DataFrame, keys, measures) -> DataFrame:
    """Totals, means and extremes, rounded to two places as they are stored."""
    columns = [column for measure in measures for column in _reported(measure)]
    return partials.select(*keys, "trip_count", *columns)


def grouped_metrics(df: DataFrame, keys, measures) -> DataFrame:
    return finish_metrics(partial_metrics(df, keys, measures), keys, measures)


def daily_metrics(detail: DataFrame) -> DataFrame:
    return grouped_metrics(detail, [DATE_KEY], DAILY_MEASURES)


def hourly_metrics(detail: DataFrame) -> DataFrame:
    return grouped_metrics(detail, ["pickup_hour"], HOURLY_MEASURES).orderBy("pickup_hour")


def location_metrics(detail: DataFrame) -> DataFrame:
    return grouped_metrics(detail, ["PULocationID"], LOCATION_MEASURES)


def metrics_from_partials(partials: DataFrame, keys, measures) -> DataFrame:
    return finish_metrics(roll_up(partials, keys, measures), keys, measures)


def overall_metrics(locations: DataFrame) -> DataFrame:
    """One row over all zones; the means are weighted by trips, from the rounded zone values."""
    revenue, distance = F.col("total_revenue"), F.col("avg_distance")
    trips = F.col("total_trip_count").cast("double")
    weighted = F.sum(cents(distance).cast("decimal(19,0)") * F.col("trip_count").cast("decimal(19,0)"))
    weighted_rest = F.sum(beyond_cents(distance) * F.col("trip_count"))
    return locations.agg(
        F.sum("trip_count").alias("total_trip_count"),
        from_cents(sum_cents(revenue), F.sum(beyond_cents(revenue))).alias("total_revenue"),
        from_cents(weighted, weighted_rest).alias("weighted_distance"),
    ).select(
        "total_trip_count",
        "total_revenue",
        round2(F.try_divide(F.col("total_revenue"), trips)).alias("avg_revenue"),
        round2(F.try_divide(F.col("weighted_distance"), trips)).alias("avg_distance"),
    )


def total_of(df: DataFrame, column: str = "trip_count", alias: str = "total_trip_count") -> DataFrame:
    return df.agg(F.sum(column).alias(alias))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))
