"""Checks between layers and the series behind the charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions.exprs import round2


def reconcile_totals(layers: dict[str, DataFrame], report: DataFrame, column: str, reported: str) -> DataFrame:
    """The total of each layer beside the one the report states; ``ok`` where they agree."""
    sides = [
        df.agg(F.sum(column).alias("layer_total"), F.lit(None).cast("bigint").alias("report_total")).select(
            F.lit(name).alias("layer"), "layer_total", "report_total"
        )
        for name, df in layers.items()
    ]
    names = F.array(*[F.lit(name) for name in layers])
    rows = report.select(
        F.explode(names).alias("layer"), F.lit(None).cast("bigint").alias("layer_total"), F.col(reported).alias("report_total")
    )
    for side in sides:
        rows = rows.unionByName(side)
    totals = rows.groupBy("layer").agg(F.max("layer_total").alias("layer_total"), F.max("report_total").alias("report_total"))
    return totals.withColumn("ok", F.col("layer_total").eqNullSafe(F.col("report_total")))


def recheck_average(overall: DataFrame) -> DataFrame:
    """The stored mean beside the one recomputed from the stored totals."""
    recomputed = round2(F.try_divide(F.col("total_revenue"), F.col("total_trip_count").cast("double")))
    return overall.select("total_revenue", "total_trip_count", "avg_revenue", recomputed.alias("recomputed")).withColumn(
        "ok", F.col("avg_revenue").eqNullSafe(F.col("recomputed"))
    )


def chart_hourly(hourly: DataFrame) -> DataFrame:
    return hourly.select("pickup_hour", "trip_count").orderBy("pickup_hour")


def chart_zones(top: DataFrame, measure: str) -> DataFrame:
    return top.select("Zone", measure).orderBy(F.desc_nulls_last(measure), F.asc("Zone"))


def chart_borough(borough_top: DataFrame) -> DataFrame:
    named = borough_top.where(F.col("Borough").isNotNull())
    return named.select("Borough", "Zone", "trip_count").orderBy("Borough", F.desc("trip_count"), "Zone")


def chart_overall(overall: DataFrame) -> DataFrame:
    """The four figures of the metric card, one row each."""

    def card(position: int, label: str, value: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"), F.lit(label).alias("metric"), value.cast("double").alias("value")
        )

    cards = F.array(
        card(1, "Total Trips", F.col("total_trip_count")),
        card(2, "Total Revenue", F.col("total_revenue")),
        card(3, "Avg Revenue", F.col("avg_revenue")),
        card(4, "Avg Distance", F.col("avg_distance")),
    )
    return overall.select(F.inline(cards))
