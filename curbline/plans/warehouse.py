"""All layers from raw months to reports, each table built by one function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curbline import contracts as C
from curbline.operators import metrics as M
from curbline.operators.enrich import location_zone, unmatched_keys
from curbline.operators.rank import borough_top, location_ranks, top_k
from curbline.plans.incremental import LoadResult, load_months, refresh_by_date
from curbline.plans.totals import maintain_totals
from curbline.sinks.parquet import overwrite
from curbline.sinks.publish import audit_outputs
from curbline.sources.files import load_dimension

TABLES = [
    C.DETAIL,
    C.DAILY,
    C.HOURLY,
    C.LOCATION,
    C.LOCATION_ZONE,
    C.TOP_TRIPS,
    C.TOP_REVENUE,
    C.TOP_AVG_REVENUE,
    C.BOROUGH_TOP,
    C.UNMATCHED,
    C.OVERALL,
]


def top_zones(zones: DataFrame, by: str, k: int = 10) -> DataFrame:
    return top_k(zones, by, k, "PULocationID").select(*C.ZONE_COLUMNS)


def build_aggregates(spark: SparkSession, warehouse: str, zones: DataFrame) -> None:
    """Daily, hourly and zone tables.

    Detail rows are read once, and only for the dates that changed, to renew
    their partials; of the partials, too, only those dates are read to renew the other tables.
    """
    partials_path = f"{warehouse}/{C.PARTIALS}"
    refresh_by_date(
        spark, f"{warehouse}/{C.DETAIL}", partials_path, lambda detail: M.partial_metrics(detail, M.PARTIAL_KEYS)
    )
    refresh_by_date(
        spark,
        partials_path,
        f"{warehouse}/{C.DAILY}",
        lambda partials: M.metrics_from_partials(partials, [C.DATE_KEY], M.DAILY_MEASURES),
    )
    hours = maintain_totals(spark, partials_path, f"{warehouse}/{C.HOURLY_TOTALS}", ["pickup_hour"], M.HOURLY_MEASURES)
    hourly = M.finish_metrics(hours, ["pickup_hour"], M.HOURLY_MEASURES)
    overwrite(hourly.orderBy("pickup_hour"), f"{warehouse}/{C.HOURLY}")
    places = maintain_totals(spark, partials_path, f"{warehouse}/{C.LOCATION_TOTALS}", ["PULocationID"], M.LOCATION_MEASURES)
    locations = M.finish_metrics(places, ["PULocationID"], M.LOCATION_MEASURES)
    overwrite(location_ranks(locations), f"{warehouse}/{C.LOCATION}")
    ranked = spark.read.parquet(f"{warehouse}/{C.LOCATION}")
    overwrite(location_zone(ranked, zones), f"{warehouse}/{C.LOCATION_ZONE}")


def build_reports(spark: SparkSession, warehouse: str) -> None:
    """The report tables, all from the zone table."""
    zones = spark.read.parquet(f"{warehouse}/{C.LOCATION_ZONE}")
    overwrite(top_zones(zones, "trip_count"), f"{warehouse}/{C.TOP_TRIPS}")
    overwrite(top_zones(zones, "total_revenue"), f"{warehouse}/{C.TOP_REVENUE}")
    overwrite(top_zones(zones, "avg_revenue"), f"{warehouse}/{C.TOP_AVG_REVENUE}")
    overwrite(borough_top(zones), f"{warehouse}/{C.BOROUGH_TOP}")
    overwrite(unmatched_keys(zones), f"{warehouse}/{C.UNMATCHED}")
    overwrite(M.overall_metrics(zones), f"{warehouse}/{C.OVERALL}")


def run_warehouse(
    spark: SparkSession,
    raw_dir: str,
    warehouse: str,
    zone_csv: str,
    schema: T.StructType | None = None,
    allow_losses: bool = False,
) -> tuple[LoadResult, DataFrame]:
    """Load missing months, renew what depends on them, and audit the tables."""
    loaded = load_months(spark, raw_dir, f"{warehouse}/{C.DETAIL}", schema, allow_losses=allow_losses)
    build_aggregates(spark, warehouse, load_dimension(spark, zone_csv))
    build_reports(spark, warehouse)
    return loaded, audit_outputs(spark, warehouse, TABLES)
