"""The data study of raw months: profiles, extracts of odd rows, and the exploratory cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.operators import clean, profile
from curbline.session import freeze
from curbline.sinks.parquet import overwrite
from curbline.sources.files import read_raw

MEASURES = ["trip_distance", "fare_amount", "total_amount"]

# The columns shown of each kind of odd row.
NULL_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "total_amount",
]
NEGATIVE_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "payment_type",
]
UNPAID_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
]
FAR_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "PULocationID",
    "DOLocationID",
]


def quality_report(df: DataFrame) -> dict[str, DataFrame]:
    """Null counts, numeric profile, band counts and rule rejects from one scan of the table."""
    rule_sets = {"detail": clean.detail_rules(), "exploratory": clean.exploratory_rules()}
    sections = {
        "nulls": profile.null_entries(df.columns),
        "numeric": profile.numeric_entries(MEASURES),
        "bands": profile.band_entries(profile.BANDS),
        "rejects": clean.reject_entries(rule_sets),
    }
    row = freeze(df.agg(*[F.array(*entries).alias(name) for name, entries in sections.items()]))
    return {name: row.select(F.inline(name)) for name in sections}


def odd_rows(df: DataFrame) -> dict[str, DataFrame]:
    """All rows of each kind; columns the table lacks are left out."""
    kinds = {
        "null_passengers": (F.col("passenger_count").isNull(), NULL_COLUMNS),
        "negative_amounts": (F.col("total_amount") < 0, NEGATIVE_COLUMNS),
        "payment_type_zero": (F.col("payment_type") == 0, UNPAID_COLUMNS),
        "far_trips": (F.col("trip_distance") > 100, FAR_COLUMNS),
    }
    return {
        name: profile.anomalies(df, condition, [column for column in columns if column in df.columns])
        for name, (condition, columns) in kinds.items()
    }


def study_months(spark: SparkSession, paths: list[str], out: str, schema: T.StructType | None = None) -> list[str]:
    """Write every table of the study under ``out`` and return their names."""
    raw = read_raw(spark, paths, schema)
    tables = quality_report(raw) | odd_rows(raw)
    tables["passenger_counts"] = profile.frequencies(raw, "passenger_count")
    tables["payment_types"] = profile.frequencies(raw, "payment_type")
    tables["quantiles"] = profile.quantile_summary(raw, MEASURES)
    tables["clean"] = clean.clean_exploratory(raw)
    for name, df in tables.items():
        overwrite(df, f"{out}/{name}")
    return list(tables)
