"""Column names, schemas and table keys of the layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TripColumns:
    """Names of the raw columns the cleaning rules look at."""

    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    passengers: str = "passenger_count"
    distance: str = "trip_distance"
    pickup_zone: str = "PULocationID"
    dropoff_zone: str = "DOLocationID"
    total: str = "total_amount"


TRIP = TripColumns()

# Raw column names, month file names, partition column, layer table names and keys.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

ZONE_CSV_SCHEMA = T.StructType(
    [
        T.StructField("Location ID", T.IntegerType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("Borough", T.StringType()),
    ]
)

MONTH_FILE_PATTERN = r"yellow_tripdata_(\d{4})-(\d{2})\.parquet"
DATE_KEY = "trip_date"

DETAIL = "dwd/dwd_taxi_trip"
DAILY = "dws/dws_daily_taxi"
HOURLY = "dws/dws_hourly_taxi"
LOCATION = "dws/dws_location_taxi"
LOCATION_ZONE = "dws/dws_location_zone"
TOP_TRIPS = "ads/location_trip_top10"
TOP_REVENUE = "ads/ads_location_revenue_top10"
TOP_AVG_REVENUE = "ads/ads_location_avg_revenue_top10"
BOROUGH_TOP = "ads/ads_borough_location_top3"
UNMATCHED = "ads/ads_location_data_quality"
OVERALL = "ads/ads_overall_metrics"

ZONE_COLUMNS = ["PULocationID", "Zone", "Borough", "trip_count", "total_revenue", "avg_revenue", "avg_distance"]

# Sums by date, hour and zone that every aggregate is rolled up from; not a table of the reports.
PARTIALS = "dws/trip_partials"
# Totals by hour and by zone, kept up by the difference of the dates that changed.
HOURLY_TOTALS = "dws/hourly_totals"
LOCATION_TOTALS = "dws/location_totals"
