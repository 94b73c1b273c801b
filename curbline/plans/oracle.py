"""The same queries as SQL for an independent engine, over the same tables."""

from __future__ import annotations

RAW = """
raw_trips AS (
  SELECT event_id, user_id % 3 AS VendorID, ts AS tpep_pickup_datetime,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS tpep_dropoff_datetime,
         nullif(event_id % 7, 6) AS passenger_count,
         CASE WHEN event_id % 50 = 0 THEN 0.0 WHEN event_id % 53 = 0 THEN -value ELSE value END AS trip_distance,
         nullif(user_id % 30, 29) AS PULocationID, nullif(event_id % 31, 30) AS DOLocationID,
         event_id % 5 AS payment_type,
         CAST(CAST(value AS decimal(18,2)) - 5 AS double) AS fare_amount,
         CAST(CAST(value AS decimal(18,2)) - 3 AS double) AS total_amount
  FROM events)"""

SECONDS = "date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)"


def two_places(value: str) -> str:
    return f"CAST(round(CAST({value} AS decimal(38,10)), 2) AS double)"


def total(column: str) -> str:
    return f"CAST(sum(CAST({column} AS decimal(18,2))) AS double)"


def mean(column: str) -> str:
    return f"{total(column)} / count({column})"


DETAIL_RULES = f"""tpep_dropoff_datetime > tpep_pickup_datetime AND trip_distance > 0 AND trip_distance <= 100
    AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AND {SECONDS} > 0 AND {SECONDS} <= 86400"""

STUDY_RULES = f"""passenger_count > 0 AND trip_distance > 0 AND tpep_dropoff_datetime > tpep_pickup_datetime
    AND total_amount >= 0 AND {SECONDS} > 0 AND {SECONDS} <= 86400"""

DERIVED = f"""CAST(tpep_pickup_datetime AS date) AS trip_date,
         CAST(hour(tpep_pickup_datetime) AS integer) AS pickup_hour"""

DWD = f"""
dwd AS (
  SELECT t.*, {DERIVED},
         {two_places(f"CAST({SECONDS} AS double) / 60")} AS trip_duration_minutes
  FROM (SELECT DISTINCT * FROM raw_trips) t
  WHERE {DETAIL_RULES})"""

STUDY = f"""
study AS (
  SELECT t.*, {DERIVED}, CAST({SECONDS} AS double) / 60 AS trip_duration_minutes
  FROM raw_trips t
  WHERE {STUDY_RULES})"""

ZONE_ROWS = """
zone_rows AS (
  SELECT n_nationkey AS LocationID, n_name AS Zone, r_name AS Borough
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT n_nationkey, concat(n_name, '_OLD'), r_name
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = 7)"""

ZONES = """
zones AS (
  SELECT LocationID, min(Zone) AS Zone, min(Borough) AS Borough FROM zone_rows GROUP BY LocationID)"""

REVENUE = f"""{two_places(total("total_amount"))} AS total_revenue, {two_places(mean("total_amount"))} AS avg_revenue"""
DISTANCE = f"""{two_places(mean("trip_distance"))} AS avg_distance"""
DURATION = f"""{two_places(mean("trip_duration_minutes"))} AS avg_duration"""
EXTREMES = f"""{two_places("min(trip_duration_minutes)")} AS min_duration,
         {two_places("max(trip_duration_minutes)")} AS max_duration"""

DAILY = f"""
daily AS (
  SELECT trip_date, count(*) AS trip_count, {REVENUE}, {DISTANCE}, {DURATION}, {EXTREMES}
  FROM dwd GROUP BY trip_date)"""

HOURLY = f"""
hourly AS (
  SELECT pickup_hour, count(*) AS trip_count, {REVENUE}, {DISTANCE}, {DURATION}
  FROM dwd GROUP BY pickup_hour)"""

LOCATION = f"""
location AS (
  SELECT PULocationID, count(*) AS trip_count, {REVENUE}, {DISTANCE}
  FROM dwd GROUP BY PULocationID)"""

ZONE_COLUMNS = "PULocationID, Zone, Borough, trip_count, total_revenue, avg_revenue, avg_distance"

LOCATION_ZONE = f"""
location_zone AS (
  SELECT {ZONE_COLUMNS} FROM location LEFT JOIN zones ON PULocationID = LocationID)"""

OVERALL = f"""
overall AS (
  SELECT total_trip_count, total_revenue,
         {two_places("total_revenue / total_trip_count")} AS avg_revenue,
         {two_places("weighted / total_trip_count")} AS avg_distance
  FROM (SELECT CAST(sum(trip_count) AS bigint) AS total_trip_count, {total("total_revenue")} AS total_revenue,
               CAST(sum(CAST(avg_distance AS decimal(18,2)) * trip_count) AS double) AS weighted
        FROM location_zone) t)"""

BOROUGH = """
borough_top AS (
  SELECT Borough, CAST(location_rank AS integer) AS location_rank, PULocationID, Zone,
         trip_count, total_revenue, avg_revenue, avg_distance
  FROM (SELECT *, row_number() OVER (PARTITION BY Borough ORDER BY trip_count DESC, PULocationID) AS location_rank
        FROM location_zone WHERE Borough IS NOT NULL) t
  WHERE location_rank <= 3)"""

MIDDLE = """
middle AS (
  SELECT CAST(min(ts) AS date) + CAST(date_diff('day', CAST(min(ts) AS date), CAST(max(ts) AS date)) // 2 AS integer) AS day
  FROM events)"""

ORDER_TRIPS = f"""
order_raw AS (
  SELECT l_orderkey, l_linenumber, pickup AS tpep_pickup_datetime,
         pickup + to_minutes(CAST(trunc(l_quantity) AS integer)) AS tpep_dropoff_datetime,
         CAST(l_linenumber AS bigint) AS passenger_count, l_discount * 100 AS trip_distance,
         CAST(l_suppkey % 30 AS integer) AS PULocationID, CAST(l_partkey % 31 AS integer) AS DOLocationID,
         l_extendedprice AS total_amount
  FROM (SELECT *, CAST(date_trunc('month', l_shipdate) AS timestamp) + to_days(l_linenumber - 1)
                  + to_hours(CAST(l_orderkey % 24 AS integer)) AS pickup FROM lineitem) t),
order_dwd AS (
  SELECT t.*, {DERIVED},
         {two_places(f"CAST({SECONDS} AS double) / 60")} AS trip_duration_minutes
  FROM (SELECT DISTINCT * FROM order_raw) t
  WHERE {DETAIL_RULES})"""

LOST = """
lost AS (
  SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS year_month,
         [{'name': 'passenger_count', 'lost': passenger_count NOT BETWEEN -128 AND 127},
          {'name': 'trip_distance', 'lost': trip_distance <> trunc(trip_distance)},
          {'name': 'total_amount', 'lost': abs(total_amount) > 9999.99
                                           OR CAST(CAST(total_amount AS decimal(18,2)) AS double) <> total_amount}] AS losses
  FROM order_raw)"""

FRONT = (RAW, DWD)
ZONED = (RAW, DWD, ZONE_ROWS, ZONES, LOCATION, LOCATION_ZONE)


def select(parts, body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body


def top_zones(by: str, columns: str = ZONE_COLUMNS) -> str:
    return f"SELECT {columns} FROM location_zone ORDER BY {by} DESC NULLS LAST, PULocationID LIMIT 10"


def rejects(rule_set: str, rules: list[tuple[str, str]]) -> str:
    rows, before = [], "true"
    for position, (name, keep) in enumerate(rules, start=1):
        kept = f"coalesce({keep}, false)"
        rows.append(
            f"SELECT '{rule_set}' AS rule_set, CAST({position} AS integer) AS position, '{name}' AS rule,"
            f" count(*) FILTER (WHERE NOT {kept}) AS failing,"
            f" count(*) FILTER (WHERE {before} AND NOT {kept}) AS first_failing FROM raw_trips"
        )
        before += f" AND {kept}"
    return "\nUNION ALL ".join(rows)


WITHIN_DAY = f"({SECONDS} > 0 AND {SECONDS} <= 86400)"

REJECTS = (
    rejects(
        "detail",
        [
            ("pickup_present", "(tpep_pickup_datetime IS NOT NULL)"),
            ("dropoff_present", "(tpep_dropoff_datetime IS NOT NULL)"),
            ("dropoff_after_pickup", "(tpep_dropoff_datetime > tpep_pickup_datetime)"),
            ("distance_positive", "(trip_distance > 0)"),
            ("distance_at_most_100", "(trip_distance <= 100)"),
            ("pickup_zone_present", "(PULocationID IS NOT NULL)"),
            ("dropoff_zone_present", "(DOLocationID IS NOT NULL)"),
            ("lasts_up_to_a_day", WITHIN_DAY),
        ],
    )
    + "\nUNION ALL "
    + rejects(
        "exploratory",
        [
            ("passengers_positive", "(passenger_count > 0)"),
            ("distance_positive", "(trip_distance > 0)"),
            ("dropoff_after_pickup", "(tpep_dropoff_datetime > tpep_pickup_datetime)"),
            ("total_not_negative", "(total_amount >= 0)"),
            ("pickup_present", "(tpep_pickup_datetime IS NOT NULL)"),
            ("dropoff_present", "(tpep_dropoff_datetime IS NOT NULL)"),
            ("lasts_up_to_a_day", WITHIN_DAY),
        ],
    )
)


def numeric_profile(source: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER (WHERE {c} = 0) AS zeros,"
        f" count(*) FILTER (WHERE {c} < 0) AS negatives, min({c} + 0.0) AS low, max({c} + 0.0) AS high,"
        f" {mean(c)} AS mean FROM {source}"
        for c in columns
    )


def null_profile(source: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {source}"
        for c in columns
    )


def quantile_summary(source: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, min({c} + 0.0) AS min, quantile_disc({c} + 0.0, 0.25) AS p25,"
        f" quantile_disc({c} + 0.0, 0.5) AS p50, quantile_disc({c} + 0.0, 0.75) AS p75, max({c} + 0.0) AS max FROM {source}"
        for c in columns
    )


BAND_CONDITIONS = {
    "trip_distance": [
        ("0", "v = 0"),
        ("0~5", "v > 0 AND v <= 5"),
        ("5~10", "v > 5 AND v <= 10"),
        ("10~20", "v > 10 AND v <= 20"),
        ("20~50", "v > 20 AND v <= 50"),
        ("50~100", "v > 50 AND v <= 100"),
        ("100+", "v >= 100"),
        ("unbanded", "v < 0 OR v IS NULL"),
    ],
    "fare_amount": [
        ("negative", "v < 0"),
        ("0~10", "v > 0 AND v <= 10"),
        ("10~20", "v > 10 AND v <= 20"),
        ("20~50", "v > 20 AND v <= 50"),
        ("50~100", "v > 50 AND v <= 100"),
        ("100+", "v >= 100"),
        ("unbanded", "v = 0 OR v IS NULL"),
    ],
    "total_amount": [
        ("negative", "v < 0"),
        ("0~20", "v > 0 AND v <= 20"),
        ("20~50", "v > 20 AND v <= 50"),
        ("50~100", "v > 50 AND v <= 100"),
        ("100~500", "v > 100 AND v <= 500"),
        ("500+", "v >= 500"),
        ("unbanded", "v = 0 OR v IS NULL"),
    ],
}

HISTOGRAM = "\nUNION ALL ".join(
    f"SELECT '{column}' AS \"column\", CAST({position} AS integer) AS position, '{band}' AS band,"
    f" count(*) FILTER (WHERE {condition}) AS rows FROM (SELECT {column} AS v FROM raw_trips) t"
    for column, bands in BAND_CONDITIONS.items()
    for position, (band, condition) in enumerate(bands, start=1)
)

RAW_COLUMNS = [
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
MONEY = ["trip_distance", "fare_amount", "total_amount"]
TIMES = "event_id, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime"
FAR = f"SELECT {TIMES}, trip_distance, fare_amount, total_amount, PULocationID, DOLocationID FROM raw_trips WHERE trip_distance > 100"

COVERAGE = """
days AS (SELECT DISTINCT CAST(o_orderdate AS date) AS day FROM orders),
coverage AS (
  SELECT strftime(day, '%Y-%m') AS year_month, count(*) AS days_present,
         CAST(day(last_day(min(day))) AS integer) AS days_in_month,
         count(*) = day(last_day(min(day))) AS covered
  FROM days GROUP BY 1)"""

RANKED_PARTS = """
WITH counts AS (SELECT l_partkey, count(*) AS line_count FROM lineitem GROUP BY l_partkey)
SELECT *, row_number() OVER (ORDER BY line_count DESC, l_partkey) AS row_number,
       rank() OVER (ORDER BY line_count DESC) AS rank, dense_rank() OVER (ORDER BY line_count DESC) AS dense_rank
FROM counts"""

PUBLISHED = [
    ("dws_daily_taxi", "SELECT count(*) FROM daily"),
    ("dws_hourly_taxi", "SELECT count(*) FROM hourly"),
    ("dws_location_taxi", "SELECT count(*) FROM location"),
    ("dws_location_zone", "SELECT count(*) FROM location_zone"),
    ("ads_overall_metrics", "SELECT 1"),
    ("ads_location_trip_top10", "SELECT least(10, count(*)) FROM location_zone"),
    ("ads_location_revenue_top10", "SELECT least(10, count(*)) FROM location_zone"),
    ("ads_location_avg_revenue_top10", "SELECT least(10, count(*)) FROM location_zone"),
    ("ads_borough_location_top3", "SELECT count(*) FROM borough_top"),
    ("ads_location_data_quality", "SELECT count(*) FROM location_zone WHERE Zone IS NULL OR Borough IS NULL"),
]

DATASETS = [
    "dwd/dwd_taxi_trip",
    "dws/dws_daily_taxi",
    "dws/dws_hourly_taxi",
    "dws/dws_location_taxi",
    "dws/dws_location_zone",
    "ads/location_trip_top10",
    "ads/ads_location_revenue_top10",
    "ads/ads_location_avg_revenue_top10",
    "ads/ads_borough_location_top3",
    "ads/ads_location_data_quality",
    "ads/ads_overall_metrics",
]

SELECT_DWD = select(FRONT, "SELECT * FROM dwd")
SELECT_HOURLY = select((*FRONT, HOURLY), "SELECT * FROM hourly")
SELECT_DAILY = select((*FRONT, DAILY), "SELECT * FROM daily")


def oracle_sql() -> dict[str, str]:
    reconciled = "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, CAST(sum(trip_count) AS bigint) AS layer_total,"
        f" (SELECT total_trip_count FROM overall) AS report_total,"
        f" sum(trip_count) = (SELECT total_trip_count FROM overall) AS ok FROM {layer}"
        for layer in ("daily", "hourly", "location")
    )
    published = "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"table\", 'ok' AS status, CAST(({rows}) AS bigint) AS source_rows,"
        f" CAST(({rows}) AS bigint) AS target_rows"
        for name, rows in PUBLISHED
    )
    cards = "\nUNION ALL ".join(
        f"SELECT CAST({position} AS integer) AS position, '{label}' AS metric, CAST({column} AS double) AS value FROM overall"
        for position, (label, column) in enumerate(
            [
                ("Total Trips", "total_trip_count"),
                ("Total Revenue", "total_revenue"),
                ("Avg Revenue", "avg_revenue"),
                ("Avg Distance", "avg_distance"),
            ],
            start=1,
        )
    )
    audited = "\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, (SELECT count(*) FROM dwd) > 0 AS ok" for name in DATASETS
    )
    return {
        "scan_raw": select((RAW,), "SELECT * FROM raw_trips"),
        "discover_months": "SELECT DISTINCT strftime(ts, '%Y-%m') AS year_month,"
        " concat('yellow_tripdata_', strftime(ts, '%Y-%m'), '.parquet') AS file_name FROM events",
        "scan_partitioned": SELECT_DWD,
        "list_partitions": select(
            FRONT, "SELECT DISTINCT trip_date, strftime(trip_date, '%Y-%m-%d') AS day_text FROM dwd"
        ),
        "pruned_read": select(
            (*FRONT, MIDDLE), "SELECT dwd.* FROM dwd, middle WHERE trip_date BETWEEN day - 1 AND day + 1"
        ),
        "load_dimension": "SELECT s_suppkey AS supplier_id, s_name, s_nationkey FROM supplier",
        "load_dimension_parts": "SELECT p_partkey AS part_id, p_name, p_brand, p_type, p_size FROM part",
        "clean_detail": SELECT_DWD,
        "clean_exploratory": select((RAW, STUDY), "SELECT * FROM study"),
        "rejects_by_rule": select((RAW,), REJECTS),
        "null_rows": select((RAW,), "SELECT * FROM raw_trips WHERE passenger_count IS NULL"),
        "negative_amounts": select(
            (RAW,), f"SELECT {TIMES}, trip_distance, fare_amount, total_amount, payment_type FROM raw_trips WHERE total_amount < 0"
        ),
        "negative_amounts_sample": select(
            (RAW,),
            f"SELECT {TIMES}, trip_distance, fare_amount, total_amount, payment_type FROM raw_trips"
            " WHERE total_amount < 0 ORDER BY event_id LIMIT 20",
        ),
        "payment_type_zero": select(
            (RAW,), f"SELECT {TIMES}, passenger_count, trip_distance, fare_amount, total_amount FROM raw_trips WHERE payment_type = 0"
        ),
        "far_trips": select((RAW,), FAR),
        "far_trips_sample": select((RAW,), f"{FAR} ORDER BY trip_distance DESC, event_id LIMIT 20"),
        "daily_metrics": SELECT_DAILY,
        "hourly_metrics": SELECT_HOURLY,
        "location_metrics": select((*FRONT, LOCATION), "SELECT * FROM location"),
        "rolled_up_hourly": SELECT_HOURLY,
        "maintained_hourly": SELECT_HOURLY,
        "maintained_locations": select((*FRONT, LOCATION), "SELECT * FROM location"),
        "overall_metrics": select((*ZONED, OVERALL), "SELECT * FROM overall"),
        "total_trips": select(FRONT, "SELECT count(*) AS total_trip_count FROM dwd"),
        "row_count": "SELECT count(*) AS rows FROM lineitem",
        "freq_passenger_count": select(
            (RAW,), "SELECT passenger_count, count(*) AS count FROM raw_trips GROUP BY passenger_count"
        ),
        "freq_payment_type": select((RAW,), "SELECT payment_type, count(*) AS count FROM raw_trips GROUP BY payment_type"),
        "numeric_profile": select((RAW,), numeric_profile("raw_trips", MONEY)),
        "numeric_profile_lineitem": numeric_profile("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
        "null_profile": select((RAW,), null_profile("raw_trips", RAW_COLUMNS)),
        "quantile_summary": select((RAW,), quantile_summary("raw_trips", MONEY)),
        "quantile_summary_lineitem": quantile_summary("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]),
        "range_histogram": select((RAW,), HISTOGRAM),
        "quality_bands": select((RAW,), HISTOGRAM),
        "quality_rejects": select((RAW,), REJECTS),
        "study_clean": select((RAW, STUDY), "SELECT * FROM study"),
        "duplicate_keys": "SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey HAVING count(*) > 1",
        "duplicate_keys_lineitem": "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem"
        " GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        "location_zone": select(ZONED, "SELECT * FROM location_zone"),
        "unmatched_keys": select(
            ZONED,
            "SELECT PULocationID, count(*) AS record_count, CAST(sum(trip_count) AS bigint) AS trip_count,"
            f" {total('total_revenue')} AS total_revenue, {mean('avg_revenue')} AS avg_revenue"
            " FROM location_zone WHERE Zone IS NULL OR Borough IS NULL GROUP BY PULocationID",
        ),
        "point_lookup": select(ZONED, "SELECT * FROM location_zone WHERE PULocationID = 7"),
        "location_ranks": select(
            (*FRONT, LOCATION),
            "SELECT *, CAST(row_number() OVER (ORDER BY trip_count DESC, PULocationID) AS integer) AS row_number,"
            " CAST(rank() OVER (ORDER BY trip_count DESC) AS integer) AS rank,"
            " CAST(dense_rank() OVER (ORDER BY trip_count DESC) AS integer) AS dense_rank FROM location",
        ),
        "part_ranks": RANKED_PARTS,
        "part_ranks_by_range": RANKED_PARTS,
        "borough_top3": select((*ZONED, BOROUGH), "SELECT * FROM borough_top"),
        "top10_trips": select(ZONED, top_zones("trip_count")),
        "top10_revenue": select(ZONED, top_zones("total_revenue")),
        "top10_avg_revenue": select(ZONED, top_zones("avg_revenue")),
        "top5_hours": select((*FRONT, HOURLY), "SELECT * FROM hourly ORDER BY trip_count DESC, pickup_hour LIMIT 5"),
        "month_coverage": "WITH" + COVERAGE + " SELECT * FROM coverage",
        "plan_months": "WITH" + COVERAGE + " SELECT year_month FROM coverage WHERE NOT covered",
        "missing_days": "WITH"
        + COVERAGE
        + """ SELECT year_month, d AS trip_date
  FROM (SELECT year_month, CAST(unnest(generate_series(CAST(concat(year_month, '-01') AS timestamp),
               CAST(last_day(CAST(concat(year_month, '-01') AS date)) AS timestamp), INTERVAL 1 DAY)) AS date) AS d
        FROM coverage) c
  WHERE NOT EXISTS (SELECT 1 FROM days WHERE days.day = c.d)""",
        "plan_dates": select(
            (*FRONT, MIDDLE),
            """SELECT trip_date, CASE WHEN bool_or(tpep_pickup_datetime < CAST(day AS timestamp) + INTERVAL 18 HOUR
              OR trip_date < day) THEN 'overlap' ELSE 'new' END AS kind
  FROM dwd, middle WHERE trip_date >= day GROUP BY trip_date
  HAVING bool_or(tpep_pickup_datetime >= CAST(day AS timestamp) + INTERVAL 6 HOUR)""",
        ),
        "merge_boundary": SELECT_DWD,
        "load_months": SELECT_DWD,
        "load_many_months": select((ORDER_TRIPS,), "SELECT * FROM order_dwd"),
        "load_deliveries": select(
            (ORDER_TRIPS,),
            """SELECT year_month, raw_rows, detail_rows
  FROM (SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS year_month, count(*) AS raw_rows FROM order_raw GROUP BY 1) r
  LEFT JOIN (SELECT strftime(trip_date, '%Y-%m') AS year_month, count(*) AS detail_rows FROM order_dwd GROUP BY 1) d
  USING (year_month)""",
        ),
        "cast_losses": select(
            (ORDER_TRIPS, LOST),
            """SELECT year_month, l.name AS "column", count(*) AS rows, CAST(sum(CAST(l.lost AS integer)) AS bigint) AS lost
  FROM (SELECT year_month, unnest(losses) AS l FROM lost) GROUP BY 1, 2""",
        ),
        "merge_by_key": select(
            (*FRONT, MIDDLE),
            """SELECT event_id, trip_date, trip_distance,
       CASE WHEN trip_date >= day THEN total_amount + 1 ELSE total_amount END AS total_amount,
       CASE WHEN trip_date >= day THEN 1.0::double END AS tip_amount
  FROM dwd, middle""",
        ),
        "stream_detail": SELECT_DWD,
        "stale_dates": select(
            (*FRONT, MIDDLE),
            "SELECT DISTINCT trip_date, CASE WHEN trip_date = day THEN 'recompute' ELSE 'add' END AS action"
            " FROM dwd, middle WHERE trip_date >= day",
        ),
        "refresh_daily": SELECT_DAILY,
        "overwrite_roundtrip": select(ZONED, "SELECT * FROM location_zone"),
        "replace_partitions": select(
            (*FRONT, STUDY, MIDDLE),
            "SELECT dwd.* FROM dwd, middle WHERE trip_date < day"
            " UNION ALL SELECT study.* FROM study, middle WHERE trip_date >= day",
        ),
        "upsert_by_key": f"""WITH middle AS (
  SELECT CAST(min(o_orderdate) AS date)
         + CAST(date_diff('day', CAST(min(o_orderdate) AS date), CAST(max(o_orderdate) AS date)) // 2 AS integer) AS day
  FROM orders),
totals AS (
  SELECT o_custkey, CAST(o_orderdate AS date) >= day AS late, count(*) AS order_count,
         {two_places(total("o_totalprice"))} AS total_price
  FROM orders, middle GROUP BY 1, 2)
SELECT o_custkey, order_count, total_price FROM totals WHERE late
UNION ALL
SELECT o_custkey, order_count, total_price FROM totals t WHERE NOT late
  AND NOT EXISTS (SELECT 1 FROM totals n WHERE n.late AND n.o_custkey = t.o_custkey)""",
        "upsert_last_order": """WITH middle AS (
  SELECT CAST(min(o_orderdate) AS date)
         + CAST(date_diff('day', CAST(min(o_orderdate) AS date), CAST(max(o_orderdate) AS date)) // 2 AS integer) AS day
  FROM orders)
SELECT o_custkey, o_orderkey, o_totalprice FROM orders, middle
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS date) >= day DESC, o_orderkey DESC) = 1""",
        "publish_replace": SELECT_HOURLY,
        "nan_to_null_columns": select(
            (RAW,),
            "SELECT event_id, payment_type, CASE WHEN trip_distance = 0 THEN NULL ELSE fare_amount / trip_distance END"
            " AS fare_per_distance FROM raw_trips",
        ),
        "publish_report": select((*ZONED, DAILY, HOURLY, BOROUGH), published),
        "publish_again": select(
            (
                *FRONT,
                MIDDLE,
                """
parts AS (
  SELECT dwd.*, tpep_pickup_datetime >= CAST(day AS timestamp) + INTERVAL 6 HOUR AS late, trip_date = day AS shared
  FROM dwd, middle)""",
            ),
            """(SELECT 'daily' AS published, CAST(trip_date AS varchar) AS key, count(*) AS trip_count
 FROM parts WHERE late OR NOT shared GROUP BY trip_date)
UNION ALL
(SELECT 'top', CAST(PULocationID AS varchar), count(*) FROM parts WHERE late
 GROUP BY PULocationID ORDER BY count(*) DESC, PULocationID LIMIT 10)""",
        ),
        "audit_outputs": select(FRONT, audited),
        "warehouse_daily": SELECT_DAILY,
        "reconcile_counts": select((*ZONED, DAILY, HOURLY, OVERALL), reconciled),
        "reconcile_avg": select(
            (*ZONED, OVERALL),
            "SELECT total_revenue, total_trip_count, avg_revenue,"
            f" {two_places('total_revenue / total_trip_count')} AS recomputed,"
            f" avg_revenue = {two_places('total_revenue / total_trip_count')} AS ok FROM overall",
        ),
        "chart_hourly": select((*FRONT, HOURLY), "SELECT pickup_hour, trip_count FROM hourly"),
        "chart_top_trips": select(ZONED, f"SELECT Zone, trip_count FROM ({top_zones('trip_count')}) t"),
        "chart_top_revenue": select(ZONED, f"SELECT Zone, total_revenue FROM ({top_zones('total_revenue')}) t"),
        "chart_borough": select((*ZONED, BOROUGH), "SELECT Borough, Zone, trip_count FROM borough_top"),
        "chart_overall": select((*ZONED, OVERALL), cards),
    }
