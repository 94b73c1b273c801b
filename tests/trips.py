"""Small raw trip frames."""

import datetime as dt

RAW = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count bigint,"
    " trip_distance double, PULocationID int, DOLocationID int, total_amount double"
)


def at(text):
    return dt.datetime.fromisoformat(text)


def trip(pickup="2024-01-05 10:00:00", seconds=600, passengers=1, distance=2.5, pu=1, do=2, total=10.0):
    start = at(pickup) if pickup else None
    end = start + dt.timedelta(seconds=seconds) if start is not None and seconds is not None else None
    return (start, end, passengers, distance, pu, do, total)


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, RAW)


def whole_month(year, month, **changes):
    """One trip on every day of a month."""
    day = dt.date(year, month, 1)
    rows = []
    while day.month == month:
        rows.append(trip(f"{day} 10:00:00", **changes))
        day += dt.timedelta(days=1)
    return rows


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is not None, str(v)) for v in row])
