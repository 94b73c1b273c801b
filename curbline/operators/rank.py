"""Top-k, top-k per group, and ranks over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.session import freeze


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest ``by``, ties by ascending ``tie``."""
    return df.orderBy(F.desc_nulls_last(by), F.asc(tie)).limit(k)


def top_k_per_group(df: DataFrame, group: str, by: str, k: int, tie: str, rank: str) -> DataFrame:
    """The k largest rows of each non-NULL group; each task cuts its groups to k before the shuffle."""
    order = W.partitionBy(group).orderBy(F.desc_nulls_last(by), F.asc(tie))
    return (
        df.where(F.col(group).isNotNull())
        .withColumn(rank, F.row_number().over(order))
        .where(F.col(rank) <= k)
    )


def borough_top(location_zone: DataFrame, k: int = 3) -> DataFrame:
    top = top_k_per_group(location_zone, "Borough", "trip_count", k, "PULocationID", "location_rank")
    return top.select(
        "Borough",
        "location_rank",
        "PULocationID",
        "Zone",
        "trip_count",
        "total_revenue",
        "avg_revenue",
        "avg_distance",
    ).orderBy("Borough", "location_rank")


def range_parts(df: DataFrame, order) -> DataFrame:
    """Rows placed in sort order over the tasks, with the number of their part in ``_part``."""
    return df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())


def global_ranks(df: DataFrame, by: str, tie: str) -> DataFrame:
    """row_number (ties by ``tie``, which must be unique), rank and dense_rank by descending ``by``.

    Rows are ranked inside range parts, then each part is shifted by what comes
    before it. A value may straddle parts: the later part then goes on with the rank at
    which its first value began, and does not count that value again.
    """
    order = [F.desc_nulls_last(by), F.asc(tie)]
    in_part = W.partitionBy("_part").orderBy(*order)
    value_in_part = W.partitionBy("_part").orderBy(order[0])
    local = freeze(
        range_parts(freeze(df), order).select(
            "*",
            F.row_number().over(in_part).alias("_row"),
            F.rank().over(value_in_part).alias("_rank"),
            F.dense_rank().over(value_in_part).alias("_dense"),
        )
    )

    # one row per part, never more than there are shuffle partitions
    parts = local.groupBy("_part").agg(
        F.max("_row").alias("rows"),
        F.max("_rank").alias("tail_rank"),
        F.max("_dense").alias("values"),
        F.min_by(by, "_row").alias("first_value"),
        F.max_by(by, "_row").alias("last_value"),
    )
    by_part = W.orderBy("_part")
    before = by_part.rowsBetween(W.unboundedPreceding, -1)
    goes_on = F.col("first_value").eqNullSafe(F.lag("last_value").over(by_part)) & (F.lag("rows").over(by_part).isNotNull())
    shifted = parts.withColumns(
        {
            "goes_on": goes_on,
            "rows_before": F.coalesce(F.sum("rows").over(before), F.lit(0)),
        }
    )
    tail_starts_here = ~(F.col("goes_on") & (F.col("tail_rank") == 1))
    shifted = shifted.withColumns(
        {
            "tail_start": F.when(tail_starts_here, F.col("rows_before") + F.col("tail_rank")),
            "new_values": F.col("values") - F.col("goes_on").cast("int"),
        }
    )
    shifted = shifted.select(
        "_part",
        "rows_before",
        "goes_on",
        F.last("tail_start", ignorenulls=True).over(before).alias("open_start"),
        (F.coalesce(F.sum("new_values").over(before), F.lit(0)) - F.col("goes_on").cast("int")).alias("values_before"),
    )

    in_open_run = F.col("goes_on") & (F.col("_rank") == 1)
    return local.join(F.broadcast(shifted), "_part").select(
        *df.columns,
        (F.col("rows_before") + F.col("_row")).alias("row_number"),
        F.when(in_open_run, F.col("open_start")).otherwise(F.col("rows_before") + F.col("_rank")).alias("rank"),
        (F.col("values_before") + F.col("_dense")).alias("dense_rank"),
    )


def location_ranks(locations: DataFrame) -> DataFrame:
    """The three ranks of the zones, as int: there are no more zones than int ids."""
    ranked = global_ranks(locations, "trip_count", "PULocationID")
    return ranked.withColumns({name: F.col(name).cast("int") for name in ("row_number", "rank", "dense_rank")})
