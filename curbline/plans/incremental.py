"""Loading only missing months and refreshing only dates that changed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.contracts import DATE_KEY, MONTH_FILE_PATTERN
from curbline.functions.dates import days_in_month, month_days, month_text
from curbline.operators.clean import clean_detail
from curbline.operators.metrics import daily_metrics
from curbline.plans.merge import SLICE_BYTES, SLICE_ROWS, one_exchange, plan_rows
from curbline.session import fitted_shuffles, freeze
from curbline.sinks.parquet import drop_partitions, recover, replace_partitions
from curbline.sources.files import (
    cast_losses,
    discover_files,
    is_partitioned,
    layouts,
    list_files,
    partition_files,
    path_exists,
    read_folders,
    read_raw,
    refuse_losses,
)

#: when a row's file was written; a column of tables that are merged by key
DELIVERED = "delivered_at"
#: bytes and files of raw data that are merged at once
GROUP_BYTES = 256 << 30
GROUP_FILES = 10_000
#: logs inside a table's folder, hidden from scans of the table
DELIVERIES = "_deliveries/log"
BUILT_FROM = "_built_from/log"


def month_coverage(months: DataFrame, dates: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """Per month: days that have a date, days it has, and whether every day is there."""
    present = (
        dates.select(key).distinct().groupBy(month_text(F.col(key)).alias("year_month")).agg(F.count(key).alias("days_present"))
    )
    covered = months.join(present, "year_month", "left").withColumns(
        {
            "days_present": F.coalesce("days_present", F.lit(0)),
            "days_in_month": days_in_month(F.col("year_month")),
        }
    )
    return covered.withColumn("covered", F.col("days_present") == F.col("days_in_month"))


def missing_days(months: DataFrame, dates: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """Calendar days of the months without a date."""
    return month_days(months.select("year_month"), day=key).join(dates.select(key).distinct(), key, "left_anti")


def plan_months(months: DataFrame, dates: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """The months still to load, in order."""
    return month_coverage(months, dates, key).where(~F.col("covered")).select(*months.columns).orderBy("year_month")


def plan_dates(fresh: DataFrame, existing: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """Each delivered date: ``overlap`` if the table already has it, else ``new``.

    ``existing`` has one row per date; its other columns are carried along.
    """
    delivered = fresh.select(key).distinct()
    known = existing.withColumn("known", F.lit(True))
    kind = F.when(F.col("known"), "overlap").otherwise("new").alias("kind")
    carried = [name for name in existing.columns if name != key]
    return delivered.join(known, key, "left").select(key, kind, *carried)


@dataclass
class LoadResult:
    months: list[str] = field(default_factory=list)
    new_dates: list = field(default_factory=list)
    overlap_dates: list = field(default_factory=list)
    groups: int = 0


def merge_into_detail(
    spark: SparkSession,
    cleaned: DataFrame,
    detail_path: str,
    listing: DataFrame | None = None,
    keys: list[str] | None = None,
    same_columns: bool = False,
) -> LoadResult:
    """Merge cleaned rows into the detail table and replace only the dates they touch.

    Without ``keys`` the distinct rows of both sides stay, and a column that one side lacks is NULL there, so that a row
    delivered again with a new column is a second row; ``same_columns`` refuses such a merge instead. With
    ``keys`` the row delivered last (by the column ``delivered_at``) is the only one of its key and date.

    The plan is one row per calendar day and is all the driver sees. Only the
    dates present on both sides are read back from the table. ``listing`` has
    the table's files, if the caller has listed them already.
    """
    recover(spark, detail_path)
    if listing is None:
        listing = list_files(spark, detail_path)
    order = DELIVERED if keys else None
    planned = plan_rows(cleaned, keys, order)
    existing = partition_files(listing).select(DATE_KEY, "folder", "bytes")
    slices = F.ceil(F.col("rows") / SLICE_ROWS + F.coalesce("bytes", F.lit(0)) / SLICE_BYTES)
    dates = plan_dates(planned.counts, existing).join(planned.counts, DATE_KEY)
    plan = dates.select(DATE_KEY, "kind", "folder", slices.alias("slices")).collect()
    overlap = {row[DATE_KEY]: row["folder"] for row in plan if row["kind"] == "overlap"}
    new = [row[DATE_KEY] for row in plan if row["kind"] == "new"]
    if plan:
        rows = cleaned
        if overlap:
            old = read_folders(spark, detail_path, sorted(overlap.values()))
            if same_columns and not keys and set(old.columns) != set(cleaned.columns):
                raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(cleaned.columns))}")
            rows = old.unionByName(cleaned, allowMissingColumns=True)
        sliced = spark.createDataFrame([(row[DATE_KEY], row["slices"]) for row in plan], f"{DATE_KEY} date, slices long")
        merged = one_exchange(rows, sliced, planned.frequent, keys, order)
        replace_partitions(merged, detail_path, gathered=True)
    return LoadResult(new_dates=sorted(new), overlap_dates=sorted(overlap))


def file_groups(
    files: DataFrame, group_bytes: int = GROUP_BYTES, group_files: int = GROUP_FILES
) -> list[tuple[list[str], DataFrame]]:
    """Files of the listing in groups of bounded bytes and number, in order of month: (months, files) of each.

    A month too large for a group is cut between its files; a single file is never cut. The driver sees a row a
    month and cut.
    """
    before = W.partitionBy("year_month").orderBy("modified", "path").rowsBetween(W.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("length").over(before), F.lit(0))
    number = F.count("*").over(before)
    cut = F.greatest(F.floor(ahead / group_bytes), F.floor(number / group_files))
    listed = freeze(files.withColumn("cut", cut))
    pieces = listed.groupBy("year_month", "cut").agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))
    groups: list[list] = []
    held = [0, 0]
    for piece in pieces.orderBy("year_month", "cut").collect():
        if not groups or held[0] + piece["bytes"] > group_bytes or held[1] + piece["files"] > group_files:
            groups.append([])
            held = [0, 0]
        groups[-1].append((piece["year_month"], piece["cut"]))
        held = [held[0] + piece["bytes"], held[1] + piece["files"]]
    found = []
    for group in groups:
        first, last = group[0], group[-1]
        month, number = F.col("year_month"), F.col("cut")
        begun = (month > first[0]) | (month == first[0]) & (number >= first[1])
        ended = (month > last[0]) | (month == last[0]) & (number > last[1])
        found.append((sorted({month for month, _ in group}), listed.where(begun & ~ended).drop("cut")))
    return found


def load_files(
    spark: SparkSession,
    files: DataFrame,
    detail_path: str,
    schema: T.StructType | None = None,
    keys: list[str] | None = None,
    group_bytes: int = GROUP_BYTES,
    merged: Callable[[DataFrame], None] | None = None,
    allow_losses: bool = False,
) -> LoadResult:
    """Merge the listed raw files group by group; ``merged`` is told of each group once its dates are in place.

    A group with values that the schema's types cannot hold is refused before any of it is written, unless ``allow_losses``.

    No group depends on a later one, and merging one again changes nothing, so a load that broke off can be repeated.
    Groups follow the months, so each reads back few dates of the one before.
    """
    result = LoadResult()
    for months, group in file_groups(files, group_bytes):
        paths = sorted(row["path"] for row in group.select("path").collect())
        size = group.agg(F.sum("length")).first()[0]
        with fitted_shuffles(spark, size):
            found = layouts(spark, paths) if schema else None
            if schema and not allow_losses:
                refuse_losses(cast_losses(spark, paths, schema, found=found))
            raw = read_raw(spark, paths, schema, DELIVERED if keys else None, found)
            part = merge_into_detail(spark, clean_detail(raw), detail_path, keys=keys)
        if merged:
            merged(group)
        result.months += [month for month in months if month not in result.months]
        again = set(part.new_dates) - set(result.overlap_dates)
        result.overlap_dates = sorted({*result.overlap_dates, *part.overlap_dates} - set(result.new_dates))
        result.new_dates = sorted({*result.new_dates, *again})
        result.groups += 1
    return result


def load_months(
    spark: SparkSession,
    raw_dir: str,
    detail_path: str,
    schema: T.StructType | None = None,
    pattern: str = MONTH_FILE_PATTERN,
    keys: list[str] | None = None,
    group_bytes: int = GROUP_BYTES,
    allow_losses: bool = False,
) -> LoadResult:
    """Load every month not yet covered, in groups of bounded bytes; nothing is written if none is missing.

    A month counts as covered once every one of its days is there, whatever is delivered for it later: see
    ``load_deliveries`` for files instead of days.
    """
    recover(spark, detail_path)
    found = discover_files(spark, raw_dir, pattern)
    missing = plan_months(found.select("year_month").distinct(), list_dates(spark, detail_path))
    files = found.join(missing, "year_month", "left_semi")
    return load_files(spark, files, detail_path, schema, keys, group_bytes, allow_losses=allow_losses)


def list_dates(spark: SparkSession, path: str) -> DataFrame:
    return partition_files(list_files(spark, path)).select(DATE_KEY)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a log of a table; none where there is no log yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


DELIVERY_COLUMNS = "path string, modified timestamp, length long, year_month string, rows long, batch long"


def delivered_files(spark: SparkSession, detail_path: str) -> DataFrame:
    """The files that the detail table holds: path, modified, length, year_month, their raw rows, and the batch that merged them."""
    return read_log(spark, f"{detail_path}/{DELIVERIES}", DELIVERY_COLUMNS)


def load_deliveries(
    spark: SparkSession,
    raw_dir: str,
    detail_path: str,
    schema: T.StructType | None = None,
    pattern: str = MONTH_FILE_PATTERN,
    keys: list[str] | None = None,
    group_bytes: int = GROUP_BYTES,
    allow_losses: bool = False,
) -> LoadResult:
    """Load every file that was not loaded yet as it stands now, in groups of bounded bytes.

    The table's log has path, time and length of each file that was merged. A month that lacks days is not
    loaded again, and one that is whole is loaded again for the files that were delivered anew: the file decides, not
    the dates. A group is logged after its dates are in place: a load that broke off in between merges that group again, to
    the same rows.
    """
    recover(spark, detail_path)
    known = delivered_files(spark, detail_path)
    found = discover_files(spark, raw_dir, pattern)
    fresh = found.join(known, ["path", "modified", "length"], "left_anti")
    last = known.agg(F.max("batch")).first()[0] or 0
    batches = iter(range(last + 1, 1 << 62))

    def log(group: DataFrame) -> None:
        paths = [row["path"] for row in group.select("path").collect()]
        # both kinds of listing name a file by the same path but for the slashes after the scheme
        plain = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
        rows = spark.read.option("mergeSchema", False).parquet(*paths).groupBy(plain.alias("path")).agg(F.count("*").alias("rows"))
        entries = group.join(rows, "path", "left").withColumn("batch", F.lit(next(batches)).cast("long"))
        entries = entries.select("path", "modified", "length", "year_month", F.coalesce("rows", F.lit(0)).alias("rows"), "batch")
        entries.coalesce(1).write.mode("append").parquet(f"{detail_path}/{DELIVERIES}")

    return load_files(spark, fresh, detail_path, schema, keys, group_bytes, log, allow_losses)


def stale_dates(upstream: DataFrame, downstream: DataFrame, key: str = DATE_KEY, state: str = "modified") -> DataFrame:
    """Dates to ``add``, ``recompute`` or ``drop``; up-to-date ones are left out.

    ``state`` is what an upstream date is like now, and downstream what it was like when the date was built from
    it; any difference makes the date stale, also one back in time, and a date whose state downstream is not
    known is built again. The other columns of the upstream listing are carried along.
    """
    up = upstream.withColumns({"up_state": F.col(state), "up": F.lit(True)})
    down = downstream.select(key, F.col(state).alias("down_state"), F.lit(True).alias("down"))
    action = (
        F.when(F.col("down").isNull(), "add")
        .when(F.col("up").isNull(), "drop")
        .when(~F.col("up_state").eqNullSafe(F.col("down_state")), "recompute")
    )
    carried = [name for name in upstream.columns if name not in (key, state)]
    joined = up.join(down, key, "full").select(key, action.alias("action"), F.col("up_state").alias(state), *carried)
    return joined.where(F.col("action").isNotNull())


BUILT_COLUMNS = f"{DATE_KEY} date, version string, batch long"


def built_from(spark: SparkSession, path: str) -> DataFrame:
    """Per date of a table, the version of the upstream date that it was built from; null where it was not recorded."""
    log = read_log(spark, f"{path}/{BUILT_FROM}", BUILT_COLUMNS)
    last = log.groupBy(DATE_KEY).agg(F.max_by("version", "batch").alias("version"))
    return list_dates(spark, path).join(last, DATE_KEY, "left")


def _record_build(spark: SparkSession, path: str, versions: DataFrame) -> None:
    last = read_log(spark, f"{path}/{BUILT_FROM}", BUILT_COLUMNS).agg(F.max("batch")).first()[0] or 0
    entries = versions.select(DATE_KEY, "version", F.lit(last + 1).cast("long").alias("batch"))
    entries.coalesce(1).write.mode("append").parquet(f"{path}/{BUILT_FROM}")


def refresh_by_date(
    spark: SparkSession, upstream_path: str, downstream_path: str, build: Callable[[DataFrame], DataFrame]
) -> dict[str, list]:
    """Rebuild the dates whose upstream partition is not what they were built from, and drop those that are gone.

    Upstream versions are listed before the rows are read and recorded after the new dates are in place. An
    upstream date that changes in between, or a driver that is lost, leaves a version that differs, so the next run builds
    the date again. A downstream table in the old flat layout is rebuilt as a whole.
    """
    for path in (upstream_path, downstream_path):
        recover(spark, path)
    upstream = freeze(partition_files(list_files(spark, upstream_path)).select(DATE_KEY, "version", "folder", "bytes"))
    downstream = list_files(spark, downstream_path)
    if not is_partitioned(downstream):
        overwrite_by_date(build(spark.read.parquet(upstream_path)), downstream_path)
        _record_build(spark, downstream_path, upstream)
        return {"rebuilt": [downstream_path]}
    found = freeze(stale_dates(upstream, built_from(spark, downstream_path), state="version"))
    plan = found.collect()
    stale = {row[DATE_KEY]: row for row in plan if row["action"] != "drop"}
    gone = sorted(row[DATE_KEY] for row in plan if row["action"] == "drop")
    if stale:
        with fitted_shuffles(spark, sum(row["bytes"] for row in stale.values())):
            rows = build(read_folders(spark, upstream_path, sorted(row["folder"] for row in stale.values())))
            replace_partitions(rows, downstream_path, affected=sorted(stale))
        _record_build(spark, downstream_path, found.where("action <> 'drop'"))
    drop_partitions(spark, downstream_path, gone)
    return {"refreshed": sorted(stale), "dropped": gone}


def overwrite_by_date(df: DataFrame, path: str) -> None:
    df.hint("rebalance", F.col(DATE_KEY)).write.mode("overwrite").partitionBy(DATE_KEY).parquet(path)


def refresh_daily(spark: SparkSession, detail_path: str, daily_path: str) -> dict[str, list]:
    return refresh_by_date(spark, detail_path, daily_path, daily_metrics)
