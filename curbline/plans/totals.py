"""Totals over all dates that are kept up by the difference of the dates that changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.contracts import DATE_KEY
from curbline.operators.metrics import Measure, roll_up
from curbline.plans.incremental import read_log, stale_dates
from curbline.session import fitted_shuffles, freeze
from curbline.sinks.parquet import file_system_of, overwrite, recover
from curbline.sources.files import list_files, partition_files, read_folders

# Below the folder of the totals: what each date adds, which dates are in, the totals, and a marker for each whole batch.
PARTS, DATES, TOTALS, COMMITS = "parts", "dates", "totals", "commits"
BATCH = "totals_batch"
DATE_COLUMNS = f"{DATE_KEY} date, version string, {BATCH} int"


def maintain_totals(
    spark: SparkSession, partials_path: str, path: str, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """The roll-up of a partials table by `keys`, from its last state and the dates that were added, changed or dropped.

    What each date adds is kept beside the totals, so a changed date takes away what it added before; partials of
    other dates are not read. Counts and whole cents are exact, so the totals equal a full roll-up. Sums of what is
    beyond cents, which depend on their order and cannot take back a NaN, and extremes are combined anew from what
    the dates add, and the former only if there are any. A key whose trips are all gone leaves the totals.

    A batch counts from the moment its marker is written; one that broke off before is done again. The totals of the
    batch before stay for those who still read them. A table has one writer at a time. No partials give no totals.
    """
    recover(spark, partials_path)
    last = _last_batch(spark, path)
    upstream = freeze(partition_files(list_files(spark, partials_path)).select(DATE_KEY, "version", "folder", "bytes"))
    known = _dates_of(spark, path, last)
    found = freeze(stale_dates(upstream, known, state="version"))
    plan = found.collect()
    held = spark.read.parquet(_folder(path, TOTALS, last)) if last else None
    if held is not None and set(held.columns) != {*keys, *_added(measures), *_combined(measures)}:
        raise ValueError(f"{path} has other keys or measures: {held.columns}")
    if not plan:
        if held is None:
            raise ValueError(f"no partials in {partials_path}")
        return held
    batch = last + 1
    current = [row for row in plan if row["action"] != "drop"]
    with fitted_shuffles(spark, sum(row["bytes"] for row in current)):
        changes = []
        if current:
            partials = read_folders(spark, partials_path, sorted(row["folder"] for row in current))
            overwrite(roll_up(partials, [DATE_KEY, *keys], measures), _folder(path, PARTS, batch))
            changes.append((spark.read.parquet(_folder(path, PARTS, batch)), 1))
        if any(row["action"] != "add" for row in plan):
            before = known.join(found.where("action <> 'add'").select(DATE_KEY), DATE_KEY, "left_semi")
            changes.append((_parts_of(spark, path, before), -1))
        entries = found.select(DATE_KEY, F.when(F.col("action") != "drop", F.col("version")).alias("version"))
        overwrite(entries.coalesce(1), _folder(path, DATES, batch))
        if held is not None:
            changes.append((held, 1))
        live = _dates_of(spark, path, batch)
        overwrite(_sum_up(changes, lambda: _parts_of(spark, path, live), keys, measures), _folder(path, TOTALS, batch))
    file_system, marker = file_system_of(spark, f"{path}/{COMMITS}/{batch}")
    file_system.create(marker, True).close()
    _clean_up(spark, path, batch, live)
    return spark.read.parquet(_folder(path, TOTALS, batch))


def _added(measures: Sequence[Measure]) -> list[str]:
    """Columns that a difference keeps exact."""
    return ["trip_count"] + [f"{m.column}__{part}" for m in measures for part in ("cents", "n")]


def _combined(measures: Sequence[Measure]) -> dict[str, object]:
    """Columns that are combined from what all dates add, and how."""
    columns = {f"{m.column}__rest": F.sum for m in measures}
    columns |= {f"{m.column}__min": F.min for m in measures if m.low}
    return columns | {f"{m.column}__max": F.max for m in measures if m.high}


def _sum_up(changes: list[tuple[DataFrame, int]], live, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    added, combined = _added(measures), _combined(measures)
    rests = [name for name in combined if name.endswith("__rest")]
    beyond = reduce(Column.__or__, [F.coalesce(F.col(name) != 0, F.lit(False)) for name in rests], F.lit(False))
    inexact = any(not frame.where(beyond).isEmpty() for frame, _ in changes)
    # where no trip has digits beyond cents, nothing of the other dates needs to be read
    again = [name for name in combined if inexact or name not in rests]
    frames = [
        frame.select(
            *keys,
            *[(F.coalesce(F.col(name), F.lit(0)) * sign).cast(frame.schema[name].dataType).alias(name) for name in added],
            *[F.lit(None).cast("double").alias(name) for name in again],
        )
        for frame, sign in changes
    ]
    if again:
        frame = live()
        nothing = [F.lit(0).cast(frame.schema[name].dataType).alias(name) for name in added]
        frames.append(frame.select(*keys, *nothing, *[F.col(name).cast("double") for name in again]))
    sums = reduce(DataFrame.unionByName, frames).groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in added], *[combined[name](name).alias(name) for name in again]
    )
    columns = []
    for measure in measures:
        some = F.col(f"{measure.column}__n") > 0
        cents, rest = f"{measure.column}__cents", f"{measure.column}__rest"
        columns.append(F.when(some, F.col(cents)).alias(cents))
        columns.append(F.when(some, F.col(rest) if inexact else F.lit(0.0)).alias(rest))
        columns.append(F.col(f"{measure.column}__n"))
    columns += [F.col(name) for name in again if name not in rests]
    return sums.where("trip_count <> 0").select(*keys, "trip_count", *columns)


def _folder(path: str, part: str, batch: int) -> str:
    return f"{path}/{part}/{BATCH}={batch}"


def _dates_of(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """The dates that the totals of a batch hold, with the version and the batch that each was last read in."""
    log = read_log(spark, f"{path}/{DATES}", DATE_COLUMNS).where(F.col(BATCH) <= batch)
    last = log.groupBy(DATE_KEY).agg(F.max_by(F.struct("version", BATCH), BATCH).alias("last"))
    return last.select(DATE_KEY, "last.*").where("version IS NOT NULL")


def _parts_of(spark: SparkSession, path: str, dates: DataFrame) -> DataFrame:
    """What the given dates add, read from the batches that they were last read in."""
    batches = [row[BATCH] for row in dates.select(BATCH).distinct().collect()]
    folders = [_folder(path, PARTS, batch) for batch in sorted(batches)]
    if not folders:
        # every date is gone: the columns of any batch, and no rows
        return spark.read.parquet(f"{path}/{PARTS}").where(F.lit(False))
    parts = spark.read.option("basePath", f"{path}/{PARTS}").parquet(*folders)
    return parts.join(dates.select(DATE_KEY, BATCH), [DATE_KEY, BATCH], "left_semi")


def _numbers(spark: SparkSession, folder: str) -> dict[int, object]:
    """Batch numbers of the entries of a folder, and their paths."""
    file_system, root = file_system_of(spark, folder)
    if not file_system.exists(root):
        return {}
    paths = [status.getPath() for status in file_system.listStatus(root)]
    names = {path.getName().removeprefix(f"{BATCH}="): path for path in paths}
    return {int(name): path for name, path in names.items() if name.isdigit()}


def _last_batch(spark: SparkSession, path: str) -> int:
    return max(_numbers(spark, f"{path}/{COMMITS}"), default=0)


def _clean_up(spark: SparkSession, path: str, batch: int, live: DataFrame) -> None:
    """Remove totals before the last but one batch, and parts that no date of the totals was last read in."""
    used = {row[BATCH] for row in live.select(BATCH).distinct().collect()} | {batch}
    file_system, _ = file_system_of(spark, path)
    old = [entry for number, entry in _numbers(spark, f"{path}/{TOTALS}").items() if number < batch - 1]
    old += [entry for number, entry in _numbers(spark, f"{path}/{PARTS}").items() if number not in used]
    for entry in old:
        file_system.delete(entry, True)
