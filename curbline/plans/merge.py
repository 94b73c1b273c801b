"""Old and new rows of a date-partitioned table made one, with one exchange of whole rows.

Distinct rows, or the newest row of each key, are found where the rows are written from: rows go to
the tasks by date and, for a date too large for one task, by a slice of it that the row's identity (the row, or its key)
chooses. Equal identities meet in one slice, so no second exchange is needed.

A first pass without an exchange of whole rows counts the rows of each date and the identities in a sample. What
the sample shows to be repeated more often than a slice is large is aggregated where it is read, before it
is exchanged; so a row or key of which a third of the table consists does not go to one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.contracts import DATE_KEY
from curbline.session import freeze

#: rows of a date that one task takes, and bytes of the files that are read back
SLICE_ROWS = 1_000_000
SLICE_BYTES = 128 << 20
#: identities counted in the sample, about
SAMPLE_ROWS = 200_000
#: times an identity has to be seen in the sample to be called frequent
LEAST_SEEN = 20

_SLICE, _WHOLE, _SEEN = "__slice", "__whole", "__seen"


def identity(columns: list[str], keys: list[str] | None, order: str | None = None) -> Column:
    """Hash of what makes two rows one: the key, or where there is none or it has a NULL the row, but for its `order`."""
    row = F.xxhash64(*[F.col(f"`{name}`") for name in sorted(columns) if name != order])
    if not keys:
        return row
    return F.when(_whole_key(keys), F.xxhash64(*[F.col(f"`{name}`") for name in keys])).otherwise(row)


def _whole_key(keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"`{name}`").isNotNull() for name in keys])


@dataclass
class RowPlan:
    """Rows by date, and the frequent identities."""

    counts: DataFrame
    frequent: list[int]


def plan_rows(
    rows: DataFrame,
    keys: list[str] | None = None,
    order: str | None = None,
    sample_rows: int = SAMPLE_ROWS,
    slice_rows: int = SLICE_ROWS,
    key: str = DATE_KEY,
) -> RowPlan:
    """Counts dates and sampled identities in one aggregate; it shuffles a row a date and task, and the sample."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # a row is taken for 16 bytes at least, so that the sample is rather too small than too large
    share = min(1.0, 16 * sample_rows / max(1, size))
    sampled = F.when(F.rand(0) < share, identity(rows.columns, keys, order))
    counts = freeze(rows.select(key, sampled.alias("seen")).groupBy(key, "seen").count())
    least = max(LEAST_SEEN, int(slice_rows * share / 2))
    seen = counts.where("seen is not null").groupBy("seen").agg(F.sum("count").alias("times"))
    # no more than the sample divided by `least`
    frequent = [row["seen"] for row in seen.where(F.col("times") >= least).collect()]
    return RowPlan(counts.groupBy(key).agg(F.sum("count").alias("rows")), frequent)


def _unified(rows: DataFrame, keys: list[str] | None, order: str | None, by: list[str]) -> DataFrame:
    """Distinct rows, or of each key in `by` the row that is last in `order`, ties by the row's hash."""
    if not keys:
        return rows.dropDuplicates()
    columns = {name: F.col(f"`{name}`") for name in rows.columns if name != _SLICE}
    # rows without a whole key are themselves what they are grouped by
    whole = F.when(~_whole_key(keys), F.struct(*[column for name, column in columns.items() if name != order]))
    newest = F.max_by(F.struct(*columns.values()), F.struct(columns[order], F.xxhash64(*columns.values())))
    found = rows.withColumn(_WHOLE, whole).groupBy(*by, *[f"`{name}`" for name in keys if name not in by], _WHOLE)
    return found.agg(newest.alias(_SEEN)).select(f"{_SEEN}.*")


def one_exchange(
    rows: DataFrame,
    dates: DataFrame,
    frequent: list[int],
    keys: list[str] | None = None,
    order: str | None = None,
    key: str = DATE_KEY,
) -> DataFrame:
    """Distinct rows, or the last one of each key, gathered by date and slice.

    `dates` has a row a date with its slices; it is no longer than the calendar and joined by broadcast. A
    key is one within its date. Rows with a NULL in the key are only made distinct, whatever their `order`.
    """
    wanted = identity(rows.columns, keys, order)
    if frequent:
        often = wanted.isin(frequent)
        rows = rows.where(~often).unionByName(_unified(rows.where(often), keys, order, [key]))
    sliced = rows.join(F.broadcast(dates), key, "left")
    slice_of = F.pmod(identity(rows.columns, keys, order), F.coalesce("slices", F.lit(1)))
    sliced = sliced.select(*[F.col(f"`{name}`") for name in rows.columns], slice_of.alias(_SLICE))
    gathered = sliced.repartition(key, _SLICE)
    return _unified(gathered, keys, order, [key, _SLICE]).select(*[F.col(f"`{name}`") for name in rows.columns])
