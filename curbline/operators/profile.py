"""Column profiles: null counts, frequencies, ranges, quantiles, duplicates, anomalies."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.functions.exprs import beyond_cents, from_cents, sum_cents
from curbline.operators.rank import range_parts
from curbline.session import freeze

SAMPLE_ROWS = 20
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _one_pass(df: DataFrame, entries: list[Column]) -> DataFrame:
    """All entries from one aggregate over the table, one output row per entry."""
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def null_entries(columns: list[str]) -> list[Column]:
    return [
        F.struct(F.lit(name).alias("column"), F.count("*").alias("rows"), F.count_if(F.col(name).isNull()).alias("nulls"))
        for name in columns
    ]


def null_profile(df: DataFrame) -> DataFrame:
    """Rows and NULLs of every column."""
    return _one_pass(df, null_entries(df.columns))


def null_rows(df: DataFrame, column: str, columns: list[str]) -> DataFrame:
    return df.where(F.col(column).isNull()).select(*columns)


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Rows per value in value order; NULL is a value of its own."""
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.asc_nulls_first(column))


def numeric_entries(columns: list[str]) -> list[Column]:
    entries = []
    for name in columns:
        value = F.col(name)
        total = from_cents(sum_cents(value), F.sum(beyond_cents(value)))
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count("*").alias("rows"),
                F.count_if(value == 0).alias("zeros"),
                F.count_if(value < 0).alias("negatives"),
                F.min(value + 0.0).alias("low"),
                F.max(value + 0.0).alias("high"),
                F.try_divide(total, F.count(value).cast("double")).alias("mean"),
            )
        )
    return entries


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, zeros, negatives, extremes and mean of each column."""
    return _one_pass(df, numeric_entries(columns))


@dataclass(frozen=True)
class Band:
    """A named range: ``at`` one value, ``below`` a value, ``over..upto``, or ``from_`` a value on."""

    name: str
    at: float | None = None
    below: float | None = None
    over: float | None = None
    upto: float | None = None
    from_: float | None = None

    def holds(self, value: Column) -> Column:
        if self.at is not None:
            return value == self.at
        if self.below is not None:
            return value < self.below
        if self.from_ is not None:
            return value >= self.from_
        return (value > self.over) & (value <= self.upto)


# The bands of each column. The open band starts at its edge, so a value on
# that edge is in two bands; some values (such as a zero fare) are in none.
BANDS = {
    "trip_distance": [
        Band("0", at=0),
        Band("0~5", over=0, upto=5),
        Band("5~10", over=5, upto=10),
        Band("10~20", over=10, upto=20),
        Band("20~50", over=20, upto=50),
        Band("50~100", over=50, upto=100),
        Band("100+", from_=100),
    ],
    "fare_amount": [
        Band("negative", below=0),
        Band("0~10", over=0, upto=10),
        Band("10~20", over=10, upto=20),
        Band("20~50", over=20, upto=50),
        Band("50~100", over=50, upto=100),
        Band("100+", from_=100),
    ],
    "total_amount": [
        Band("negative", below=0),
        Band("0~20", over=0, upto=20),
        Band("20~50", over=20, upto=50),
        Band("50~100", over=50, upto=100),
        Band("100~500", over=100, upto=500),
        Band("500+", from_=500),
    ],
}


def band_entries(bands: dict[str, list[Band]]) -> list[Column]:
    def entry(column, position, name, condition):
        return F.struct(
            F.lit(column).alias("column"),
            F.lit(position).alias("position"),
            F.lit(name).alias("band"),
            F.count_if(condition).alias("rows"),
        )

    entries = []
    for column, ranges in bands.items():
        held = [band.holds(F.col(column)) for band in ranges]
        entries += [entry(column, i, band.name, hit) for i, (band, hit) in enumerate(zip(ranges, held), start=1)]
        in_any = F.coalesce(reduce(Column.__or__, held), F.lit(False))
        entries.append(entry(column, len(ranges) + 1, "unbanded", ~in_any))
    return entries


def range_histogram(df: DataFrame, bands: dict[str, list[Band]] = BANDS) -> DataFrame:
    """Rows in each band, and per column the rows in no band (``unbanded``)."""
    return _one_pass(df, band_entries(bands))


#: entries of the sketches that bracket a quantile, and how many of its errors a bracket reaches to each side
SKETCH_ACCURACY = 10_000
BRACKET_ERRORS = 2


def _doubles(columns: list[str]) -> dict[str, Column]:
    return {name: F.col(f"`{name}`").cast("double") for name in columns}


def sketched_ranges(
    df: DataFrame, columns: list[str], shares: list[float], accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Per column, in one pass: count, NaNs, min, max and, for each share, values that enclose the quantile.

    Only sketches are shuffled. NaNs are no part of a sketch; they count as the largest values.
    """
    reach = BRACKET_ERRORS / accuracy
    ends = [min(1.0, max(0.0, share + side)) for share in shares for side in (-reach, reach)]
    entries = []
    for name, value in _doubles(columns).items():
        nan = F.isnan(value)
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(value).alias("count"),
                F.count_if(nan).alias("nans"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                F.percentile_approx(F.when(~nan, value), ends, accuracy).alias("ends"),
            )
        )
    return _one_pass(df, entries)


def bracketed_counts(df: DataFrame, brackets: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """Rows by column and value inside the brackets, and of each gap between them in one row.

    ``at`` is the value, or for a gap the end of the bracket before it (NULL for the first gap). Sorted by at and gap, the
    counts are in the order of the values. Gaps collapse in the tasks that read them. NULLs and NaNs are left out.
    """
    pairs = []
    for name, value in _doubles(list(brackets)).items():
        inside = reduce(Column.__or__, [value.between(low, high) for low, high in brackets[name]])
        passed = [F.when(value > high, F.lit(high)) for _, high in brackets[name]]
        before = F.greatest(*passed, F.lit(None).cast("double"))
        known = value.isNotNull() & ~F.isnan(value)
        at = F.when(inside, value).otherwise(before)
        pairs.append(F.when(known, F.struct(F.lit(name).alias("column"), at.alias("at"), (~inside).alias("gap"))))
    placed = df.select(F.explode(F.array(*pairs)).alias("cell")).where("cell is not null").select("cell.*")
    return placed.groupBy("column", "at", "gap").agg(F.count("*").alias("n"))


def _values_at(counted: DataFrame, wanted: dict[str, dict[str, int]]) -> dict[str, dict[str, tuple[float | None, bool]]]:
    """The value (or gap) that reaches each wanted rank, per column and label, from sorted counts spread over range parts."""
    placed = freeze(range_parts(counted, [F.asc("column"), F.asc("at"), F.asc("gap")]))
    # at most one row per part and column
    parts = placed.groupBy("_part", "column").agg(F.sum("n").alias("part_rows"))
    before = W.partitionBy("column").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    ahead = parts.select("_part", "column", F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"))
    inside = W.partitionBy("_part", "column").orderBy("at", "gap").rowsBetween(W.unboundedPreceding, 0)
    reached = placed.withColumn("in_part", F.sum("n").over(inside)).join(F.broadcast(ahead), ["_part", "column"])
    upto = F.col("rows_before") + F.col("in_part")
    first = {}
    for label in {label for ranks in wanted.values() for label in ranks}:
        ranks = [F.when(F.col("column") == name, F.lit(of[label])) for name, of in wanted.items() if label in of]
        first[label] = F.min(F.when(upto >= F.coalesce(*ranks), F.struct(upto, "at", "gap"))).alias(label)
    # one row per column
    rows = reached.groupBy("column").agg(*first.values()).collect()
    return {row["column"]: {label: (row[label]["at"], row[label]["gap"]) for label in wanted[row["column"]]} for row in rows}


def quantile_summary(
    df: DataFrame, columns: list[str], quantiles: dict[str, float] = QUARTILES, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Count, minimum, quantiles and maximum of each column, exact, NULLs left out.

    A quantile is the smallest value that at least that share of rows reaches; NaN is the largest value. A first pass
    sketches each column, which brackets every quantile between two values. A second one counts the values inside the
    brackets, some 4 / accuracy of the rows for each quantile, and the gaps between them as one row each; only these
    are sorted, over as many tasks as they need. A quantile that a sketch misses lies in a known gap, and a further
    pass counts the values there. The driver holds a row per column.
    """
    spark = df.sparkSession
    shares = list(quantiles.values())
    sketches = {row["column"]: row for row in sketched_ranges(df, columns, shares, accuracy).collect()}
    found: dict[str, dict[str, float]] = {name: {} for name in columns}
    wanted: dict[str, dict[str, int]] = {}
    brackets: dict[str, list[tuple[float, float]]] = {}
    for name, sketch in sketches.items():
        for position, (label, share) in enumerate(quantiles.items()):
            rank = max(1, math.ceil(sketch["count"] * share))
            if rank <= sketch["count"] - sketch["nans"]:
                wanted.setdefault(name, {})[label] = rank
                brackets.setdefault(name, []).append(tuple(sketch["ends"][2 * position : 2 * position + 2]))
            elif sketch["count"]:
                found[name][label] = math.nan
    while wanted:
        hits = _values_at(bracketed_counts(df, brackets), wanted)
        missed: dict[str, dict[str, int]] = {}
        gaps: dict[str, list[tuple[float, float]]] = {}
        for name, labels in hits.items():
            for label, (at, gap) in labels.items():
                if not gap:
                    found[name][label] = at
                    continue
                low = -math.inf if at is None else at
                missed.setdefault(name, {})[label] = wanted[name][label]
                gaps.setdefault(name, []).append((low, min([end for end, _ in brackets[name] if end > low], default=math.inf)))
        wanted, brackets = missed, gaps
    rows = [
        (name, of["count"], of["min"], *[found[name].get(label) for label in quantiles], of["max"])
        for name, of in sketches.items()
    ]
    values = ", ".join(f"`{label}` double" for label in quantiles)
    return spark.createDataFrame(rows, f"column string, count long, min double, {values}, max double")


def approx_quantile_summary(
    df: DataFrame, columns: list[str], quantiles: dict[str, float] = QUARTILES, accuracy: int = 10_000
) -> DataFrame:
    """The same statistics from one sketch per column: one pass, ranks off by up to rows / accuracy."""
    entries = []
    for name in columns:
        value = F.col(name).cast("double")
        found = F.percentile_approx(value, list(quantiles.values()), accuracy)
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(value).alias("count"),
                F.min(value).alias("min"),
                *[found[i].alias(label) for i, label in enumerate(quantiles)],
                F.max(value).alias("max"),
            )
        )
    return _one_pass(df, entries)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, most frequent first."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("count")).where(F.col("count") > 1)
    return counts.orderBy(F.desc("count"), *[F.asc(key) for key in keys])


def anomalies(df: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    return df.where(condition).select(*columns)


def sample_rows(df: DataFrame, order: list[Column], rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows of the given order."""
    return df.orderBy(*order).limit(rows)
