"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# From here on doubles are too coarse to hold hundredths. Such values, NaN and infinities are summed as doubles.
CENTS_LIMIT = 2.0**53 / 100


def cents(value: Column) -> Column:
    """The value in whole hundredths, as bigint; 0 where that does not fit, NULL for NULL.

    Sums of hundredths are exact whatever the order of the rows.
    """
    small = F.abs(value) < CENTS_LIMIT
    return F.when(value.isNotNull(), F.when(small, F.rint(value * 100)).otherwise(0.0)).cast("bigint")


def sum_cents(value: Column) -> Column:
    """The sum of ``cents`` as decimal(38,0).

    Rows add to two bigints, the multiples of 2**20 and what is left, so that
    neither grows too large; decimals, which cost several times as much, are
    only used once a group.
    """
    whole = cents(value)
    high = F.sum(F.shiftright(whole, 20)).cast("decimal(38,0)")
    low = F.sum(whole.bitwiseAND(F.lit((1 << 20) - 1))).cast("decimal(38,0)")
    return (high * F.lit(1 << 20).cast("decimal(7,0)") + low).cast("decimal(38,0)")


def beyond_cents(value: Column) -> Column:
    """What ``cents`` leaves out: 0 for two-decimal values, so only finer, huge or NaN values add to it."""
    return value - cents(value) / F.lit(100.0)


def from_cents(whole: Column, rest: Column) -> Column:
    return whole.cast("double") / F.lit(100.0) + rest


def round2(value: Column) -> Column:
    """Half-up on the decimal text, two places; NaN, infinities and values too large stay as they are."""
    rounded = F.round(value.try_cast("decimal(38,10)"), 2).cast("double")
    return F.coalesce(rounded, value)


def seconds_between(start: Column, end: Column) -> Column:
    """Difference of the clock seconds, each floored."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes2(seconds: Column) -> Column:
    """Non-negative seconds as minutes, half-up to two places, in integer arithmetic."""
    return F.floor((seconds * 100 + 30) / 60) / F.lit(100.0)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in the float and double columns; other columns are untouched."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({name: F.when(~F.isnan(df[name]), df[name]) for name in floats})
