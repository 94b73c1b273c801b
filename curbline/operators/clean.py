"""Cleaning rule sets and the derived detail columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.contracts import DATE_KEY, TRIP, TripColumns
from curbline.functions.exprs import minutes2, seconds_between

DAY_SECONDS = 86_400


@dataclass(frozen=True)
class Rule:
    """Rows where ``keep`` is false or NULL are rejected."""

    name: str
    keep: Column


def detail_rules(cols: TripColumns = TRIP) -> list[Rule]:
    c = F.col
    seconds = seconds_between(c(cols.pickup), c(cols.dropoff))
    return [
        Rule("pickup_present", c(cols.pickup).isNotNull()),
        Rule("dropoff_present", c(cols.dropoff).isNotNull()),
        Rule("dropoff_after_pickup", c(cols.dropoff) > c(cols.pickup)),
        Rule("distance_positive", c(cols.distance) > 0),
        Rule("distance_at_most_100", c(cols.distance) <= 100),
        Rule("pickup_zone_present", c(cols.pickup_zone).isNotNull()),
        Rule("dropoff_zone_present", c(cols.dropoff_zone).isNotNull()),
        Rule("lasts_up_to_a_day", (seconds > 0) & (seconds <= DAY_SECONDS)),
    ]


def exploratory_rules(cols: TripColumns = TRIP) -> list[Rule]:
    c = F.col
    seconds = seconds_between(c(cols.pickup), c(cols.dropoff))
    return [
        Rule("passengers_positive", c(cols.passengers) > 0),
        Rule("distance_positive", c(cols.distance) > 0),
        Rule("dropoff_after_pickup", c(cols.dropoff) > c(cols.pickup)),
        Rule("total_not_negative", c(cols.total) >= 0),
        Rule("pickup_present", c(cols.pickup).isNotNull()),
        Rule("dropoff_present", c(cols.dropoff).isNotNull()),
        Rule("lasts_up_to_a_day", (seconds > 0) & (seconds <= DAY_SECONDS)),
    ]


def keep_clean(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.where(reduce(Column.__and__, [rule.keep for rule in rules]))


def clean_detail(raw: DataFrame, cols: TripColumns = TRIP) -> DataFrame:
    """Detail rows: all raw columns plus date, hour and duration in minutes to two places."""
    seconds = seconds_between(F.col(cols.pickup), F.col(cols.dropoff))
    return keep_clean(raw, detail_rules(cols)).withColumns(
        {
            DATE_KEY: F.to_date(cols.pickup),
            "pickup_hour": F.hour(cols.pickup),
            "trip_duration_minutes": minutes2(seconds),
        }
    )


def clean_exploratory(raw: DataFrame, cols: TripColumns = TRIP) -> DataFrame:
    """The stricter rule set of the data study; its duration is not rounded."""
    seconds = seconds_between(F.col(cols.pickup), F.col(cols.dropoff))
    return keep_clean(raw, exploratory_rules(cols)).withColumns(
        {
            DATE_KEY: F.to_date(cols.pickup),
            "pickup_hour": F.hour(cols.pickup),
            "trip_duration_minutes": seconds / F.lit(60.0),
        }
    )


def reject_entries(rule_sets: dict[str, list[Rule]]) -> list[Column]:
    entries = []
    for name, rules in rule_sets.items():
        passed_before = F.lit(True)
        for position, rule in enumerate(rules, start=1):
            keep = F.coalesce(rule.keep, F.lit(False))
            entries.append(
                F.struct(
                    F.lit(name).alias("rule_set"),
                    F.lit(position).alias("position"),
                    F.lit(rule.name).alias("rule"),
                    F.count_if(~keep).alias("failing"),
                    F.count_if(passed_before & ~keep).alias("first_failing"),
                )
            )
            passed_before = passed_before & keep
    return entries


def rejects_by_rule(df: DataFrame, rule_sets: dict[str, list[Rule]]) -> DataFrame:
    """Per rule, in one pass over all sets: rows failing it, and rows it is the first of its set to reject."""
    return df.agg(F.array(*reject_entries(rule_sets)).alias("entries")).select(F.inline("entries"))
