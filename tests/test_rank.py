import random

import pytest
from trips import rows_of

from curbline.operators.enrich import location_zone, one_row_per_key, unmatched_keys
from curbline.operators.rank import borough_top, global_ranks, top_k


def brute_force_ranks(rows):
    ordered = sorted(rows, key=lambda row: (row[1] is None, -(row[1] or 0), row[0]))
    out, values = [], []
    for position, (key, count) in enumerate(ordered, start=1):
        if not values or values[-1][0] != count:
            values.append((count, position))
        out.append((key, count, position, values[-1][1], len(values)))
    return sorted(out)


def hot(n):
    """A third of the rows share one count, another third two counts."""
    pick = random.Random(11)
    rows = []
    for key in range(n):
        if key % 3 == 0:
            count = 50
        elif key % 3 == 1:
            count = 10 + key % 2
        else:
            count = pick.randrange(1, 200)
        rows.append((key, count))
    return rows


@pytest.mark.parametrize("rows", [hot(3000), [(k, 5) for k in range(500)], [(1, 9), (2, 9), (3, 7)], [(1, None), (2, 3), (3, None)], []])
def test_global_ranks(spark, rows):
    df = spark.createDataFrame(rows, "k int, n int")
    ranked = global_ranks(df, "n", "k")
    assert sorted(tuple(row) for row in ranked.collect()) == brute_force_ranks(rows)


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 9), (4, None)], "k int, n int")
    assert [row["k"] for row in top_k(df, "n", 3, "k").collect()] == [2, 1, 3]


ZONED = "PULocationID int, Zone string, Borough string, trip_count bigint, total_revenue double, avg_revenue double, avg_distance double"


def test_borough_top_has_three_each_and_no_null(spark):
    rows = [(i, f"z{i}", "A", 5, 1.0, 1.0, 1.0) for i in range(5)]
    rows += [(10, "z10", "B", 1, 1.0, 1.0, 1.0), (11, None, None, 99, 1.0, 1.0, 1.0)]
    top = borough_top(spark.createDataFrame(rows, ZONED))
    assert [(r["Borough"], r["location_rank"], r["PULocationID"]) for r in top.collect()] == [
        ("A", 1, 0),
        ("A", 2, 1),
        ("A", 3, 2),
        ("B", 1, 10),
    ]


def test_duplicate_dimension_key_does_not_multiply(spark):
    zones = spark.createDataFrame(
        [(56, "b", "Q"), (56, "a", "Z"), (1, "c", "M")], "LocationID int, Zone string, Borough string"
    )
    single = one_row_per_key(zones, ["LocationID"])
    assert rows_of(single) == [(1, "c", "M"), (56, "a", "Z")]
    locations = spark.createDataFrame(
        [(56, 4, 10.0, 2.5, 1.0), (99, 2, 5.0, 2.5, 1.0), (None, 1, 1.0, 1.0, 1.0)],
        "PULocationID int, trip_count bigint, total_revenue double, avg_revenue double, avg_distance double",
    )
    joined = location_zone(locations, single)
    assert joined.count() == 3
    assert [tuple(r) for r in unmatched_keys(joined).collect()] == [(99, 1, 2, 5.0, 2.5), (None, 1, 1, 1.0, 1.0)]
