"""Top-k by inner product against all pairs in plain Python; ties, copies, nulls, values of any size."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import pivots, queries

SF_DIR = "/root/testdata/sf0.01"
SHAPE = "vec_id long, embedding array<float>"


def expected(rows, is_query, k):
    held = [
        (i, row_id, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, (row_id, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for i, row_id, q in held:
        if row_id is None or not is_query(row_id):
            continue
        scores = [(sum(a * b for a, b in zip(q, v)), other) for j, other, v in held if j != i]
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        found += [(row_id, rank, other, score) for rank, (score, other) in enumerate(scores[:k], 1)]
    return sorted(found, key=str)


def found(df, **options):
    rows = pivots.top_k(df, F.col("id") % 50 == 0, **options).collect()
    return sorted((tuple(r) for r in rows), key=str)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SHAPE).repartition(parts)


def test_recall_is_whole_on_the_given_table(spark):
    """Recall against brute force is 1, ranks and scores included."""
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    result = queries.op11_pivot_search(spark, SF_DIR).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted((tuple(r) for r in result), key=str) == expected(rows, lambda i: i % 50 == 0, 5)


@pytest.mark.parametrize("options", [{}, {"query_bytes": 64, "pivots": 3, "sample_rows": 10}, {"pivots": 1, "k": 1}])
def test_clusters_ties_and_copies(spark, options):
    rng = random.Random(5)
    middles = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(5)]
    rows = [(i, [m + rng.gauss(0, 0.01) for m in rng.choice(middles)]) for i in range(400)]
    rows += [(1000 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(300)]
    rows += [(None, [1.0, 0.0, 0.0, 0.0])] * 20 + [(1100, [1.0, 0.0, 0.0, 0.0])] * 3 + [(50, [0.0, 0.0, 2.0, 0.0])] * 2
    rows += [(-50, [0.25] * 4), (-100, [0.0] * 4)]
    rng.shuffle(rows)
    k = options.get("k", 5)
    assert found(frame(spark, rows), **options) == expected(rows, lambda i: i % 50 == 0, k)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [1.0, None]), (4, [-inf, 0.0]), (5, [3.0, 1.0])]
    assert found(frame(spark, rows)) == expected(rows, lambda i: i % 50 == 0, 5) == [(0, 1, 5, 256 * 256 * 5)]


def test_few_rows_and_none(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(0, [1.0])])) == []
    assert found(frame(spark, [(1, [1.0]), (2, [2.0])])) == []
    assert found(frame(spark, [(0, [1.0]), (50, [0.0])])) == [(0, 1, 50, 0), (50, 1, 0, 0)]
    # vectors without components, and of different lengths
    assert found(frame(spark, [(0, []), (1, [])])) == [(0, 1, 1, 0)]
    assert found(frame(spark, [(0, [1.0, 1.0]), (1, [2.0])])) == [(0, 1, 1, 2 * 65536)]


def test_large_values_stay_exact(spark):
    rows = [(0, [70000.0, 3.0]), (50, [1e6, -1e6]), (1, [70000.0, 3.00390625]), (2, [-1e6, 1e6]), (3, [1e6, 1e6])]
    assert found(frame(spark, rows)) == expected(rows, lambda i: i % 50 == 0, 5)
    ends = found(frame(spark, [(0, [3e38]), (1, [3e38]), (2, [-3e38])]))
    assert ends == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_other_columns_are_not_read(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)]
    clash = frame(spark, rows).withColumns({"id": F.lit("x"), "vector": F.lit(1), "pivot": F.lit(2), "a.b": F.lit(3)})
    assert found(clash) == expected(rows, lambda i: i % 50 == 0, 5)


def test_far_annuli_are_left_out(spark):
    """Of two far clusters a query scores its own only; the rings reach the scan as pushed filters."""
    rng = np.random.default_rng(3)
    near = rng.normal(0, 0.01, (3000, 8)) + np.eye(8)[0] * 10
    far = rng.normal(0, 0.01, (3000, 8)) - np.eye(8)[0] * 10
    vectors = np.floor(256 * np.concatenate([near, far])).astype(np.int64)
    width, radius = 8, float(np.sqrt((vectors.astype(float) ** 2).sum(1).max()))
    space = pivots.Sphere(width, radius, np.zeros((0, 9)))
    lifted = np.concatenate([vectors, space.lift(vectors.astype(float))[:, None]], axis=1)
    space = pivots.Sphere(width, radius, pivots.centres(lifted[::10], 4))
    query = vectors[:1]
    to_pivots = space.distances(query.astype(float), np.zeros(1))
    least = np.sort(pivots.products(query, vectors[::10])[0])[-6:-5]
    gap = space.distances(vectors.astype(float), space.lift(vectors.astype(float)))
    bound = np.abs(gap - to_pivots).max(1) - space.slack
    left = bound <= space.reach(query, least)[0]
    scores = pivots.products(query, vectors)[0]
    assert left[np.argsort(-scores)[:6]].all() and left[3000:].sum() == 0
