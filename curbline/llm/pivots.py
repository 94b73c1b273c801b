"""Exact top-k by inner product over a pivot-distance index.

Vectors are made points of one sphere: a component is added to each so that all have the largest
length M. For a query q (whose added component is 0) the distance to a point x is then
sqrt(|q|^2 + M^2 - 2 q.x), so the largest inner products are the nearest points, and the triangle
inequality holds for every pivot p: the distance is at least |d(q, p) - d(x, p)|.

The index keys every row by its nearest pivot and its distance to it, and stands in that order in
Parquet. The pivots are centres of a sample; it only decides how much is pruned. A query first meets the sample, whose k best
scores bound its radius. Every pivot then has a ring (annulus) of distances that the query must see: the
rings of a chunk of queries are pushed to the scan, and inside a task each query expands its annuli from the
nearest outwards, and stops when the next one's bound lies beyond its radius, which shrinks with each
better score. Only that bound leaves anything out, so the result is exact.

Queries are many (they grow with the table), so they go to the executors in chunks of bounded
bytes, one pass over the rings each; what a pass finds is written before the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.session import freeze, scratch_path

SCALE = 256
SAMPLE_ROWS = 2048
PIVOTS = 32
#: bytes of queries that one pass holds in every worker
QUERY_BYTES = 4 << 20
#: bytes of index behind one file
FILE_BYTES = 64 << 20
ANNULUS_ROWS = 256
#: queries that are scored against an annulus at a time
QUERY_BLOCK = 2048

#: no score yet, and the end of a long's range
UNKNOWN = -(2**63)

_ID, _VECTOR, _PIVOT, _DIST = "id", "vector", "pivot", "dist"


def quantised(df: DataFrame, row_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id and vector, its components floor(scale * x) as longs; rows that can take no part are left out.

    These are null vectors and those with a component that is null, NaN or infinite. A component beyond the range of a long
    becomes the end of that range.
    """
    values = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(values, lambda x: F.floor(x * scale))
    # the predicate is null only for a null vector
    return df.where(finite).select(F.col(f"`{row_id}`").cast("long").alias(_ID), whole.alias(_VECTOR))


@dataclass(frozen=True)
class Sphere:
    """Length of the vectors, radius M and the pivots, one a row with its added component last."""

    width: int
    radius: float
    pivots: np.ndarray

    @property
    def slack(self) -> float:
        """More than the rounding of any distance here."""
        return 4e-6 * (self.radius + 1)

    def distances(self, points: np.ndarray, added: np.ndarray) -> np.ndarray:
        """From each point (with its added component) to each pivot."""
        products = points @ self.pivots[:, :-1].T + added[:, None] * self.pivots[None, :, -1]
        squares = (points * points).sum(1) + added * added
        squares = squares[:, None] + (self.pivots * self.pivots).sum(1)[None, :] - 2 * products
        return np.sqrt(np.maximum(squares, 0))

    def reach(self, queries: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """How far points with at least these scores can be from the queries."""
        lengths = (queries.astype(np.float64) ** 2).sum(1)
        squares = lengths + self.radius**2 - 2 * scores.astype(np.float64)
        return np.where(scores == UNKNOWN, np.inf, np.sqrt(np.maximum(squares, 0)) + self.slack)

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """The added component of each vector."""
        return np.sqrt(np.maximum(self.radius**2 - (vectors * vectors).sum(1), 0))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of longs as rows of one matrix, shorter ones filled up with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(lists)), lengths)
    starts = np.cumsum(lengths) - lengths
    out[rows, np.arange(len(flat)) - starts[rows]] = flat
    return out


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no sum can pass 2**53, else in whole numbers of any size.

    Scores beyond the range of a long become the end of that range.
    """
    most = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (queries, rows)]
    if most[0] * most[1] * max(1, queries.shape[1]) < 2**53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    exact = queries.astype(object) @ rows.astype(object).T
    return np.clip(exact, UNKNOWN, 2**63 - 1).astype(np.int64)


def centres(points: np.ndarray, number: int, rounds: int = 8) -> np.ndarray:
    """At most `number` centres of the points: the farthest point each time, then moved to their means."""
    if not len(points):
        return np.zeros((0, points.shape[1]))
    chosen, nearest = [0], ((points - points[0]) ** 2).sum(1)
    while len(chosen) < number and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(1))
    found = points[chosen]
    for _ in range(rounds):
        squares = (found * found).sum(1)[None, :] - 2 * points @ found.T
        of = squares.argmin(1)
        sums = np.zeros_like(found)
        np.add.at(sums, of, points)
        held = np.bincount(of, minlength=len(found))
        found = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], found)
    return found


def sphere(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, pivots: int = PIVOTS) -> tuple[Sphere, np.ndarray, int]:
    """The sphere of all rows, a sample of their vectors (at most `sample_rows`), and the number of rows."""
    square = F.aggregate(_VECTOR, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    width, most, count = rows.agg(F.max(F.size(_VECTOR)), F.max(square), F.count("*")).first()
    if not count:
        return Sphere(0, 0.0, np.zeros((0, 1))), np.zeros((0, 0), dtype=np.int64), 0
    # thinned in the tasks, so that few more than the wanted rows meet
    thinned = rows.where(F.rand(7) < 4 * sample_rows / count).select(_VECTOR, F.rand(8).alias("spread"))
    taken = thinned.orderBy("spread").limit(sample_rows).select(_VECTOR).toArrow()
    sample = matrix(taken[_VECTOR], width)
    flat = Sphere(width, float(np.sqrt(most)) * (1 + 1e-12), np.zeros((0, width + 1)))
    vectors = sample.astype(np.float64)
    lifted = np.concatenate([vectors, flat.lift(vectors)[:, None]], axis=1)
    return Sphere(width, flat.radius, centres(lifted, pivots)), sample, count


def _keyed(space: Sphere) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column(_VECTOR), space.width).astype(np.float64)
            distances = space.distances(vectors, space.lift(vectors))
            nearest = distances.argmin(1)
            batch = batch.append_column(_PIVOT, pa.array(nearest.astype(np.int32)))
            yield batch.append_column(_DIST, pa.array(distances[np.arange(len(nearest)), nearest]))

    return run


def write_index(rows: DataFrame, space: Sphere, path: str, count: int, file_bytes: int = FILE_BYTES) -> None:
    """Every row in order of pivot, distance and id; rows equal in these are parted like any others."""
    spark = rows.sparkSession
    keyed = rows.mapInArrow(_keyed(space), f"{_ID} long, {_VECTOR} array<long>, {_PIVOT} int, {_DIST} double")
    keyed = keyed.withColumn("salt", F.monotonically_increasing_id())
    files = max(spark.sparkContext.defaultParallelism, -(-count * (8 * space.width + 32) // file_bytes))
    order = [_PIVOT, _DIST, F.asc_nulls_last(_ID), "salt"]
    keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("salt").write.parquet(path)


@dataclass
class Best:
    """The best rows of each query so far: parallel arrays in order of query, score (falling) and id (nulls last)."""

    queries: int
    k: int

    def __post_init__(self) -> None:
        self.query = np.zeros(0, dtype=np.int64)
        self.score = np.zeros(0, dtype=np.int64)
        self.row = np.zeros(0, dtype=np.int64)
        self.null = np.zeros(0, dtype=bool)
        self.own = np.zeros(0, dtype=bool)
        self.least = np.full(self.queries, UNKNOWN, dtype=np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, row: np.ndarray, null: np.ndarray, own: np.ndarray) -> None:
        columns = [
            np.concatenate(pair)
            for pair in ((self.query, query), (self.score, score), (self.row, row), (self.null, null), (self.own, own))
        ]
        # ~score falls as score rises, without the overflow of a minus
        order = np.lexsort((columns[2], columns[3], ~columns[1], columns[0]))
        columns = [column[order] for column in columns]
        first = np.searchsorted(columns[0], columns[0], side="left")
        held = np.arange(len(order)) - first < self.k
        self.query, self.score, self.row, self.null, self.own = (column[held] for column in columns)
        number = np.bincount(self.query, minlength=self.queries)
        full = np.flatnonzero(number == self.k)
        last = np.cumsum(number)[full] - 1
        self.least[full] = np.maximum(self.least[full], self.score[last])


def annuli(pivot: np.ndarray, size: int = ANNULUS_ROWS) -> np.ndarray:
    """Bounds of the annuli of sorted rows: at most `size` rows of one pivot each."""
    starts = np.flatnonzero(np.concatenate([[True], pivot[1:] != pivot[:-1]]))
    ends = np.append(starts[1:], len(pivot))
    return np.append(np.concatenate([np.arange(a, b, size) for a, b in zip(starts, ends)]), len(pivot))


def few_copies(vectors: np.ndarray, ids: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """The rows, in order, without those with k equal rows of smaller ids: no query can need these."""
    weights = (np.arange(1, vectors.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    key = (vectors.astype(np.uint64) * weights).sum(1, dtype=np.uint64)
    order = np.lexsort((ids, null, key))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (key[order][1:] == key[order][:-1]) & (vectors[order][1:] == vectors[order][:-1]).all(1)
    place = np.arange(len(order))
    run = place - np.maximum.accumulate(np.where(same, 0, place))
    return np.sort(order[run < k])


def _search(
    space: Sphere, ids: np.ndarray, vectors: np.ndarray, to_pivots: np.ndarray, least: np.ndarray, k: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each task's k best rows of each query, among them the query's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), k)
        best.least = least.copy()
        for batch in batches:
            if batch.num_rows:
                _expand(batch, best)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best.query),
                pa.array(best.score),
                pa.array(best.row, mask=best.null),
                pa.array(best.own),
            ],
            ["number", "score", _ID, "own"],
        )

    def _expand(batch: pa.RecordBatch, best: Best) -> None:
        rows = matrix(batch.column(_VECTOR), space.width)
        null = batch.column(_ID).is_null().to_numpy(zero_copy_only=False)
        row_ids = batch.column(_ID).fill_null(0).to_numpy()
        kept = few_copies(rows, row_ids, null, k)
        rows, null, row_ids = rows[kept], null[kept], row_ids[kept]
        pivot = batch.column(_PIVOT).to_numpy()[kept]
        dist = batch.column(_DIST).to_numpy()[kept]
        bounds = annuli(pivot)
        low, high = dist[bounds[:-1]], dist[bounds[1:] - 1]
        from_pivot = to_pivots[:, pivot[bounds[:-1]]]
        # what a query is at least away from every point of an annulus
        gap = np.maximum(np.maximum(low - from_pivot, from_pivot - high), 0) - space.slack
        order = np.argsort(gap, axis=1, kind="stable")
        # step by step every query takes its next annulus; those that take the same one are scored together
        going = np.arange(len(ids))
        for step in range(gap.shape[1]):
            at = order[going, step]
            inside = gap[going, at] <= space.reach(vectors[going], best.least[going])
            going, at = going[inside], at[inside]
            if not len(going):
                return
            found = []
            for ring in np.unique(at):
                a, b = bounds[ring], bounds[ring + 1]
                takers = going[at == ring]
                for first in range(0, len(takers), QUERY_BLOCK):
                    some = takers[first : first + QUERY_BLOCK]
                    scores = products(vectors[some], rows[a:b])
                    q, r = np.nonzero(scores >= best.least[some][:, None])
                    own = (ids[some][q] == row_ids[a:b][r]) & ~null[a:b][r]
                    own[own] = (vectors[some][q[own]] == rows[a:b][r[own]]).all(1)
                    found.append((some[q], scores[q, r], row_ids[a:b][r], null[a:b][r], own))
            best.add(*(np.concatenate(column) for column in zip(*found)))

    return run


def _ring_filter(space: Sphere, to_pivots: np.ndarray, reach: np.ndarray) -> Column:
    """The rings of all queries of a chunk, one range of distances a pivot: pushed to the scan of the index."""
    wanted = F.lit(False)
    for i in range(len(space.pivots)):
        low = float((to_pivots[:, i] - reach).min()) - space.slack
        high = float((to_pivots[:, i] + reach).max()) + space.slack
        wanted |= (F.col(_PIVOT) == i) & (F.col(_DIST) >= low) & (F.col(_DIST) <= high)
    return wanted


def _pass(
    spark: SparkSession, index: str, space: Sphere, sample: np.ndarray, chunk: pa.Table, k: int
) -> DataFrame:
    """What one pass over the index finds for a chunk of queries: at least the k best rows of each."""
    vectors = matrix(chunk[_VECTOR], space.width)
    ids, numbers = chunk[_ID].to_numpy(), chunk["number"].to_numpy()
    to_pivots = space.distances(vectors.astype(np.float64), np.zeros(len(vectors)))
    least = np.full(len(ids), UNKNOWN, dtype=np.int64)
    if len(sample) >= k:
        for first in range(0, len(ids), QUERY_BLOCK):
            scores = products(vectors[first : first + QUERY_BLOCK], sample)
            least[first : first + QUERY_BLOCK] = np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k]
    reach = space.reach(vectors, least)
    rings = spark.read.parquet(index).where(_ring_filter(space, to_pivots, reach))
    found = rings.mapInArrow(
        _search(space, ids, vectors, to_pivots, least, k), f"number long, score long, {_ID} long, own boolean"
    )
    names = spark.createDataFrame(pa.table({"number": np.arange(len(ids)), "query": numbers, "query_id": ids}))
    return found.join(F.broadcast(names), "number").drop("number")


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    row_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    sample_rows: int = SAMPLE_ROWS,
    pivots: int = PIVOTS,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """For each row that is a query (a condition on its column `id`): query_id, rank (from 1), id and score of its k best others.

    The score is the inner product of the quantised vectors; ties go to the smaller id, nulls last.
    Rows whose vector is null or holds a null or non-finite component take no part; vectors of
    different lengths count as filled up with zeros. Rows equal in id and vector are rows of their own: each
    is a query, and the others are candidates for it. A query whose other rows are fewer than k has them all; an
    empty frame gives no rows. Other columns are not read. Scores beyond the range of a long become its end,
    and are then ties.
    """
    spark = df.sparkSession
    rows = quantised(df, row_id, vector, scale)
    space, sample, count = sphere(rows, sample_rows, pivots)
    shape = "query_id long, rank int, id long, score long"
    if not count:
        return spark.createDataFrame([], shape)
    index = scratch_path(spark, "index")
    write_index(rows, space, index, count)

    # queries that lie close together make a chunk, so that its rings are narrow
    queries = spark.read.parquet(index).where(is_query & F.col(_ID).isNotNull())
    queries = freeze(queries.withColumn("number", F.monotonically_increasing_id()))
    most = max(1, query_bytes // (8 * max(1, space.width)))
    order = [_PIVOT, _DIST, "number"]
    number = queries.count()
    if not number:
        return spark.createDataFrame([], shape)
    placed = queries.repartitionByRange(-(-number // most), *order).withColumn("part", F.spark_partition_id())
    in_part = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    placed = freeze(placed.withColumn("place", in_part))
    # one row a part: what the parts before it hold
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    placed = freeze(placed.join(ahead, "part").withColumn("chunk", F.floor((F.col("ahead") + F.col("place")) / most)))
    found = scratch_path(spark, "found")
    for i in range(-(-number // most)):
        chunk = placed.where(F.col("chunk") == i).select("number", _ID, _VECTOR).toArrow()
        # one more than wanted, as a query's own row may be among them
        _pass(spark, index, space, sample, chunk, k + 1).write.mode("append").parquet(found)

    in_order = [F.desc("score"), F.asc_nulls_last(_ID)]
    hits = spark.read.parquet(found)
    # per query the rows of all tasks: the best, less one that is the query itself
    best = hits.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(*in_order))).where(
        F.col("place") <= k + 1
    )
    selves = Window.partitionBy("query", "own").orderBy("place")
    best = best.withColumn("self", F.col("own") & (F.row_number().over(selves) == 1)).where("not self")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("place"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", _ID, "score")
