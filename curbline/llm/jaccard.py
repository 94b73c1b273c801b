"""N-gram Jaccard join with count vectors and packed R-tree leaves.

A document is its set of distinct shingles (hashed runs of five words). Documents of equal sets are one
class, and only classes are compared. The shingles of a class, hashed into GROUPS groups, give its
count vector, a point. Two sets overlap in at most the sum of the smaller coordinates of their points;
where that sum is too small for the threshold, the pair is never compared as sets. The bound is taken
twice: on the points, and for pairs left by them on finer count vectors of a group for every two shingles.

Candidates share a shingle of their prefixes (the rarest shingles of a set, so many that two linked
sets must share one), and so are spread by shingle; the smaller set of a pair has one among its rarest
seventh. The classes at a shingle, ordered by size, are linked in two rounds:

1. Each class is paired with the last one before it that has the shingle among its rarest seventh. Of the pairs that pass the bound, each class's
   FIRST_PAIRS at the most shingles are verified on the sets, and the links give first components; a large group of
   near copies mostly falls into one, at linear cost.
2. At shingles where several components meet, the points are packed into R-tree leaves of LEAF points
   with their coordinate maxima. The points outside the largest component of a shingle, in leaves of
   their own, meet all leaves there: leaves, then points, are joined while the bound allows a link, leaving
   out what is in one component already. The pairs left are verified in rounds, a few of the same two
   components at a time, as one link makes the others needless.

Every link within a component either is found or cannot change the components, which are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm import textbytes as tb
from curbline.llm.decontamination import bit_table
from curbline.session import freeze

WORDS = 5
GROUPS = 128
LEAF = 64
LOWEST = 8
SLOTS = 1 << 22
FILTER_BITS = 24
#: pairs of a class that the first round verifies, and of two components in the first of the rounds after it
FIRST_PAIRS = 6
#: how many times as many pairs of two components each further round takes, until none is left
MORE_PAIRS = 8
EDGES_A_TASK = 1_000_000
_FULL = 255
_FINE_FULL = 15


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> list[np.ndarray]:
    """Per text of a slice, its shingle hashes, sorted, each once."""
    data = tb.LOWER[data]
    starts, ends, of = tb.words(data, bounds, tb.NOT_SPACE)
    hashes = tb.span_hashes(tb.prefix_sums(data), starts, ends)
    n = len(bounds) - 1
    cut = np.searchsorted(of, np.arange(n + 1))
    grams = tb.gram_hashes(hashes, words)
    sets = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            sets.append(tb.gram_hashes(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            sets.append(grams[:0])
    return sets


def _signature(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over the set."""
    at = np.arange(1, len(own) + 1, dtype=np.uint64)
    first = tb.mix(own + tb.mix(at)).sum(dtype=np.uint64)
    second = tb.mix(own ^ tb.mix(at + np.uint64(1 << 40))).sum(dtype=np.uint64)
    return int(first.astype(np.int64)), int(second.astype(np.int64))


def _need(n: np.ndarray | int) -> np.ndarray | int:
    """The least overlap with any linked set: three quarters, rounded up."""
    return (3 * n + 3) // 4


def _is_rare(place: Column, n: Column) -> Column:
    """Whether a shingle at this place of a prefix (from 0) is among the first seventh, and one, of its set.

    Two linked sets overlap in six sevenths of the smaller one at least, so that one has a shingle there which the
    other has in its prefix.
    """
    return place * 7 <= n


def common_levels(texts: DataFrame, words: int) -> np.ndarray:
    """Per slot of a hashed shingle, how common it is (0 unless it stands out in some task).

    Counted over all texts. The levels only order the shingles, rare ones first; any order is right.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for _, _, data, bounds in tb.slices(batch.column(0)):
                data = tb.LOWER[data]
                starts, ends, of = tb.words(data, bounds, tb.NOT_SPACE)
                grams = tb.gram_hashes(tb.span_hashes(tb.prefix_sums(data), starts, ends), words)
                slot = grams[tb.same_text(of, words)] & np.uint64(SLOTS - 1)
                np.add.at(times, slot.astype(np.int64), 1)
        mean = times.mean()
        common = np.flatnonzero(times > mean + 3 * np.sqrt(mean) + 2)
        yield pa.RecordBatch.from_arrays([pa.array(common), pa.array(times[common])], names=["slot", "times"])

    counted = texts.mapInArrow(work, "slot long, times long").groupBy("slot").agg(F.sum("times").alias("times"))
    levels = np.zeros(SLOTS, dtype=np.uint8)
    found = counted.toArrow()
    levels[found["slot"].to_numpy()] = np.log2(found["times"].to_numpy() + 1).astype(np.uint8)
    return levels


def _nibbles(counts: np.ndarray) -> bytes:
    """Two counts a byte; one of _FINE_FULL may be any number from there."""
    low = np.minimum(counts, _FINE_FULL).astype(np.uint8)
    return (low[0::2] | low[1::2] << 4).tobytes()


def _point(counts: np.ndarray) -> bytes:
    """The counts in half a byte each where none is larger, else in a byte; one of _FULL may be any number from there."""
    return _nibbles(counts) if counts.max() <= _FINE_FULL else np.minimum(counts, _FULL).astype(np.uint8).tobytes()


def _counts(nibbles: np.ndarray) -> np.ndarray:
    return np.stack([nibbles & 15, nibbles >> 4], axis=1).ravel()


def _described(levels: np.ndarray, words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in tb.slices(batch.column(1)):
                rows = []
                for own in shingle_sets(data, bounds, words):
                    if not len(own):
                        rows.append((0, None, None, None, None, None))
                        continue
                    slot = (own & np.uint64(SLOTS - 1)).astype(np.int64)
                    order = np.lexsort((own, levels[slot]))
                    prefix = own[order[: len(own) - _need(len(own)) + 1]]
                    points = np.bincount((own >> np.uint64(57)).astype(np.int64), minlength=GROUPS)
                    # 32 bits of each prefix shingle: a clash only adds a candidate
                    short = (prefix >> np.uint64(20)).astype(np.uint32).view(np.int32)
                    bits = max(7, (len(own) // 2).bit_length())
                    fine = np.bincount((own >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
                    rows.append((len(own), *_signature(own), short, _point(points), _nibbles(fine)))
                columns = list(zip(*rows))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.binary())
                arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), *arrays], names=["id", "n", "s1", "s2", "prefix", "point", "fine"]
                )

    return work


def _may_link(n1: np.ndarray, p1: np.ndarray, n2: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Whether the summed minima of the points allow a link; a full coordinate may be any number."""
    least = np.minimum(p1, p2)
    return (7 * least.sum(axis=1, dtype=np.int64) >= 3 * (n1 + n2)) | (least == _FULL).any(axis=1)


def _points(column: pa.Array) -> np.ndarray:
    """A row for each point, as _point has packed them."""
    packed = column.to_pylist()
    points = np.zeros((len(packed), GROUPS), dtype=np.uint8)
    halved = np.array([len(x) < GROUPS for x in packed], dtype=bool)
    for kind in (True, False):
        data = np.frombuffer(b"".join(x for x, half in zip(packed, halved) if half == kind), dtype=np.uint8)
        points[halved == kind] = (_counts(data) if kind else data).reshape(-1, GROUPS)
    return points


def _fine_link(na: int, fa: np.ndarray, nb: int, fb: np.ndarray) -> bool:
    """The same on count vectors of 2**k groups each; neighbouring groups of the longer one are merged."""
    if len(fa) < len(fb):
        fa, fb = fb, fa
    full = (fa == _FINE_FULL).any() and (fb == _FINE_FULL).any()
    fa = fa.reshape(len(fb), -1).sum(axis=1, dtype=np.int64)
    return bool(full or 7 * int(np.minimum(fa, fb).sum()) >= 3 * (na + nb))


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, times, na, fa, nb, fb) that may link."""
    for batch in batches:
        fa, fb = ([_counts(np.frombuffer(x.as_buffer(), dtype=np.uint8)) for x in batch.column(i)] for i in (4, 6))
        na, nb = batch.column(3).to_pylist(), batch.column(5).to_pylist()
        ok = [_fine_link(*x) for x in zip(na, fa, nb, fb)]
        yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b", "times"])


def may_link(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b, times) of classes that the fine bound leaves."""
    fine = classes.select("cid", "n", "fine")
    joined = pairs.join(fine.toDF("a", "na", "fa"), "a").join(fine.toDF("b", "nb", "fb"), "b")
    joined = joined.select("a", "b", "times", "na", "fa", "nb", "fb")
    return joined.mapInArrow(_bounded, "a long, b long, times long")


def _made_here(low1: np.ndarray, low2: np.ndarray, shingle: np.ndarray) -> np.ndarray:
    """Whether the least of the shingles in both rows is the given one, or there is none."""
    least = np.full(len(shingle), np.nan)
    for k in reversed(range(low1.shape[1])):
        hit = (low1[:, k : k + 1] == low2).any(axis=1)
        least[hit] = low1[hit, k]
    return np.isnan(least) | (least == shingle)


def _leaf_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows are a leaf and another one of its shingle (or none): the pairs of points that may link.

    A pair meets at every shingle it shares; it is made at the least one in both points' lowest
    shingles, or at all where those have none in common.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            rows = batch.slice(at, 512)
            sides = []
            for name in ("left", "right"):
                column = rows.column(name)
                flat = column.flatten()
                sizes = pa.compute.list_value_length(column).fill_null(0).to_numpy().astype(np.int64)
                n, cid, comp = (flat.field(k).to_numpy() for k in ("n", "cid", "comp"))
                low = np.stack([flat.field(f"low{k}").to_numpy(zero_copy_only=False).astype(float) for k in range(LOWEST)], axis=1)
                sides.append((sizes, np.cumsum(sizes) - sizes, n, cid, comp, _points(flat.field("point")), low))
            left, right = sides
            shingle = rows.column("shingle").to_numpy()
            firsts, seconds, inner = [], [], []
            for k in range(rows.num_rows):
                i, a = int(left[0][k]), int(left[1][k])
                j, b = int(right[0][k]), int(right[1][k])
                if not j:
                    x, y = np.triu_indices(i, 1)
                    firsts.append(x + a)
                    seconds.append(y + a)
                    inner.append(np.ones(len(x), dtype=bool))
                    continue
                # a leaf's maxima bound its overlap with any point of the other leaf
                tops = [side[5][c : c + m].max(axis=0) for side, c, m in ((left, a, i), (right, b, j))]
                x = np.flatnonzero(_may_link(left[2][a : a + i], left[5][a : a + i], right[2][b : b + j].min(), tops[1][None, :]))
                y = np.flatnonzero(_may_link(right[2][b : b + j], right[5][b : b + j], left[2][a : a + i].min(), tops[0][None, :]))
                firsts.append(np.repeat(x + a, len(y)))
                seconds.append(np.tile(y + b, len(x)))
                inner.append(np.zeros(len(x) * len(y), dtype=bool))
            first, second, inside = np.concatenate(firsts), np.concatenate(seconds), np.concatenate(inner)
            here = np.repeat(shingle, [len(x) for x in firsts])
            found: list[np.ndarray] = []
            for one, two, kind in ((left, left, True), (left, right, False)):
                x, y, at_list = first[inside == kind], second[inside == kind], here[inside == kind]
                ok = (one[4][x] != two[4][y]) & (4 * np.minimum(one[2][x], two[2][y]) >= 3 * np.maximum(one[2][x], two[2][y]))
                x, y, at_list = x[ok], y[ok], at_list[ok]
                for start in range(0, len(x), 50_000):
                    p, q = x[start : start + 50_000], y[start : start + 50_000]
                    ok = _made_here(one[6][p], two[6][q], at_list[start : start + 50_000])
                    p, q = p[ok], q[ok]
                    ok = _may_link(one[2][p], one[5][p], two[2][q], two[5][q])
                    ends = np.stack([one[3][p[ok]], two[3][q[ok]]], axis=1)
                    found.append(np.sort(ends, axis=1))
            ends = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, set of a, set of b) that are linked."""
    for batch in batches:
        ok = []
        for one, two in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (one, two))
            ok.append(7 * len(np.intersect1d(x, y, assume_unique=True)) >= 3 * (len(x) + len(y)))
        yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])


def class_sets(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(cid, own) of the classes in pairs, and of no others; each task builds a set once."""
    ends = [pairs.select(F.col(end).alias("cid")).distinct() for end in ("a", "b")]
    ends = ends[0].union(ends[1]).distinct()
    needed = freeze(ends.join(classes.select("cid", "s1", "s2"), "cid"))
    table = bit_table(needed, "s1", FILTER_BITS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for batch in batches:
            for _, _, data, bounds in tb.slices(batch.column(0)):
                rows = []
                for own in shingle_sets(data, bounds, words):
                    if len(own):
                        key = _signature(own)
                        slot = key[0] & ((1 << FILTER_BITS) - 1)
                        if table[slot >> 3] >> (slot & 7) & 1 and key not in done:
                            done.add(key)
                            rows.append((*key, own.tobytes()))
                columns = list(zip(*rows)) if rows else [[], [], []]
                types = (pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["s1", "s2", "own"])

    sets = texts.mapInArrow(work, "s1 long, s2 long, own binary").join(needed, ["s1", "s2"])
    return sets.groupBy("cid").agg(F.first("own").alias("own"))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of classes whose sets link."""
    joined = pairs.join(sets.select(F.col("cid").alias("a"), F.col("own").alias("own_a")), "a")
    joined = joined.join(sets.select(F.col("cid").alias("b"), F.col("own").alias("own_b")), "b")
    return joined.select("a", "b", "own_a", "own_b").mapInArrow(_verified, "a long, b long")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars: every node with the least node it reaches here.

    Stars are given out, and a new forest begun, whenever EDGES_A_TASK nodes are held.
    """
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    def stars() -> pa.RecordBatch:
        rows = [(x, top(x)) for x in list(above) if top(x) != x]
        columns = list(zip(*rows)) if rows else [[], []]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = top(a), top(b)
            above[max(a, b)] = min(a, b)
        if len(above) >= EDGES_A_TASK:
            yield stars()
            above.clear()
    yield stars()


def components(edges: DataFrame) -> DataFrame:
    """(cid, comp) for every node of the edges (a, b): comp is the least node it reaches.

    Each task first reduces its own edges to stars. Edges that fit one task, with no more than EDGES_A_TASK ends, are
    done with that; otherwise large-star and small-star steps alternate until no edge changes, each cut
    off by a checkpoint.
    """
    edges = freeze(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    number = edges.count()
    if 2 * number <= EDGES_A_TASK:
        return edges.coalesce(1).mapInArrow(_forest, "a long, b long").toDF("cid", "comp")
    stars = freeze(edges.coalesce(max(4, number // EDGES_A_TASK)).mapInArrow(_forest, "a long, b long"))
    before = None
    while True:
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = freeze(small.select("a", F.col("m").alias("b")).union(hooked).distinct())
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return stars.groupBy("a").agg(F.min("b").alias("comp")).withColumnRenamed("a", "cid")
        before = now


def rest_of_links(
    pairs: DataFrame, links: DataFrame, joined: DataFrame, classes: DataFrame, texts: DataFrame, words: int
) -> tuple[DataFrame, DataFrame]:
    """All links and the components (cid, comp) they make, once the candidate pairs are decided as well.

    Only pairs of two components matter. Of the pairs of the same two components, FIRST_PAIRS are verified; then the
    components are made anew, pairs that are inside one by now are left out, and MORE_PAIRS times as many are
    taken, until no pair is left. A class outside a large group of near copies has a pair with each of them, but
    needs one link.
    """
    pairs = freeze(pairs)
    sets = freeze(class_sets(pairs, classes, texts, words))
    for end in ("a", "b"):
        comp = joined.select(F.col("cid").alias(end), F.col("comp").alias(f"comp_{end}"))
        pairs = pairs.join(comp, end, "left").withColumn(f"comp_{end}", F.coalesce(f"comp_{end}", end))
    apart = pairs.select("a", "b", F.least("comp_a", "comp_b").alias("one"), F.greatest("comp_a", "comp_b").alias("two"))
    turn = F.row_number().over(Window.partitionBy("one", "two").orderBy(F.xxhash64("a", "b"), "a", "b"))
    most = FIRST_PAIRS
    while True:
        ranked = freeze(apart.where("one <> two").withColumn("turn", turn))
        if ranked.isEmpty():
            # components of before and the new links make those of now
            stars = joined.select(F.col("cid").alias("a"), F.col("comp").alias("b"))
            return links, freeze(components(stars.union(links)))
        now = ranked.where(F.col("turn") <= most)
        found = freeze(verify(now.select("a", "b"), sets))
        links = links.union(found)
        fused = components(now.join(found, ["a", "b"]).select(F.col("one").alias("a"), F.col("two").alias("b")))
        # the new components are looked up once for each two old ones that have pairs left, not for each pair
        rest = ranked.where(F.col("turn") > most).select("a", "b", "one", "two")
        between = rest.select("one", "two").distinct()
        for end in ("one", "two"):
            comp = fused.select(F.col("cid").alias(end), F.col("comp").alias(f"new_{end}"))
            between = between.join(comp, end, "left").withColumn(f"new_{end}", F.coalesce(f"new_{end}", end))
        between = between.where("new_one <> new_two")
        apart = rest.join(between, ["one", "two"]).select(
            "a", "b", F.least("new_one", "new_two").alias("one"), F.greatest("new_one", "new_two").alias("two")
        )
        most *= MORE_PAIRS


def packed(points: DataFrame) -> DataFrame:
    """Points (shingle, main, listed, p) in leaves of LEAF, by size within their shingle."""
    by_size = Window.partitionBy("shingle").orderBy("p.n", "p.cid")
    leaf = F.floor((F.row_number().over(by_size) - 1) / LEAF)
    return points.withColumn("leaf", leaf).groupBy("shingle", "leaf").agg(
        F.collect_list("p").alias("points"),
        F.min("p.n").alias("n_least"),
        F.max("p.n").alias("n_most"),
        F.first("main").alias("main"),
        F.first("listed").alias("listed"),
    )


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, classes and links of the join at a Jaccard similarity of 0.75 or more.

    Documents: one row per row of `df` with its id, n_shingles, its class (`s1`, `s2`; null for an empty
    set) and component_id, the least id reachable by links (its own where there are none; null ids do
    not count, and a component without any id has none). Classes: one row per different set, with
    `cid`. Links: pairs of classes (a, b) that were verified; they connect the components, but pairs
    inside a component that was already connected are not all listed. A text shorter than `words`
    words is one shingle; null, empty and blank texts have none and link with nothing. Rows with equal
    ids are separate documents; other columns are not read. The texts are read up to four times and
    must be the same each time, in any order.
    """
    texts = df.select(F.col(f"`{text}`").cast("string").alias("text"))
    docs = df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string"))
    kind = df.schema[doc_id].dataType.simpleString()
    levels = common_levels(texts, words)
    shape = f"id {kind}, n long, s1 long, s2 long, prefix array<int>, point binary, fine binary"
    docs = freeze(docs.mapInArrow(_described(levels, words), shape))
    classes = docs.where("n > 0").groupBy("s1", "s2").agg(
        F.min("id").alias("least_id"),
        F.first("n").alias("n"),
        F.first("prefix").alias("prefix"),
        F.first("point").alias("point"),
        F.first("fine").alias("fine"),
    )
    classes = freeze(classes).withColumn("cid", F.monotonically_increasing_id())

    # classes at each prefix shingle, by size, those that have it among their rarest first. A link has such a class before
    # its other end at some shingle; rows without a neighbour of near size that they may link with in this way are left out
    # (`turn` is twice the size, and one where it is not among them)
    by_size = Window.partitionBy("shingle").orderBy("turn", "cid")
    at_shingle = classes.select("cid", "n", F.posexplode("prefix").alias("place", "shingle"))
    turn = F.col("n") * 2 + (~_is_rare(F.col("place"), F.col("n"))).cast("int")
    at_shingle = at_shingle.select("cid", turn.alias("turn"), "shingle")
    is_rare, size = F.col("turn") % 2 == 0, F.shiftright("turn", 1)
    so_far = by_size.rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(is_rare, F.struct("cid", size.alias("n"))), ignorenulls=True)
    at_shingle = at_shingle.withColumn("before", before.over(so_far))
    at_shingle = at_shingle.withColumn("next_n", F.lead(size).over(by_size)).withColumn("n", size.cast("int"))
    near_before = F.coalesce(F.col("before.n") * 4 >= F.col("n") * 3, F.lit(False))
    near_next = is_rare & F.coalesce(F.col("n") * 4 >= F.col("next_n") * 3, F.lit(False))
    shared = at_shingle.where(near_before | near_next)
    shared = freeze(shared.select("shingle", "cid", "n", F.when(near_before, F.col("before.cid")).alias("before")))

    pairs = shared.where("before is not null").select(F.greatest("cid", "before").alias("a"), F.least("cid", "before").alias("b"))
    pairs = pairs.where("a <> b").groupBy("a", "b").agg(F.count("*").alias("times"))
    closest = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("times"), "b"))
    pairs = freeze(may_link(pairs, classes).withColumn("turn", closest).where(F.col("turn") <= FIRST_PAIRS).select("a", "b"))
    links = freeze(verify(pairs, class_sets(pairs, classes, texts, words)))
    joined = freeze(components(links))

    # gathered by shingle once, to see where components meet, and by class once, for its lowest shingles and its point
    with_comp = shared.join(joined, "cid", "left").select("shingle", "cid", "n", F.coalesce("comp", "cid").alias("comp"))
    with_comp = with_comp.repartition("shingle")
    of_list = with_comp.groupBy("shingle", "comp").agg(F.count("*").alias("k")).groupBy("shingle").agg(
        F.max(F.struct("k", "comp"))["comp"].alias("main"), F.sum("k").alias("listed"), F.count("*").alias("comps")
    )
    in_lists = with_comp.join(of_list.where("comps > 1").drop("comps"), "shingle")
    in_lists = in_lists.groupBy("cid").agg(
        F.first("n").alias("n"),
        F.first("comp").alias("comp"),
        F.sort_array(F.collect_list(F.struct("shingle", "main", "listed"))).alias("lists"),
    )
    in_lists = in_lists.join(classes.select("cid", "point"), "cid")
    lowest = [F.get(F.col("lists.shingle"), F.lit(k)).alias(f"low{k}") for k in range(LOWEST)]
    point = F.struct("n", "cid", "comp", "point", *lowest).alias("p")
    leaves = freeze(packed(in_lists.select(point, F.inline("lists")).select("shingle", "main", "listed", "p")))

    # a pair of two components has an end outside the main component of its list: those ends meet the whole list
    alone = leaves.where(F.col("listed") <= LEAF)
    alone = alone.select("shingle", F.col("points").alias("left"), F.expr("filter(points, x -> false)").alias("right"))
    long_lists = leaves.where(F.col("listed") > LEAF)
    outside = packed(long_lists.select("shingle", "main", "listed", F.explode("points").alias("p")).where("p.comp <> main"))
    whole = long_lists.select("shingle", F.col("points").alias("right"), F.col("n_least").alias("r_least"), F.col("n_most").alias("r_most"))
    across = outside.join(whole, "shingle").where("n_most * 4 >= r_least * 3 and r_most * 4 >= n_least * 3")
    across = across.select("shingle", F.col("points").alias("left"), "right")
    more = freeze(alone.unionByName(across).mapInArrow(_leaf_pairs, "a long, b long").distinct())
    more = more.join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    more = may_link(more.withColumn("times", F.lit(1).cast("long")), classes).select("a", "b")
    links, joined = rest_of_links(more, links, joined, classes, texts, words)

    of_class = classes.select("cid", "s1", "s2", "least_id").join(joined, "cid", "left")
    of_class = of_class.withColumn("comp", F.coalesce("comp", "cid"))
    least = of_class.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    of_class = of_class.join(least, "comp").select("s1", "s2", "component_id")
    found = docs.select("id", "n", "s1", "s2").join(of_class, ["s1", "s2"], "left").select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        "s1",
        "s2",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
    return found, classes.select("cid", "s1", "s2", "n", "least_id"), links
