"""The n-gram Jaccard join against all pairs."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curbline.llm import jaccard as ja


def brute(texts):
    sets = []
    for text in texts:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        size = min(5, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    comp = list(range(len(texts)))

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((top(i), top(j)))
                comp[y] = x
    return {i: (len(sets[i]), top(i)) for i in range(len(texts))}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ja.near_duplicates(df)[0].collect()}


@pytest.mark.parametrize("leaf", [64, 2])
def test_same_as_all_pairs(spark, documents, monkeypatch, leaf):
    monkeypatch.setattr(ja, "LEAF", leaf)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.randrange(1, 14)):
            own = list(base)
            for _ in range(rng.randrange(1 + len(own) // 30)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            cut = rng.randrange(1 + len(own) // 6)
            texts.append(" ".join(own[cut:] + (shared if rng.random() < 0.3 else [])))
    texts += [None, "", "  ", "One two", "one TWO", "one", texts[0], texts[5]]
    assert found(documents(*texts).repartition(5)) == brute(texts)


def test_chain_of_near_copies(documents):
    words = [f"w{i}" for i in range(260)]
    texts = [" ".join(words[i : i + 100]) for i in range(0, 160, 4)]
    assert found(documents(*texts)) == brute(texts)


def test_odd_rows(odd, empty):
    rows = ja.near_duplicates(odd.withColumn("n", F.lit(1)).withColumn("point", F.lit(1)))[0].collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert by_id[1] == by_id[2] == 1 and by_id[6] == 6 and by_id[3] == 3
    assert ja.near_duplicates(empty)[0].collect() == []


@pytest.mark.parametrize("at_once", [None, 500])
def test_components(spark, monkeypatch, at_once):
    """In one task, and in alternating steps."""
    if at_once:
        monkeypatch.setattr(ja, "EDGES_A_TASK", at_once)
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(3000) if i % 500] + [(rng.randrange(4000, 5000), rng.randrange(4000, 5000)) for _ in range(600)]
    rng.shuffle(edges)
    rows = {r["cid"]: r["comp"] for r in ja.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {}
    for a, b in edges:
        top.setdefault(a, a), top.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(top[a], top[b])
            changed |= top[a] != least or top[b] != least
            top[a] = top[b] = least
    assert rows == {x: t for x, t in top.items() if t != x}


def test_fine_counts_keep_the_bound():
    """Packed counts never bound an overlap below the true one, full ones included."""
    rng = random.Random(4)
    for _ in range(300):
        size = rng.choice([30, 200, 900])
        common = {rng.getrandbits(64) for _ in range(size)}
        if rng.random() < 0.2:
            common = {rng.getrandbits(40) for _ in range(size)}
        one, two = ({*common, *(rng.getrandbits(64) for _ in range(rng.randrange(size)))} for _ in range(2))
        sides = []
        for own in (one, two):
            bits = max(7, (len(own) // 2).bit_length())
            counts = ja.np.bincount([x >> (64 - bits) for x in own], minlength=1 << bits)
            sides += [len(own), ja._counts(ja.np.frombuffer(ja._nibbles(counts), dtype=ja.np.uint8))]
        if 100 * len(one & two) >= 75 * len(one | two):
            assert ja._fine_link(*sides)


def test_points_come_back_whole():
    """Points of small counts take half a byte a count; larger ones keep their counts."""
    small = ja.np.arange(ja.GROUPS) % 16
    large = ja.np.arange(ja.GROUPS) * 3
    packed = [ja._point(x) for x in (small, large, small[::-1])]
    assert [len(x) for x in packed] == [ja.GROUPS // 2, ja.GROUPS, ja.GROUPS // 2]
    points = ja._points(pa.array(packed, pa.binary()))
    assert (points == ja.np.minimum([small, large, small[::-1]], 255)).all()


def test_linked_sets_share_a_rare_shingle_of_the_smaller_one(spark):
    """At the threshold as well: the smaller set's first seventh, and one, meets the other's prefix."""
    rng = random.Random(6)
    rows = []
    while len(rows) < 400:
        small = rng.randrange(1, 60)
        large = rng.randrange(small, small * 4 // 3 + 1)
        least = -(-3 * (small + large) // 7)
        if least > small:
            continue
        whole = rng.sample(range(1000), small + large - least)
        # the shared ones last, where their prefixes meet least
        own, rest = sorted(whole)[: small + large - 2 * least], sorted(whole)[small + large - 2 * least :]
        rng.shuffle(own)
        one, two = sorted(own[: small - least] + rest), sorted(own[small - least :] + rest)
        reach = set(two[: large - ja._need(large) + 1])
        rows.append((len(rows), small, [x in reach for x in one]))
    pairs = spark.createDataFrame(rows, "pair int, n long, met array<boolean>")
    places = pairs.select("pair", "n", F.posexplode("met").alias("place", "met"))
    met = places.where(ja._is_rare(F.col("place"), F.col("n"))).groupBy("pair").agg(F.max("met").alias("met"))
    assert met.where("met").count() == len(rows)
