"""Winnowing against a plain search for every window of every item."""

import random
import re

import pytest
from pyspark.sql import functions as F

from curbline.llm import decontamination as dc

ITEM = "item_id long, text string"


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items):
    words, hit, found = words_of(text), set(), set()
    for item_id, item in items:
        parts = words_of(item)
        size = min(len(parts), 13)
        windows = {tuple(parts[i : i + size]) for i in range(len(parts) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item_id))
    return len(words), len(hit), sorted(found)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(5)
    pool = ["alpha", "beta", "gamma", "delta", "Eps", "ζeta", "eta2", "thêta"]
    text = lambda n: " ".join(rng.choice(pool) + rng.choice(["", "", ",", "!"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 12, 13, 14, 30, 60]))) for i in range(30)]
    items += [(100, items[5][1]), (101, None), (102, ""), (103, "---")]
    texts = []
    for _ in range(60):
        item = words_of(rng.choice(items)[1] or "x")
        at = rng.randrange(len(item)) if item else 0
        texts.append(f"{text(rng.randrange(40))} {' '.join(item[at : at + rng.randrange(1, 40)])}\n{text(5)}")
    return items, [*texts, None, "", "  ", texts[0]]


@pytest.mark.parametrize("settings", [{}, {"filter_bits": 6, "broadcast_rows": 0}, {"gram": 3}])
def test_same_as_plain_search(spark, cases, settings):
    items, texts = cases
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    result = dc.contamination(docs, spark.createDataFrame(items, ITEM), **settings).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in result} == {
        i: brute(text, items) for i, text in enumerate(texts)
    }


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "Some plain words that stand in"), (None, "text"), (2, None)], ITEM)
    clash = odd.withColumn("hits", F.lit(1)).withColumn("row", F.lit(1))
    rows = dc.contamination(clash, items.withColumn("print", F.lit(1))).collect()
    assert len(rows) == odd.count()
    assert sorted(r["n_hit"] for r in rows)[-3:] == [6, 6, 6]
    assert dc.contamination(empty, items).collect() == []
    assert all(r["n_hit"] == 0 for r in dc.contamination(odd, items.limit(0)).collect())
