"""Weak labels: accuracy on labels never learned from, EM on known patterns, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from curbline.llm import queries
from curbline.llm import weak_labels as wl

SF_DIR = "/root/testdata/sf0.01"


def test_accuracy_on_the_labels(spark):
    rows = {r["doc_id"]: r for r in queries.op5_weak_labels(spark, SF_DIR).collect()}
    assert len(rows) == 1000
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    good = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1]
    bad = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.05 * len(bad)


def test_em_finds_the_labellers(spark):
    rng = np.random.default_rng(1)
    good = rng.random(20000) < 0.7
    bad_signs, good_signs = len(wl.SHARES), len(wl.GOOD_SIGNS)
    on_bad = np.concatenate([np.linspace(0.2, 0.6, bad_signs), np.full(good_signs, 0.1)])
    on_good = np.concatenate([np.full(bad_signs, 0.03), np.full(good_signs, 0.9)])
    voted = rng.random((20000, bad_signs + good_signs)) < np.where(good[:, None], on_good, on_bad)
    vote = np.array([wl.BAD] * bad_signs + [wl.GOOD] * good_signs)
    cast = np.where(voted, vote, wl.NOTHING)
    patterns, counts = np.unique(cast @ wl._PLACES, return_counts=True)
    labels = wl.Labels(patterns, counts.astype(float))
    assert abs(labels.good - 0.7) < 0.02
    found = labels.vote[:, np.arange(len(vote)), vote]
    assert np.abs(found - np.stack([on_bad, on_good])).max() < 0.04
    assert ((labels.posterior(cast) > 0.5) == good).mean() > 0.97


def test_good_rows_keep_every_column(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = wl.learn_labels(docs)
    scorer = wl.learn_scorer(docs, labels)
    kept = {r["doc_id"] for r in wl.classify(docs, labels, scorer).where("kept").collect()}
    rows = wl.good_rows(docs, labels, scorer)
    assert rows.schema == docs.schema and {r["doc_id"] for r in rows.collect()} == kept


def test_copies_do_not_thin_the_training_texts(documents, monkeypatch):
    texts = [f"Text number {i} has some words of its own." for i in range(500)]
    df = documents(*texts, *texts[:5] * 900)
    labels = wl.learn_labels(df)
    monkeypatch.setattr(wl, "Scorer", lambda text_of, slot, value, label: len(label))
    assert 140 <= wl.learn_scorer(df, labels, rows=200) <= 260


def test_odd_rows(odd, empty):
    labels = wl.learn_labels(odd)
    scorer = wl.learn_scorer(odd, labels)
    rows = wl.classify(odd.withColumn("kept", F.lit(1)), labels, scorer).collect()
    assert len(rows) == odd.count()
    assert all(not r["kept"] and r["score"] == 0 for r in rows if not r["n_words"])
    none = wl.learn_labels(empty)
    assert wl.classify(empty, none, wl.learn_scorer(empty, none)).collect() == []
