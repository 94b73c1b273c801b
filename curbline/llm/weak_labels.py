"""Quality classifier from weak labels.

Heuristic labellers vote on every text: most vote bad or nothing, two vote good or nothing. How often each vote pattern occurs is
counted over all texts; expectation-maximisation on those counts estimates how each labeller votes on
good and on bad texts (a labeller's votes are taken as independent of the others' given the class),
and so the posterior of every pattern. Texts of a bounded sample, with their posteriors as soft labels,
train a linear scorer over hashed features, which then scores every text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm import textbytes as tb
from curbline.llm.quality_rules import LETTER, SYMBOLS, UPPER, Texts

BAD, GOOD, NOTHING = 0, 1, 2
TRAIN_ROWS = 4000
FEATURES = 1 << 18
STEPS = 300
RATE = 2.0
DECAY = 1e-5

_DIGIT = tb.byte_class((0x30, 0x39))
_STOP = np.isin(np.arange(256), np.frombuffer(b".!?", dtype=np.uint8))
_PAUSE = np.isin(np.arange(256), np.frombuffer(b".,;:", dtype=np.uint8))
_PIPE = tb.byte_class((0x7C, 0x7C))
_BANG = tb.byte_class((0x21, 0x21))
_SMALL = tb.byte_class((0x61, 0x7A), (0x80, 0xFF))


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


#: name, share measured, votes bad above, counts as fine below
SHARES: tuple[tuple[str, Callable[[Texts], np.ndarray], float, float], ...] = (
    ("symbols", lambda t: _share(t.bytes_in(SYMBOLS), t.measure("n_words")), 0.10, 0.02),
    ("pipes", lambda t: _share(t.bytes_in(_PIPE), t.measure("n_words")), 0.10, 0.02),
    ("exclamations", lambda t: _share(t.bytes_in(_BANG), t.measure("n_words")), 0.20, 0.05),
    ("capitals", lambda t: _share(t.bytes_in(UPPER), t.bytes_in(LETTER)), 0.40, 0.15),
    ("repeated_words", lambda t: _share(t.measure("n_repeat_words"), t.measure("n_words")), 0.50, 0.35),
    ("repeated_lines", lambda t: _share(t.measure("n_dup_lines"), t.measure("n_lines")), 0.50, 0.40),
    ("long_words", lambda t: _share(t.measure("word_chars"), t.measure("n_words")), 16.0, 9.0),
    ("digits", lambda t: _share(t.bytes_in(_DIGIT), t.measure("word_chars")), 0.30, 0.15),
    ("pauses", lambda t: 0.5 - _share(t.bytes_in(_PAUSE), t.measure("n_words")), 0.495, 0.47),
)


#: these vote good when all the shares named are fine
GOOD_SIGNS = (
    ("varied", ("repeated_words", "repeated_lines")),
    ("prose", tuple(name for name, *_ in SHARES)),
)
LABELLERS = tuple(name for name, *_ in (*SHARES, *GOOD_SIGNS))


def shares(texts: Texts) -> np.ndarray:
    return np.stack([measure(texts) for _, measure, _, _ in SHARES], axis=1)


def votes(texts: Texts) -> np.ndarray:
    """One row a text, one column a labeller; a text without words gets no votes."""
    found = shares(texts)
    cast = np.full((texts.n, len(LABELLERS)), NOTHING)
    cast[:, : len(SHARES)][found > np.array([bad for _, _, bad, _ in SHARES])] = BAD
    fine = found < np.array([good for _, _, _, good in SHARES])
    for j, (_, names) in enumerate(GOOD_SIGNS):
        needed = [i for i, (name, *_) in enumerate(SHARES) if name in names]
        cast[fine[:, needed].all(axis=1), len(SHARES) + j] = GOOD
    cast[texts.measure("n_words") == 0] = NOTHING
    return cast


_PLACES = 3 ** np.arange(len(LABELLERS))
# where estimation starts: chances of the votes bad, good and nothing, on bad and on good texts
_START_BAD = ((0.40, 0.001, 0.599), (0.02, 0.001, 0.979))
_START_GOOD = ((0.001, 0.30, 0.699), (0.001, 0.90, 0.099))


class Labels:
    """What expectation-maximisation found: the share of good texts, and per labeller and class its votes."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 200):
        cast = patterns[:, None] // _PLACES[None, :] % 3
        self.good = 0.8
        # per class, labeller and vote
        starts = [_START_BAD] * len(SHARES) + [_START_GOOD] * len(GOOD_SIGNS)
        self.vote = np.array(starts).transpose(1, 0, 2)
        for _ in range(rounds if len(counts) else 0):
            held = self._posterior(cast)
            weight = np.stack([(1 - held) * counts, held * counts])
            before = self.vote
            self.good = (weight[1].sum() + 1) / (counts.sum() + 2)
            self.vote = np.stack(
                [[[weight[c][cast[:, j] == v].sum() + 0.1 for v in range(3)] for j in range(len(LABELLERS))] for c in (0, 1)]
            )
            self.vote = self.vote / self.vote.sum(axis=2, keepdims=True)
            if np.abs(before - self.vote).max() < 1e-6:
                break

    def _posterior(self, cast: np.ndarray) -> np.ndarray:
        logs = np.log(self.vote)
        log_odds = np.log(self.good / (1 - self.good))
        for j in range(len(LABELLERS)):
            log_odds = log_odds + logs[1, j][cast[:, j]] - logs[0, j][cast[:, j]]
        return 1 / (1 + np.exp(-np.clip(log_odds, -40, 40)))

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        return self._posterior(cast)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of the hashed features: words, pairs of word shapes, and bands of the shares.

    Word and shape features hold their share of the text's words.
    """
    starts, ends, of = tb.words(texts.data, texts.bounds, tb.NOT_SPACE)
    hashes = tb.span_hashes(tb.prefix_sums(tb.LOWER[texts.data]), starts, ends)
    shape = np.minimum(ends - starts, 15).astype(np.uint64)
    for bit, kind in enumerate((UPPER, _SMALL, _DIGIT, SYMBOLS, _BANG)):
        before = np.concatenate([[0], np.cumsum(kind[texts.data], dtype=np.int64)])
        shape |= (before[ends] > before[starts]).astype(np.uint64) << np.uint64(4 + bit)
    shape |= _STOP[texts.data[ends - 1]].astype(np.uint64) << np.uint64(9)
    again = np.zeros(len(of), dtype=np.uint64)
    again[1:] = hashes[1:] == hashes[:-1]
    pairs = np.flatnonzero(tb.same_text(of, 2))
    pair = tb.mix(shape[pairs] << np.uint64(20) | shape[pairs + 1] << np.uint64(2) | again[pairs + 1] << np.uint64(1) | np.uint64(1))
    band = np.floor(np.log2(shares(texts).clip(0) + 2**-8)).astype(np.int64) + 16
    band = tb.mix((band + 64 * np.arange(len(SHARES))[None, :] + (1 << 40)).astype(np.uint64))
    which = np.concatenate([of, of[pairs], np.repeat(np.arange(texts.n), len(SHARES))])
    slot = (np.concatenate([hashes, pair, band.ravel()]) % np.uint64(FEATURES)).astype(np.int64)
    words = np.maximum(texts.measure("n_words"), 1)
    value = np.concatenate([1 / words[of], 1 / words[of[pairs]], np.full(band.size, 0.25)])
    key, where = np.unique(which * FEATURES + slot, return_inverse=True)
    return key // FEATURES, key % FEATURES, np.bincount(where, weights=value, minlength=len(key))


def _each(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, int, Texts]]:
    for batch in batches:
        for first, end, data, bounds in tb.slices(batch.column(column)):
            yield batch, first, end, Texts(data, bounds)


def learn_labels(df: DataFrame, text: str = "text") -> Labels:
    """Counts the vote patterns of all texts (at most three to the labellers' number) and fits them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, texts in _each(batches, 0):
            patterns, counts = np.unique(votes(texts) @ _PLACES, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(patterns), pa.array(counts)], names=["pattern", "n"])

    counted = df.select(F.col(f"`{text}`").cast("string")).mapInArrow(work, "pattern long, n long")
    rows = sorted((r[0], r[1]) for r in counted.groupBy("pattern").agg(F.sum("n")).collect())
    return Labels(np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=float))


class Scorer:
    """Logistic regression on (text, feature, value) rows with soft labels, by gradient steps."""

    def __init__(self, text_of: np.ndarray, slot: np.ndarray, value: np.ndarray, label: np.ndarray):
        self.weights, self.bias = np.zeros(FEATURES), 0.0
        if not len(label):
            return
        used, slot = np.unique(slot, return_inverse=True)
        weights, square = np.zeros(len(used)), np.full(len(used), 1e-8)
        # both classes weigh alike
        class_weight = label / max(label.sum(), 1e-9) + (1 - label) / max((1 - label).sum(), 1e-9)
        for _ in range(STEPS):
            margin = np.bincount(text_of, weights=weights[slot] * value, minlength=len(label)) + self.bias
            error = class_weight * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - label)
            slope = np.bincount(slot, weights=error[text_of] * value, minlength=len(used)) + DECAY * weights
            square += slope**2
            weights -= RATE * 0.1 * slope / np.sqrt(square)
            self.bias -= RATE * 0.1 * error.sum()
        self.weights[used] = weights

    def score(self, texts: Texts) -> np.ndarray:
        of, slot, value = features(texts)
        margin = np.bincount(of, weights=self.weights[slot] * value, minlength=texts.n) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def learn_scorer(df: DataFrame, labels: Labels, text: str = "text", rows: int = TRAIN_ROWS) -> Scorer:
    """Trains on about `rows` texts, chosen by a hash of the text; that bound is what reaches the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, texts in _each(batches, 0):
            of, slot, value = features(texts)
            label = labels.posterior(votes(texts))
            cut = np.searchsorted(of, np.arange(texts.n + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(slot, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(value, pa.float32())),
                    pa.array(label),
                ],
                names=["slot", "value", "label"],
            )

    worded = df.select(F.col(f"`{text}`").cast("string").alias("text")).where("length(text) > 0")
    distinct = worded.select(F.xxhash64("text")).distinct().count()
    share = min(1.0, rows / max(1, distinct))
    # a text's copies go together, so one copy of each is enough
    sample = worded.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()
    got = sample.mapInArrow(work, "slot array<int>, value array<float>, label double").toArrow()
    sizes = pa.compute.list_value_length(got["slot"]).to_numpy().astype(np.int64)
    flat = {name: pa.compute.list_flatten(got[name]).to_numpy() for name in ("slot", "value")}
    return Scorer(np.repeat(np.arange(len(sizes)), sizes), flat["slot"], flat["value"].astype(float), got["label"].to_numpy())


def classify(
    df: DataFrame, labels: Labels, scorer: Scorer, doc_id: str = "doc_id", text: str = "text", least: float = 0.5
) -> DataFrame:
    """One row per text: its id, n_words, `posterior` of its votes, `score` of the scorer, and `kept`.

    Kept are texts with words and a score of `least` or more. A null text is an empty one, which is not
    kept, with score 0. Rows with equal ids are separate texts; other columns are not read.
    """
    context = df.sparkSession.sparkContext
    shared = context.broadcast((labels, scorer))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, scorer = shared.value
        for batch, first, end, texts in _each(batches, 1):
            n = texts.measure("n_words")
            score = np.where(n > 0, scorer.score(texts), 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, end - first),
                    pa.array(n, pa.int64()),
                    pa.array(labels.posterior(votes(texts))),
                    pa.array(score),
                    pa.array((n > 0) & (score >= least)),
                ],
                names=["id", "n_words", "posterior", "score", "kept"],
            )

    kind = df.schema[doc_id].dataType.simpleString()
    found = df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string"))
    found = found.mapInArrow(work, f"id {kind}, n_words long, posterior double, score double, kept boolean")
    return found.select(F.col("id").alias(doc_id), *found.columns[1:])


def good_rows(df: DataFrame, labels: Labels, scorer: Scorer, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `df` that are kept, with all their columns."""
    context = df.sparkSession.sparkContext
    shared = context.broadcast((labels, scorer))
    place = df.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, scorer = shared.value
        for batch, first, end, texts in _each(batches, place):
            kept = (texts.measure("n_words") > 0) & (scorer.score(texts) >= least)
            yield batch.slice(first, end - first).filter(pa.array(kept))

    return df.mapInArrow(work, df.schema)
