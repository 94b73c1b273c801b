"""Quality rules as a short-circuit cascade.

Every rule rejects a text by one measure of it. On a bounded sample each measure is timed and each
rule's rejections are noted; then the rules are ordered greedily by the rejections they add per second
they cost, and each text is only measured until its first rejection. The verdict does not depend on
the order, so neither the sample nor the clock can change it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm import textbytes as tb

SAMPLE_ROWS = 2000

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
UPPER = tb.byte_class((0x41, 0x5A))
LETTER = tb.byte_class((0x41, 0x5A), (0x61, 0x7A))
FIRST_BYTE = ~tb.byte_class((0x80, 0xBF))


class Texts:
    """The texts of one slice with their measures, each computed when first asked for."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds, self.n = data, bounds, len(bounds) - 1
        self._known: dict[str, np.ndarray] = {}

    def of_texts(self, rows: np.ndarray) -> Texts:
        if len(rows) == self.n:
            return self
        pieces = [self.data[self.bounds[i] : self.bounds[i + 1]] for i in rows]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        part = Texts(np.concatenate(pieces) if pieces else self.data[:0], bounds)
        part._known = {name: values[rows] for name, values in self._known.items()}
        return part

    def measure(self, name: str) -> np.ndarray:
        if name not in self._known:
            self._known |= MEASURES[name](self)
        return self._known[name]

    def bytes_in(self, kind: np.ndarray) -> np.ndarray:
        """How many bytes of each text are in a class."""
        before = np.concatenate([[0], np.cumsum(kind[self.data], dtype=np.int64)])
        return before[self.bounds[1:]] - before[self.bounds[:-1]]


def _words(texts: Texts) -> dict[str, np.ndarray]:
    _, _, of = tb.words(texts.data, texts.bounds, tb.NOT_SPACE)
    return {"n_words": tb.counts(of, texts.n)}


def _repeated(keys: np.ndarray) -> np.ndarray:
    """For each key, whether it occurs twice or more."""
    _, where, times = np.unique(keys, return_inverse=True, return_counts=True)
    return times[where] > 1


def _repeat_words(texts: Texts) -> dict[str, np.ndarray]:
    starts, ends, of = tb.words(texts.data, texts.bounds, tb.NOT_SPACE)
    covered = np.zeros(len(of) + 3, dtype=np.int64)
    windows = tb.gram_hashes(tb.span_hashes(tb.prefix_sums(texts.data), starts, ends), 3)
    inside = np.flatnonzero(tb.same_text(of, 3))
    again = inside[_repeated(windows[inside] ^ tb.mix(of[inside].astype(np.uint64) + np.uint64(1)))]
    covered[again] += 1
    covered[again + 3] -= 1
    hit = np.cumsum(covered)[: len(of)] > 0
    return {"n_words": tb.counts(of, texts.n), "n_repeat_words": tb.counts(of[hit], texts.n)}


def _lines(texts: Texts) -> dict[str, np.ndarray]:
    breaks = np.flatnonzero(texts.data == 10)
    starts = np.concatenate([texts.bounds[:-1], breaks + 1])
    ends = np.concatenate([breaks, texts.bounds[1:]])
    starts.sort()
    ends.sort()
    before = np.concatenate([[0], np.cumsum(tb.NOT_SPACE[texts.data], dtype=np.int64)])
    worded = before[ends] > before[starts]
    starts, ends = starts[worded], ends[worded]
    of = np.searchsorted(texts.bounds, starts, side="right") - 1
    keys = tb.span_hashes(tb.prefix_sums(texts.data), starts, ends) ^ tb.mix(of.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(keys, return_index=True)
    n_lines = tb.counts(of, texts.n)
    return {"n_lines": n_lines, "n_dup_lines": n_lines - tb.counts(of[first], texts.n)}


MEASURES: dict[str, Callable[[Texts], dict[str, np.ndarray]]] = {
    "n_words": _words,
    "word_chars": lambda t: {"word_chars": t.bytes_in(tb.NOT_SPACE & FIRST_BYTE)},
    "n_symbols": lambda t: {"n_symbols": t.bytes_in(SYMBOLS)},
    "n_repeat_words": _repeat_words,
    "n_lines": _lines,
    "n_dup_lines": _lines,
    "n_letters": lambda t: {"n_letters": t.bytes_in(LETTER)},
    "n_upper": lambda t: {"n_upper": t.bytes_in(UPPER)},
    "n_bangs": lambda t: {"n_bangs": t.bytes_in(tb.byte_class((0x21, 0x21)))},
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text when 100 * measure is over `percent` * per (or under it)."""

    name: str
    measure: str
    percent: int
    per: str | None = None
    under: bool = False

    def rejects(self, texts: Texts) -> np.ndarray:
        value = 100 * texts.measure(self.measure)
        limit = self.percent * (texts.measure(self.per) if self.per else 1)
        return value < limit if self.under else value > limit


BASE_RULES = (
    Rule("few_words", "n_words", 5000, under=True),
    Rule("repeated_words", "n_repeat_words", 50, "n_words"),
)
MORE_RULES = (
    Rule("symbols", "n_symbols", 10, "n_words"),
    Rule("repeated_lines", "n_dup_lines", 30, "n_lines"),
    Rule("short_words", "word_chars", 200, "n_words", under=True),
    Rule("long_words", "word_chars", 1600, "n_words"),
    Rule("capitals", "n_upper", 60, "n_letters"),
    Rule("exclamations", "n_bangs", 30, "n_words"),
)
RULES = BASE_RULES + MORE_RULES


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, Texts]]:
    for first, end, data, bounds in tb.slices(batch.column(column)):
        yield first, end, Texts(data, bounds)


def estimate(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections added per second, measured on a random sample of about `rows` rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in _slices(batch, 0):
                for i, rule in enumerate(rules):
                    began = time.perf_counter()
                    rejected = rule.rejects(Texts(texts.data, texts.bounds))
                    spent = time.perf_counter() - began
                    yield pa.RecordBatch.from_pydict(
                        {"rule": [i], "seconds": [spent], "rejected": [np.packbits(rejected).tobytes()]}
                    )

    sample = df.select(F.col(f"`{text}`").cast("string")).sample(min(1.0, rows / max(1, df.count())), seed=9)
    seen = sample.mapInArrow(work, "rule long, seconds double, rejected binary").collect()
    cost = [sum(r["seconds"] for r in seen if r["rule"] == i) + 1e-9 for i in range(len(rules))]
    masks = [np.frombuffer(b"".join(r["rejected"] for r in seen if r["rule"] == i), np.uint8) for i in range(len(rules))]
    masks = [np.unpackbits(m).astype(bool) for m in masks]
    order: list[int] = []
    left = np.ones(len(masks[0]), dtype=bool) if masks else None
    while len(order) < len(rules):
        rest = [i for i in range(len(rules)) if i not in order]
        best = max(rest, key=lambda i: (np.count_nonzero(masks[i] & left) / cost[i], -cost[i]))
        left &= ~masks[best]
        order.append(best)
    return [rules[i] for i in order]


def cascade(
    df: DataFrame,
    rules: Sequence[Rule] = RULES,
    report: Sequence[str] = (),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per text: its id, the measures in `report` and `rejected_by`, null for a text to keep.

    `rules` are tried in the order given (see `estimate`), each only on texts that none before it
    rejected; reported measures are taken of every text. A null text is an empty one. Rows with equal
    ids are separate texts; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in _slices(batch, 1):
                reported = [pa.array(texts.measure(name), pa.int64()) for name in report]
                verdict = np.full(texts.n, -1)
                alive = np.arange(texts.n)
                rest = texts
                for number, rule in enumerate(rules):
                    if not len(alive):
                        break
                    rejected = rule.rejects(rest)
                    verdict[alive[rejected]] = number
                    alive = alive[~rejected]
                    rest = rest.of_texts(np.flatnonzero(~rejected))
                names = pa.array([None if v < 0 else rules[v].name for v in verdict], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), *reported, names], names=["id", *report, "by"]
                )

    kind = df.schema[doc_id].dataType.simpleString()
    shape = ", ".join([f"id {kind}", *(f"{name} long" for name in report), "by string"])
    found = df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")).mapInArrow(work, shape)
    return found.select(F.col("id").alias(doc_id), *report, F.col("by").alias("rejected_by"))
