"""Personal data: patterns, and a skip-chain conditional random field that makes each document consistent.

Patterns give the base spans. Every token with a digit or an @ is a variable whose label is a kind or
"outside"; all other tokens are observed as outside. Neighbouring variables share a transition
potential, and so do a variable and the previous one in the document that repeats it or resembles it
(same closing digits, or same letters), however far away, and the first such one: the skip edges. A number written as short groups
of digits with blanks between is one variable. The potentials are log odds
counted over all documents, with the base spans as labels. Loopy sum-product message passing gives the
beliefs; the base labels stay observed, and a run of other tokens believed to be of one kind, and tied
by a skip edge to a token of that kind, becomes a further span.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm import textbytes as tb

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
LABELS = OUTSIDE + 1
#: messages are passed until none changes by SETTLED; a field that never settles is stopped after ROUNDS
ROUNDS = 1000
SETTLED = 1e-4
LEAST_BELIEF = 0.9
LEAST_DIGITS = 6
LEAST_LETTERS = 6
SHAPES = 1 << 12
#: the digits of the longest card number
MOST_DIGITS = 19
#: how often each label has met itself on a skip edge before anything is counted
SAME_BEFORE = 20

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# starts only where a run of digits starts, and gives no digits back, so long runs take linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*")
_GROUP = re.compile(r"\(?[0-9]{1,%d}\)?" % (LEAST_DIGITS - 1))
_EDGE = ".,;:!?'\"()[]{}<>"
_MARKED = tb.byte_class((0x30, 0x39), (0x40, 0x40))


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start, in code points."""
    found, upto = [], 0
    for match in _DOMAIN.finditer(text):
        # the name before an @ is the run of its characters after the previous address
        start = match.start()
        while start > upto and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            found.append((0, start, match.end()))
            upto = match.end()
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") for part in match.group().split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append((1, *match.span()))
    for kind, pattern, least, most in ((2, _CARD, 16, 19), (3, _PHONE, 8, 15)):
        for match in pattern.finditer(text):
            digits = "".join(c for c in match.group() if c in "0123456789")
            if least <= len(digits) <= most and (kind == 3 or _luhn(digits)):
                found.append((kind, *match.span()))
    return found


def _shape(token: str) -> int:
    kinds = re.sub(r"[0-9]+", lambda m: f"9{len(m.group())}", token)
    return zlib.crc32(re.sub(r"[^\W\d_]+", "a", kinds).encode()) % SHAPES


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _tokens(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of the tokens with a digit or an @; groups of digits that make up one number are one token.

    Short groups outside the base spans, with blanks between, do if they have at most MOST_DIGITS digits,
    but for those that end like another number of the text, which are cut out.
    """
    spans = [match.span() for match in _TOKEN.finditer(text)]
    starts = [start for start, _ in spans]
    owned = {
        i
        for _, start, end in base
        for i in range(max(0, bisect_right(starts, start) - 1), bisect_left(starts, end))
        if spans[i][1] > start
    }
    runs: list[list[int]] = []
    for i, (start, end) in enumerate(spans):
        if runs:
            last = runs[-1][-1]
            before = text[spans[last][0] : spans[last][1]]
            joined = not text[spans[last][1] : start].strip(" ") and not owned & {last, i}
            joined = joined and _GROUP.fullmatch(before.lstrip(_EDGE)) and _GROUP.fullmatch(text[start:end].rstrip(_EDGE))
            if joined:
                runs[-1].append(i)
                continue
        runs.append([i])
    # how many numbers of the text end with the same digits
    whole = [_digits(text[spans[run[0]][0] : spans[run[-1]][1]]) for run in runs]
    given = [d for run, d in zip(runs, whole) if run[0] not in owned and LEAST_DIGITS <= len(d) <= MOST_DIGITS]
    given += [_digits(text[start:end]) for kind, start, end in base if KINDS[kind] in ("card", "phone")]
    ending, numbers = Counter(d[-7:] for d in given), set(given)
    suffixes = Counter(d[at:] for d in numbers for at in range(len(d) - LEAST_DIGITS + 1))
    found: list[tuple[int, int]] = []
    for run, digits in zip(runs, whole):
        if len(run) == 1 or run[0] in owned or len(digits) <= MOST_DIGITS and ending[digits[-7:]] > 1:
            found.append((spans[run[0]][0], spans[run[-1]][1]))
            continue
        parts = [_digits(text[spans[i][0] : spans[i][1]]) for i in run]
        pieces: list[list[int]] = []
        open_from = 0
        for stop in range(1, len(run) + 1):
            best, joined, first = None, "", stop
            while first > open_from and len(joined) + len(parts[first - 1]) <= MOST_DIGITS:
                first -= 1
                joined = parts[first] + joined
                if suffixes[joined] > (digits in numbers and digits.endswith(joined)):
                    best = first
            if best is not None:
                pieces += [list(range(open_from, best)), list(range(best, stop))]
                open_from = stop
        pieces.append(list(range(open_from, len(run))))
        for piece in filter(None, pieces):
            few = sum(len(parts[i]) for i in piece) <= MOST_DIGITS
            for part in [piece] if few else [[i] for i in piece]:
                found.append((spans[run[part[0]]][0], spans[run[part[-1]]][1]))
    return found


class Graph:
    """The variables of one text: spans, base labels, shapes and edges."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        self.spans: list[tuple[int, int]] = []
        self.shapes: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        earliest: dict[str, int] = {}
        latest: dict[str, int] = {}
        after = -1
        # the last token of a number's base span resembles others by all digits of the span
        closing = sorted((end, start) for kind, start, end in base if KINDS[kind] in ("card", "phone"))
        for begin, stop in _tokens(text, base):
            raw = text[begin:stop]
            core = raw.strip(_EDGE)
            if not core:
                continue
            start = begin + len(raw) - len(raw.lstrip(_EDGE))
            i = len(self.spans)
            self.spans.append((start, start + len(core)))
            self.shapes.append(_shape(raw))
            if i and text[after:begin].isspace():
                self.chain.append((i - 1, i))
            after = stop
            digits = _digits(core)
            ended = bisect_right(closing, (begin, len(text)))
            if ended < len(closing) and closing[ended][0] <= stop:
                digits = _digits(text[closing[ended][1] : closing[ended][0]])
            letters = "".join(c for c in core.lower() if c.isalpha() or c == "@")
            likes = [f"t{core.lower()}"] if len(core) >= LEAST_DIGITS else []
            if len(digits) >= LEAST_DIGITS:
                likes.append(f"d{digits[-7:]}")
            if len(letters) >= LEAST_LETTERS:
                likes.append(f"l{letters}")
            for j in sorted({seen[like] for like in likes for seen in (earliest, latest) if like in seen}):
                self.skip.append((j, i))
            for like in likes:
                earliest.setdefault(like, i)
            latest.update(dict.fromkeys(likes, i))
        self.labels = np.full(len(self.spans), OUTSIDE)
        starts = np.array([s for s, _ in self.spans], dtype=np.int64)
        ends = np.array([e for _, e in self.spans], dtype=np.int64)
        for kind, start, end in reversed(base):
            # tokens that overlap the span
            self.labels[np.searchsorted(ends, start, "right") : np.searchsorted(starts, end, "left")] = kind


def _marked(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, int, dict[int, str]]]:
    """Slices of rows, with the texts that have a digit or an @."""
    for batch in batches:
        for first, end, data, bounds in tb.slices(batch.column(column)):
            before = np.concatenate([[0], np.cumsum(_MARKED[data], dtype=np.int64)])
            rows = np.flatnonzero(before[bounds[1:]] > before[bounds[:-1]])
            yield batch, first, end, {i: data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8") for i in rows.tolist()}


class Field:
    """Potentials: by shape and label, by neighbouring labels and by labels tied by a skip edge."""

    def __init__(self, shape: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        prior = shape.sum(axis=0) + 1
        # a label's chance given the shape, drawn to the general one where a shape is rare
        self.unary = np.log((shape + prior / prior.sum()) / (shape.sum(axis=1, keepdims=True) + 1))
        self.chain, self.skip = self._odds(chain, 1), self._odds(skip, SAME_BEFORE)

    @staticmethod
    def _odds(pairs: np.ndarray, same: float) -> np.ndarray:
        """Log of how much likelier two labels meet than by chance; equal ones have met `same` times before counting."""
        pairs = pairs + same * np.eye(LABELS) + 0.01
        share = pairs / pairs.sum()
        odds = np.log(share / np.outer(share.sum(axis=1), share.sum(axis=0)))
        return (odds + odds.T) / 2

    def beliefs(self, graph: Graph, rounds: int = ROUNDS) -> np.ndarray:
        """Marginals by loopy sum-product; tokens in base spans are observed."""
        unary = self.unary[graph.shapes].copy()
        seen = graph.labels != OUTSIDE
        unary[seen] = -30.0
        unary[seen, graph.labels[seen]] = 0.0
        edges = np.array([*graph.chain, *graph.skip], dtype=np.int64).reshape(-1, 2)
        if len(edges):
            pair = np.exp(np.concatenate([np.tile(self.chain, (len(graph.chain), 1, 1)), np.tile(self.skip, (len(graph.skip), 1, 1))]))
            source = np.concatenate([edges[:, 0], edges[:, 1]])
            target = np.concatenate([edges[:, 1], edges[:, 0]])
            pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(edges), 2 * len(edges)), np.arange(len(edges))])
            sent = np.zeros((len(source), LABELS))
            for _ in range(rounds):
                total = unary.copy()
                np.add.at(total, target, sent)
                out = total[source] - sent[back]
                out = np.exp(out - out.max(axis=1, keepdims=True))
                new = np.log(np.einsum("el,elm->em", out, pair) + 1e-300)
                new -= new.max(axis=1, keepdims=True)
                change = np.abs(new - sent).max()
                sent = 0.5 * sent + 0.5 * new
                if change < SETTLED:
                    break
            np.add.at(unary, target, sent)
        belief = np.exp(unary - unary.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)

    def more_spans(self, text: str, base: list[tuple[int, int, int]], least: float = LEAST_BELIEF) -> list[tuple[int, int, int]]:
        graph = Graph(text, base)
        if not graph.skip:
            return []
        belief = self.beliefs(graph)
        best = belief.argmax(axis=1)
        sure = (belief.max(axis=1) >= least) & (best != OUTSIDE) & (graph.labels == OUTSIDE)
        tied = np.zeros(len(best), dtype=bool)
        for i, j in graph.skip:
            tied[i] |= best[i] == best[j]
            tied[j] |= best[i] == best[j]
        beside = set(graph.chain)
        runs: list[list[int]] = []
        for i in np.flatnonzero(sure).tolist():
            if runs and runs[-1][-1] == i - 1 and best[i] == best[i - 1] and (i - 1, i) in beside:
                runs[-1].append(i)
            else:
                runs.append([i])
        return [(int(best[r[0]]), graph.spans[r[0]][0], graph.spans[r[-1]][1]) for r in runs if tied[r].any()]


def learn(df: DataFrame, text: str = "text") -> Field:
    """Counts potentials over all texts; what reaches the driver is bounded by shapes and labels."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, texts in _marked(batches, 0):
            cells: list[np.ndarray] = []
            for own in texts.values():
                graph = Graph(own, base_spans(own))
                labels = graph.labels
                cells.append(np.array(graph.shapes, dtype=np.int64) * LABELS + labels)
                for number, edges in enumerate((graph.chain, graph.skip)):
                    pairs = np.array(edges, dtype=np.int64).reshape(-1, 2)
                    cells.append((SHAPES + number * LABELS + labels[pairs[:, 0]]) * LABELS + labels[pairs[:, 1]])
            cell, n = np.unique(np.concatenate(cells), return_counts=True) if cells else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])

    counted = df.select(F.col(f"`{text}`").cast("string")).mapInArrow(work, "cell long, n long")
    table = np.zeros((SHAPES + 2 * LABELS) * LABELS)
    for cell, n in counted.groupBy("cell").agg(F.sum("n")).collect():
        table[cell] = n
    table = table.reshape(-1, LABELS)
    return Field(table[:SHAPES], table[SHAPES : SHAPES + LABELS], table[SHAPES + LABELS :])


def find(df: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: its id, `base` and `spans`, arrays of (kind, start, end), kind as its number.

    `spans` are the base spans and those that the field adds, by kind, then start. Null and empty texts
    have none. Rows with equal ids are separate texts; other columns are not read.
    """
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def rows(lists: list[list[tuple[int, int, int]]]) -> pa.Array:
        return pa.array([[dict(zip(("kind", "start", "end"), x)) for x in spans] for spans in lists], pa.list_(span))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, end, texts in _marked(batches, 1):
            base: list[list] = [[] for _ in range(end - first)]
            spans: list[list] = [[] for _ in range(end - first)]
            for i, own in texts.items():
                base[i] = base_spans(own)
                spans[i] = sorted({*base[i], *field.more_spans(own, base[i])})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, end - first), rows(base), rows(spans)], names=["id", "base", "spans"]
            )

    kind = df.schema[doc_id].dataType.simpleString()
    of = "array<struct<kind:int,start:int,end:int>>"
    found = df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string"))
    found = found.mapInArrow(work, f"id {kind}, base {of}, spans {of}")
    return found.select(F.col("id").alias(doc_id), "base", "spans")
