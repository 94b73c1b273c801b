"""Benchmark decontamination by winnowing.

Words are hashed, the hashes of every GRAM consecutive words make a sequence, and of every WINDOW
neighbours in it the least (the rightmost of equals) is kept as a fingerprint. Two texts that share
SPAN = GRAM + WINDOW - 1 consecutive words share a whole window and so a fingerprint: no shared span
of SPAN words is missed. Fingerprints of documents and benchmark items are joined, every hit is
extended to the SPAN-word windows around it, and those are compared as words with the items' windows,
so a result never rests on a hash. An item of fewer words is one window of its own length, found by
the n-grams of just that length (winnowing with a window of one).

Before the join, a bit table of fixed size drops fingerprints that no item has. A benchmark of any
size only fills it; the join decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm import textbytes as tb
from curbline.session import freeze

SPAN = 13
GRAM = 8
FILTER_BITS = 24
BROADCAST_ROWS = 200_000


def least_of_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` hashes, the place of the least, the rightmost of equals."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best = hashes[width - 1 :].copy()
    back_by = np.zeros(n, dtype=np.int64)
    for back in range(1, width):
        earlier = hashes[width - 1 - back : len(hashes) - back]
        less = earlier < best
        best[less] = earlier[less]
        back_by[less] = back
    return np.arange(width - 1, len(hashes)) - back_by


def fingerprints(hashes: np.ndarray, text_of: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the kept hashes; windows lie within one text."""
    grams = tb.gram_hashes(hashes, gram)
    places = least_of_windows(grams, span - gram + 1)
    places = np.unique(places[tb.same_text(text_of, span)]) if len(places) else places
    return places, grams[places]


def item_windows(span: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per window of an item: item, its words, its text and its fingerprint (null if it has none)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in tb.slices(batch.column(1)):
                data = tb.LOWER[data]
                starts, ends, of = tb.words(data, bounds, tb.ALNUM)
                hashes = tb.span_hashes(tb.prefix_sums(data), starts, ends)
                held = tb.counts(of, end - first)
                raw = data.tobytes()
                rows: list[tuple] = []
                places, values = fingerprints(hashes, of, span, gram)
                kept = dict(zip(places.tolist(), values.view(np.int64).tolist()))
                at = 0
                for i, n in enumerate(held.tolist()):
                    item = batch.column(0)[first + i].as_py()
                    size = min(n, span)
                    words = [raw[s:e].decode("utf-8") for s, e in zip(starts[at : at + n], ends[at : at + n])]
                    if 0 < n < span:
                        value = int(tb.gram_hashes(hashes[at : at + n], n).view(np.int64)[0])
                        rows.append((item, n, " ".join(words), value))
                    for j in range(n - span + 1 if n >= span else 0):
                        rows.append((item, size, " ".join(words[j : j + span]), None))
                    for j in range(n if n >= span else 0):
                        if at + j in kept:
                            rows.append((item, size, None, kept[at + j]))
                    at += n
                columns = list(zip(*rows)) if rows else [[], [], [], []]
                types = (pa.string(), pa.int32(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=["item", "words", "window", "print"]
                )

    return work


def document_hits(
    table: np.ndarray, lengths: list[int], span: int, gram: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document: its id, its words and the windows around fingerprints that pass the bit table."""
    bits = np.uint64(len(table) * 8 - 1)

    def passing(values: np.ndarray) -> np.ndarray:
        slot = (values & bits).astype(np.int64)
        return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1

    hit = pa.struct([("start", pa.int32()), ("words", pa.int32()), ("print", pa.int64()), ("window", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in tb.slices(batch.column(1)):
                data = tb.LOWER[data]
                starts, ends, of = tb.words(data, bounds, tb.ALNUM)
                hashes = tb.span_hashes(tb.prefix_sums(data), starts, ends)
                held = tb.counts(of, end - first)
                begin = np.cumsum(held) - held
                found: list[tuple[np.ndarray, np.ndarray, int]] = []
                places, values = fingerprints(hashes, of, span, gram)
                ok = passing(values)
                places, values = places[ok], values[ok]
                if len(places):
                    back = np.arange(span - gram + 1)
                    s = (places[:, None] - back).ravel()
                    p = np.repeat(values, len(back))
                    ok = (s >= 0) & (s + span <= len(of))
                    s, p = s[ok], p[ok]
                    ok = of[s] == of[s + span - 1]
                    found.append((s[ok], p[ok], span))
                for n in lengths:
                    grams = tb.gram_hashes(hashes, n)
                    s = np.flatnonzero(passing(grams) & tb.same_text(of, n)) if len(grams) else np.zeros(0, np.int64)
                    found.append((s, grams[s], n))
                raw = data.tobytes()
                hits: list[list] = [[] for _ in range(end - first)]
                for s, p, n in found:
                    for start, value in zip(s.tolist(), p.view(np.int64).tolist()):
                        i = int(of[start])
                        words = b" ".join(raw[a:b] for a, b in zip(starts[start : start + n], ends[start : start + n]))
                        hits[i].append((start - int(begin[i]), n, value, words.decode("utf-8")))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(held, pa.int64()),
                        pa.array([[dict(zip(("start", "words", "print", "window"), h)) for h in x] for x in hits], pa.list_(hit)),
                    ],
                    names=["id", "n_words", "hits"],
                )

    return work


def bit_table(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """2**bits flags (bits >= 6), one set for each value's low bits; merged on the executors, by machine word."""
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = values.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    words = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("flags")).toArrow()
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    table[words["word"].to_numpy()] = words["flags"].to_numpy()
    return table.view(np.uint8)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Hints a broadcast when the counted rows are within the bound, else leaves the join to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    filter_bits: int = FILTER_BITS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document: its id, n_words, n_hit and `items`, the sorted ids (as text) of the items hit.

    Words are runs of ASCII letters and digits and of non-ASCII characters, ASCII lower-cased. n_hit
    counts the words inside any occurrence of an item's window. Null and empty texts have no words; an
    item without words, or without an id, is never hit. Rows with equal ids are separate documents;
    other columns are not read. An empty frame on either side gives no hits.
    """
    items = benchmark.where(F.col(f"`{item_id}`").isNotNull())
    items = items.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    shape = "item string, words int, window string, print long"
    rows = freeze(items.mapInArrow(item_windows(span, gram), shape))
    prints = freeze(rows.where("print is not null").select("print", "words").distinct())
    windows = freeze(
        rows.where("window is not null").groupBy("words", "window").agg(F.collect_set("item").alias("items"))
    )
    lengths = sorted(r[0] for r in prints.select("words").distinct().collect() if r[0] < span)

    table = bit_table(prints, "print", filter_bits)
    shape = "id {}, n_words long, hits array<struct<start:int,words:int,print:long,window:string>>"
    id_type = documents.schema[doc_id].dataType.simpleString()
    docs = documents.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string"))
    docs = freeze(docs.mapInArrow(document_hits(table, lengths, span, gram), shape.format(id_type)))
    docs = docs.withColumn("row", F.monotonically_increasing_id())

    hits = docs.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    hits = hits.join(small(prints, broadcast_rows), ["print", "words"], "left_semi")
    hits = hits.join(small(windows, broadcast_rows), ["words", "window"])
    spans = F.array_sort(F.collect_set(F.struct(F.col("start"), (F.col("start") + F.col("words")).alias("end"))))
    per_row = hits.groupBy("row").agg(spans.alias("spans"), F.collect_set("items").alias("item_sets"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], x["end"]).alias("upto"),
        ),
        lambda acc: acc["n"],
    )
    per_row = per_row.select(
        "row", covered.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("item_sets"))).alias("items")
    )
    return docs.join(per_row, "row", "left").select(
        F.col("id").alias(doc_id),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def is_contaminated() -> Column:
    """A twentieth of the words or more inside benchmark windows."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))
