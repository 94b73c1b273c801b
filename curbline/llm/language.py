"""Language identification, words first.

Per language, words and the character n-grams inside words are counted, and every count is kept. A known
word scores its log frequency in each language; an unseen one is read with the longest known n-gram at
each of its characters, falling back to shorter ones, each step at a price. The scores of a text's words
add up. The entries that make up at least one in VOCABULARY of their kind (at most that many) go to every
worker, which scores them in place; all others stay in a table, to which a text's other words, and the
n-grams of the words found in neither, are joined. Where the line is drawn changes no score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import textbytes as tb
from curbline.session import scratch_path

LENGTHS = (4, 3, 2, 1)
#: a share of the memory of a worker, not a cut
VOCABULARY = 1 << 21
FALL_BACK = 0.5
SMOOTHING = 0.5
UNKNOWN = "und"

_WORD = tb.byte_class((0x61, 0x7A), (0x80, 0xFF))
_FIRST = ~tb.byte_class((0x80, 0xBF))


def held_out(doc_id: str) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 4 == 2, F.lit(False))


class Words:
    """The words of one slice, each different one once, with its characters."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        data = tb.LOWER[data]
        starts, ends, self.text_of = tb.words(data, bounds, _WORD)
        self.sums = tb.prefix_sums(data)
        hashes = tb.span_hashes(self.sums, starts, ends)
        self.keys, first, self.word_of = np.unique(hashes, return_index=True, return_inverse=True)
        self.starts, self.ends = starts[first], ends[first]
        self.first_byte = np.flatnonzero(_FIRST[data])
        self.after = np.append(self.first_byte, len(data))

    def characters(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the given words: the word and the character number of each character, and each word's end."""
        begin = np.searchsorted(self.first_byte, self.starts[words])
        end = np.searchsorted(self.first_byte, self.ends[words])
        sizes = end - begin
        of = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[of]
        return of, place, end[of]

    def grams(self, place: np.ndarray, size: int) -> np.ndarray:
        return tb.span_hashes(self.sums, self.after[place], self.after[place + size])


def _count(lang_column: int, languages: list[str]):
    """Per task: how often each word and n-gram occurs in each language; `kind` 0 is words, else the length."""

    def fold(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(where, weights=np.concatenate([n for _, n in parts]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: i for i, name in enumerate(languages)}
        seen: dict[tuple[int, int], list] = {}
        for batch in batches:
            for first, end, data, bounds in tb.slices(batch.column(0)):
                own = batch.column(lang_column).slice(first, end - first).to_pylist()
                lang_of = np.array([number[x] for x in own])
                words = Words(data, bounds)
                for lang in np.unique(lang_of):
                    inside = lang_of[words.text_of] == lang
                    times = np.bincount(words.word_of[inside], minlength=len(words.keys)).astype(float)
                    used = np.flatnonzero(times)
                    if not len(used):
                        continue
                    seen.setdefault((lang, 0), []).append((words.keys[used], times[used]))
                    of, place, stop = words.characters(used)
                    for size in LENGTHS:
                        ok = place + size <= stop
                        part = (words.grams(place[ok], size), times[used][of[ok]])
                        seen.setdefault((lang, size), []).append(fold([part]))
                for key, parts in seen.items():
                    if len(parts) > 16:
                        seen[key] = [fold(parts)]
        for (lang, kind), parts in seen.items():
            keys, times = fold(parts)
            for at in range(0, len(keys), 50_000):
                some = keys[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), kind), pa.int32()),
                        pa.array(some.view(np.int64)),
                        pa.array(np.full(len(some), lang), pa.int32()),
                        pa.array(times[at : at + 50_000].astype(np.int64)),
                    ],
                    names=["kind", "key", "lang", "times"],
                )

    return work


class Model:
    """Log frequencies by kind: sorted keys and one column a language; `rest` is the path of all rarer entries' counts.

    `whole` has the counts of each kind summed by language, smoothed.
    """

    def __init__(
        self,
        languages: list[str],
        prior: np.ndarray,
        tables: dict[int, tuple[np.ndarray, np.ndarray]],
        whole: dict[int, np.ndarray],
        rest: str | None = None,
    ):
        self.languages, self.prior, self.tables, self.whole, self.rest = languages, prior, tables, whole, rest

    def find(self, kind: int, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 for those not known."""
        known = self.tables[kind][0]
        if not len(known):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, at, -1)

    def best_grams(self, words: Words, chosen: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Step, size, word, character, key and table row (-1 if not here) of the n-grams at each character, down to the first that is here."""
        of, place, stop = words.characters(chosen)
        for step, size in enumerate(LENGTHS):
            ok = place + size <= stop
            keys = words.grams(place[ok], size)
            row = self.find(size, keys)
            yield step, size, of[ok], place[ok], keys, row
            left = np.ones(len(place), dtype=bool)
            left[np.flatnonzero(ok)[row >= 0]] = False
            of, place, stop = of[left], place[left], stop[left]

    def score(self, words: Words, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """One row a text, one column a language: log scores; and the words that `rest` must be asked for."""
        count = len(self.languages)
        of_word = np.zeros((len(words.keys), count))
        row = self.find(0, words.keys)
        of_word[row >= 0] = self.tables[0][1][row[row >= 0]]
        unseen = np.flatnonzero(row < 0)
        if self.rest is None:
            for step, size, of, _, _, row in self.best_grams(words, unseen):
                gained = self.tables[size][1][row[row >= 0]] - FALL_BACK * step
                for j in range(count):
                    of_word[unseen, j] += np.bincount(of[row >= 0], weights=gained[:, j], minlength=len(unseen))
        total = np.tile(self.prior, (texts, 1))
        for j in range(count):
            total[:, j] += np.bincount(words.text_of, weights=of_word[words.word_of, j], minlength=texts)
        return total, unseen if self.rest else unseen[:0]


def learn(df: DataFrame, text: str = "text", lang: str = "lang", vocabulary: int = VOCABULARY) -> Model:
    """Counts over all rows with a text and a language. The languages are assumed to be few.

    `vocabulary` bounds what each worker holds; the rarer entries are written to the shared folder.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    by_lang = sorted((r[0], r[1]) for r in rows.groupBy("lang").count().collect())
    languages = [name for name, _ in by_lang]
    counted = rows.mapInArrow(_count(1, languages), "kind int, key long, lang int, times long")
    sums = [F.sum(F.when(F.col("lang") == j, F.col("times")).otherwise(0)).alias(f"n{j}") for j in range(len(languages))]
    path = scratch_path(spark, "language")
    counted = counted.groupBy("kind", "key").agg(*(sums or [F.sum("times").alias("times")]))
    if languages:
        whole_count = reduce(Column.__add__, [F.col(f"n{j}") for j in range(len(languages))])
        counted = counted.select("kind", "key", whole_count.alias("times"), *[f"n{j}" for j in range(len(languages))])
    counted.write.option("compression", "zstd").parquet(path)
    counted = spark.read.parquet(path)
    by_kind = counted.groupBy("kind").agg(F.count("key").alias("entries"), *[F.sum(c).alias(c) for c in counted.columns[2:]])
    totals = {r["kind"]: r for r in by_kind.collect()}
    least = F.lit(None)
    for kind, r in totals.items():
        least = F.when(F.col("kind") == kind, F.lit(r["times"] / vocabulary)).otherwise(least)
    kept = counted.where(F.col("times") >= least).toArrow() if totals else None
    tables, whole = {}, {}
    for kind in (0, *LENGTHS):
        keys, table = np.zeros(0, np.uint64), np.zeros((0, len(languages)))
        if kind in totals:
            r = totals[kind]
            whole[kind] = np.array([r[f"n{j}"] for j in range(len(languages))], dtype=float) + SMOOTHING * r["entries"]
            own = kept.filter(pa.compute.equal(kept["kind"], kind))
            keys = own["key"].to_numpy().view(np.uint64)
            times = np.stack([own[f"n{j}"].to_numpy() for j in range(len(languages))], axis=1) if len(own) else table
            table = np.log((times + SMOOTHING) / whole[kind])
            order = np.argsort(keys)
            keys, table = keys[order], table[order]
        tables[kind] = (keys, table)
    seen = np.array([n for _, n in by_lang], dtype=float)
    held = sum(len(keys) for keys, _ in tables.values())
    rest = path if held < sum(r["entries"] for r in totals.values()) else None
    return Model(languages, np.log(seen / seen.sum()) if len(seen) else seen, tables, whole, rest)


def _cut(shared: Broadcast):
    """Per task: what the n-grams of each word (key, word) give, or ask for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each word, with a null place: the sum over the characters whose n-gram is here at once.

        And one for each n-gram tried at any other character, with its values where it is here.
        """
        model = shared.value
        langs = range(len(model.languages))
        names = ["word_key", "place", "step", "kind", "key", "v"]
        for batch in batches:
            for first, end, data, bounds in tb.slices(batch.column(1).cast(pa.string())):
                own = Words(data, bounds)
                n = len(own.keys)
                name = batch.column(0).slice(first, end - first).to_numpy()
                name = name[own.text_of[np.unique(own.word_of, return_index=True)[1]]]
                settled = np.zeros((n, len(langs)))
                asked = np.zeros(len(own.after), dtype=bool)
                for step, size, of, place, keys, row in model.best_grams(own, np.arange(n)):
                    here = (row >= 0) & ~asked[place]
                    gained = model.tables[size][1][row[here]] - FALL_BACK * step
                    for j in langs:
                        settled[:, j] += np.bincount(of[here], weights=gained[:, j], minlength=n)
                    asked[place[row < 0]] = True
                    of, place, keys, row = (x[~here] for x in (of, place, keys, row))
                    values = [None if i < 0 else model.tables[size][1][i].tolist() for i in row.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(name[of]),
                            pa.array(place - own.first_byte.searchsorted(own.starts)[of]),
                            pa.array(np.full(len(of), step), pa.int32()),
                            pa.array(np.full(len(of), size), pa.int32()),
                            pa.array(keys.view(np.int64)),
                            pa.array(values, pa.list_(pa.float64())),
                        ],
                        names=names,
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(name),
                        pa.nulls(n, pa.int64()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.int64()),
                        pa.array(list(settled), pa.list_(pa.float64())),
                    ],
                    names=names,
                )

    return work


def _rest_scores(spark: SparkSession, model: Model, words: DataFrame) -> DataFrame:
    """Log scores `v` by word key for the given words (key, word), in one or two rows that add up; none for a word without any."""
    langs = range(len(model.languages))
    counts = spark.read.parquet(model.rest)
    parts = []
    for kind, whole in model.whole.items():
        logs = F.array(*[F.log((F.col(f"n{j}") + F.lit(SMOOTHING)) / F.lit(float(whole[j]))) for j in langs])
        parts.append(counts.where(F.col("kind") == kind).select("kind", "key", logs.alias("v")))
    known = parts[list(model.whole).index(0)].select("key", "v")
    grams = reduce(DataFrame.unionAll, [part for kind, part in zip(model.whole, parts) if kind])
    # each task sends a word once
    unseen = words.dropDuplicates(["key"]).join(known, "key", "left_anti")
    read = unseen.select("key", F.col("word").cast("string")).mapInArrow(
        _cut(spark.sparkContext.broadcast(model)), "word_key long, place long, step int, kind int, key long, v array<double>"
    )
    # the words are cut once: what is read from here is used three times
    path = scratch_path(spark, "grams")
    read.write.option("compression", "zstd").parquet(path)
    read = spark.read.parquet(path)
    settled = read.where("place is null").select(F.col("word_key").alias("key"), "v")
    tried = read.where("place is not null")
    asked = tried.where("v is null").drop("v").join(grams, ["kind", "key"])
    hits = tried.where("v is not null").unionByName(asked).groupBy("word_key", "place")
    hits = hits.agg(F.min("step").alias("step"), F.min_by("v", "step").alias("v"))
    gained = [F.sum(F.col("v")[j] - F.lit(FALL_BACK) * F.col("step")).alias(f"v{j}") for j in langs]
    read_scores = hits.groupBy("word_key").agg(*gained).select(F.col("word_key").alias("key"), F.array(*[f"v{j}" for j in langs]).alias("v"))
    # a word's values add up, so what its settled and its other characters give may stay two rows
    read_scores = settled.unionByName(read_scores)
    return known.unionByName(read_scores)


def identify(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: its id, `lang_pred` and `score`, the share of the best language (0 to 1).

    A text that is null or has no letter is `und`, score 0, as is every text when no language was
    learned. A text whose characters are all unknown gets the language most texts had. Rows with equal
    ids are separate texts; no column but the text is read.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    langs = range(len(model.languages))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, with a null key, and one for each of its words that the rest must be asked for."""
        model = shared.value
        for batch in batches:
            for first, end, data, bounds in tb.slices(batch.column(2)):
                n = end - first
                row = batch.column(0).slice(first, n).to_numpy()
                total, asked, lettered = np.zeros((n, 0)), np.zeros(0, np.int64), np.zeros(n, dtype=bool)
                if model.languages:
                    words = Words(data, bounds)
                    total, asked = model.score(words, n)
                    before = np.concatenate([[0], np.cumsum(tb.LOWER[data] - 97 < 26, dtype=np.int64)])
                    lettered = before[bounds[1:]] > before[bounds[:-1]]
                    for i in np.flatnonzero(~lettered):
                        lettered[i] = any(map(str.isalpha, data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8")))
                of = pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), batch.column(1).slice(first, n), pa.array(lettered), pa.array(list(total), pa.list_(pa.float64())), *of],
                    names=names,
                )
                if not len(asked):
                    continue
                number = np.full(len(words.keys), -1)
                number[asked] = np.arange(len(asked))
                here = np.flatnonzero(number[words.word_of] >= 0)
                pairs, times = np.unique(words.text_of[here] * len(asked) + number[words.word_of[here]], return_counts=True)
                text_of, word = np.divmod(pairs, len(asked))
                flat = tb.LOWER[data]
                spelled = [flat[a:b].tobytes().decode("utf-8") for a, b in zip(words.starts[asked], words.ends[asked])]
                m = len(pairs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row[text_of]),
                        pa.nulls(m, batch.column(1).type),
                        pa.nulls(m, pa.bool_()),
                        pa.nulls(m, pa.list_(pa.float64())),
                        pa.array(words.keys[asked][word].view(np.int64)),
                        pa.array(spelled, pa.string()).take(pa.array(word)),
                        pa.array(times, pa.int64()),
                    ],
                    names=names,
                )

    names = ["row", "id", "lettered", "s", "key", "word", "times"]
    kind = df.schema[doc_id].dataType.simpleString()
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string"))
    found = rows.mapInArrow(work, f"row long, id {kind}, lettered boolean, s array<double>, key long, word string, times long")
    if model.rest:
        path = scratch_path(spark, "texts")
        found.write.option("compression", "zstd").parquet(path)
        found = spark.read.parquet(path)
        asked = found.where("key is not null")
        scores = _rest_scores(spark, model, asked.select("key", "word"))
        gained = asked.select("key", "row", "times").join(scores, "key")
        gained = gained.groupBy("row").agg(*[F.sum(F.col("v")[j] * F.col("times")).alias(f"g{j}") for j in langs])
        total = F.array(*[F.col("s")[j] + F.coalesce(f"g{j}", F.lit(0.0)) for j in langs])
        found = found.where("key is null").join(gained, "row", "left").select("id", "lettered", total.alias("s"))
    best = F.array_position("s", F.array_max("s")).cast("int")
    pred = F.get(F.array(*[F.lit(name) for name in model.languages]).cast("array<string>"), best - 1)
    share = 1 / F.aggregate("s", F.lit(0.0), lambda sum_, x: sum_ + F.exp(x - F.array_max("s")))
    return found.select(
        F.col("id").alias(doc_id),
        F.when(F.col("lettered"), pred).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("lettered"), share).otherwise(F.lit(0.0)).alias("score"),
    )
