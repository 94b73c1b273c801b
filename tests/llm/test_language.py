"""Held-out accuracy of the language model, its laws and its backoff."""

import math
import zlib
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import functions as F

from curbline.llm import language as la
from curbline.llm import queries

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.op6_language(spark, SF_DIR).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_score(train, text, lengths=la.LENGTHS):
    """The model in dictionaries, every entry kept."""
    langs = sorted({lang for _, lang in train})
    words = lambda t: "".join(c if c.isalpha() else " " for c in t.lower()).split()
    tables = {kind: {} for kind in (0, *lengths)}
    for t, lang in train:
        for w in words(t):
            tables[0].setdefault(w, dict.fromkeys(langs, 0))[lang] += 1
            for size in lengths:
                for i in range(len(w) - size + 1):
                    tables[size].setdefault(w[i : i + size], dict.fromkeys(langs, 0))[lang] += 1

    def log(kind, key, lang):
        whole = sum(x[lang] for x in tables[kind].values())
        return math.log((tables[kind][key][lang] + la.SMOOTHING) / (whole + la.SMOOTHING * len(tables[kind])))

    total = {}
    for lang in langs:
        total[lang] = math.log(sum(x == lang for _, x in train) / len(train))
        for w in words(text):
            if w in tables[0]:
                total[lang] += log(0, w, lang)
                continue
            for i in range(len(w)):
                for step, size in enumerate(lengths):
                    if i + size <= len(w) and w[i : i + size] in tables[size]:
                        total[lang] += log(size, w[i : i + size], lang) - la.FALL_BACK * step
                        break
    return total


def test_same_as_dictionaries(spark):
    train = [("the cat sat on the mat", "en"), ("die katze saß dort auf der matte", "de"), ("le chat était là", "fr")]
    texts = ["the matte", "katzen", "ça était", "zzz", "Das SATTE Haus", "the the xq", "été"]
    model = la.learn(spark.createDataFrame(train, "text string, lang string"), vocabulary=1 << 40)
    rows = la.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in rows:
        total = plain_score(train, texts[r["doc_id"]])
        assert total[r["lang_pred"]] == max(total.values())
        top = max(total.values())
        assert abs(r["score"] - 1 / sum(math.exp(x - top) for x in total.values())) < 1e-9


def test_rare_entries_count_as_much(spark):
    train = [("the cat sat on the mat", "en")] * 300 + [("die katze saß dort auf der matte", "de"), ("le chat était là", "fr")]
    texts = ["the matte", "katzen matte auf", "ça était", "zzz", "Das SATTE Haus", "le chat et le cat", "été", None, "7", "the"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for vocabulary in (1, 8, 64):
        model = la.learn(spark.createDataFrame(train, "text string, lang string"), vocabulary=vocabulary)
        rows = la.identify(df, model).collect()
        assert len(rows) == len(texts)
        for r in rows:
            if r["doc_id"] in (7, 8):
                assert (r["lang_pred"], r["score"]) == ("und", 0.0)
                continue
            total = plain_score(train, texts[r["doc_id"]])
            top = max(total.values())
            assert total[r["lang_pred"]] > top - 1e-9
            assert abs(r["score"] - 1 / sum(math.exp(x - top) for x in total.values())) < 1e-9


def test_known_characters_are_summed_before_they_are_sent(spark):
    """A word whose n-grams all are on the worker is one row; only characters that may be better known elsewhere are more."""
    train = [("the cat sat on the mat", "en")] * 300 + [("die katze auf der matte", "de")]
    full = la.learn(spark.createDataFrame(train, "text string, lang string"), vocabulary=1 << 40)
    part = la.learn(spark.createDataFrame(train, "text string, lang string"), vocabulary=64)
    batch = pa.RecordBatch.from_pydict({"key": [7, 8], "word": ["katz", "atze"]})
    rows = pa.Table.from_batches(la._cut(SimpleNamespace(value=full))(iter([batch]))).to_pylist()
    assert [(r["word_key"], r["place"]) for r in rows] in ([(7, None), (8, None)], [(8, None), (7, None)])
    batch = pa.RecordBatch.from_pydict({"key": [7, 8], "word": ["thecat", "matkatz"]})
    rows = pa.Table.from_batches(la._cut(SimpleNamespace(value=part))(iter([batch]))).to_pylist()
    whole = [r for r in rows if r["place"] is None]
    tried = [r for r in rows if r["place"] is not None]
    assert len(whole) == 2
    # no character is both in the sum and among those asked for, and each of these has something to ask
    assert {(r["word_key"], r["place"]) for r in tried} == {(r["word_key"], r["place"]) for r in tried if r["v"] is None}
    assert len({(r["word_key"], r["place"]) for r in tried}) < len("thecatmatkatz")


def test_odd_rows(odd, empty):
    model = la.learn(odd)
    rows = {r["doc_id"]: r for r in la.identify(odd.withColumn("score", F.lit(1)), model).collect()}
    for i in (3, 4, 5, 7):
        assert (rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0)
    assert rows[6]["lang_pred"] == "en"
    assert la.identify(empty, model).collect() == []
    assert {r["lang_pred"] for r in la.identify(odd, la.learn(empty)).collect()} == {"und"}


def test_number_signs_are_no_letters(spark, odd):
    texts = ["½ ² ①", "Ⅷ ⅷ 12", "٣ ४ _", "ª", "ж", "12 é", "中", "ǅ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["lang_pred"] for r in la.identify(docs, la.learn(odd)).collect()}
    assert [rows[i] == "und" for i in range(len(texts))] == [True] * 3 + [False] * 5
