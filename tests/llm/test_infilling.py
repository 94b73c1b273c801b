"""Fill-in-middle: cuts against plain Python, exact round trips, edge cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from curbline.llm import infilling, queries

SF_DIR = "/root/testdata/sf0.001"


def expected(doc_id, text, rate=100, spm_share=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    if h4 % 100 < spm_share:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(df, **options):
    rows = infilling.infill(df, **options).withColumn("restored", infilling.restore()).collect()
    for r in rows:
        found = tuple(r[name] for name in infilling.ADDED)
        assert found == expected(r["doc_id"], r["text"], **options)
        assert r["restored"] == (r["text"] or "")
    return rows


TEXTS = [
    "", "\n", "\n\n\n", "a", "a\n", "a\nb", "\r\na\r\n", "ü\n😀\n漢字", "$1 \\ $2\n(\\E [^\n{3}\n", "ends <\nS> <P\n> <\n<", "has <S> in it\nb",
    "<M>", "x<P>", "  \n\t\n", "a b\x0bc\x85d e\nf",
]


def test_all_small_texts(spark):
    rows = [(100 * i + j, text) for i, text in enumerate(TEXTS) for j in range(30)]
    found = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_rates(documents):
    df = documents(*["a\nb\nc\n"] * 300)
    forms = [r["form"] for r in check(df, rate=40, spm_share=10)]
    assert 150 <= forms.count("plain") <= 210 and 1 <= forms.count("spm") <= 30


def test_given_texts_come_back(spark):
    rows = queries.op12_infilling(spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r["restored_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(odd, empty):
    check(odd)
    clash = odd.withColumns({"output": F.lit("x"), "form": F.lit(1), "__fim_text": F.lit("y"), "a.b": F.lit(2)})
    rows = infilling.infill(clash).collect()
    assert len(rows) == odd.count() and {r["a.b"] for r in rows} == {2} and {r["__fim_text"] for r in rows} == {"y"}
    assert infilling.infill(empty).collect() == []


def test_very_long_texts(spark):
    """Many units neither recurse nor go back; one unit of any length is one."""
    texts = ["line\n" * 400_000, "\n" * 300_000, "x" * 3_000_000, ("y" * 1_000_000 + "\n") * 3]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_registered_query_on_odd_and_empty_tables(spark, odd, empty, folder_of):
    assert queries.op12_infilling(spark, folder_of(documents=odd)).count() == odd.count()
    assert queries.op12_infilling(spark, folder_of(documents=empty)).collect() == []


def test_markers():
    for wrong in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "ca", "d"), ("a", "ab", "c")):
        with pytest.raises(ValueError):
            infilling.Markers(*wrong)


def test_other_units_and_markers(documents):
    markers = infilling.Markers("$p.", "(s", "\\m")
    df = documents("one two  three", "a $p. b", "word", "x (z s")
    rows = infilling.infill(df, unit=r"\s*\S+\s*", markers=markers).withColumn(
        "restored", infilling.restore(markers=markers)
    )
    assert [r["restored"] for r in rows.orderBy("doc_id").collect()] == ["one two  three", "a $p. b", "word", "x (z s"]
    assert [r["n_units"] for r in rows.orderBy("doc_id").collect()] == [3, 3, 1, 3]


def test_no_python_and_no_shuffle(spark):
    plan = queries.op12_infilling(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
