"""Base spans against the plain patterns, and what the skip-chain field adds."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from curbline.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [
        (number, m.start(), m.end())
        for number, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]


def test_base_spans_of_random_texts():
    rng = random.Random(7)
    for _ in range(4000):
        text = "".join(rng.choice(["1", "25", "0", "a", "é", ".", "@", "+", " ", "-", "(", "%", "4111111111111111", "a@b.c"]) for _ in range(rng.randrange(30)))
        assert pii.base_spans(text) == brute(text), text


def test_query(spark):
    rows = queries.op4_pii(spark, "/root/testdata/sf0.01").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        joined = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(b[0] == k for b in base) for k in range(4)]
        assert set(joined) <= set(r["spans"].split(","))


def spans(spark, *texts):
    filler = [f"call +1 (555) 555-{i:04d} or mail user{i}@mail.example.com in room 4{i}" for i in range(1000, 1040)]
    df = spark.createDataFrame(list(enumerate([*texts, *filler])), "doc_id long, text string")
    rows = pii.find(df, pii.learn(df)).where(F.col("doc_id") < len(texts)).collect()
    return {r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["spans"] if s not in r["base"]] for r in rows}


def test_repeats_of_personal_data_are_found(spark):
    found = spans(
        spark,
        "Reach me at +49 170 2345678 today. Again: 1702345678, thanks; it is 4711.",
        "Mail jane.roe@mail.example.com now; jane.roe@mail isn't whole. Room 1002.",
        "In 2024 we had 123456 rows, then 123456 rows again.",
    )
    assert found[0] == ["1702345678"]
    assert found[2] == []


def test_grouped_numbers_share_edges(spark):
    texts = [
        "Reach me at +49 170 234 5678 today. Again: 170 234 5678, thanks; or 1702345678.",
        "Card 4111 1111 1111 1111 is mine, yes 4111111111111111 it is, or 1111 1111 of it.",
        "Ring +49 170 234 5678 now; it is 170 234 5678 2024 12 in the list.",
    ]
    for text, ends in zip(texts, (3, 2, 2)):
        graph = pii.Graph(text, pii.base_spans(text))
        tied = {i for edge in graph.skip for i in edge}
        assert len(tied) >= ends, text
    alone = "It is 170 234 5678 here."
    assert [alone[a:b] for a, b in pii.Graph(alone, []).spans] == ["170 234 5678"]
    found = spans(spark, texts[0])
    assert "1702345678" in found[0]
    assert "170 234 5678" in found[0]


def test_evidence_reaches_every_repeat(spark):
    text = "Reach me at +49 170 2345678 today. " + "Then call 1702345678 or so. " * 60
    filler = [f"call +1 (555) 555-{i:04d} or mail user{i}@mail.example.com in room 4{i}" for i in range(1000, 1040)]
    field = pii.learn(spark.createDataFrame([(x,) for x in filler], "text string"))
    found = field.more_spans(text, pii.base_spans(text))
    assert [text[a:b] for _, a, b in found] == ["1702345678"] * 60
    graph = pii.Graph(text, pii.base_spans(text))
    base = np.flatnonzero(graph.labels != pii.OUTSIDE)
    near = {i for edge in graph.skip for i in edge if set(edge) & set(base.tolist())}
    assert near >= set(range(2, len(graph.spans)))


def test_no_base_span_is_needed(spark):
    filler = [f"call +1 (555) 555-{i:04d} or mail user{i}@mail.example.com in room 4{i}" for i in range(1000, 1040)]
    field = pii.learn(spark.createDataFrame([(x,) for x in filler], "text string"))
    text = "Call 555-1000 now, and call 555-1000 later. "
    found = [text[a:b] for _, a, b in field.more_spans(text, [])]
    assert found == ["555-1000"] * 2
    mailed = text + "Or mail jane@mail.example.com."
    assert field.more_spans(mailed, pii.base_spans(mailed)) == field.more_spans(text, [])


def test_odd_rows(odd, empty, documents):
    field = pii.learn(odd)
    assert len(pii.find(odd.withColumn("base", F.lit(1)), field).collect()) == odd.count()
    assert pii.find(empty, pii.learn(empty)).collect() == []
    long = documents("1" * 200_000, "a" * 100_000 + "@", "+1" * 50_000, "1.1.1." * 20_000)
    assert len(pii.find(long, pii.learn(long)).collect()) == 4


def test_the_whole_token_makes_its_shape():
    head = "ab-" * 60
    assert len({pii._shape(head + tail) for tail in ("1", "@@@9999", "12", "1" * 30, "1" * 31)}) == 5
    assert pii._shape("x-12@" * 200_000) != pii._shape("x-12@" * 200_000 + "7")
