"""The quality cascade and the licence scan on small texts."""

import random

from pyspark.sql import functions as F

from curbline.llm import licenses as li
from curbline.llm import quality_rules as qr

GOOD = " ".join(f"word{i} and" for i in range(60))


def rejected(df, rules):
    return {r["doc_id"]: r["rejected_by"] for r in qr.cascade(df, rules).collect()}


def test_verdict_is_the_same_in_any_order(documents):
    rng = random.Random(2)
    junk = [GOOD, GOOD.upper(), "a | b " * 50, "same line\n" * 60, "Hey!!! " * 80, "x " * 90, "few", None, "", "#" * 500]
    df = documents(*junk)
    kept = {k for k, v in rejected(df, qr.RULES).items() if v is None}
    assert kept == {0}
    for _ in range(3):
        rules = rng.sample(qr.RULES, len(qr.RULES))
        assert {k for k, v in rejected(df, rules).items() if v is None} == kept


def test_estimate_prefers_rules_that_reject(documents):
    order = qr.estimate(documents(*["# # #" * 50] * 50, *[GOOD] * 5))
    assert sorted(r.name for r in order) == sorted(r.name for r in qr.RULES)
    rejecting = {"symbols", "repeated_words", "short_words"}
    assert order[0].name in rejecting | {"few_words"}


def test_cascade_of_odd_rows(odd, empty):
    rows = qr.cascade(odd.withColumn("by", F.lit(1)), report=("n_words", "n_repeat_words")).collect()
    assert len(rows) == odd.count()
    assert max(r["n_repeat_words"] for r in rows) == 60000
    assert qr.cascade(empty).collect() == []
    assert len(qr.estimate(empty)) == len(qr.RULES)


def found(df, **settings):
    return {r["doc_id"]: {(m["level"], m["license"]) for m in r["matches"]} for r in li.scan(df, **settings).collect()}


def test_lines_sentences_and_texts(documents):
    mit = li.TEMPLATES[3][1]
    texts = [
        "Intro here.\nReleased under the MIT license!\nMore of the text",
        "One line. Licensed under CC BY-NC 4.0. And it goes on for quite a while after that.",
        mit.upper().replace(" ", "\n"),
        "under the of the to the in the",
        "MIT",
    ]
    result = found(documents(*texts))
    assert result[0] == {("line", "MIT"), ("sentence", "MIT")}
    assert result[1] == {("sentence", "CC-BY-NC-4.0")}
    assert result[2] == {("text", "MIT")}
    assert result[3] == result[4] == set()


def test_wrapped_notices_inside_texts(documents):
    before, after = "\n".join([GOOD] * 2), "\n".join([GOOD.upper()] * 3)

    def wrapped(text):
        words = text.split()
        return "\n".join(" * " + " ".join(words[i : i + 7]) for i in range(0, len(words), 7))

    full = dict(li.FULL_TEXTS)
    inside = [li.TEMPLATES[3][1], li.TEMPLATES[8][1], li.TEMPLATES[19][1], full["MIT"], full["GPL-3.0"]]
    result = found(documents(*[f"{before}\n{wrapped(x)}\n{after}" for x in inside], full["Apache-2.0"], before))
    for i, name in enumerate(["MIT", "GPL-3.0", "BSD", "MIT", "GPL-3.0", "Apache-2.0"]):
        assert ("window", name) in result[i], (i, result[i])
    assert result[6] == set()


def test_scan_of_odd_rows(odd, empty):
    assert len(li.scan(odd.withColumn("matches", F.lit(1))).collect()) == odd.count()
    assert li.scan(empty).collect() == []
    assert all(not r["matches"] for r in li.scan(odd, templates=()).collect())


def test_same_as_comparing_every_template(documents):
    rng = random.Random(4)
    words = " ".join(t for _, t in li.TEMPLATES).lower().split()
    texts = []
    for _ in range(300):
        own = rng.choice(li.TEMPLATES)[1].split()
        for _ in range(rng.randrange(4)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    sets = li.bigram_sets([t for _, t in li.TEMPLATES])
    mine = li.bigram_sets(texts)
    for i, matches in found(documents(*texts)).items():
        dice = [2 * len(set(mine[i].tolist()) & set(s.tolist())) / (len(mine[i]) + len(s)) for s in sets]
        assert bool([m for m in matches if m[0] == "text"]) == (max(dice) >= li.LEAST_DICE)
