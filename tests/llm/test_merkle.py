"""The manifest against a plain tree in Python; proofs, ties, nulls, and chunks of every size."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from curbline.llm import merkle, queries

SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
    return levels


def folded(levels, at, digest, arity):
    siblings = ""
    for level in levels[:-1]:
        first = at // arity * arity
        run = level[first : first + arity]
        siblings += "".join(run[: at - first] + run[at - first + 1 :])
        run[at - first] = digest
        digest, at = sha("".join(run)), at // arity
    return digest, siblings


def expected(rows, arity=8):
    """rows: (id, group, leaf, changed); what fold adds, as sorted tuples."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[name] = levels_of([r[2] for r in groups[name]], arity)
    top = levels_of([trees[name][-1][0] for name in names], arity)
    found = []
    for i, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            digest, lower = folded(trees[name], at, row[3], arity)
            digest, upper = folded(top, i, digest, arity)
            found.append((row[2], trees[name][-1][0], top[-1][0], sha(lower + upper), digest, digest == top[-1][0]))
    return sorted(found)


NAMES = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(df, arity=8, levels=3):
    rows = merkle.fold(merkle.build(df, "leaf", "lang", "doc_id", arity, levels), "changed").select(*NAMES).collect()
    return sorted(tuple(r) for r in rows)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, lang string, leaf string, changed string").repartition(parts)


@pytest.mark.parametrize(("arity", "levels"), [(8, 3), (2, 1), (2, 2), (3, 1)])
def test_sizes_of_groups(spark, arity, levels):
    """Groups around every bound of runs and chunks, and more groups than one run holds."""
    rng = random.Random(arity * 10 + levels)
    rows = []
    for name, size in zip([None, "", "ä", "z", *"abcdefgh"], [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 30, 65]):
        for i in range(size):
            leaf = sha(f"{name}{i}")
            rows.append((i, name, leaf, sha("changed" + leaf) if rng.random() < 0.4 else leaf))
    rng.shuffle(rows)
    assert found(frame(spark, rows), arity, levels) == expected(rows, arity)


def test_one_large_group(spark):
    rows = [(i, "en", sha(str(i)), sha(str(-i if i % 3 == 1 else i))) for i in range(1500)]
    assert found(frame(spark, rows)) == expected(rows)


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(i, lang, sha(f"{i}{n}"), sha(f"{i}{n}")) for i in (None, 1, 2) for lang in (None, "en") for n in (0, 0, 1)]
    rows += [(None, None, sha("same"), sha("other"))] * 40
    assert found(frame(spark, rows)) == expected(rows)
    # the tree depends on the rows, not on where they stand
    assert found(frame(spark, rows[::-1], 7)) == expected(rows)


def test_empty_and_single(spark):
    assert found(frame(spark, [])) == []
    leaf = sha("x")
    assert found(frame(spark, [(1, "en", leaf, leaf)])) == [(leaf, leaf, leaf, sha(""), leaf, True)]


def test_clashing_columns_pass_or_are_replaced(spark):
    rows = [(i, "en", sha(str(i)), sha(str(i))) for i in range(20)]
    df = frame(spark, rows).withColumns({"subroot": F.lit("x"), "root": F.lit(1), "a.b": F.lit(2), "own": F.col("doc_id")})
    result = merkle.fold(merkle.build(df, "leaf", "lang", "doc_id"), "changed")
    assert sorted(tuple(r) for r in result.select(*NAMES).collect()) == expected(rows)
    assert sorted(r["own"] for r in result.collect()) == list(range(20)) and "a.b" in result.columns


def leaf_of(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_query_on_odd_rows(spark, odd, empty, folder_of):
    docs = odd.collect()
    rows = []
    for r in docs:
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        leaf = leaf_of(r, r["text"])
        rows.append((r["doc_id"], r["lang"], leaf, leaf_of(r, lowered(r["text"])) if hit else leaf))
    result = queries.op13_manifest(spark, folder_of(documents=odd)).select(*NAMES).collect()
    assert sorted(tuple(r) for r in result) == expected(rows)
    assert queries.op13_manifest(spark, folder_of(documents=empty)).collect() == []


def test_only_changed_texts_fail(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op13_manifest(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and lowered(docs[r["doc_id"]]) != docs[r["doc_id"]]
        assert r["verified"] is not changed


def test_a_parent_resumes_its_states():
    children = [sha(str(i)).encode() for i in range(8)]
    parent = merkle.Parent(children)
    for slot in range(8):
        replaced = [*children[:slot], b"x" * 64, *children[slot + 1 :]]
        assert parent.fold(slot, b"x" * 64) == hashlib.sha256(b"".join(replaced)).hexdigest().encode()
        assert parent.fold(slot, children[slot]) == parent.digest
