"""Benchmark passages in documents against a plain search."""

import hashlib
import re

import pytest

from scarmap.llm import decontaminate as D

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(docs, items):
    where = {}
    for item, text in items:
        w = words(text)
        for j in range(max(len(w) - 9, min(len(w), 1))):
            where.setdefault(tuple(w[j : j + 10]), set()).add(item)
    sizes = {len(w) for w in where}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in where:
                    hit |= set(range(j, j + n))
                    found |= where[tuple(w[j : j + n])]
        names = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items, **more):
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in D.contamination(d, b, **more).collect()), key=repr)


@pytest.mark.parametrize("slice_rows", [D.SLICE_ROWS, 400])
def test_whole_tables(spark, slice_rows):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted((tuple(r) for r in D.contamination(docs, items, slice_rows=slice_rows).collect()), key=repr) == want
    assert any(r[-1] for r in want)


def test_short_items_ties_repeats_and_odd_texts(spark):
    long_item = "one two three four five six seven eight nine ten eleven twelve"
    items = [(10, long_item), (2, long_item), (2, long_item), (3, "Solo"), (4, "Two Words!"), (5, ""), (6, None), (7, "a a a a a a a a a a a a")]
    docs = [
        (1, None), (2, ""), (3, "?!"), (4, "x SOLO y solo"), (5, "two... words, TWO words"), (6, "ONE, two-three four five six seven eight nine ten; eleven"),
        (6, "one two three"), (7, "a " * 11), (8, "é solo É"), (8, "é solo É"), (None, "solo"), (9, "b " * 200_000 + "solo"), (10, "words two"),
    ]
    want = brute(docs, [i for i in items])
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, slice_rows=2) == want
    assert [r[2] for r in run(spark, docs, [])] == [0] * len(docs)
    assert run(spark, [], items) == []
    assert run(spark, docs, [(None, "solo")])[0][2] == 0


def test_clean_documents_keep_their_columns(spark):
    rows = [(1, "x solo", "a", 1), (2, "clean", None, 2), (2, "clean", None, 2), (None, "clean", "b", 3), (None, "solo", "b", 3), (3, None, "c", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string, found_ int")
    kept = D.clean_documents(docs, spark.createDataFrame([(1, "solo")], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in docs.collect() if "solo" not in (r.text or ""))


def test_slices_stay_bounded_under_a_shared_phrase(spark, monkeypatch):
    phrase = " ".join(f"shared{i}" for i in range(12))
    items = [(i, f"{phrase} own{i}") for i in range(300)]
    docs = [(1, f"before {phrase} after"), (2, "nothing of it"), (3, f"{phrase} own7")]
    sizes, made = [], D._probes
    monkeypatch.setattr(D, "_probes", lambda rows, texts: sizes.append(len(rows)) or made(rows, texts))
    got = run(spark, docs, items, slice_rows=200)
    assert len(sizes) == 6 and sum(sizes) == 1200 and max(sizes) < 300
    monkeypatch.undo()
    assert got == run(spark, docs, items) == brute(docs, items)
