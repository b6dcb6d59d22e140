"""Line dedup against a plain count of sites."""

import random
from collections import Counter, defaultdict

import pytest

from scarmap.llm import lines as L


def brute(rows, min_sites, copy_share=0.9):
    sites = defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if line.strip(" ") and source is not None:
                sites[line.strip(" ")].add(source)
    common = {line for line, s in sites.items() if len(s) >= min_sites}
    out = []
    for doc, text, source in rows:
        if text is not None:
            parts = text.split("\n")
            lost = sum(len(x) for x in parts if x.strip(" ") in common)
            if lost < copy_share * sum(len(x) for x in parts if x.strip(" ")):
                text = "\n".join(x for x in parts if x.strip(" ") not in common)
        out.append((doc, text, source))
    return Counter(out)


def run(spark, rows, min_sites):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return Counter(tuple(r) for r in L.without_boilerplate(docs, min_sites).collect())


@pytest.mark.parametrize("min_sites", [1, 4, 30, 200])
def test_sketches_and_exact_counts_give_the_plain_answer(spark, min_sites):
    rng = random.Random(min_sites)
    rows = []
    for i in range(600):
        own = [f"own {i} {j} words" for j in range(8)]
        shared = [f"line {rng.randrange(40) ** 2 // 40}" for _ in range(3)]
        rows.append((i, "\n".join(rng.sample(own + shared, 11)), f"s{rng.randrange(260)}" if i % 50 else None))
    assert run(spark, rows, min_sites) == brute(rows, min_sites)


def test_edge_cases(spark):
    top = "Menu | Home"
    rows = [(i, f"{top}\nbody of document number {i}\n\n  {top} ", f"s{i}") for i in range(6)]
    rows += [(10, None, "s1"), (11, "", "s2"), (12, "\n\n", "s3"), (13, top, "s4"), (14, f"{top}\nx", "s5"), (15, f"long enough text\n{top}", None), (None, f"long enough text\n{top}", "s7")]
    rows += [(0, rows[0][1], "s0"), (0, f"another text here, longer\n{top}", "s0"), (16, "w" * 1_000_000 + f"\n{top}", "s9"), (17, "same\n" * 1000, "s1")]
    for n in (1, 3, 6, 50):
        assert run(spark, rows, n) == brute(rows, n)
    assert run(spark, [], 3) == Counter()


def test_copies_of_a_widely_copied_document_stay_whole(spark):
    body = "\n".join(f"sentence {i} of the copied page" for i in range(20))
    rows = [(i, f"{body}\nown line {i}", f"s{i}") for i in range(9)] + [(50, "quite another document with one line of it\nsentence 3 of the copied page", "t")]
    got = run(spark, rows, 5)
    assert got == brute(rows, 5) and (50, "quite another document with one line of it", "t") in got and (0, rows[0][1], "s0") in got


def test_other_columns_stay_and_sizes_follow(spark):
    rows = [(i, f"top\nbody {i}", f"s{i}", 10, "keep") for i in range(5)] + [(9, None, "s", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, r_numbers string")
    got = L.without_boilerplate(docs, 5)
    assert got.columns == docs.columns
    assert Counter(tuple(r) for r in got.collect()) == Counter([(i, f"body {i}", f"s{i}", 6, "keep") for i in range(5)] + [rows[-1]])


def test_a_page_that_is_mostly_navigation_is_cleaned(spark):
    menu = "\n".join(f"menu entry number {i} of the site" for i in range(6))
    rows = [(i, f"{menu}\nbody of page {i}, with a sentence of its own that is long enough", f"s{i}") for i in range(6)]
    rows.append((9, f"{menu}\na short but real body, of this page alone", "s9"))
    got = run(spark, rows, 5)
    assert got == brute(rows, 5) and (9, "a short but real body, of this page alone", "s9") in got
