"""Repeated passages: planted ones, a plain search over whole texts, chaining against all chains, edge cases."""

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from scarmap.llm import passages as P

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def run(spark, rows, **more):
    return [tuple(r) for r in P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), **more).collect()]


def check(rows, found, min_words=50, percent=80):
    """Every reported range holds; every run of 60 equal words between documents is covered in all of them but one."""
    texts = {}
    for i, t in rows:
        texts.setdefault(i, words(t))
    for doc, other, s, e, os, oe, equal in found:
        assert doc != other and min(e - s, oe - os) >= min_words
        if max(e - s, oe - os) < 700:
            assert common(texts[doc][s:e], texts[other][os:oe]) >= equal >= percent * max(e - s, oe - os) / 100
    where = defaultdict(set)
    for i, w in texts.items():
        for j in range(len(w) - 59):
            where[tuple(w[j : j + 60])].add((i, j))
    covered = defaultdict(list)
    for doc, _, s, e, *_ in found:
        covered[doc].append((s, e))
    for places in where.values():
        docs = {i for i, _ in places}
        bare = {i for i, j in places if not any(s < j + 45 and e > j + 15 for s, e in covered[i])}
        assert len(docs) == 1 or len(bare) <= 1, (docs, bare)
    return where


def test_whole_table_against_a_plain_search(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = run(spark, docs)
    check(docs, found)
    assert found


def test_planted_exact_and_fuzzy_passages(spark):
    rng = random.Random(3)
    fill = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    exact, fuzzy, short = fill(55), fill(80), fill(40)
    rows = []
    for i in range(40):
        rows.append((i, " ".join(fill(rng.randrange(5, 200)) + exact + fill(rng.randrange(0, 60)))))
    for i in range(40, 60):
        own = list(fuzzy)
        for at in rng.sample(range(80), 2):
            own[at] = f"x{rng.randrange(10**6)}"
        del own[rng.randrange(80)]
        rows.append((i, " ".join(fill(30) + own + fill(rng.randrange(0, 60)))))
    rows += [(i, " ".join(fill(90) + short + fill(90))) for i in range(60, 70)] + [(i, " ".join(fill(300))) for i in range(70, 80)]
    rng.shuffle(rows)
    found = run(spark, rows)
    check(rows, found)
    hit = {f[0] for f in found} | {f[1] for f in found}
    assert hit == set(range(60))
    assert {f[0] for f in found} >= set(range(1, 40))


def test_chains_against_all_subsequences():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = rng.integers(2, 8)
        runs = np.stack([rng.integers(0, 60, n), rng.integers(0, 60, n), rng.integers(5, 12, n)], 1)
        got = P.chains(runs)
        assert sorted(map(tuple, np.concatenate(got))) == sorted(map(tuple, runs))

        def worth(chain):
            total = chain[0][2]
            for a, b in zip(chain, chain[1:]):
                gaps = [b[k] - (a[k] + a[2] - P.SEED_WORDS + 1) for k in (0, 1)]
                if min(gaps) < 0:
                    return -1
                total += b[2] - P.GAP_COST * sum(gaps)
            return total

        rows = sorted(map(tuple, runs.tolist()))
        best = max(worth(c) for k in range(1, n + 1) for c in combinations(rows, k))
        assert worth([tuple(r) for r in got[0].tolist()]) == pytest.approx(best)


def test_alignment_finds_ends_and_gaps():
    a = np.arange(100)
    b = np.concatenate([np.arange(900, 910), a[5:40], [777, 778], a[40:80], np.arange(800, 820)])
    start, end, other, other_end, equal = P.align(a, b, np.array([[10, 15, 20], [45, 52, 10]]))
    assert (start, end, other, other_end, equal) == (5, 80, 10, 87, 75)
    assert P.align(a, b, np.array([[90, 100, 30]])) is None
    assert P._common(np.array([1, 2, 3, 4]), np.array([2, 9, 4])) == 2


def test_edge_cases(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(70))
    long_text = " ".join(f"l{rng.randrange(10**6)}" for _ in range(60_000))
    rows = [(1, None), (2, ""), (3, "few words"), (4, passage), (5, "x " + passage), (5, "x " + passage), (6, passage + " y"), (None, passage), (7, long_text + " " + passage), (8, "same " * 5000), (9, "same " * 5000)]
    found = run(spark, rows)
    assert {(f[0], f[1]) for f in found} >= {(5, 4), (6, 4), (7, 4), (9, 8)} and all(f[0] != f[1] and f[0] not in (1, 2, 3, 4, 8) for f in found)
    assert [f for f in found if f[0] == 7] == [(7, 4, 60_000, 60_070, 0, 70, 70)]
    assert run(spark, []) == [] and run(spark, [(1, passage)]) == []
    extra = spark.createDataFrame([(1, passage, "x", 2), (2, passage, "y", 3)], "doc_id long, text string, key string, pos int")
    assert [tuple(r) for r in P.repeated_passages(extra).collect()] == [(2, 1, 0, 70, 0, 70, 70)]


def test_every_part_of_a_chain_is_tried(spark):
    rng = random.Random(21)
    fill = lambda n: [f"w{rng.randrange(10**8)}" for _ in range(n)]
    rows, want = [], set()
    for i, (one, gap, two) in enumerate([(60, 80, 60), (100, 480, 100), (25, 60, 60), (60, 60, 25), (55, 300, 70), (50, 13, 50), (200, 100, 50)]):
        a, b = fill(one), fill(two)
        rows += [(2 * i + k, " ".join(fill(9 + k) + a + fill(gap) + b + fill(7))) for k in (0, 1)]
        if one + two >= 0.8 * (one + gap + two):
            want.add((2 * i + 1, 2 * i, 10, 10 + one + gap + two))
        else:
            want |= {(2 * i + 1, 2 * i, 10 + s, 10 + e) for s, e in ((0, one), (one + gap, one + gap + two)) if e - s >= 50}
    found = run(spark, rows)
    check(rows, found)
    assert {f[:4] for f in found} == want


def test_parts_against_all_stretches():
    rng = np.random.default_rng(8)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        step = lambda: np.cumsum(1 + (rng.random(n) < 0.3) * rng.integers(0, 4, n))
        x, y = step(), step()
        want = set()
        for i in range(n):
            for j in range(i, n):
                sides = [int(z[j] - z[i]) + 1 for z in (x, y)]
                if min(sides) >= 8 and 100 * (j - i + 1) >= 80 * max(sides):
                    want |= set(range(i, j + 1))
        got = set()
        for s, e, os, oe, equal in P.parts(x, y, 8, 80):
            i, j = np.searchsorted(x, s), np.searchsorted(x, e - 1)
            assert (y[i], y[j] + 1, j - i + 1) == (os, oe, equal) and min(e - s, oe - os) >= 8 and 100 * equal >= 80 * max(e - s, oe - os)
            got |= set(range(i, j + 1))
        assert got == want


def test_common_subsequences_of_any_size(monkeypatch):
    rng = np.random.default_rng(5)
    for bits in (P.TABLE_BITS, 40):
        monkeypatch.setattr(P, "TABLE_BITS", bits)
        for _ in range(50):
            a, b = rng.integers(0, 6, rng.integers(0, 40)), rng.integers(0, 6, rng.integers(0, 40))
            i, j = P._matched(a, b)
            assert (a[i] == b[j]).all() and (np.diff(i) > 0).all() and (np.diff(j) > 0).all()
            assert len(i) == common(a.tolist(), b.tolist())


@pytest.mark.parametrize(("size", "changed"), [(50, 10), (60, 12), (60, 9)])
def test_recall_at_the_stated_thresholds(spark, size, changed):
    rng = random.Random(size + changed)
    fill = lambda n: [f"w{rng.randrange(10**8)}" for _ in range(n)]
    rows = []
    for i in range(100):
        passage = fill(size)
        own = list(passage)
        for at in rng.sample(range(1, size - 1), changed):
            own[at] = fill(1)[0]
        rows += [(2 * i, " ".join(fill(20) + passage + fill(20))), (2 * i + 1, " ".join(fill(30) + own + fill(10)))]
    found = run(spark, rows)
    assert all(f[1] == f[0] - 1 for f in found)
    assert len({f[0] for f in found}) >= 97


def test_first_holder_with_too_little_hides_no_link(spark):
    rng = random.Random(31)
    fill = lambda n: [f"w{rng.randrange(10**8)}" for _ in range(n)]
    rows, want = [], set()

    def add(i, part):
        rows.append((i, " ".join(fill(30) + part + fill(20))))

    whole = fill(55)
    add(1, whole[:48])  # too little of what 2 and 3 share
    add(2, whole)
    add(3, whole)
    want.add((3, 2))
    whole = fill(50)
    add(11, whole[:49])
    add(12, whole[1:])  # both together have every short seed
    add(13, whole)
    add(14, whole)
    want.add((14, 13))
    whole = fill(80)
    for i in range(30):  # random parts, then two holders of the whole
        at = rng.randrange(0, 32)
        add(100 + i, whole[at : at + 49])
    add(200, whole)
    add(201, whole)
    want.add((201, 200))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 50):
        found = [tuple(r) for r in P.repeated_passages(docs.repartition(parts, "doc_id")).collect()]
        check(rows, found)
        assert {f[:2] for f in found} >= want and all(f[0] not in (1, 2, 11, 12) for f in found), parts


def test_passages_are_covered_alike_for_any_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    linked = []
    for parts in (1, 50):
        found = P.repeated_passages(docs.repartition(parts, "doc_id")).select("doc_id").distinct().collect()
        linked.append({r.doc_id for r in found})
    assert linked[0] == linked[1] != set()


def test_longer_seeds_are_those_of_their_words():
    rng = np.random.default_rng(12)
    h = rng.integers(0, 3, 400).astype(np.uint64)
    cuts = np.array([0, 100, 100, 130, 400])
    for k in (6, 14, 28, 50):
        g, at = P._longer(h, cuts, k)
        assert at.tolist() == [i for a, b in zip(cuts, cuts[1:]) for i in range(a, b - k + 1)]
        runs = [tuple(h[i : i + k]) for i in at]
        assert len(set(runs)) == len(set(g.tolist())) == len(set(zip(runs, g.tolist())))
    assert len(P._longer(h[:20], np.array([0, 20]), 50)[0]) == 0
    assert P._around([0, 2, 9], 150).nonzero()[0].tolist() == [*range(64), *range(128, 150)]


def test_chains_inside_aligned_ones_are_left_out():
    old, new = [2, 0, 10, 20, 30, 45, 8], [1, 5, 15, 14, 2, 25, 36, 14, 60, 70, 14, 1, 0, 40, 28]
    batch = P.pa.record_batch([P.pa.array([5, 6, 7]), P.pa.array([1, 1, 1]), P.pa.array([new, new, new[:4]]), P.pa.array([old, None, old])], ["member", "center", "chains", "had"])
    got = [r for out in P._unseen([batch]) for r in out.to_pylist()]
    assert got == [{"member": 5, "center": 1, "chains": new[4:]}, {"member": 6, "center": 1, "chains": new}]
