"""Near-duplicate grouping against all pairs, and its edge cases."""

import random
import re

import numpy as np
import pytest

from scarmap.llm import minhash as M
from scarmap.llm import textkit as K

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def run(spark, rows, schema="doc_id long, text string"):
    return sorted((tuple(r) for r in M.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=repr)


def test_against_all_pairs_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(tuple(r) for r in M.near_duplicates(docs).collect()) == want
    assert any(not kept for *_, kept in want)


def test_chains_and_dense_groups_that_a_star_cannot_settle(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(M, "REGISTER_MEMBERS", 5)
    rng = random.Random(7)
    rows, words = [], [f"w{rng.randrange(10**6)}" for _ in range(200)]
    for i in range(60):  # each text is close to the one before, far from the first
        rows.append((i, " ".join(words)))
        at = rng.randrange(190)
        words = words[:at] + [f"x{rng.randrange(10**6)}"] + words[at + 1 :]
    base = [f"v{i}" for i in range(200)]
    for i in range(60, 120):  # all at about 0.8 of each other, some above
        own = list(base)
        for at in rng.sample(range(200), rng.randrange(1, 6)):
            own[at] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rng.shuffle(rows)
    assert sorted(run(spark, rows)) == brute(rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, "É a b c d e"), (7, "É a b c d e"), (8, "é a b c d e"), (9, "big " * 300_000)]
    got = run(spark, rows)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 2, 7, True), (7, 2, 7, True), (8, 2, 8, True), (9, 1, 9, True)], key=repr)
    assert run(spark, []) == []


def test_one_id_with_two_texts_and_rows_without_id(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    got = run(spark, [(3, a), (3, b), (1, a), (2, b), (None, a), (None, "lone text here"), (None, "")])
    assert got == sorted([(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (3, 4, 1, False), (None, 4, 1, False), (None, 1, None, True), (None, 0, None, True)], key=repr)


def test_extra_columns_with_clashing_names(spark):
    rows = [(1, "a b c d e f", "x", True, 5), (2, "a b c d e f", "y", False, 6)]
    assert run(spark, rows, "doc_id long, text string, component_id string, kept boolean, n_shingles int") == [(1, 2, 1, True), (2, 2, 1, False)]


def test_signature_collisions_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for n in (3, 40, 1500):
        a, b = pool[:n], pool[n // 3 : n + n // 3]
        sig = M.superminhash(np.concatenate([a, b]), np.array([0, n, 2 * n]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert np.mean(sig[0] == sig[1]) == pytest.approx(true, abs=0.15)
        assert (np.sort(M.superminhash(a[::-1].copy(), np.array([0, n]))) == np.sort(sig[:1])).all()


def test_words_and_hashes_do_not_depend_on_blocks():
    import pyarrow as pa

    texts = ["Ab\tc  d", None, "", "é x", "y" * 3_000_000, "Ab c"]
    whole = [h for *_, data, off in K.text_blocks(pa.array(texts)) for h in K.words_of(data, off, K.VISIBLE)[0].tolist()]
    split = [h for t in texts for *_, data, off in K.text_blocks(pa.array([t], pa.string()), 2) for h in K.words_of(data, off, K.VISIBLE)[0].tolist()]
    assert whole == split and len(whole) == 8 and whole[0] == whole[6] and len(set(whole)) == 6


def test_components_of_chains_stars_and_cycles(spark):
    from scarmap.llm.shared import components

    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(700, 701), (701, 702), (702, 700), (9, 9)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    rng.shuffle(edges)
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {x: find(x) for x in root if x != 9}
    some = components(df, turns=1).collect()
    assert len({r.node for r in some}) == len(some) and all(find(r.node) == find(r.component) for r in some)
    assert components(df.limit(0)).count() == 0


def test_few_true_pairs_agree_in_too_few_registers():
    assert M.enough(85) > M.enough(80) > M.REGISTERS // 2
    rng = np.random.default_rng(3)
    for percent in (80, 85):
        lost = 0
        for _ in range(200):
            common, own = rng.integers(0, 1 << 63, percent, dtype=np.uint64), rng.integers(0, 1 << 63, 100 - percent, dtype=np.uint64)
            half = (100 - percent) // 2
            a, b = np.concatenate([common, own[:half]]), np.concatenate([common, own[half:]])
            signature = M.superminhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            lost += np.count_nonzero(signature[0] == signature[1]) < M.enough(percent)
        assert lost == 0


def test_a_link_with_a_center_behind_those_tried_first(spark):
    """Text 4 is near 1, 2 and 3 by its registers, alike only 3, and shares no bucket with 3 and another one."""
    rng = random.Random(789)
    word = lambda: f"w{rng.randrange(10**9)}"
    own = [word() for _ in range(400)]

    def changed(lo, n):
        return " ".join([*own[:lo], *[word() for _ in range(n)], *own[lo + n :]])

    rows = [(1, changed(10, 62)), (2, changed(130, 62)), (3, changed(260, 20)), (4, " ".join(own))]
    assert run(spark, rows) == brute(rows) == [(1, 396, 1, True), (2, 396, 2, True), (3, 396, 3, True), (4, 396, 3, False)]
