"""Merkle manifest against trees built one node at a time."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from scarmap.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    doc, text, lang, source, n = row
    return H(*map(field, (doc, source, lang, n, text)))


def tree(leaves, fanout):
    """(root, per leaf the (left, right) of every level)"""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, path in enumerate(paths):
            a = at[i] // fanout * fanout
            path.append(("".join(level[a : at[i]]), "".join(level[at[i] + 1 : a + fanout])))
        level = [H(*level[j : j + fanout]) for j in range(0, len(level), fanout)]
        at = [i // fanout for i in at]
    return level[0], paths


def brute(rows, fanout=2, damaged=7):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    parts = {}
    for x in langs:
        own = sorted(by_lang[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        parts[x] = (own, *tree([leaf(r) for r in own], fanout))
    root, tops = tree([parts[x][1] for x in langs], fanout) if langs else (None, [])
    out = Counter()
    for x, top in zip(langs, tops, strict=True):
        own, subroot, paths = parts[x]
        for r, path in zip(own, paths, strict=True):
            path = path + top
            node = leaf(r)
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % damaged == 0:
                node = leaf((*r[:4], r[4] + 1))
            for left, right in path:
                node = H(left, node, right)
            out[(r[0], leaf(r), subroot, root, H(*[a + b for a, b in path]), node, node == root)] += 1
    return out


def run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, SCHEMA)
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    if kw:
        columns = [F.col(c) for c in M.FIELDS]
        made = M.manifest(docs, "lang", ["doc_id"], M.leaf(columns), {"doc_id": F.col("doc_id")}, **kw)
        got = made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", M.fold(F.col("leaf"), F.col("path")))
        return Counter(tuple(r) for r in got.collect())
    return Counter(tuple(r) for r in M.document_manifest(docs, altered).collect())


def table(n, seed=1):
    rng = random.Random(seed)
    langs = ["en", "en", "en", "de", "fr", None, "ü", "z"]
    return [(i, f"text {i} é\n" * rng.randrange(4), rng.choice(langs), f"s{rng.randrange(4)}", rng.choice([i, None])) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 700])
def test_trees_and_proofs(spark, n):
    rows = table(n)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize(("fanout", "slots"), [(2, 2), (2, 32), (3, 9), (5, 16)])
def test_any_fanout_and_block(spark, fanout, slots):
    rows = table(150, 2)
    want = Counter()
    for r, n in brute(rows, fanout, damaged=1 << 40).items():
        want[r[:6]] += n
    assert run(spark, rows, fanout=fanout, slots=slots) == want


def test_odd_rows(spark):
    rows = [(1, "x" * 1_000_000, "en", "s", 5), (2, "", "en", "", 0), (None, None, None, None, None), (None, None, None, None, None), (3, "same", "en", "s", 7)]
    rows += [(3, "same", "en", "s", 7)] * 20 + [(3, "other", "en", "s", 7), (4, "1:a", "12:", "-", -1)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == Counter()
    one = [(None, "a", None, "b", 3)]
    assert run(spark, one) == brute(one)


def test_a_changed_row_is_found_and_others_are_not(spark):
    rows = table(200, 3)
    for doc, *_, verified in run(spark, rows):
        changed = zlib.crc32(str(doc).encode()) % 7 == 0 and dict((r[0], r[4]) for r in rows)[doc] is not None
        assert verified != changed


def test_clashing_columns_play_no_part(spark):
    rows = table(40, 4)
    docs = spark.createDataFrame(rows, SCHEMA)
    odd = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(["tree", "place", "size", "node", "leaf", "root", "path", "with", "above", "found", "_tie", "n0_0"])])
    assert Counter(tuple(r) for r in M.document_manifest(odd).collect()) == Counter(tuple(r) for r in M.document_manifest(docs).collect())


def test_refuses_a_tree_without_branches(spark):
    with pytest.raises(ValueError):
        run(spark, table(2), fanout=1, slots=4)
