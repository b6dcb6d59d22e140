"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scarmap.llm import resample as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, run=2):
    words = WORD.findall((text or "").translate(FOLD))
    return words, [" ".join(words[i : i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, run=2, buckets=10_000, percent=25, least=20, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in rows for f in features(text, run)[1])
    t = Counter(bucket(f) for text in target for f in features(text, run)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for doc, text in rows:
        words, found = features(text, run)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    pool = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(pool[: percent * len(pool) // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in out)


def run(spark, rows, target, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = spark.createDataFrame([(x,) for x in target], "text string")
    return Counter(tuple(r) for r in R.resample(docs, wanted, **kw).collect())


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Straße", "ÉTÉ", "東京", "a", "b"]
    joint = [" ", "  ", ". ", "\n", "-", "_", "\x00", " "]
    return ["".join(rng.choice(vocabulary) + rng.choice(joint) for _ in range(rng.choice([0, 1, 5, 30, 200])))[: rng.choice([-1, None])] for _ in range(n)]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=50), st.binary(max_size=300))
def test_checksums_are_composed(a, b):
    got = R.joined(np.array([zlib.crc32(a)], dtype=np.uint32), np.array([zlib.crc32(b)], dtype=np.uint32), np.array([len(b)]))
    assert int(got[0]) == zlib.crc32(a + b)


def test_checksum_of_a_very_long_second_part():
    a, b = b"head", b"\xfftail" * 1_000_003
    got = R.joined(np.array([zlib.crc32(a)], dtype=np.uint32), np.array([zlib.crc32(b)], dtype=np.uint32), np.array([len(b)]))
    assert int(got[0]) == zlib.crc32(a + b)


# with few dictionary words or none, other words are hashed at their place
@pytest.mark.parametrize("kw", [{}, {"most": 0}, {"most": 40}, {"run": 3, "buckets": 97, "percent": 60, "least_words": 4}, {"run": 1}])
def test_plain_answer(spark, kw):
    rows = [(i, t) for i, t in enumerate(texts(400, 1))]
    target = texts(30, 2)
    same = {"least": kw["least_words"]} if "least_words" in kw else {}
    assert run(spark, rows, target, **kw) == brute(rows, target, **{k: v for k, v in kw.items() if k not in ("most", "least_words")}, **same)


def test_texts_end_where_rows_end(spark):
    rows = [(0, "foo"), (1, "bar"), (2, "foobar foobar"), (3, "bar foo"), (4, "foobar")] * 3
    assert run(spark, rows, ["foo bar", "foobar"], least_words=1) == brute(rows, ["foo bar", "foobar"], least=1)


def test_odd_rows(spark):
    long = "word " * 300_000 + "x" * 500_000
    rows = [(1, None), (2, ""), (3, " \n.-"), (4, long), (None, "a b " * 20), (None, "a b " * 20), (6, "c d " * 20), (6, "c d " * 20), (7, "é" * 100_000)]
    rows += [(i, "tie of equal words " * 10) for i in range(10, 30)]
    target = [None, "", "a b c"]
    assert run(spark, rows, target, percent=50) == brute(rows, target, percent=50)
    assert run(spark, rows, []) == brute(rows, [])
    assert run(spark, [], target) == Counter()


def test_clashing_columns_play_no_part(spark):
    rows = [(i, t) for i, t in enumerate(texts(60, 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    odd = docs.select("*", *[F.lit("x").alias(c) for c in ["pool", "place", "size", "weight", "score", "rank", "n_words", "_tie", "_at"]])
    target = spark.createDataFrame([("w1 w2 w3", 1)], "text string, n long")
    assert Counter(tuple(r) for r in R.resample(odd, target).collect()) == brute(rows, ["w1 w2 w3"])


def test_the_draw_moves_towards_the_target(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["sun", "sea", "sand"] if i % 4 == 0 else ["tax", "law", "court"]) for _ in range(40))) for i in range(400)]
    drawn = [r for r in run(spark, rows, ["sun sea sand sea sun"] * 50, buckets=1000) if r[4]]
    assert len(drawn) == 100 and sum(r[0] % 4 == 0 for r in drawn) > 60
