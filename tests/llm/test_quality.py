"""The quality classifier: slopes by finite differences, held-out accuracy, edge cases."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scarmap.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_slopes_agree_with_finite_differences():
    rng = np.random.default_rng(0)
    scores, grades, cuts = rng.normal(size=30) * 2, rng.integers(0, 3, 30), np.array([-0.7, 1.1])
    value, by_score, by_cut = Q.loss_and_slopes(scores, grades, cuts)
    tails = Q.Model(np.zeros(1), cuts).tails(scores)
    p = np.stack([1 - tails[:, 0], tails[:, 0] - tails[:, 1], tails[:, 1]], 1)
    assert value == pytest.approx(-np.log(p[np.arange(30), grades]).sum())
    e = 1e-6
    for i in range(30):
        up = scores.copy()
        up[i] += e
        assert (Q.loss_and_slopes(up, grades, cuts)[0] - value) / e == pytest.approx(by_score[i], abs=1e-4)
    for k in range(2):
        up = cuts.copy()
        up[k] += e
        assert (Q.loss_and_slopes(scores, grades, up)[0] - value) / e == pytest.approx(by_cut[k], abs=1e-3)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = Q.fit(docs, labels.where(~held))
    assert model.thresholds[0] < model.thresholds[1]
    rows = Q.score(docs, model, ["doc_id"], "g").join(labels.where(held), "doc_id").select(Q.grade(F.col("quality"), F.col("toxic")).alias("y"), "g.expected_grade").collect()
    good, rest = ([r.expected_grade for r in rows if (r.y == 2) == side] for side in (True, False))
    ahead = np.mean([g > b for g in good for b in rest])
    assert len(rows) > 60 and ahead > 0.85


def test_selection_keeps_columns_and_whatever_cannot_be_rated(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(words, 30)) + (" vile" if i % 3 == 0 else ""), "x", 1.5) for i in range(300)]
    rows += [(1000, None, "x", 1.0), (1001, "", None, 2.0), (1002, "word " * 100_000, "x", 0.0), (None, "w1 w2 w3", "x", 0.0), (5, rows[5][1], "again", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, given string, tail double")
    rated = [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(7, None, 0), (8, 1, None), (None, 1, 1), (1000, 1, 0), (10, 1, 0)]
    labels = spark.createDataFrame(rated, "doc_id long, quality int, toxic int")
    kept = Q.select_documents(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    bad = {i for i in range(300) if i % 3 == 0}
    assert not bad & set(ids) and set(range(300)) - bad <= set(ids) and ids.count(5) == 2
    assert Q.select_documents(docs, labels.limit(0)).count() == len(rows)
    assert Q.select_documents(docs.limit(0), labels).count() == 0


def test_sample_bound_and_features():
    texts = pa.array(["Alpha alpha beta!!", None, "", "x" * 3_000_000, "alpha BETA alpha!!"])
    lists = list(Q.features(texts))
    assert len(lists) == 5 and len(lists[1]) == len(lists[2]) == 6 * Q.STYLE_SCALE
    assert all(0 <= f.min() and f.max() < 1 << Q.BITS for f in lists)
    alone = [next(Q.features(pa.array([t], pa.string()))) for t in texts.to_pylist()]
    assert all(sorted(a) == sorted(b) for a, b in zip(lists, alone, strict=True))
