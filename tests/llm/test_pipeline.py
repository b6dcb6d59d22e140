"""The corpus pipeline: each stage on a small table against brute force, and the whole run."""

from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from scarmap.cluster import MAX_BATCH_BYTES
from scarmap.llm import lines as L
from scarmap.llm.packing import pieces
from scarmap.llm.quality import Model, score
from scarmap.llm.textkit import BLOCK
from tests.llm import test_decontaminate, test_lines, test_minhash, test_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage, as the driver runs them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in C.STAGES:
        rows = stage(spark, docs, SF).collect()
        out.append(rows)
        if rows and "text" in rows[0].__fields__:
            docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]
    assert all(stages[i][0].__fields__ == stages[0][0].__fields__ for i in range(5))


def test_quality_drops_toxic_and_keeps_good_documents(spark, stages):
    rated = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1]}
    assert set(stages[1]) <= set(stages[0])
    assert not [i for i, (q, t) in rated.items() if t and i in kept]
    good = [i for i, (q, t) in rated.items() if q and not t]
    assert len([i for i in good if i in kept]) >= 0.97 * len(good)


def test_lines_against_a_plain_count(stages):
    before = [(r.doc_id, r.text, r.source) for r in stages[1]]
    assert Counter((r.doc_id, r.text, r.source) for r in stages[2]) == test_lines.brute(before, L.MIN_SITES)
    assert all(r.n_chars == len(r.text) for r in stages[2])


def test_near_duplicates_against_all_pairs(monkeypatch, stages):
    sets = [(r.doc_id, test_minhash.shingles(r.text)) for r in stages[2]]
    kept = {r.doc_id for r in stages[3]}
    links = [(i, j) for n, (i, a) in enumerate(sets) for j, b in sets[n + 1 :] if a and b and 100 * len(a & b) >= C.ALIKE * len(a | b)]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    assert kept == {i for i in root if find(i) == i}


def test_decontamination_against_a_plain_search(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {r[0] for r in test_decontaminate.brute([(r.doc_id, r.text) for r in stages[3]], items) if r[-1]}
    assert {r.doc_id for r in stages[4]} == {r.doc_id for r in stages[3]} - hit


def test_packing_holds_all_that_is_left(stages):
    test_packing.whole(stages[5], [(r.doc_id, r.text) for r in stages[4]])


def test_run_gives_what_the_stages_give(spark, stages):
    got = C.run(spark, SF)
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got.collect()) == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in stages[5])


def test_odd_rows_and_extra_columns_pass_all_stages(spark):
    rows = [(1, None, "en", "a", None, "x"), (2, "", "en", "a", 0, "x"), (3, "w " * 50_000, None, None, 5, "y"), (3, "w " * 50_000, None, None, 5, "y"), (None, "no id here", "en", "b", 10, "z"), (None, "no id here", "en", "c", 10, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for name, stage in C.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name != "quality":
            assert out.count() == len(rows), name
    assert C.packing(spark, docs, SF).count() >= len(rows)
    assert C.packing(spark, docs.limit(0), SF).count() == 0


def test_stages_send_texts_to_python_in_small_batches(spark):
    """Memory of a task is bounded by bytes of texts, not by rows of any length."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("abcdefg "), 1000).alias("text")).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    spark.conf.unset(name)
    for operator in (lambda: score(docs, Model(np.zeros(4), np.array([-2.0, -1.0])), ["doc_id"], "given"), lambda: pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))):
        operator()
        assert spark.conf.get(name) == str(MAX_BATCH_BYTES)
        assert docs.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 1.5 * MAX_BATCH_BYTES
        spark.conf.unset(name)
    spark.conf.set(name, "1000000")
    pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert spark.conf.get(name) == "1000000"
    spark.conf.unset(name)
    assert BLOCK * 8 <= MAX_BATCH_BYTES  # what is held per byte of a block
