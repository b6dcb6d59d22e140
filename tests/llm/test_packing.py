"""Packing: the search against small optima, and whole jobs by taking the sequences apart again."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scarmap.llm import packing as P

SF = "/root/testdata/sf0.001"
RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def optimum(items, capacity):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for r in sorted(set(bins)):
            if r >= items[i]:
                rest = list(bins)
                rest.remove(r)
                go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best[0]


def test_search_reaches_small_optima_within_bounds():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.randrange(5, 40)
        items = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10))), reverse=True)
        counts = Counter(items)
        found = P.complete_bins(counts, capacity)
        back = Counter()
        for pattern, often in found:
            assert sum(n * k for n, k in pattern) <= capacity
            for n, k in pattern:
                back[n] += k * often
        best = optimum(items, capacity)
        assert back == counts and P.lower_bound(counts, capacity) <= best == sum(o for _, o in found)
    assert P.complete_bins({}) == []


def test_large_counts_come_close_to_the_bound():
    rng = np.random.default_rng(2)
    counts = Counter(np.clip(rng.lognormal(5.5, 1, 50_000).astype(int), 1, 1024).tolist())
    used = sum(o for _, o in P.complete_bins(counts))
    assert used <= P.lower_bound(counts, 1024) * 1.0005 and used <= sum(o for _, o in P.best_fit(counts, 1024))


def whole(rows, texts, capacity=1024):
    """Checks that ``rows`` hold all of ``texts`` [(doc_id, text)] and lie in sequences without gaps or overlaps."""
    t = Tokenizer.from_file(JSON)
    want = Counter()
    for doc, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        n = -(-len(ids) // capacity)
        first = len(ids) - capacity * (n - 1)
        for i in range(n):
            a, b = (0 if i == 0 else first + capacity * (i - 1)), first + capacity * i
            want[(doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("together", [P.RANKED_TOGETHER, 7])
def test_whole_table(spark, monkeypatch, together):
    monkeypatch.setattr(P, "RANKED_TOGETHER", together)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.pack(docs, RANKS).collect()
    used = whole(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= -(-sum(r.length for r in rows) // 1024) * 1.01 + 1


def test_edge_cases_and_both_vocabularies(spark):
    texts = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "x y"), (4, "word " * 3000), (5, " " * 2047 + "é"), (6, "<|endoftext|>"[:5])] + [(i, "same text here") for i in range(10, 400)]
    docs = spark.createDataFrame([(*t, "z", 0) for t in texts], "doc_id long, text string, offset string, rank int")
    for path in (RANKS, JSON):
        whole(P.pack(docs, path).collect(), texts)
    assert P.pack(docs.limit(0), RANKS).collect() == []
    assert whole(P.pack(docs, RANKS, capacity=64).collect(), texts, 64)


def test_exactly_full_pieces(spark):
    t = Tokenizer.from_file(JSON)
    texts = [(i, " a" * n) for i, n in enumerate((1022, 1023, 1024, 2047, 2048))]
    assert [len(t.encode(x, add_special_tokens=False).ids) for _, x in texts] == [1022, 1023, 1024, 2047, 2048]
    whole(P.pack(spark.createDataFrame(texts, "doc_id long, text string"), RANKS).collect(), texts)


def test_special_tokens_in_texts_are_one_id(spark):
    mark = "<|endoftext|>"
    texts = [(1, f"a{mark}b"), (2, mark), (3, f"{mark}{mark} {mark}\n{mark}"), (4, f"some words {mark} " * 700), (5, f"<|endoftext{mark}|>"), (6, f" {mark}  x  {mark} ")]
    t = Tokenizer.from_file(JSON)
    assert t.encode(texts[0][1], add_special_tokens=False).ids == [64, 50256, 65]
    for path in (RANKS, JSON):
        assert [P._encoder(path)(x) for _, x in texts] == [t.encode(x, add_special_tokens=False).ids for _, x in texts]
        whole(P.pack(spark.createDataFrame(texts, "doc_id long, text string"), path).collect(), texts)


@pytest.mark.parametrize("run", [" ", "\t", "\n", "\r\n", " \u00a0"])
def test_runs_of_a_million_characters_are_read(run):
    text = "a" + run * (1_000_000 // len(run)) + "b <|endoftext|>"
    ranks, contract = (P._encoder(public_tokenizers.path(f"byte_bpe_50k.{kind}")) for kind in ("tiktoken", "json"))
    assert ranks(text) == contract(text)


def test_a_text_with_a_long_run_is_packed(spark):
    rows = [(1, "a" + " " * 1_000_000 + "b"), (2, "short text"), (3, "\n" * 1_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).groupBy("doc_id").sum("length").collect()
    contract = P._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r[0]: r[1] for r in got} == {doc: len(contract(text)) + 1 for doc, text in rows}
