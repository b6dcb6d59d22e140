"""Encodings by the table of last pieces against the library's own."""

import hashlib
import random
import time
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scarmap.llm import sentencepieces as S

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
OURS = S.Pieces(MODEL)


@settings(max_examples=1500, deadline=None)
@given(st.text(max_size=60) | st.text("ab ▁e\n", max_size=80) | st.text(" theinromsd", max_size=80) | st.text(" ", max_size=120))
def test_any_text(text):
    assert OURS.encode(text) == LIBRARY.encode(text)


def test_strings_of_pieces_without_blanks():
    rng = random.Random(1)
    names = [p for p in OURS.number if p.isascii()]
    for _ in range(3000):
        text = "".join(rng.choice(names) for _ in range(rng.randrange(1, 12))).replace(S.BLANK, rng.choice(["", " ", S.BLANK]))
        assert OURS.encode(text) == LIBRARY.encode(text), text


def test_names_of_special_pieces_are_text():
    for text in ["<s>hi</s>", "<unk>", "<0x41>", "</s>", "<0x0A>\n", "\x00", "﻿a", " "]:
        assert OURS.encode(text) == LIBRARY.encode(text)


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000 + "b", "\t\n" * 100_000, "ab" * 150_000, "0123456789abcdef" * 20_000, "é東\x00" * 50_000, "a▁" * 50_000, ("the " * 15 + "end") * 3000])
def test_long_runs_take_linear_time(text):
    began = time.time()
    assert OURS.encode(text) == LIBRARY.encode(text)
    assert time.time() - began < 30


def test_one_part_without_cuts_gives_the_same():
    text = "The quick brown fox,\njumps  over   the lazy dog. " * 20
    assert OURS.encode_part((" " + text.replace("\n", " ")).replace(" ", S.BLANK)) == LIBRARY.encode(text.replace("\n", " "))


def test_the_memory_of_a_task_is_bounded(monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED", 50)
    own, rng = S.Pieces(MODEL), random.Random(2)
    for _ in range(300):
        text = " ".join("".join(rng.choices("etaoinshr", k=rng.randrange(1, 9))) for _ in range(5))
        assert own.encode(text) == LIBRARY.encode(text)
    assert len(own.known) + len(own.older) <= 50 and len(own.pairs) <= 50


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_rows(spark):
    rows = [(1, "Hello  world\n"), (1, "Hello  world\n"), (2, None), (3, ""), (None, " x"), (None, None), (4, "é" * 100_000), (5, "▁a"), (6, "w" * 400_000 + " " * 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("token"), F.lit("x").alias("decoded"))
    got = S.decode(S.encode(docs, MODEL, ids="i"), MODEL, ids="i", name="back")
    assert got.columns == ["doc_id", "text", "token", "decoded", "i", "back"]
    want = Counter()
    for doc, text in rows:
        ids = [*LIBRARY.encode(text or ""), 2]
        want[(doc, text, 1, "x", tuple(ids), LIBRARY.decode(ids))] += 1
    assert Counter((*r[:4], tuple(r.i), r.back) for r in got.collect()) == want
    assert S.decode(S.encode(docs.limit(0), MODEL), MODEL, name="back").collect() == []
    with pytest.raises(ValueError):
        S.encode(docs, MODEL, ids="Decoded")
    with pytest.raises(ValueError):
        S.decode(S.encode(docs, MODEL), MODEL)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = [*LIBRARY.encode(r.text or ""), 2]
        want[(r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids)))] += 1
    assert Counter(tuple(r) for r in S.op12(spark, sf).collect()) == want


def test_refuses_models_of_another_kind(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    with open(MODEL, "rb") as f:
        model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        S.Pieces(str(tmp_path / "other.model"))


def test_remembered_parts_are_packed():
    """Ids of a text are joined from parts of four bytes an id, remembered or not."""
    pieces = S.Pieces(MODEL)
    for text in ("a few words, a few words", "a few more", ""):
        assert pieces.packed(text) == b"".join(i.to_bytes(4, "little") for i in LIBRARY.encode(text))
    assert all(isinstance(ids, bytes) for ids in pieces.known.values())
