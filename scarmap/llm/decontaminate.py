"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

Each item is cut into windows of consecutive words; a window is a set of short shingles. As a window must be
contained whole, one of its shingles is a sufficient prefix, and the one that is rarest in the documents is
taken. Documents are probed for those prefix shingles alone. A probe that meets one gives the only place where
the window can lie (position bound), which must be inside the document (length bound); its words are then
compared one by one.

Two scans of the documents: shingle counts, then probes. The windows are sent to the executors in slices of
bounded size; a benchmark of several slices takes a pair of scans for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scarmap.cluster import bounded_batches
from scarmap.llm import textkit as K
from scarmap.llm.registry import query
from scarmap.llm.shared import fresh, stored, table

WINDOW = 10
SHINGLE = 3
#: windows with their items in one slice; 100 bytes each
SLICE_ROWS = 200_000
LONGS = T.ArrayType(T.LongType())
FOUND = T.StructType().add("n_words", T.LongType()).add("spans", LONGS).add("items", LONGS)


@dataclass(frozen=True)
class Probes:
    """Windows of one slice whose prefix shingles have ``size`` words, filed under these."""

    size: int
    tokens: np.ndarray  # sorted distinct prefix shingles
    first: np.ndarray  # per token: where its windows begin in the arrays below
    at: np.ndarray  # the shingle's place inside the window
    length: np.ndarray
    words: np.ndarray  # windows x longest length
    seen: np.ndarray  # filter on the upper bits of tokens
    item_first: np.ndarray
    items: np.ndarray


def _filter(tokens: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << 20, dtype=bool)
    seen[tokens >> np.uint64(44)] = True
    return seen


def _lookup(g: np.ndarray, tokens: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into g, index into tokens) of the entries of ``g`` that are tokens."""
    at = np.flatnonzero(seen[g >> np.uint64(44)])
    where = np.searchsorted(tokens, g[at])
    where[where == len(tokens)] = 0
    hit = tokens[where] == g[at]
    return at[hit], where[hit]


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, item_id): distinct windows of the items as arrays of word hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, _, data, offsets in K.text_blocks(batch.column(1)):
                h, rows = K.words_of(data, offsets, K.ALNUM)
                words, items = [], []
                for i in range(len(rows) - 1):
                    own = K.signed(h[rows[i] : rows[i + 1]])
                    for j in range(max(len(own) - window + 1, min(len(own), 1))):
                        words.append(own[j : j + window])
                        items.append(ids[lo + i])
                yield pa.record_batch([pa.array(words, pa.list_(pa.int64())), pa.array(items, pa.int64())], ["words", "item_id"])

    named = benchmark.where("item_id is not null").select(F.col("item_id").cast("long"), "text")
    return named.mapInArrow(cut, "words array<long>, item_id long").distinct()


def _shingles_of(words: np.ndarray) -> np.ndarray:
    return K.grams(words, min(SHINGLE, len(words)))


def _counts(texts: DataFrame, wanted: dict[int, np.ndarray]) -> dict[int, int]:
    """How often the shingles ``wanted`` (by size) occur in all texts."""
    sent = texts.sparkSession.sparkContext.broadcast({k: (v, _filter(v)) for k, v in wanted.items()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(len(v), dtype=np.int64) for k, (v, _) in sent.value.items()}
        for batch in batches:
            for *_, data, offsets in K.text_blocks(batch.column(0)):
                h, rows = K.words_of(data, offsets, K.ALNUM)
                for k, (tokens, seen) in sent.value.items():
                    total[k] += np.bincount(_lookup(K.row_grams(h, rows, k)[0], tokens, seen)[1], minlength=len(tokens))
        for k, (tokens, _) in sent.value.items():
            some = np.flatnonzero(total[k])
            yield pa.record_batch([pa.array(K.signed(tokens[some])), pa.array(total[k][some])], ["token", "n"])

    rows = texts.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r.token: r.n for r in rows}


def _probes(rows: list, texts: DataFrame) -> list[Probes]:
    """Each window of ``rows`` (words, item_id) under its rarest shingle; windows with an absent one are left out."""
    items: dict[tuple, list[int]] = {}
    for r in rows:
        items.setdefault(tuple(r.words), []).append(r.item_id)
    whole = [np.array(w, dtype=np.int64).view(np.uint64) for w in sorted(items)]
    grams = [_shingles_of(w) for w in whole]
    sizes = np.array([min(SHINGLE, len(w)) for w in whole])
    wanted = {int(k): np.unique(np.concatenate([grams[i] for i in np.flatnonzero(sizes == k)])) for k in np.unique(sizes)}
    counts = _counts(texts, wanted)
    out = []
    for k in wanted:
        filed = []
        for i in np.flatnonzero(sizes == k):
            n = [counts.get(x, 0) for x in K.signed(grams[i]).tolist()]
            if min(n):
                at = n.index(min(n))
                filed.append((int(grams[i][at]), at, i))
        filed.sort()
        if not filed:
            continue
        tokens, first = np.unique(np.array([f[0] for f in filed], dtype=np.uint64), return_index=True)
        own = [whole[f[2]] for f in filed]
        words = np.zeros((len(own), max(map(len, own))), dtype=np.uint64)
        for line, w in zip(words, own, strict=True):
            line[: len(w)] = w
        named = [items[tuple(K.signed(w).tolist())] for w in own]
        out.append(Probes(
            k, tokens, np.append(first, len(filed)), np.array([f[1] for f in filed]), np.array([len(w) for w in own]), words, _filter(tokens),
            np.concatenate([[0], np.cumsum([len(x) for x in named])]), np.array([i for x in named for i in x], dtype=np.int64),
        ))
    return out


def _occurrences(h: np.ndarray, offsets: np.ndarray, p: Probes) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of all windows that occur in a block of texts."""
    g, at = K.row_grams(h, offsets, p.size)
    hit, token = _lookup(g, p.tokens, p.seen)
    fan = p.first[token + 1] - p.first[token]
    window = np.repeat(p.first[token] - np.concatenate([[0], np.cumsum(fan)[:-1]]), fan) + np.arange(fan.sum()) if len(fan) else np.zeros(0, dtype=np.int64)
    where = np.repeat(at[hit], fan)
    row = np.searchsorted(offsets, where, "right") - 1
    start = where - p.at[window]
    inside = (start >= offsets[row]) & (start + p.length[window] <= offsets[row + 1])
    start, window = start[inside], window[inside]
    for j in range(p.words.shape[1]):
        same = p.length[window] <= j
        same[~same] = h[start[~same] + j] == p.words[window[~same], j]
        start, window = start[same], window[same]
    return start, window


def _runs(covered: np.ndarray) -> list[int]:
    """[start, end, start, end, ...] of the runs of True."""
    return np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]))).tolist()


def _probe(texts: DataFrame, probes: list[Probes], keep: list[str], name: str) -> DataFrame:
    """Column ``name`` (n_words, spans of hit words, items), added to what an earlier slice has found."""
    sent = texts.sparkSession.sparkContext.broadcast(probes)
    schema = T.StructType([*[texts.schema[c] for c in keep], T.StructField(name, FOUND)])
    kinds = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.int64()))])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(batch.schema.get_field_index(name)).to_pylist() if name in batch.schema.names else [None] * batch.num_rows
            found = []
            for lo, hi, data, offsets in K.text_blocks(batch.column(batch.schema.get_field_index("text"))):
                h, rows = K.words_of(data, offsets, K.ALNUM)
                covered, items = np.zeros(len(h) + 1, dtype=np.int32), {}
                for p in sent.value:
                    start, window = _occurrences(h, rows, p)
                    np.add.at(covered, start, 1)
                    np.add.at(covered, start + p.length[window], -1)
                    row = np.searchsorted(rows, start, "right") - 1
                    for r, w in np.unique(np.stack([row, window], 1), axis=0).tolist():
                        items.setdefault(r, set()).update(p.items[p.item_first[w] : p.item_first[w + 1]].tolist())
                covered = np.cumsum(covered) > 0
                for r in range(hi - lo):
                    a, b = rows[r], rows[r + 1]
                    before = old[lo + r] or {"spans": [], "items": []}
                    spans = before["spans"]
                    if r in items:
                        inside = covered[a:b].copy()
                        for s, e in zip(spans[::2], spans[1::2], strict=True):
                            inside[s:e] = True
                        spans = _runs(inside)
                    found.append({"n_words": int(b - a), "spans": spans, "items": sorted(items.get(r, set()) | set(before["items"]))})
            yield pa.record_batch([*[batch.column(batch.schema.get_field_index(c)) for c in keep], pa.array(found, kinds)], schema.names)

    return texts.mapInArrow(probe, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], name: str, window: int = WINDOW, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``keep`` columns of ``docs`` and, as ``name``, each text's n_words, spans of hit words [start, end, ...] and item ids.

    Item ids are whole numbers; others are an error. A null text has no words. Items without words, text or item_id take no part; items that repeat count once per
    item_id. Documents are judged row by row, so repeated and null doc_ids do no harm. With an empty benchmark or
    no documents nothing is hit. ``name`` must not be a column of ``docs`` (``shared.fresh`` gives one).
    """
    bounded_batches(docs.sparkSession)
    cut = stored(windows(benchmark, window))
    slices = -(-cut.count() // slice_rows)
    for i in range(max(slices, 1)):  # a window of many items is dealt to several slices; what they find is united
        rows = cut.where(F.pmod(F.xxhash64("words", "item_id"), F.lit(max(slices, 1))) == i).collect()
        last = i + 1 >= slices
        docs = _probe(docs, _probes(rows, docs), keep if last else [*docs.columns[: len(docs.columns) - (i > 0)]], name)
        if not last:
            docs = stored(docs)
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs`` (doc_id, text)."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark, ["doc_id"], "found", window, slice_rows)
    names = F.array_sort(F.transform("found.items", lambda x: x.cast("string")))
    signed = F.transform("found.spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256")).withColumn("contaminated", F.col("n_hit") > 0)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows of ``docs`` without any hit word, all columns as they are."""
    name = fresh(docs, "found")
    return find_contamination(docs, benchmark, docs.columns, name, window, slice_rows).where(F.size(F.col(name)["items"]) == 0).select(*docs.columns)


@query("op10_decontaminate")
def op10(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
