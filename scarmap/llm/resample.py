"""Importance resampling towards a target distribution, over hashed runs of words.

A feature is a run of consecutive words, its bucket a checksum. The checksum of two strings joined follows from their
checksums and the length of the second (``joined``), so words need to be hashed once:

1. A count of words gives the frequent ones, at most ``DICTIONARY`` of them.
2. They become an Aho-Corasick automaton of words between delimiters, whose payloads are checksum and length of the word.
   One scan of a text emits the payloads of its words in order; words it does not know are hashed at their place.
   Payloads of neighbours are composed to the checksums of runs.
3. Two scans of the documents: bucket counts, which are added up per task before they move; then, with the gains of all
   buckets, the weight of every document. The draw is a distributed sort by score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.llm import textkit as K
from scarmap.llm.registry import query
from scarmap.llm.shared import ranked, stored, table

RUN = 2
BUCKETS = 10_000
#: documents of fewer words are not drawn; of the others so many in a hundred are
LEAST_WORDS, PERCENT, SEED = 20, 25, 7
#: words of the automaton and bytes of one at most; others are hashed where they stand, with the same result
DICTIONARY, WORD_BYTES = 1 << 16, 32
#: distinct words that a task counts before it passes them on
COUNTED_TOGETHER = 200_000
#: bytes scanned at a time inside a task
BLOCK = 1 << 18

#: byte by byte: A-Z folded, everything but digits, letters and bytes beyond ASCII a blank
PLAIN = bytes(int(K.LOWER[b]) if K.ALNUM[K.LOWER[b]] else 0x20 for b in range(256))


def plain(column: pa.Array) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets) of blocks of texts: words with blanks between and after them."""
    for lo, hi, data, offsets in K.text_blocks(column, BLOCK):
        whole, cuts = data.tobytes().translate(PLAIN), offsets.tolist()
        rows = b"".join(part for a, b in zip(cuts, cuts[1:], strict=False) for part in (whole[a:b], b" "))
        yield lo, hi, rows, offsets + np.arange(len(offsets))


# Checksums are polynomials over GF(2): what a byte does to the 32 bits before it is linear, so appending n zero bytes is
# the product of the matrices of the powers of two in n. `_shift_tables` tabulates each of them by byte of the checksum.

POLYNOMIAL = 0xEDB88320
#: appending up to 2**LONGEST - 1 bytes can be composed
LONGEST = 40


@cache
def _shift_tables() -> np.ndarray:
    """tables[k, b, v]: what value v of byte b of a checksum becomes by 2**k appended zero bytes."""

    def spread(column: np.ndarray) -> np.ndarray:
        values = np.arange(256)
        table = np.zeros((4, 256), dtype=np.uint32)
        for b in range(4):
            for bit in range(8):
                table[b] ^= np.where(values >> bit & 1, column[8 * b + bit], 0).astype(np.uint32)
        return table

    def apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
        return table[0, x & 255] ^ table[1, x >> 8 & 255] ^ table[2, x >> 16 & 255] ^ table[3, x >> 24]

    column = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        column = np.where(column & 1, column >> 1 ^ np.uint32(POLYNOMIAL), column >> 1).astype(np.uint32)
    out = []
    for _ in range(LONGEST):
        out.append(spread(column))
        column = apply(out[-1], column)
    return np.array(out)


def joined(crc_a: np.ndarray, crc_b: np.ndarray, length_b: np.ndarray) -> np.ndarray:
    """Checksums of a + b from those of a and b and the bytes of b."""
    tables = _shift_tables()
    out = crc_a.astype(np.uint32)
    k = 0
    left = length_b.copy()
    while len(left) and left.max():
        odd = np.flatnonzero(left & 1)
        x = out[odd]
        t = tables[k]
        out[odd] = t[0, x & 255] ^ t[1, x >> 8 & 255] ^ t[2, x >> 16 & 255] ^ t[3, x >> 24]
        left >>= 1
        k += 1
    return out ^ crc_b


class Automaton:
    """Frequent words, each between blanks, with payload numbers; checksum and length are looked up by number."""

    def __init__(self, words: list[bytes]):
        self.crc = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        self.found = ahocorasick.Automaton()
        for i, w in enumerate(words):
            self.found.add_word(f" {w.decode('latin-1')} ", i)
        if words:
            self.found.make_automaton()

    def payloads(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(checksum, length) of the words at ``starts`` to ``ends``."""
        crc, length = np.zeros(len(starts), dtype=np.uint32), ends - starts
        known = np.zeros(len(starts), dtype=bool)
        if len(self.crc) and len(starts):
            hits = [*self.found.iter(f" {data.decode('latin-1')}")]
            if hits:
                # a match ends at the blank behind its word, one place late for the blank put in front
                end, number = np.array(hits, dtype=np.int64).T
                word = np.searchsorted(ends, end - 1)
                crc[word], length[word], known[word] = self.crc[number], self.length[number], True
        for i in np.flatnonzero(~known).tolist():
            crc[i] = zlib.crc32(data[starts[i] : ends[i]])
        return crc, length


def runs(automaton: Automaton, data: bytes, offsets: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, checksum) of all runs of 1, 2 .. ``longest`` words that lie inside one row."""
    starts, ends, first = K.find_words(np.frombuffer(data, dtype=np.uint8), offsets, K.ALNUM)
    crc, length = automaton.payloads(data, starts, ends)
    row = K.row_of(first)
    blank = np.full(len(crc), zlib.crc32(b" "), dtype=np.uint32)
    with_blank, so_far, at = joined(blank, crc, length), crc, np.arange(len(crc))
    yield row, crc
    for k in range(1, longest):
        # the run that begins at a word, one word longer: a blank and the k-th word after it
        at = at[at + k < len(crc)]
        at = at[row[at] == row[at + k]]
        grown = np.zeros(len(crc), dtype=np.uint32)
        grown[at] = joined(so_far[at], with_blank[at + k], length[at + k] + 1)
        so_far = grown
        yield row[at], so_far[at]


def frequent_words(texts: DataFrame, most: int = DICTIONARY) -> list[bytes]:
    """The words of all texts that occur at least 2**k times, for the least k > 0 for which they are at most ``most``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            kept = [(w, n) for w, n in held.items() if len(w) <= WORD_BYTES]
            held.clear()
            return pa.record_batch([pa.array([w for w, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for _, _, data, offsets in plain(batch.column(0)):
                cuts = offsets.tolist()
                for a, b in zip(cuts, cuts[1:], strict=False):
                    held.update(data[a:b].split())
                if len(held) > COUNTED_TOGETHER:
                    yield out()
        yield out()

    counts = texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts.where("n > 1").select("word", F.floor(F.log2("n")).cast("int").alias("k")))
    words, least = 0, None
    sizes = sorted(((r.k, r.n) for r in counts.groupBy("k").agg(F.count("*").alias("n")).collect()), reverse=True)
    for k, n in sizes:  # at most 64 rows
        words += n
        if words > most:
            break
        least = k
    if least is None:
        return []
    return sorted(bytes(r.word) for r in counts.where(F.col("k") >= least).select("word").collect())


def bucket_counts(texts: DataFrame, sent, run: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        automaton = Automaton(sent.value)
        for batch in batches:
            for _, _, data, offsets in plain(batch.column(0)):
                for _, crc in runs(automaton, data, offsets, run):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, thousandths of the logarithm of how much likelier it is in the target, counts smoothed by one."""
    s, t, n = source.astype(np.float64), target.astype(np.float64), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weights(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, most: int = DICTIONARY) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row of ``docs`` (doc_id, text); ``target`` (text) shows what is wanted.

    weight is the mean gain of the features, rounded down; without features it is 0. A null text has no words.
    """
    sc = docs.sparkSession.sparkContext
    words = frequent_words(docs.select("text").unionByName(target.select("text")), most)
    sent = sc.broadcast(words)  # at most `most` words of WORD_BYTES
    gain = sc.broadcast(gains(bucket_counts(docs, sent, run, buckets), bucket_counts(target, sent, run, buckets)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(sent.value)
        for batch in batches:
            for lo, hi, data, offsets in plain(batch.column(1)):
                n_words, n, total = np.zeros(hi - lo, dtype=np.int64), np.zeros(hi - lo, dtype=np.int64), np.zeros(hi - lo, dtype=np.int64)
                for k, (row, crc) in enumerate(runs(automaton, data, offsets, run)):
                    found = np.bincount(row, minlength=hi - lo)
                    n += found
                    n_words += found if k == 0 else 0
                    np.add.at(total, row, gain.value[crc % np.uint32(buckets)])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *map(pa.array, (n_words, n, weight))], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, **features) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``docs`` (doc_id, text).

    score is the weight and a Gumbel noise that depends on seed and doc_id alone, so the ``percent`` in a hundred with
    the highest scores, of the documents with ``least_words`` words or more, are a draw without replacement in proportion
    to the likelihood ratio of target and corpus. rank counts the drawn from 1, ties to the smaller doc_id; it is null
    for others.

    A null or empty text has no features, weight 0, and is not drawn. Rows that repeat a doc_id count and compete each on
    its own, with equal noise; a row without doc_id has the noise of an empty id and comes last among ties. With an
    empty target all counts of the target are 0. An empty table gives no rows; other columns are disregarded.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weights(docs, target, **features).withColumn("score", F.col("weight") + noise)
    scored = scored.withColumn("pool", F.when(F.col("n_words") >= least_words, 1).otherwise(0)).drop("n_words")
    placed = ranked(scored, "pool", [F.col("score").desc(), F.col("doc_id").asc_nulls_last()])
    drawn = (F.col("pool") == 1) & (F.col("place") < F.floor(F.lit(percent) * F.col("size") / 100))
    return placed.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place") + 1).alias("rank"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_RUNS = "list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))"

ORACLE = f"""
WITH codes AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, list_transform(range(8), lambda i: i::BIGINT)),
    lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)) AS code),
d AS (SELECT doc_id, row_number() OVER () AS no, {_WORDS} AS words FROM documents),
b AS (SELECT {_WORDS} AS words FROM benchmark),
df AS (SELECT doc_id, no, len(words) AS n_words, {_RUNS} AS runs FROM d),
source AS (SELECT unnest(runs) AS f, no FROM df),
target AS (SELECT unnest({_RUNS}) AS f FROM b),
names AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM (SELECT f FROM source UNION SELECT f FROM target)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, code[1 + (xor(c, x) & 255)])), 4294967295) % {BUCKETS} AS bucket
  FROM names, codes),
s AS (SELECT bucket, count(*) AS n FROM source JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM source) + {BUCKETS})
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM target) + {BUCKETS}))))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
sums AS (SELECT no, count(*) AS n, sum(gain)::BIGINT AS total FROM source JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY no),
scored AS (
  SELECT doc_id, no, n_words, len(runs) AS n_features, coalesce(floor(total::DOUBLE / n)::BIGINT, 0) AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
  FROM df LEFT JOIN sums USING (no)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= {LEAST_WORDS}) AS size FROM scored)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN n_words >= {LEAST_WORDS} AND place <= {PERCENT} * size // 100 THEN place END AS rank FROM placed
"""


@query("op13_resample", ORACLE)
def op13(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
