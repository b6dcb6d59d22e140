"""Best-fit packing of tokenised documents into sequences of bounded length.

Tokenising and placing run over the documents; the search for a good packing needs only how many pieces there are
of each length, at most ``capacity`` numbers whatever the size of the corpus. It gives patterns (a filling of a
sequence and how often it is used); pieces of a length are numbered and dealt to the patterns' places in order.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from scarmap.cluster import bounded_batches
from scarmap.llm.registry import query
from scarmap.llm.shared import stored, table

CAPACITY = 1024
END = 2
#: what the vocabulary has beside the rank file, by the contract's file: found in a text, it is one id
SPECIAL = {"<|endoftext|>": 50256}
#: pieces of one length that one task numbers
RANKED_TOGETHER = 10_000
#: fillings that the search may try in all, and at one place
MAX_NODES, MAX_FILLINGS = 20_000, 64


@cache
def _encoder(path: str):
    """Function from a text to its ids, by the kind of vocabulary file. Both kinds give the same ids, also of SPECIAL.

    The reader of rank files gives up on very long runs of blanks or of other characters of one kind; such a text is read with
    the file of the same name that ends in json, which must lie beside it.
    """
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        return lambda text: t.encode(text, add_special_tokens=False).ids
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    e = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def encode(text: str) -> list[int]:
        try:
            return e.encode(text, allowed_special="all")
        except ValueError:
            return _encoder(path.removesuffix("tiktoken") + "json")(text)

    return encode


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and the end id, cut where longer than ``capacity``.

    All pieces but the first are full, so a document leaves at most one piece to be packed with others.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end], dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                for i, b in enumerate(range(first, len(ids) + 1, capacity)):
                    a = max(b - capacity, 0) if i else 0
                    rows.append((doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by pieces too long to share (for every cut-off)."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    sizes = sorted(counts)
    over = list(accumulate(counts[n] for n in reversed(sizes)))[::-1]
    total = list(accumulate((n * counts[n] for n in sizes), initial=0))
    place = {n: i for i, n in enumerate(sizes)}
    for small in [s for s in sizes if 2 * s <= capacity]:
        big = sum(counts[n] for n in sizes if n > capacity - small)
        i, j = place[small], next((place[n] for n in sizes if n > capacity - small), len(sizes))
        half = next((k for k in range(i, j) if 2 * sizes[k] > capacity), j)
        alone = over[half] - (over[j] if j < len(sizes) else 0) if half < j else 0
        room = alone * capacity - (total[j] - total[half])
        best = max(best, big + alone + max(0, -(-(total[half] - total[i] - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counts: each length from the longest goes where the least room is left that takes it."""
    open_bins: dict[int, list[list]] = {}  # room -> [[filling, how often]]
    done = []
    rooms: list[int] = []
    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            room = min((r for r in rooms if r >= n and open_bins.get(r)), default=None)
            if room is None:
                per = min(capacity // n, left)
                often = left // per
                left -= per * often
                filling, room, n_bins = {n: per}, capacity - n * per, often
            else:
                base, have = open_bins[room].pop()
                per = min(room // n, left)
                n_bins = min(have, left // per)
                if have > n_bins:
                    open_bins[room].append([base, have - n_bins])
                left -= per * n_bins
                filling, room = {**base, n: per}, room - n * per
            open_bins.setdefault(room, []).append([filling, n_bins])
            if room not in rooms:
                rooms.append(room)
    for bins in open_bins.values():
        done += [(tuple(sorted(f.items(), reverse=True)), often) for f, often in bins]
    return done


def fillings(counts: dict[int, int], room: int, waste: int, limit: int = MAX_FILLINGS) -> list[Pattern]:
    """Undominated ways to fill ``room`` with what ``counts`` has and waste at most ``waste``, least waste first.

    A filling is left out if one of its pieces could give way to a longer one that is there and fits, or if
    another piece would still fit: such a filling is dominated, what it leaves over is no easier to pack.
    """
    sizes = [n for n in sorted(counts, reverse=True) if n <= room]
    found: list[tuple[int, Pattern]] = []
    tried = 0

    def search(i: int, left: int, taken: list[tuple[int, int]]) -> None:
        nonlocal tried
        tried += 1
        for j in range(max(i, bisect_left(sizes, -left, key=lambda n: -n)), len(sizes)):
            for k in range(min(counts[sizes[j]], left // sizes[j]), 0, -1):
                if len(found) >= limit or tried > 50 * limit:
                    return
                search(j + 1, left - k * sizes[j], [*taken, (sizes[j], k)])
        if left <= waste and not _dominated(taken, left):
            found.append((left, tuple(taken)))

    def _dominated(taken: list[tuple[int, int]], left: int) -> bool:
        used = dict(taken)
        if any(n <= left and counts[n] > used.get(n, 0) for n in sizes):
            return True
        return left > 0 and any(n < m <= n + left and counts[m] > used.get(m, 0) for n in used for m in range(n + 1, n + left + 1) if m in counts)

    search(0, room, [])
    return [p for _, p in sorted(found, key=lambda x: (x[0], len(x[1]), [-n for n, _ in x[1]]))]


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is used, packing all of ``counts`` (length: number of pieces).

    Best fit decreasing is the first incumbent. The search then takes the longest piece left, tries the undominated
    fillings of the rest of its sequence, uses one as often as stock allows, and goes on; it gives a branch up
    when what it has wasted leaves no packing with fewer sequences than the incumbent. It ends at the lower
    bound or after ``max_nodes`` fillings; the best packing so far is returned.
    """
    counts = {n: c for n, c in counts.items() if c}
    if not counts:
        return []
    best = best_fit(counts, capacity)
    fewest, bound = sum(c for _, c in best), lower_bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    nodes = 0
    # a frame of the search: (stock left, waste so far, fillings still to try), what has been used to get there
    path: list[tuple[Pattern, int]] = []

    def options(stock: dict[int, int], wasted: int) -> Iterator[Pattern]:
        top = max(stock)
        rest = {**stock, top: stock[top] - 1}
        allowed = (fewest - 1) * capacity - total - wasted
        if allowed < 0:
            return iter(())
        rest = {n: c for n, c in rest.items() if c}
        return iter([_with(p, top) for p in fillings(rest, capacity - top, allowed)] or [((top, 1),)] * (capacity - top <= allowed))

    stack = [(counts, 0, options(counts, 0))]
    while stack and fewest > bound and nodes < max_nodes:
        stock, wasted, choices = stack[-1]
        pattern = next(choices, None)
        if pattern is None:
            stack.pop()
            if path:
                path.pop()
            continue
        nodes += 1
        often = min(stock[n] // k for n, k in pattern)
        spare = capacity - sum(n * k for n, k in pattern)
        if spare:
            often = min(often, ((fewest - 1) * capacity - total - wasted) // spare)
        if often <= 0:
            continue
        left = dict(stock)
        for n, k in pattern:
            left[n] -= k * often
        left = {n: c for n, c in left.items() if c}
        path.append((pattern, often))
        if not left:
            best, fewest = list(path), sum(c for _, c in path)
            path.pop()
            continue
        stack.append((left, wasted + spare * often, options(left, wasted + spare * often)))
    return best


def _with(pattern: Pattern, n: int) -> Pattern:
    return tuple(sorted((Counter(dict(pattern)) + Counter({n: 1})).items(), reverse=True))


def _places(patterns: list[tuple[Pattern, int]]) -> list[tuple]:
    """(length, first rank, rank after the last, first sequence, pieces per sequence, offset) of every pattern's places."""
    ranks: Counter = Counter()
    sequence, out = 0, []
    for pattern, often in patterns:
        offset = 0
        for n, k in pattern:
            out.append((n, ranks[n], ranks[n] + k * often, sequence, k, offset))
            ranks[n] += k * often
            offset += n * k
        sequence += often
    return out


def _numbered(cut: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``cut`` with ``rank``: its number among the pieces of its length. A length with many is numbered in parts."""
    parts = [(n, -(-c // RANKED_TOGETHER)) for n, c in counts.items()]
    many = F.broadcast(cut.sparkSession.createDataFrame(parts, "length long, _parts int"))  # at most `capacity` rows
    dealt = cut.join(many, "length").withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "_parts"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n")).withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "start", "ids_crc32")
    return dealt.withColumn("_i", F.row_number().over(inside) - 1).join(first, ["length", "_part"]).withColumn("rank", F.col("_first") + F.col("_i"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, max_nodes: int = MAX_NODES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every row of ``docs`` (doc_id, text).

    A null or empty text is the end id alone. Rows that repeat a doc_id are packed each on its own, as are rows without
    one. An empty table gives no rows; other columns are disregarded. Sequence ids run from 0 without gaps.
    """
    cut = stored(pieces(docs, tokenizer, capacity, end))
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    places = np.array(sorted(_places(complete_bins(counts, capacity, max_nodes))), dtype=np.int64).reshape(-1, 6)
    numbered = _numbered(cut, counts).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    sent = docs.sparkSession.sparkContext.broadcast(places)  # a few rows per length, whatever the size of the corpus
    top = max([*counts.values(), 1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        keys = p[:, 0] * (top + 1) + p[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            at = p[np.searchsorted(keys, length * (top + 1) + rank, "right") - 1]
            inside, slot = np.divmod(rank - at[:, 1], at[:, 4])
            yield pa.record_batch([*batch.columns[:5], pa.array(at[:, 3] + inside), pa.array(at[:, 5] + slot * length)], schema.names)

    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(place, schema)


@query("op6_packing")
def op6(spark, sf_dir):
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
