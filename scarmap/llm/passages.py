"""Repeated passages across documents: shared k-mer seeds, collinear chaining, alignment.

1. Words are hashed; every k-mer is a seed. Seeds that an Arrow batch has several times are matched to their first place
   there at once, as segments, and one per batch goes into the shuffle, packed with others of its part of the hash space:
   a passage that a third of all documents have does not gather in one task.
2. In the shuffle a seed's places are matched to the first of them (a star), never to each other.
3. Matches of a pair of documents are merged along diagonals into segments, and segments are chained with gap costs by a
   Fenwick tree of best chains that end to the left and below.
4. Chains that are long enough are aligned on the texts: segments word by word, gaps between them by common
   subsequences, ends as far as matches do not fall far behind mismatches. Of the aligned words all stretches that are
   long and equal enough are passages, so that a gap between two passages costs neither of them.
5. A chain that has no passage is open: the first holder of its seeds has too little of what a later one may share with
   another. Around the open chains, on both sides, longer k-mers up to the least length of a passage are seeds of a second
   turn of 1 to 4. A first holder of such a seed has that much more, and one of the longest seed has a passage itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scarmap.cluster import checked_broadcast
from scarmap.llm import textkit as K
from scarmap.llm.registry import query
from scarmap.llm.shared import star_units, stored, table, with_texts

SEED_WORDS = 5
#: words of the seeds of the second turn; the last is set to the least words of a passage
LONG_SEEDS = (14, 28)
#: the second turn takes texts by blocks of so many words
BLOCK = 64
#: log2 of the parts of the hash space; what a batch has in one of them is one row of the shuffle
BUCKET_BITS = 14
#: matches on one diagonal so many words apart are one segment
JOIN = 8
#: a passage has at least so many words on either side, and so many percent of the longer side's words in common
MIN_WORDS, MIN_PERCENT = 50, 80
#: a chain is aligned if it spans so many words
CHAIN_WORDS = 14
#: cost of a skipped word, on either side, in words
GAP_COST = 0.1
#: bits of the largest table of common subsequences that is kept whole, and how far matches may fall behind mismatches at an end
TABLE_BITS, DROP = 1 << 27, 40


def _again(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """How many equal entries of the same row stand before each entry."""
    order = np.lexsort((row, h))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    count = np.arange(len(h)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    out = np.empty(len(h), dtype=np.uint64)
    out[order] = count
    return out


def _longer(h: np.ndarray, cuts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every ``k`` words inside a row, more than SEED_WORDS, from the hashes of the SEED_WORDS that cover them."""
    g, at = K.grams(h, SEED_WORDS), [*range(0, k - SEED_WORDS, SEED_WORDS), k - SEED_WORDS]
    n = max(len(g) - at[-1], 0)
    out = np.full(n, np.uint64(k), dtype=np.uint64)
    for i, j in enumerate(at):
        out += g[j : j + n] * K.ODD[i]
    rows = K.row_of(cuts)
    inside = np.flatnonzero(rows[:n] == rows[k - 1 :]) if n else np.zeros(0, dtype=np.int64)
    return K.mix(out[inside]), inside


def _around(blocks: list[int], words: int) -> np.ndarray:
    """Which of ``words`` words lie in one of the ``blocks``."""
    on = np.zeros(words // BLOCK + 1, dtype=bool)
    at = np.array(blocks, dtype=np.int64)
    on[at[at < len(on)]] = True
    return np.repeat(on, BLOCK)[:words]


def _seeds(batch: pa.RecordBatch, sizes: tuple[int, ...]) -> tuple[np.ndarray, ...]:
    """(hash, doc_id, first word, number of its size in ``sizes``) of the seeds of a batch (doc_id, text, blocks if any).

    A seed that a text repeats is given once more, hashed with its number there, so that repetitions meet in order.
    Where a batch has blocks, seeds lie inside those.
    """
    ids = batch.column(0).to_numpy()
    found = [(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.uint8))]
    for lo, hi, data, offsets in K.text_blocks(batch.column(1)):
        h, cuts = K.words_of(data, offsets, K.VISIBLE)
        if batch.num_columns > 2:
            blocks = batch.column(2).slice(lo, hi - lo).to_pylist()
            wanted = [_around(r, int(n)) for r, n in zip(blocks, np.diff(cuts), strict=True)]
            inside = np.concatenate([[0], np.cumsum(np.concatenate([*wanted, np.zeros(0, dtype=bool)]))])
        for number, size in enumerate(sizes):
            g, at = K.row_grams(h, cuts, size) if size == SEED_WORDS else _longer(h, cuts, size)
            if batch.num_columns > 2:
                own = inside[at + size] - inside[at] == size
                g, at = g[own], at[own]
            row = np.searchsorted(cuts, at, "right") - 1
            times = _again(g, row)
            more = times > 0
            g = np.concatenate([g, K.mix(g[more] ^ (times[more] * K.ODD[1]))])
            row, at = np.concatenate([row, row[more]]), np.concatenate([at, at[more]])
            found.append((g, ids[lo + row], (at - cuts[row]).astype(np.int32), np.full(len(g), number, dtype=np.uint8)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


SEEDS = "bucket long, doc long, other long, pos int, other_pos int, words int, seeds binary"
SEGMENTS = "doc long, other long, pos int, other_pos int, words int"
#: bytes of a packed seed: of its hash, doc_id and place
PACKED = (5, 8, 4)


def _planes(h: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Seeds as columns of bytes, one row per byte, so that equal bytes are neighbours."""
    columns = (h.astype("<u8"), doc.astype("<i8"), pos.astype("<i4"))
    return np.concatenate([c.view(np.uint8).reshape(len(c), c.itemsize)[:, :n].T for c, n in zip(columns, PACKED, strict=True)])


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(sum(PACKED), -1)
    out, at = [], 0
    for n, kind in zip(PACKED, ("<u8", "<i8", "<i4"), strict=True):
        wide = np.zeros((planes.shape[1], np.dtype(kind).itemsize), dtype=np.uint8)
        wide[:, :n] = planes[at : at + n].T
        out.append(wide.reshape(-1).view(kind))
        at += n
    return tuple(out)


def _star(h: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of each hash's first seed by (doc, pos); of the others that are in another document, and of their first."""
    order = np.lexsort((pos, doc, h))
    k = h[order]
    first = np.ones(len(k), dtype=bool)
    first[1:] = k[1:] != k[:-1]
    head = order[np.flatnonzero(first)[np.cumsum(first) - 1]]
    hit = ~first & (doc[order] != doc[head])
    return order[first], order[hit], head[hit]


def segments(pos: np.ndarray, other: np.ndarray, words: np.ndarray, doc: np.ndarray | None = None, far: np.ndarray | None = None) -> np.ndarray:
    """(first word, first word on the other side, words) of the runs of matches on one diagonal, after (doc, far) if given."""
    by = [] if doc is None else [far, doc]
    order = np.lexsort((pos, pos - other, *by))
    pos, other, words, by = pos[order].astype(np.int64), other[order].astype(np.int64), words[order], [x[order] for x in by[::-1]]
    turn = np.ones(len(pos), dtype=bool)  # another diagonal
    turn[1:] = (pos - other)[1:] != (pos - other)[:-1]
    for x in by:
        turn[1:] |= x[1:] != x[:-1]
    lift = np.cumsum(turn) << 32
    end = np.maximum.accumulate(lift + pos + words) - lift
    new = turn.copy()
    new[1:] |= pos[1:] > end[:-1] + JOIN
    start = np.flatnonzero(new)
    last = np.append(start, len(pos))[1:] - 1
    return np.stack([*(x[start] for x in by), pos[start], other[start], end[last] - pos[start]], 1)


def _seed_rows(sizes: tuple[int, ...]):
    """Seeds of a batch, each hash once, packed by size and bucket; a batch's other places of it with the first as partner,
    as segments under a number of the pair, so that they are spread."""
    words = np.array(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, doc, pos, number = _seeds(batch, sizes)
            one, more, head = _star(h, doc, pos)
            found = segments(pos[more], pos[head], words[number[more]], doc[more], doc[head])
            one.sort()
            bucket = (h[one] >> np.uint64(64 - BUCKET_BITS)).astype(np.int32) | number[one].astype(np.int32) << BUCKET_BITS
            turn = np.argsort(bucket, kind="stable")
            order, bucket = one[turn], bucket[turn].astype(np.int64)
            del turn, one, more, head
            planes = _planes(h[order], doc[order], pos[order])
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(bucket) else np.zeros(1, dtype=np.int64)
            blobs = [planes[:, a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            spread = K.signed(K.mix(found[:, 0].astype(np.uint64) * K.ODD[0] + found[:, 1].astype(np.uint64)))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.record_batch(
                [
                    pa.array(np.concatenate([bucket[cuts[:-1]], spread])),
                    *[pa.concat_arrays([pa.nulls(len(blobs), k), pa.array(found[:, i]).cast(k)]) for i, k in enumerate(kinds)],
                    pa.array([*blobs, *[None] * len(found)], pa.binary()),
                ],
                [c.split()[0] for c in SEEDS.split(", ")],
            )

    return run


def _matches(sizes: tuple[int, ...]):
    """Rows sorted by bucket: segments pass; of the seeds all but a hash's first are matched to that."""
    names = [c.split()[0] for c in SEGMENTS.split(", ")]

    def solve(rows: list[tuple[int, bytes]]):
        buckets, blobs = zip(*rows, strict=True)
        h, doc, pos = (np.concatenate(x) for x in zip(*map(_unpacked, blobs), strict=True))
        bucket = np.repeat(np.array(buckets), [len(b) // sum(PACKED) for b in blobs])
        h = h | (bucket & ((1 << BUCKET_BITS) - 1)).astype(np.uint64) << np.uint64(64 - BUCKET_BITS)
        _, more, head = _star(h, doc, pos)
        columns = [doc[more], doc[head], pos[more], pos[head], np.array(sizes, dtype=np.int32)[bucket[more] >> BUCKET_BITS]]
        return pa.record_batch([pa.array(c) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        for batch in batches:  # the last bucket of a batch may go on in the next
            packed = batch.column(6).is_valid()
            there = batch.filter(pa.compute.invert(packed))
            if there.num_rows:
                yield pa.record_batch([there.column(i) for i in range(1, 6)], names)
            mine = batch.filter(packed)
            held += zip(mine.column(0).to_pylist(), mine.column(6).to_pylist(), strict=True)
            cut = len(held)
            while cut and held[cut - 1][0] == held[-1][0]:
                cut -= 1
            if cut:
                yield solve(held[:cut])
                held = held[cut:]
        if held:
            yield solve(held)

    return run


def chains(runs: np.ndarray, seed: int = SEED_WORDS, gap: float = GAP_COST) -> list[np.ndarray]:
    """Collinear chains of segments, best first, each segment in one of them.

    A chain is worth the words of its segments less ``gap`` for every word skipped on either side. As that cost is the
    difference of two places, the best predecessor of a segment is the largest f + gap * (end + other end) among the
    segments that end before it on both sides: a prefix maximum, kept in a Fenwick tree over the other side's ends.
    Segments may overlap by less than a seed.
    """
    n = len(runs)
    if n == 1:
        return [runs]
    start, other, size = runs[:, 0], runs[:, 1], runs[:, 2]
    end, other_end = start + size - seed + 1, other + size - seed + 1
    ranks = np.unique(other_end)
    place = np.searchsorted(ranks, other_end) + 1
    reach = np.searchsorted(ranks, other, "right")
    tree: list[tuple[float, int]] = [(0.0, -1)] * (len(ranks) + 1)
    worth, before = np.zeros(n), np.full(n, -1)
    events = sorted([(int(start[i]), 1, i) for i in range(n)] + [(int(end[i]), 0, i) for i in range(n)])
    for _, opens, i in events:
        if opens:
            best, r = (-np.inf, -1), int(reach[i])
            while r:
                if tree[r][1] >= 0:
                    best = max(best, tree[r])
                r -= r & -r
            worth[i] = size[i]
            joined = best[0] - gap * (start[i] + other[i])
            if joined > 0:
                worth[i] += joined
                before[i] = best[1]
        else:
            mine, r = (worth[i] + gap * (end[i] + other_end[i]), i), int(place[i])
            while r < len(tree):
                if tree[r][1] < 0 or mine > tree[r]:
                    tree[r] = mine
                r += r & -r
    out, used = [], np.zeros(n, dtype=bool)
    for i in np.argsort(-worth, kind="stable"):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(runs[chain[::-1]])
    return out


def _chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of documents the chains that are long enough: [segments, first, other first, words, ..., segments, ...]."""
    held: list[pa.RecordBatch] = []

    def solve(rows: pa.RecordBatch):
        doc, other, pos, other_pos, words = (rows.column(i).to_numpy() for i in range(5))
        cuts = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (other[1:] != other[:-1]), [True]]))
        out = []
        spans = [np.maximum.reduceat(x + words, cuts[:-1]) - np.minimum.reduceat(x, cuts[:-1]) for x in (pos, other_pos)] if len(doc) else [cuts[:-1]] * 2
        long = np.flatnonzero(np.minimum(*spans) >= CHAIN_WORDS)
        for a, b in zip(cuts[long], cuts[long + 1], strict=True):
            flat: list[int] = []
            for chain in chains(segments(pos[a:b], other_pos[a:b], words[a:b])):
                last = chain[-1]
                if min(last[0] + last[2] - chain[0, 0], last[1] + last[2] - chain[0, 1]) >= CHAIN_WORDS:
                    flat += [len(chain), *chain.reshape(-1).tolist()]
            if flat:
                out.append((int(doc[a]), int(other[a]), flat))
        d, o, f = zip(*out, strict=True) if out else ((), (), ())
        return pa.record_batch([pa.array(d, pa.int64()), pa.array(o, pa.int64()), pa.array(f, pa.list_(pa.int32()))], ["member", "center", "chains"])

    for batch in batches:  # the last pair of a batch may go on in the next
        if not batch.num_rows:
            continue
        doc, other = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edge = np.flatnonzero((doc != doc[-1]) | (other != other[-1]))
        cut = int(edge[-1]) + 1 if len(edge) else 0
        if cut or (held and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) != (doc[0], other[0])):
            whole = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()
            for rows in whole:
                yield solve(rows)
            held = []
        held.append(batch.slice(cut))
    for rows in pa.Table.from_batches(held).combine_chunks().to_batches() if held else []:
        yield solve(rows)


def _bit_rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Per word of ``a`` the row of the table of common subsequences with ``b``: bit j is 0 where it grows at word j."""
    masks: dict[int, int] = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for x in a:
        hit = row & masks.get(x, 0)
        row = (row + hit | row - hit) & full
        yield row


def _growth(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and every prefix of ``b``."""
    *_, row = _bit_rows(a, b)
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(b) // 8), "little"), dtype=np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _subsequence(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; ``a`` is halved while the table has more than TABLE_BITS."""
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > TABLE_BITS:
        half = len(a) // 2
        cut = int((_growth(a[:half], b) + _growth(a[half:][::-1], b[::-1])[::-1]).argmax())
        return _subsequence(a[:half], b[:cut]) + [(half + i, cut + j) for i, j in _subsequence(a[half:], b[cut:])]
    rows = list(_bit_rows(a, b))
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            j -= 1
            out.append((i, j))
    return out[::-1]


def _matched(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of a longest common subsequence."""
    i, j = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    pairs = np.array(_subsequence(a[i].tolist(), b[j].tolist()), dtype=np.int64).reshape(-1, 2)
    return i[pairs[:, 0]], j[pairs[:, 1]]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    return len(_matched(a, b)[0])


def _reach(a: np.ndarray, b: np.ndarray, block: int = 256) -> np.ndarray:
    """Places of equal words from the start on, until mismatches (two for one) outweigh matches by more than DROP."""
    n = min(len(a), len(b))
    found, score, top, at = [np.zeros(0, dtype=np.int64)], 0, 0, 0
    while at < n:
        same = a[at : min(at + block, n)] == b[at : min(at + block, n)]
        run = score + np.cumsum(np.where(same, 1, -2))
        best = np.maximum(np.maximum.accumulate(run), top)
        fallen = np.flatnonzero(best - run > DROP)
        stop = int(fallen[0]) if len(fallen) else len(run)
        found.append(at + np.flatnonzero(same[:stop]))
        if stop < len(run):
            break
        score, top, at = int(run[-1]), int(best[-1]), at + len(run)
    return np.concatenate(found)


def equal_words(a: np.ndarray, b: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Places in ``a`` and in ``b`` of the aligned equal words along a chain and beyond its ends; None if it does not lie there."""
    if (chain[:, 0] + chain[:, 2]).max() > len(a) or (chain[:, 1] + chain[:, 2]).max() > len(b):
        return None
    at, other_at, _ = chain[0].tolist()
    back = _reach(a[:at][::-1], b[:other_at][::-1])[::-1]
    own, other = [at - 1 - back], [other_at - 1 - back]
    for s, o, n in chain.tolist():
        skip = max(at - s, other_at - o, 0)
        s, o, n = s + skip, o + skip, n - skip
        if n <= 0:
            continue
        i, j = _matched(a[at:s], b[other_at:o])
        same = np.flatnonzero(a[s : s + n] == b[o : o + n])
        own += [at + i, s + same]
        other += [other_at + j, o + same]
        at, other_at = s + n, o + n
    on = _reach(a[at:], b[other_at:])
    return np.concatenate([*own, at + on]), np.concatenate([*other, other_at + on])


def align(a: np.ndarray, b: np.ndarray, chain: np.ndarray) -> tuple[int, int, int, int, int] | None:
    """(start, end, other start, other end, equal words) of a whole chain on the words ``a`` and ``b``; None if it does not lie there."""
    found = equal_words(a, b, chain)
    if found is None or not len(found[0]):
        return None
    x, y = found
    return int(x[0]), int(x[-1]) + 1, int(y[0]), int(y[-1]) + 1, len(x)


def parts(x: np.ndarray, y: np.ndarray, min_words: int, min_percent: int) -> list[tuple[int, int, int, int, int]]:
    """(start, end, other start, other end, equal words) of the stretches of aligned equal words ``x``, ``y`` that are passages.

    A stretch begins where a run of equal words does and ends where one does: to go on along a run can only help. Of the
    stretches that lie in no longer one, so many are given that every word of any of them is in one.
    """
    if not len(x):
        return []
    first = np.flatnonzero(np.concatenate([[True], (np.diff(x) != 1) | (np.diff(y) != 1)]))
    last = np.append(first[1:], len(x)) - 1
    #: a stretch from run i to run j has its percentage on a side if ends[j] >= starts[i] there
    starts = [100 * first - min_percent * z[first] for z in (x, y)]
    ends = [100 * (last + 1) - min_percent * (z[last] + 1) for z in (x, y)]
    near = np.maximum(*(np.searchsorted(z[last], z[first] + min_words - 1) for z in (x, y)))
    tops = [np.append(np.maximum.accumulate(e[::-1])[::-1], -np.inf) for e in ends]
    widest: list[tuple[int, int]] = []
    for i in np.flatnonzero((tops[0][near] >= starts[0]) & (tops[1][near] >= starts[1])).tolist():
        j = max(int(near[i]), widest[-1][1] + 1 if widest else 0)
        hits = np.flatnonzero((ends[0][j:] >= starts[0][i]) & (ends[1][j:] >= starts[1][i]))
        if len(hits):
            widest.append((i, j + int(hits[-1])))
    out, at = [], 0
    while at < len(widest):
        i, j = widest[at]
        out.append((int(x[first[i]]), int(x[last[j]]) + 1, int(y[first[i]]), int(y[last[j]]) + 1, int(last[j] - first[i]) + 1))
        at += 1
        while at + 1 < len(widest) and widest[at + 1][0] <= j:
            at += 1
    return out


PASSAGES = "doc_id long, other_id long, start_word int, end_word int, other_start int, other_end int, equal_words int"


def _passage_rows(min_words: int, min_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centers = None, []
        for batch in batches:
            out = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            words = (h[c[i] : c[i + 1]] for *_, data, offsets in K.text_blocks(batch.column(5)) for h, c in [K.words_of(data, offsets, K.VISIBLE)] for i in range(len(c) - 1))
            for (center, part, role, doc, flat), own in zip(keys, words, strict=True):
                if (center, part) != now:
                    now, centers = (center, part), []
                if role == 0:
                    centers.append(own.copy())
                    continue
                found = set()
                i = 0
                while i < len(flat):
                    chain = np.array(flat[i + 1 : i + 1 + 3 * flat[i]]).reshape(-1, 3)
                    i += 1 + 3 * flat[i]
                    for theirs in centers:
                        equal = equal_words(own, theirs, chain)
                        if equal:
                            found.update(parts(*equal, min_words, min_percent))
                out += [(doc, center, *hit) for hit in sorted(found)]
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in PASSAGES.split(", ")])

    return run


def _chained(texts: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """(member, center, chains) of the pairs that share seeds of ``sizes`` words; ``texts`` is (doc_id, text, blocks if any)."""
    seeds = texts.mapInArrow(_seed_rows(sizes), SEEDS).repartition("bucket").sortWithinPartitions("bucket")
    matches = seeds.mapInArrow(_matches(sizes), SEGMENTS).repartition("doc", "other").sortWithinPartitions("doc", "other")
    return stored(matches.mapInArrow(_chain_rows, "member long, center long, chains array<int>"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of the chains of rows (member, center, chains), with the number of their chain there."""
    for batch in batches:
        out = [np.zeros((0, 6), dtype=np.int64)]
        for member, center, flat in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            i = number = 0
            while i < len(flat):
                runs = np.array(flat[i + 1 : i + 1 + 3 * flat[i]], dtype=np.int64).reshape(-1, 3)
                out.append(np.column_stack([np.broadcast_to([member, center, number], (len(runs), 3)), runs]))
                i, number = i + 1 + 3 * flat[i], number + 1
        rows = np.concatenate(out)
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
        yield pa.record_batch([pa.array(rows[:, i]).cast(k) for i, k in enumerate(kinds)], ["doc_id", "center", "chain", "s", "other", "words"])


def open_blocks(found: DataFrame, passages: DataFrame, margin: int) -> DataFrame:
    """(doc_id, blocks): where chains of ``found`` have CHAIN_WORDS words or more that are in none of their member's
    ``passages``, on both sides, with ``margin`` words around them, as numbers of blocks of words.

    A document's segments and passages are sorted by their starts, and one sweep keeps the farthest end of a passage.
    """
    runs = found.mapInArrow(_runs, "doc_id long, center long, chain int, s int, other int, words int").withColumn("e", F.col("s") + F.col("words"))
    held = passages.select("doc_id", F.col("start_word").alias("s"), F.col("end_word").alias("e")).distinct()
    before = Window.partitionBy("doc_id").orderBy("s", F.col("center").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    far = F.coalesce(F.max(F.when(F.col("center").isNull(), F.col("e"))).over(before), F.lit(0))
    bare = runs.unionByName(held, allowMissingColumns=True).withColumn("skip", F.greatest(far - F.col("s"), F.lit(0))).where("center is not null and s + skip < e")
    spans = bare.groupBy("doc_id", "center", "chain").agg(
        F.sum(F.col("words") - F.col("skip")).alias("n"), F.min(F.col("s") + F.col("skip")).alias("s"), F.max("e").alias("e"),
        F.min(F.col("other") + F.col("skip")).alias("cs"), F.max(F.col("other") + F.col("words")).alias("ce"),
    ).where(F.col("n") >= CHAIN_WORDS)
    sides = F.array(F.struct("doc_id", "s", "e"), F.struct(F.col("center").alias("doc_id"), F.col("cs").alias("s"), F.col("ce").alias("e")))
    one = spans.select(F.explode(sides).alias("x")).select("x.doc_id", F.greatest(F.col("x.s") - margin, F.lit(0)).alias("s"), (F.col("x.e") + margin).alias("e"))
    blocks = one.select("doc_id", F.explode(F.sequence(F.floor(F.col("s") / BLOCK).cast("int"), F.floor(F.col("e") / BLOCK).cast("int"))).alias("block")).distinct()
    return blocks.groupBy("doc_id").agg(F.collect_list("block").alias("blocks"))


def _boxes(flat: list[int]) -> np.ndarray:
    """Per chain where it starts and ends on both sides and where it lies in ``flat``: (start, end, other, other end, from, to)."""
    out, i = [], 0
    while i < len(flat):
        to = i + 1 + 3 * flat[i]
        out.append((flat[i + 1], flat[to - 3] + flat[to - 1], flat[i + 2], flat[to - 2] + flat[to - 1], i, to))
        i = to
    return np.array(out, dtype=np.int64).reshape(-1, 6)


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (member, center, chains, chains that are aligned already) without the chains that lie inside one of those."""
    for batch in batches:
        kept = []
        for flat, old in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if old:
                had = _boxes(old)
                new = [b for b in _boxes(flat) if not ((had[:, [0, 2]] <= b[[0, 2]]).all(1) & (had[:, [1, 3]] >= b[[1, 3]]).all(1)).any()]
                flat = [x for b in new for x in flat[b[4] : b[5]]]
            kept.append(flat)
        rows = pa.record_batch([batch.column(0), batch.column(1), pa.array(kept, pa.list_(pa.int32()))], ["member", "center", "chains"])
        yield rows.filter(pa.array([bool(k) for k in kept], pa.bool_()))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, min_percent: int = MIN_PERCENT) -> DataFrame:
    """One row per passage of a document that another one has too: doc_id, other_id, word ranges on both sides, equal words.

    Words are runs of visible characters, A-Z folded; ends are exclusive. Both sides have at least ``min_words`` words, and the
    aligned words that are equal are at least ``min_percent`` percent of the longer side. Of the documents that share a
    passage one is its source and has no row for it; each of the others is matched to an earlier one (smaller
    doc_id), through which the source is reached; not all pairs are listed. A seed is matched to its first holder
    only. Where that one has too little of a passage, later holders meet in the second turn, by its longer seeds:
    always if ``min_words`` words are equal in a row and a chain lies there. Missed are a passage with changed words whose
    long seeds all have earlier holders that have no passage with it, and one whose seeds lie in many earlier documents,
    no two of them CHAIN_WORDS apart in the same one.

    Null and short texts, and rows without doc_id, have no passages. Rows that repeat a doc_id are one document: what they
    share with each other does not count. No documents give no rows; other columns are disregarded.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")

    def aligned(found: DataFrame) -> DataFrame:
        return with_texts(star_units(found, ["chains"]), docs, ["center", "part"]).mapInArrow(_passage_rows(min_words, min_percent), PASSAGES)

    found = _chained(docs, (SEED_WORDS,))
    passages = stored(aligned(found))
    around = docs.join(checked_broadcast(open_blocks(found, passages, min_words)), "doc_id").select("doc_id", "text", "blocks")
    longer = (*[k for k in LONG_SEEDS if SEED_WORDS < k < min_words], max(min_words, SEED_WORDS))
    had = found.withColumnRenamed("chains", "had")
    more = _chained(around, longer).join(had, ["member", "center"], "left").mapInArrow(_unseen, found.schema)
    return passages.unionByName(aligned(more)).distinct()


@query("op4_passages")
def op4(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))
