"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find grouping.

1. One pass over the texts gives every document its shingle count, a digest of its shingle set and the
   hashes of its signature's bands. Documents of equal sets fall into one class by aggregation.
2. Classes that share a band are candidates. Every bucket is first joined to one of its classes alone (a star),
   pairs are verified on full sets, and verified links are grouped; then once more with another centre.
3. What stars leave open are buckets whose classes still lie in different groups. Members outside a bucket's
   largest group are compared with all others inside tasks, block by block; only links leave a task, and
   none between documents that are connected already, as it could not change a group.

Before a text is fetched for a pair, a byte of every register is compared: a pair at the threshold agrees in fewer
registers than ``enough`` asks for with probability ``MISSED`` at most, and most false candidates agree in fewer. So texts
move for the documents alone that are about to be linked.

A pair at the threshold of 0.85 shares no band of 25 with probability 4e-7.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.cluster import bounded_batches, checked_broadcast, settle
from scarmap.llm import textkit as K
from scarmap.llm.registry import query
from scarmap.llm.shared import components, find, star_units, stored, table, unite, with_texts

BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: members of a bucket that meet in one task, per side of a block pair
BLOCK_MEMBERS = 64
EMPTY = np.uint32(0xFFFFFFFF)
#: the same where registers are compared, which are shorter than texts
REGISTER_MEMBERS = 2048
#: of the centers that a member may be linked with, so many are tried first; the others where these leave them in other groups
CENTERS = 2
#: chance that the registers of a pair at the threshold agree too rarely for its texts to be compared
MISSED = 1e-7


def superminhash(elements: np.ndarray, offsets: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Signatures (rows x m) of the element sets that ``offsets`` cuts out of ``elements``.

    Element e draws a random permutation step by step; its j-th rank is j plus a random fraction and goes to
    register p(j). All elements take step j together; a row leaves once its largest register is below j + 1,
    because later steps could not lower any. A rank is kept as j in the upper 8 bits, the fraction below.
    """
    if m > 256:
        raise ValueError("at most 256 registers")
    rows = len(offsets) - 1
    signature = np.full(rows * m, EMPTY, dtype=np.uint32)
    row = K.row_of(offsets)
    element, order = elements, None
    for j in range(m):
        if not len(element):
            break
        draw = K.mix(element + K.step(j + 1))
        rank = (draw >> np.uint64(40)).astype(np.uint32) | np.uint32(j << 24)
        k = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            target = k
        else:
            line = np.arange(len(element))
            target = order[line, k].astype(np.int64)
            order[line, k] = order[:, j]
            order[:, j] = target
        np.minimum.at(signature, row * m + target, rank)
        going = (signature.reshape(rows, m).max(axis=1) >= np.uint64(j + 1 << 24))[row]
        if order is None:
            element, row, target = element[going], row[going], target[going]
            order = np.tile(np.arange(m, dtype=np.uint8), (len(element), 1))
            line = np.arange(len(element))
            order[line, target] = 0
            order[:, 0] = target
        elif not going.all():
            element, row, order = element[going], row[going], order[going]
    return signature.reshape(rows, m)


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash per band of a signature; the band's number is part of it."""
    rows, m = signature.shape
    parts = signature.reshape(rows, bands, m // bands).astype(np.uint64)
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * K.BASE, (rows, 1))
    for i in range(parts.shape[2]):
        out = K.mix(out + parts[:, :, i] * K.ODD[i])
    return out


def enough(percent: int, m: int = REGISTERS, missed: float = MISSED) -> int:
    """The least number of agreeing registers, of ``m``, that a pair of that similarity stays below with probability ``missed`` at
    most: the tail of a binomial distribution, whose variance is no less than that of these registers."""
    p, tail = percent / 100, 0.0
    for k in range(m + 1):
        tail += math.comb(m, k) * p**k * (1 - p) ** (m - k)
        if tail > missed:
            return k
    return m


PROFILE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, registers binary"


def profiles(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """Per document the size and digest of its shingle set, its band hashes and a byte of every register (none for an empty set)."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in K.text_blocks(batch.column(1)):
                sets = K.shingle_sets(*K.words_of(data, offsets, K.VISIBLE), shingle)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                cuts = np.concatenate([[0], np.cumsum(sizes)])
                flat = np.concatenate([*sets, np.zeros(0, dtype=np.uint64)])
                sums = np.zeros((2, len(flat) + 1), dtype=np.uint64)
                np.cumsum(flat, out=sums[0, 1:])
                np.cumsum(K.mix(flat ^ K.BASE), out=sums[1, 1:])
                digest = sums[:, cuts[1:]] - sums[:, cuts[:-1]]
                signature = superminhash(flat, cuts)
                bands = K.signed(band_hashes(signature).reshape(-1))
                # a byte per register: of the rank and the random fraction
                short = (K.mix(signature.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                registers = pa.FixedSizeBinaryArray.from_buffers(pa.binary(REGISTERS), len(sizes), [None, pa.py_buffer(short.tobytes())]).cast(pa.binary())
                none = pa.array(sizes == 0)
                keep = lambda x: pa.compute.if_else(none, None, pa.array(x))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * BANDS), pa.array(bands))
                yield pa.record_batch(
                    [ids.slice(lo, hi - lo), pa.array(sizes), keep(K.signed(digest[0])), keep(K.signed(digest[1])), lists, registers],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands", "registers"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(profile, PROFILE)


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, exactly."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _links(shingle: int, percent: int):
    """Verified links of units (u, v, w, role, doc_id, group, text): rows of role 0 are held, those of role 1 pass by.

    Inside a unit a link between rows that are connected already is not looked for: it would change no group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, root = None, [], {}
        for batch in batches:
            a, b = [], []
            keys = zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)
            for (u, v, w, role, doc, group), found in zip(keys, K.text_sets(batch.column(6), shingle), strict=True):
                if (u, v, w) != now:
                    now, held, root = (u, v, w), [], {}
                unite(root, doc, group)
                if role == 0:
                    held.append((doc, found))
                    continue
                for other, its in held:
                    if find(root, other) != find(root, doc) and _alike(its, found, percent):
                        unite(root, other, doc)
                        a.append(other)
                        b.append(doc)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, REGISTERS)


def _verified(units: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links of units, on the texts of the documents that are in one: few, so a list of them is sent to the scan while it is small."""
    units = settle(units)
    wanted = checked_broadcast(units.select("doc_id").distinct())
    texts = docs.join(wanted, "doc_id", "left_semi")
    return settle(with_texts(units, texts, ["u", "v", "w"]).mapInArrow(_links(shingle, percent), "a long, b long"))


def _star(bucketed: DataFrame, registers: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Verified links of every class of a bucket with the bucket's head (rep, n, group), unless sizes, groups or registers rule a link out.

    A member has a center per band at most. The smallest ``CENTERS`` are tried first; then all others of another group by then.
    """
    possible = F.expr(f"100 * least(n, head.n) >= {percent} * greatest(n, head.n)") & (F.col("group") != F.col("head.group"))
    pairs = bucketed.where(possible).select(F.col("head.rep").alias("center"), F.col("rep").alias("member")).distinct()
    centers = checked_broadcast(pairs.select("center").distinct().join(registers.toDF("center", "of_center"), "center"))
    both = pairs.join(registers.toDF("member", "of_member"), "member").join(centers, "center")
    least = enough(percent)

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = np.count_nonzero(_matrix(batch.column(2)) == _matrix(batch.column(3)), axis=1) >= least
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(near)) for c in batch.columns[:2]], names=["center", "member"])

    near = both.select("center", "member", "of_center", "of_member").mapInArrow(alike, "center long, member long")
    near = settle(near.groupBy("member").agg(F.array_sort(F.collect_list("center")).alias("centers")))
    some = lambda part: F.explode(part).alias("center")
    first = near.select("member", some(F.slice("centers", 1, CENTERS)))
    links = _verified(_star_rows(first), docs, shingle, percent)
    rest = near.where(F.size("centers") > CENTERS).select("member", some(F.slice("centers", CENTERS + 1, BANDS)))
    if rest.limit(1).count() == 0:
        return links
    groups = stored(components(links, turns=1))
    for side in ("center", "member"):
        own = groups.toDF(side, f"of_{side}")
        rest = rest.join(own, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    rest = settle(rest.where("of_center <> of_member").select("center", "member"))
    return links.unionByName(_verified(_star_rows(rest), docs, shingle, percent))


def _star_rows(pairs: DataFrame) -> DataFrame:
    """Units of pairs (center, member), each class its own group."""
    return star_units(pairs).select(
        F.col("center").alias("u"), F.col("part").alias("v"), F.lit(0).alias("w"), "role", "doc_id", F.col("doc_id").alias("group")
    )


def _with_candidates(bucketed: DataFrame, registers: DataFrame, percent: int) -> DataFrame:
    """Rows of ``bucketed`` whose registers agree often enough with those of a class of another group in their bucket."""
    least = enough(percent)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs, groups, rows, held = None, [], [], [], None
        for batch in batches:
            found = set()
            keys = zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)
            own = _matrix(batch.column(6)) if batch.num_rows else []
            for (u, v, w, role, doc, group), mine in zip(keys, own, strict=True):
                if (u, v, w) != now:
                    now, docs, groups, rows, held = (u, v, w), [], [], [], None
                if role == 0:
                    docs.append(doc)
                    groups.append(group)
                    rows.append(mine)
                    continue
                if rows:
                    held = held or (np.array(rows), np.array(groups))  # rows of role 0 come first
                    close = (np.count_nonzero(held[0] == mine, axis=1) >= least) & (held[1] != group)
                    if close.any():
                        found |= {(u, doc), *((u, docs[i]) for i in np.flatnonzero(close))}
            pairs = sorted(found)
            yield pa.record_batch([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["bucket", "rep"])

    units = with_texts(_blocks(bucketed, REGISTER_MEMBERS), registers.withColumnRenamed("rep", "doc_id"), ["u", "v", "w"], "registers")
    kept = units.mapInArrow(near, "bucket long, rep long").distinct()
    return settle(bucketed.join(kept, ["bucket", "rep"]))


def _regroup(bucketed: DataFrame, links: DataFrame) -> DataFrame:
    """``bucketed`` (bucket, rep, n) with the group of each class so far, and only buckets that several groups share.

    Groups that one turn does not join yet cost comparisons, no links.
    """
    grouped = bucketed.select("bucket", "rep", "n").join(components(links, turns=1), F.col("rep") == F.col("node"), "left").select(
        "bucket", "rep", "n", F.coalesce("component", "rep").alias("group")
    )
    several = settle(grouped.groupBy("bucket").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("bucket"))
    return settle(grouped.join(several, "bucket"))


def _blocks(bucketed: DataFrame, members: int) -> DataFrame:
    """Members outside their bucket's largest group, in blocks of about ``members`` that are held, against all members of the bucket."""
    largest = settle(bucketed.groupBy("bucket", "group").agg(F.count("*").alias("n_group")).groupBy("bucket").agg(
        F.max_by("group", F.struct("n_group", "group")).alias("main"), (F.sum("n_group") - F.max("n_group")).alias("rest"), F.sum("n_group").alias("all")
    ))
    dealt = (
        bucketed.join(largest, "bucket")
        .withColumn("_blocks", F.ceil(F.col("rest") / members)).withColumn("_parts", F.ceil(F.col("all") / (8 * members)))
        .withColumn("_own", F.pmod(F.xxhash64("rep"), "_blocks")).withColumn("_part", F.pmod(F.xxhash64("rep", F.lit(1)), "_parts"))
    )
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    row = lambda v, w, role: [F.col("bucket").alias("u"), F.col(v).alias("v"), F.col(w).alias("w"), F.lit(role).alias("role"), F.col("rep").alias("doc_id"), "group"]
    held = dealt.where(F.col("group") != F.col("main")).withColumn("_w", upto("_parts")).select(*row("_own", "_w", 0))
    passing = dealt.withColumn("_v", upto("_blocks")).select(*row("_v", "_part", 1))
    return held.unionByName(passing)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Documents whose shingle sets have a Jaccard similarity of at least ``percent`` / 100 are linked;
    component_id is the smallest doc_id that links reach and kept tells whether that is the document itself.

    A null, empty or wordless text has no shingles and is linked with nothing; a text of fewer words than a
    shingle is one shingle. Rows that repeat a doc_id count as one document: each row is returned, and links of
    any of its texts hold for all. A row without doc_id gets the component of the documents with equal shingle
    sets, if there are any, and brings no links. An empty table gives no rows; other columns are disregarded.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = stored(profiles(docs, shingle))
    classes = profile.where("set_a is not null").groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("registers").alias("registers")
    ).where("rep is not null")
    classes = stored(classes.drop("set_a", "set_b"))
    registers = classes.select("rep", "registers")
    banded = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    heads = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct("rep", "n", F.col("rep").alias("group"))).alias("head"))
    # what is known of a bucket is settled before rows are joined to it: a hot bucket's rows are then split by the join
    bucketed = stored(banded.join(stored(heads.where("size > 1")), "bucket").withColumn("group", F.col("rep")))

    links = _star(bucketed, registers, docs, shingle, percent)
    bucketed = _regroup(bucketed.where("size > 2 and rep <> head.rep"), links)
    if bucketed.limit(1).count():
        heads = settle(bucketed.groupBy("bucket").agg(F.min_by(F.struct("rep", "n", "group"), F.xxhash64("rep")).alias("head")))
        links = links.unionByName(_star(bucketed.join(heads, "bucket"), registers, docs, shingle, percent))
        bucketed = _with_candidates(_regroup(bucketed, links), registers, percent)
        if bucketed.limit(1).count():
            links = links.unionByName(_verified(_blocks(bucketed, BLOCK_MEMBERS), docs, shingle, percent))

    shared = profile.where("set_a is not null").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    least = stored(shared.where("n > 1").drop("n"))
    copies = profile.join(least, ["set_a", "set_b"]).where("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    found = components(links.unionByName(copies))
    known = profile.where("doc_id is not null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("rep"))
    nameless = profile.where("doc_id is null").join(least, ["set_a", "set_b"], "left").select("doc_id", "n_shingles", "rep")
    return (
        known.unionByName(nameless).join(found, F.coalesce("doc_id", "rep") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id", "rep").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


@query("op5_minhash")
def op5(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
