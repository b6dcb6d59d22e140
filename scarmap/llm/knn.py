"""Exact top-k by inner product: a Voronoi join of queries with data.

Inner products become distances: with M the greatest norm, a data vector s is lifted onto the sphere of radius M by one
more coordinate, and a query is stretched to length M; then larger inner products are smaller distances. Queries and
data are assigned to their nearest pivots. The few nearest rows of every cell bound the distance within which
a query cell finds its k best (theta); a data row goes only to those groups of query cells that it could lie within theta
of. Each group is solved against its rows, part by part, with integer scores, and the parts' best are merged.

Pivots decide how much is moved, never what is found: bounds are not strict and have a margin for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scarmap.llm.registry import query
from scarmap.llm.shared import stored, table

PIVOTS = 64
#: queries that a group holds, and data rows that meet them in one task
GROUP_QUERIES, PART_ROWS = 8192, 32_768
#: sides of a block of scores
BLOCK_QUERIES, BLOCK_ROWS = 1024, 2048


@dataclass(frozen=True)
class Space:
    """The lifted space: dimension, greatest squared norm, pivots (one per row, lifted) and the type that scores need."""

    size: int
    top: float
    pivots: np.ndarray
    exact_floats: bool

    def matrix(self, column: pa.Array) -> np.ndarray:
        """Vectors as rows; missing coordinates at the end are 0."""
        cut = column.offsets.to_numpy()
        flat = column.values.to_numpy(zero_copy_only=False)
        length = np.diff(cut)
        if (length == self.size).all():
            return flat[cut[0] : cut[-1]].reshape(-1, self.size)
        out = np.zeros((len(length), self.size), dtype=np.int64)
        out[np.repeat(np.arange(len(length)), length), np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)] = flat[cut[0] : cut[-1]]
        return out

    def lift(self, rows: np.ndarray) -> np.ndarray:
        x = rows.astype(np.float64)
        return np.concatenate([x, np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))[:, None]], 1)

    def stretch(self, rows: np.ndarray) -> np.ndarray:
        x = rows.astype(np.float64)
        norm = np.sqrt((x * x).sum(1))
        x *= (np.sqrt(self.top) / np.maximum(norm, 1e-300))[:, None] * (norm > 0)[:, None]
        return np.concatenate([x, np.zeros((len(x), 1))], 1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        square = (points * points).sum(1)[:, None] + (self.pivots * self.pivots).sum(1)[None, :] - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    @property
    def margin(self) -> float:
        return 1e-5 * np.sqrt(self.top) + 1e-9


def integer_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, v) with v = floor(1024 * x) per component; rows with a null id or vector, or any component null or not finite, are left out."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = rows.select(F.col("vec_id").cast("long"), F.col("embedding")).where("vec_id is not null and embedding is not null").where(~bad)
    return whole.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(1024.0) * x.cast("double")).cast("long")).alias("v"))


def _space(data: DataFrame, queries: DataFrame, pivots: int) -> Space | None:
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    top, size = data.agg(F.max(squares), F.max(F.size("v"))).first()
    widest, wider = queries.agg(F.max(squares), F.max(F.size("v"))).first()
    if top is None or widest is None:
        return None
    some = data.select("v", F.xxhash64("v").alias("h")).groupBy("h").agg(F.first("v").alias("v")).orderBy("h").limit(pivots).collect()
    size = max(size, wider, 1)
    space = Space(size, top, np.zeros((0, size + 1)), np.sqrt(top * widest) < 2.0**52)
    lists = pa.array([r.v for r in some], pa.list_(pa.int64()))
    return Space(size, top, space.lift(space.matrix(lists)), space.exact_floats)


def _nearest_of_cells(data: DataFrame, space: Space, k: int) -> dict[int, list[float]]:
    """Per cell the k + 1 least distances of its rows to the pivot: the summary that bounds theta."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            d = space.distances(space.lift(space.matrix(batch.column(0))))
            cell = d.argmin(1)
            for c in np.unique(cell).tolist():
                own = np.concatenate([best.get(c, np.zeros(0)), d[cell == c, c]])
                best[c] = np.sort(own)[: k + 1]
        for c, own in best.items():
            yield pa.record_batch([pa.array([c] * len(own), pa.int32()), pa.array(own)], ["cell", "d"])

    few = data.select("v").mapInArrow(summarise, "cell int, d double")
    nth = Window.partitionBy("cell").orderBy("d")
    kept = few.withColumn("n", F.row_number().over(nth)).where(F.col("n") <= k + 1)
    out: dict[int, list[float]] = {}
    for r in kept.collect():  # at most pivots x (k + 1) numbers
        out.setdefault(r.cell, []).append(r.d)
    return out


def _cells(queries: DataFrame, space: Space) -> DataFrame:
    """(query, vec_id, v, cell, d) of every query."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = space.distances(space.stretch(space.matrix(batch.column(2))))
                cell = d.argmin(1)
                yield pa.record_batch([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], ["query", "vec_id", "v", "cell", "d"])

    return queries.mapInArrow(assign, "query long, vec_id long, v array<long>, cell int, d double")


def _groups(radius: dict[int, tuple[float, int]], space: Space, group_queries: int) -> tuple[dict[int, tuple[int, int]], list[list[int]]]:
    """({cell: (first group, groups)}, cells of every group): neighbouring cells share a group, a hot one is cut into several."""
    centre = np.linalg.norm(space.pivots[:, None, :] - space.pivots[None, :, :], axis=2)
    left, order = set(radius), []
    while left:
        near = min(left, key=lambda c: (centre[order[-1], c] if order else 0, c))
        order.append(near)
        left.remove(near)
    place, cells, held = {}, [], group_queries
    for c in order:
        n = radius[c][1]
        if n > group_queries:
            parts = -(-n // group_queries)
            place[c] = (len(cells), parts)
            cells += [[c]] * parts
            held = group_queries
        else:
            if held + n > group_queries:
                cells.append([])
                held = 0
            place[c] = (len(cells) - 1, 1)
            cells[-1].append(c)
            held += n
    return place, cells


def _solve(space: Space, k: int):
    """Best k of every query among the rows of its unit (group, part): queries (role 0) are held, data rows pass by."""
    kind = np.float64 if space.exact_floats else np.int64
    least = -np.inf if space.exact_floats else np.iinfo(np.int64).min

    class Unit:
        def __init__(self):
            self.numbers, self.ids, self.vectors, self.best = [], [], [], None

        def hold(self, numbers, ids, vectors):
            self.numbers.append(numbers)
            self.ids.append(ids)
            self.vectors.append(vectors.astype(kind))

        def meet(self, ids, vectors):
            if self.best is None:
                if not self.numbers:
                    return
                self.numbers, self.ids, self.vectors = np.concatenate(self.numbers), np.concatenate(self.ids), np.concatenate(self.vectors)
                self.best = [(np.zeros(0, dtype=np.int64),) * 3 for _ in range(0, len(self.ids), BLOCK_QUERIES)]
                self.kth = np.full(len(self.ids), least, dtype=kind)
            for a in range(0, len(ids), BLOCK_ROWS):
                some, columns = ids[a : a + BLOCK_ROWS], vectors[a : a + BLOCK_ROWS].astype(kind).T
                for b, lo in enumerate(range(0, len(self.ids), BLOCK_QUERIES)):
                    hi = min(lo + BLOCK_QUERIES, len(self.ids))
                    scores = self.vectors[lo:hi] @ columns
                    scores[self.ids[lo:hi, None] == some[None, :]] = least
                    floor = self.kth[lo:hi]
                    if len(some) > k:
                        floor = np.maximum(floor, np.partition(scores, len(some) - k, axis=1)[:, len(some) - k])
                    q, d = np.nonzero((scores >= floor[:, None]) & (scores > least))
                    q, ident, score = (np.concatenate(x) for x in zip(self.best[b], (q, some[d], scores[q, d].astype(np.int64)), strict=True))
                    order = np.lexsort((ident, -score, q))
                    q, ident, score = q[order], ident[order], score[order]
                    rank = np.arange(len(q)) - np.searchsorted(q, q)
                    top = rank < k
                    self.best[b] = (q[top], ident[top], score[top])
                    last = rank[top] == k - 1
                    self.kth[lo:hi][q[top][last]] = score[top][last]

        def rows(self):
            for b, (q, ident, score) in enumerate(self.best or []):
                at = q + b * BLOCK_QUERIES
                yield pa.record_batch([pa.array(self.numbers[at]), pa.array(self.ids[at]), pa.array(ident), pa.array(score)], ["query", "query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, unit = None, Unit()
        for batch in batches:
            if not batch.num_rows:
                continue
            group, part, role, number, ids = (batch.column(i).to_numpy() for i in range(5))
            vectors = space.matrix(batch.column(5))
            edge = np.flatnonzero((np.diff(group) != 0) | (np.diff(part) != 0) | (np.diff(role) != 0)) + 1
            for a, b in zip([0, *edge], [*edge, len(group)], strict=True):
                if (group[a], part[a]) != now:
                    yield from unit.rows()
                    now, unit = (group[a], part[a]), Unit()
                if role[a] == 0:
                    unit.hold(number[a:b], ids[a:b], vectors[a:b])
                else:
                    unit.meet(ids[a:b], vectors[a:b])
        yield from unit.rows()

    return run


FOUND = "query_id long, rank int, vec_id long, score long"


def top_k(queries: DataFrame, data: DataFrame, k: int = 10, pivots: int = PIVOTS, group_queries: int = GROUP_QUERIES, part_rows: int = PART_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: per row of ``queries`` (vec_id, v) the k rows of ``data`` (vec_id, v) of highest inner product.

    Ties go to the smaller vec_id. Rows of ``data`` with the query's own vec_id are no candidates; with fewer than k
    candidates all are returned. Repeated query rows are queries each, repeated data rows are candidates each. A vector
    shorter than others counts as 0 where it ends. Without queries or data there are no rows.
    """
    spark = data.sparkSession
    queries = stored(queries.select(F.monotonically_increasing_id().alias("query"), "vec_id", "v"))
    space = _space(data, queries, pivots)
    if space is None:
        return spark.createDataFrame([], FOUND)
    near = _nearest_of_cells(data, space, k)
    placed = stored(_cells(queries, space))
    radius = {r.cell: (r.u, r.n) for r in placed.groupBy("cell").agg(F.max("d").alias("u"), F.count("*").alias("n")).collect()}  # one per pivot
    between = space.distances(space.pivots)
    theta = {}
    for i, (u, _) in radius.items():
        reach = sorted(u + between[i, j] + d for j, own in near.items() for d in own)
        theta[i] = reach[k] if len(reach) > k else np.inf
    place, cells = _groups(radius, space, group_queries)
    reach = {i: theta[i] + radius[i][0] + space.margin for i in radius}
    parts = -(-data.count() // part_rows)
    of_group = [np.array(c) for c in cells]
    limits = [np.array([reach[i] for i in c]) for c in cells]

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = space.distances(space.lift(space.matrix(batch.column(1))))
            for g, (own, limit) in enumerate(zip(of_group, limits, strict=True)):
                some = batch.filter(pa.array((d[:, own] <= limit).any(axis=1)))
                if some.num_rows:
                    yield pa.record_batch([pa.array(np.full(some.num_rows, g, dtype=np.int32)), *some.columns], ["group", "vec_id", "v"])

    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    passing = data.select("vec_id", "v").mapInArrow(replicate, "group int, vec_id long, v array<long>").select("group", part.alias("part"), F.lit(1).alias("role"), F.lit(0).cast("long").alias("query"), "vec_id", "v")
    start, several = (F.create_map(*[x for c, p in place.items() for x in (F.lit(c), F.lit(p[i]))]) for i in (0, 1))
    group = (start[F.col("cell")] + F.pmod(F.xxhash64("query"), several[F.col("cell")])).cast("int")
    held = placed.select(group.alias("group"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("role"), "query", "vec_id", "v")
    dealt = held.unionByName(passing).repartition("group", "part").sortWithinPartitions("group", "part", "role", "vec_id")
    found = dealt.mapInArrow(_solve(space, k), "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024.0 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


@query("op1_topk", ORACLE)
def op1(spark, sf_dir):
    data = stored(integer_vectors(table(spark, sf_dir, "embeddings")))
    return top_k(data.where("vec_id % 100 = 0"), data, 10)
