"""Pairs of rows that meet in a cell, tested in arrays.

Rows of either side come as lists of at most about ``MAX_LISTED`` rows of a cell. A pair of lists is tested in one block of
arrays, and only pairs that pass the test become rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scarmap.cluster import checked_broadcast, settle
from scarmap.functions import geometry as G

# Rows of a cell in a list, pairs that are tested at a time, and pairs of edges that are compared at a time.
MAX_LISTED, PAIRS, EDGE_PAIRS = 1_000, 1 << 18, 1_000_000


class Listed:
    """The rows of one side of a batch: ``starts`` says where the list of each row of the batch begins."""

    def __init__(self, column: pa.ListArray):
        self.starts, self.rows = column.offsets.to_numpy(), column.values

    def field(self, name: str) -> pa.Array:
        return self.rows.field(name)

    def numbers(self, name: str) -> np.ndarray:
        return self.field(name).to_numpy(zero_copy_only=False)


class Polygons:
    """Polygons as arrays: the edges of all, where those of each begin, and how many each has (one at least)."""

    def __init__(self, column: pa.ListArray):
        ends = column.offsets.to_numpy()
        self.edges = np.column_stack([f.to_numpy(zero_copy_only=False) for f in column.values.flatten()])
        self.first, self.count = ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)

    def bounds(self) -> tuple[np.ndarray, ...]:
        """minx, miny, maxx, maxy."""
        x, y = np.sort(self.edges[:, 0::2]), np.sort(self.edges[:, 1::2])
        low, high = (lambda v: np.minimum.reduceat(v, self.first)), (lambda v: np.maximum.reduceat(v, self.first))
        return low(x[:, 0]), low(y[:, 0]), high(x[:, 1]), high(y[:, 1])


def pairs_by_cell(left: DataFrame, right: DataFrame, on: list[str], left_out: list[str], right_out: list[str], test: Callable) -> DataFrame:
    """(left_out, right_out) of all pairs of rows that are equal in ``on`` and that ``test`` finds.

    ``test(cells, left, right)`` gets the values of ``on`` and both sides of a batch and gives places of rows that pass, some at a
    time. If a cell is crowded on the left, its lists go to several tasks, each with all lists of the right.
    """
    others = {s: [c for c in df.columns if c not in on] for s, df in (("_left", left), ("_right", right))}
    crowded = {s: _crowded(df, on) for s, df in (("_left", left), ("_right", right))}
    a, b = (_lists(df, on, s, others[s], crowded[s]) for s, df in (("_left", left), ("_right", right)))
    keys = [*on, "_part"] if crowded["_left"] is not None else on
    if crowded["_left"] is not None:
        b = b.drop("_part").join(checked_broadcast(crowded["_left"]), on, "left")
        b = b.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    joined = a.select(*keys, "_left").join(b.select(*keys, "_right").hint("merge"), keys).select(*on, "_left", "_right")
    schema = StructType([*[left.schema[c] for c in left_out], *[right.schema[c] for c in right_out]])

    def tested(batches):
        for batch in batches:
            cells = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(on))]
            sides = Listed(batch.column(len(on))), Listed(batch.column(len(on) + 1))
            for i, j in test(cells, *sides):
                at = pa.array(i), pa.array(j)
                out = [sides[k].field(c).take(at[k]) for k, names in ((0, left_out), (1, right_out)) for c in names]
                yield pa.RecordBatch.from_arrays(out, names=[*left_out, *right_out])

    return joined.mapInArrow(tested, schema)


def _crowded(df: DataFrame, on: list[str]) -> DataFrame | None:
    """Cells with more rows than a list takes, and in how many lists these are dealt."""
    n = F.ceil(F.count(F.lit(1)) / MAX_LISTED).cast("int")
    found = settle(df.dropna(subset=on).groupBy(*on).agg(n.alias("_parts")).where("_parts > 1"))
    return found if found.limit(1).count() else None


def _lists(df: DataFrame, on: list[str], name: str, columns: list[str], crowded: DataFrame | None) -> DataFrame:
    df, keys = df.dropna(subset=on), on
    if crowded is not None:
        dealt = [c for c in columns if "map<" not in df.schema[c].dataType.simpleString()]
        part = F.pmod(F.xxhash64(*dealt), F.coalesce("_parts", F.lit(1))).cast("int")
        df, keys = df.join(checked_broadcast(crowded), on, "left").withColumn("_part", part), [*on, "_part"]
    # moved first, so that lists are made in the tasks that join them and not in the few that read the table
    return df.repartition(*keys).groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias(name))


def candidates(left: Listed, right: Listed, may: Callable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of which ``may(row of the batch, slice of left, slice of right)`` is true, about ``PAIRS`` at a time."""
    held, n = [], 0
    for k in range(len(left.starts) - 1):
        a, b = slice(*left.starts[k : k + 2]), slice(*right.starts[k : k + 2])
        i, j = np.nonzero(may(k, a, b))
        held.append((i + a.start, j + b.start))
        n += len(i)
        if n >= PAIRS or n and k == len(left.starts) - 2:
            i, j = (np.concatenate(v) for v in zip(*held, strict=True))
            for lo in range(0, n, PAIRS):
                yield i[lo : lo + PAIRS], j[lo : lo + PAIRS]
            held, n = [], 0


def _each(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) of ``count`` places from ``first`` on."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) + np.repeat(first - np.cumsum(count) + count, count)


def held(polygons: Polygons, at: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the polygons ``at`` hold the points, as ``functions.geometry.contains``; points on edges go either way."""
    owner, place = _each(polygons.first[at], polygons.count[at])
    x1, y1, x2, y2 = polygons.edges[place].T
    px, py = x[owner], y[owner]
    side = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
    crossed = ((y1 > py) != (y2 > py)) & ((side > 0) == (y2 > y1))
    return np.bincount(owner[crossed], minlength=len(at)) % 2 == 1


def near(polygons: Polygons, at: np.ndarray, x: np.ndarray, y: np.ndarray, metres: float) -> np.ndarray:
    """Whether an edge of the polygons ``at`` is at most ``metres`` from the points, as ``functions.geometry.within_metres``."""
    owner, place = _each(polygons.first[at], polygons.count[at])
    x1, y1, x2, y2 = polygons.edges[place].T
    px, py, narrow = x[owner], y[owner], np.cos(np.radians(y))[owner]
    ax, ay = (x1 - px) * G.METRES_PER_DEGREE * narrow, (y1 - py) * G.METRES_PER_DEGREE
    dx, dy = (x2 - px) * G.METRES_PER_DEGREE * narrow - ax, (y2 - py) * G.METRES_PER_DEGREE - ay
    length = dx * dx + dy * dy
    along = np.divide(-(ax * dx + ay * dy), length, out=np.zeros_like(length), where=length != 0)
    t = np.clip(along, 0.0, 1.0)
    ax, ay = ax + t * dx, ay + t * dy
    return np.bincount(owner[ax * ax + ay * ay <= metres * metres], minlength=len(at)) > 0


def meet(a: Polygons, i: np.ndarray, b: Polygons, j: np.ndarray, segments_meet: Callable) -> np.ndarray:
    """Whether the polygons ``i`` of ``a`` and ``j`` of ``b`` share a point: edges meet, or one holds a vertex of the other.

    The first vertex decides most pairs; edges are compared for the others, and all vertices for those still left.
    """
    found = held(b, j, *a.edges[a.first[i], :2].T)
    left = np.flatnonzero(~found)
    while len(left):
        pairs = a.count[i[left]] * b.count[j[left]]
        k = max(int(np.searchsorted(np.cumsum(pairs), EDGE_PAIRS, "right")), 1)
        now, left, pairs = left[:k], left[k:], pairs[:k]
        owner, place = _each(np.zeros_like(pairs), pairs)
        wide = b.count[j[now]][owner]
        crossing = segments_meet(a.edges[a.first[i[now]][owner] + place // wide], b.edges[b.first[j[now]][owner] + place % wide])
        found[now[owner[crossing]]] = True
    for p, at, q, of in ((a, i, b, j), (b, j, a, i)):
        left = np.flatnonzero(~found)
        owner, place = _each(p.first[at[left]], p.count[at[left]])
        found[left[owner[held(q, of[left][owner], *p.edges[place, :2].T)]]] = True
    return found


def plain(edges: Column, most: int) -> Column:
    """A polygon of one to ``most`` edges, all of whose coordinates are numbers."""
    known = F.forall(edges, lambda e: ~(F.isnan(e["x1"] + e["y1"] + e["x2"] + e["y2"])) & (e["x1"] + e["y1"] + e["x2"] + e["y2"]).isNotNull())
    return F.coalesce(F.size(edges).between(1, most) & known, F.lit(False))
