"""What several operators of this subpackage share: star pairs with texts, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scarmap.cluster import checkpoint_folder, settle

MEMBERS_PER_TASK = 64


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage is cut and columns are compressed."""
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ranked(rows: DataFrame, group: str, order: list[Column | str], place: str = "place", size: str = "size") -> DataFrame:
    """``rows`` with each one's number (from 0) inside its ``group`` by ``order``, and the size of the group.

    Rows are sorted by ranges, so a group may fill many tasks: a row's number is its number inside its task and group plus
    the group's rows in the tasks before, and only counts per task and group are added up. ``group`` must not be null. Rows
    that are equal in ``order`` are told apart by a number that is written with them, so a task that is run again gives
    the same answer and equal rows are split over tasks too.
    """
    tie, at, task, first, before = (fresh(rows, c) for c in ("_tie", "_at", "_task", "_first", "_before"))
    tied = stored(rows.withColumn(tie, F.monotonically_increasing_id()))
    keys = [F.col(group), *order, F.col(tie)]
    # in a sorted task the id is the task's number above 33 bits for the row's number inside the task
    laid = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie).withColumn(at, F.monotonically_increasing_id())
    laid = stored(laid).withColumn(task, F.shiftright(at, 33))
    parts = laid.groupBy(group, task).agg(F.min(at).alias(first), F.count("*").alias(size))
    earlier = Window.partitionBy(group).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(group, task, first, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(before), F.sum(size).over(Window.partitionBy(group)).alias(size))
    return laid.join(parts, [group, task]).withColumn(place, F.col(at) - F.col(first) + F.col(before)).drop(at, task, first, before)


def with_texts(units: DataFrame, docs: DataFrame, by: list[str], what: str = "text") -> DataFrame:
    """``units`` (by..., role, doc_id, ...) with the text of each document (or its column ``what``), grouped by ``by`` and sorted
    by it and role, so that a task can stream one unit after the other: first the rows of role 0, which it holds,
    then those of role 1, which pass by. Callers see to it that a unit is small."""
    columns = [*by, "role", "doc_id", *[c for c in units.columns if c not in {*by, "role", "doc_id"}], what]
    return (
        units.join(docs.select("doc_id", what), "doc_id")
        .repartition(*by).sortWithinPartitions(*by, "role", "doc_id").select(*columns)
    )


def star_units(pairs: DataFrame, carry: list[str] = [], members: int = MEMBERS_PER_TASK) -> DataFrame:
    """Units (center, part) of ``pairs`` (center, member, *carry): the center as role 0, some members as role 1.

    The members of a center are dealt to parts of about ``members``, so a hot center is spread over tasks.
    """
    counts = pairs.groupBy("center").agg(F.ceil(F.count("*") / members).alias("_parts"))
    dealt = pairs.join(counts, "center").withColumn("part", F.pmod(F.xxhash64("member"), "_parts"))
    none = [F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in carry]
    heads = dealt.select("center", "part").distinct().select("center", "part", F.lit(0).alias("role"), F.col("center").alias("doc_id"), *none)
    return heads.unionByName(dealt.select("center", "part", F.lit(1).alias("role"), F.col("member").alias("doc_id"), *carry))


#: edges that one partition holds between turns
EDGES_TOGETHER = 250_000


def components(edges: DataFrame, turns: int | None = None) -> DataFrame:
    """(node, component) of the connected components of ``edges`` (a, b): component is the smallest node.

    Every partition first reduces its edges to a spanning forest by union-find. Then neighbours are
    re-hung onto the smallest one, by turns those above a node and those below it, until every node hangs on one
    root; the number of turns grows with the logarithm of the longest chain. Only pairs of numbers move.

    With ``turns`` it ends after so many: then nodes of one component are connected, but not all connected
    nodes need be in one.
    """
    stars = _kept(edges.select("a", "b").mapInArrow(_forest, "a long, b long"))
    done = 0
    while (turns is None or done < turns) and not _stars_only(stars):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), "a").alias("m"))
        above = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        lowest = above.groupBy("a").agg(F.min("b").alias("m"))
        below = above.join(lowest, "a")
        roots = below.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = _kept(below.select("a", F.col("m").alias("b")).unionByName(roots).distinct())
        done += 1
    ends = stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component")))
    return ends.groupBy("node").agg(F.min("component").alias("component"))


def _kept(edges: DataFrame) -> DataFrame:
    """Edges settled in as many partitions as their number asks for."""
    held = settle(edges)
    parts = -(-held.count() // EDGES_TOGETHER)
    return held.coalesce(max(parts, 1))


def _stars_only(edges: DataFrame) -> bool:
    """Every node hangs on one other, and none that others hang on hangs itself."""
    ends = edges.distinct().select("a", F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    wrong = ends.groupBy("a").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or hangs + holds > 1")
    return wrong.limit(1).count() == 0


def find(root: dict[int, int], x: int) -> int:
    top = x
    while (up := root.get(top, top)) != top:
        top = up
    while x != top:
        root[x], x = top, root.get(x, x)
    return top


def unite(root: dict[int, int], a: int, b: int) -> bool:
    """Join two trees under the smaller root; False if they are one already."""
    a, b = find(root, a), find(root, b)
    if a == b:
        return False
    root[max(a, b)] = min(a, b)
    return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        root: dict[int, int] = {}
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            unite(root, a, b)
        nodes = sorted(root)
        yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([find(root, x) for x in nodes], pa.int64())], ["a", "b"])


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """A function of one Arrow batch as one of an iterator of batches."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
