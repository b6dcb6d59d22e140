"""Merkle manifest of a dataset: one hash tree per group of rows, one tree over their roots, and a proof per row.

Nodes are numbered in their tree by a distributed sort, so a node's parent and its slot below it follow from its number alone.
A pass takes several levels: conditional aggregates spread the children of a block into one column per slot; concatenating
columns and hashing gives the columns of the level above, up to the block's top; a run of columns without the own slot is
what a slot's proof needs. The way up keeps the blocks, the way down joins each block with the proof of its top.
Both move a row per block, never a proof per row: proofs are unfolded and hashed beside the lowest blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.llm.registry import query
from scarmap.llm.shared import ranked, stored, table

#: children of a node
FANOUT = 2
#: slot columns of a block: the largest power of the fan-out that is not above this is taken
SLOTS = 16
#: what a leaf is the hash of
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: the query damages the rows whose id has a checksum divisible by this
DAMAGED = 7


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes and itself, so that neighbours cannot be mixed up; null is a dash."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return digest(*[field(c) for c in fields])


def _height(fanout: int, slots: int) -> int:
    h = 1
    while fanout ** (h + 1) <= slots:
        h += 1
    return h


def _levels(size: Column, fanout: int, height: int) -> Column:
    """Levels above ``size`` nodes until one is left, at most ``height``."""
    return reduce(lambda a, b: a + b, [F.when(size > fanout**k, 1).otherwise(0) for k in range(height)])


def _name(level: int, i: int) -> str:
    return f"n{level}_{i}"


def _pivot(nodes: DataFrame, fanout: int, height: int, carry: list[str]) -> DataFrame:
    """(tree, block, size, n0_*, carry*): nodes (tree, place, size, node) of a block as one column per slot."""
    width = fanout**height
    slot = F.pmod("place", F.lit(width))
    spread = lambda c, name: [F.max(F.when(slot == i, F.col(c))).alias(name(i)) for i in range(width)]
    columns = [*spread("node", lambda i: _name(0, i)), *[a for c in carry for a in spread(c, lambda i, c=c: f"{c}_{i}")]]
    block = F.floor(F.col("place") / width)
    return nodes.groupBy("tree", block.alias("block"), "size").agg(*columns)


def _hashed(blocks: DataFrame, fanout: int, height: int) -> DataFrame:
    """``blocks`` with the columns of the levels above the slots, null where a tree has ended, and ``top``."""
    for k in range(height):
        runs = [[F.col(_name(k, i)) for i in range(j * fanout, (j + 1) * fanout)] for j in range(fanout ** (height - k - 1))]
        more = F.col("size") > fanout**k
        blocks = blocks.select("*", *[F.when(more & run[0].isNotNull(), digest(run[0], *[F.coalesce(c, F.lit("")) for c in run[1:]])).alias(_name(k + 1, j)) for j, run in enumerate(runs)])
    return blocks.withColumn("top", F.coalesce(*[F.col(_name(k, 0)) for k in range(height, -1, -1)]))


def _step(level: int, i: int, fanout: int) -> Column:
    """What stands left and right of node ``i`` of a level in its run, as text; null where the tree ends below."""
    run = range(i // fanout * fanout, (i // fanout + 1) * fanout)
    side = lambda js: F.concat(F.lit(""), *[F.coalesce(F.col(_name(level, j)), F.lit("")) for j in js])
    step = F.struct(side(j for j in run if j < i).alias("left"), side(j for j in run if j > i).alias("right"))
    return F.when(F.col(_name(level + 1, i // fanout)).isNotNull(), step)


def _unfold(blocks: DataFrame, fanout: int, height: int, carry: list[str], keep: list[str]) -> DataFrame:
    """(keep, tree, place, node, carry, path): the slots of every block, ``path`` from the slot to the root of all."""
    width = fanout**height
    children = []
    for i in range(width):
        own = F.array_compact(F.array(*[_step(k, i // fanout**k, fanout) for k in range(height)]))
        children.append(F.struct(
            (F.col("block") * width + i).alias("place"), F.col(_name(0, i)).alias("node"), *[F.col(f"{c}_{i}").alias(c) for c in carry],
            F.concat(own, "above").alias("path"),
        ))
    each = blocks.select(*keep, "tree", F.explode(F.array(*children)).alias("c"))
    return each.select(*keep, "tree", "c.*").where("node is not null")


def _grow(nodes: DataFrame, fanout: int, slots: int, carry: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every pass, the lowest first, and (tree, root) of all trees."""
    height = _height(fanout, slots)
    passes, roots = [], None
    largest = nodes.agg(F.max("size")).first()[0]
    while True:
        blocks = stored(_pivot(nodes, fanout, height, [] if passes else carry))
        passes.append(blocks)
        tops = _hashed(blocks, fanout, height).select("tree", "block", "size", "top")
        done = tops.where(F.col("size") <= fanout**height).select("tree", F.col("top").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        if largest is None or largest <= fanout**height:
            return passes, stored(roots)
        nodes = tops.where(F.col("size") > fanout**height).select(
            "tree", F.col("block").alias("place"), F.ceil(F.col("size") / fanout**height).alias("size"), F.col("top").alias("node")
        )
        largest = -(-largest // fanout**height)


def _proofs(passes: list[DataFrame], ends: DataFrame, fanout: int, slots: int, carry: list[str]) -> DataFrame:
    """(subroot, tree, place, node, carry, path) of the lowest nodes. ``ends``: (tree, subroot, above) of every tree."""
    height = _height(fanout, slots)
    known = None
    for i, blocks in reversed(list(enumerate(passes))):
        # a tree that ends in this pass has one block, whose top is the tree's root
        tops = blocks.where(F.col("size") <= fanout**height).select("tree", "block").join(ends, "tree")
        if known is not None:
            tops = tops.unionByName(known.select("tree", F.col("place").alias("block"), "subroot", F.col("path").alias("above")))
        joined = _hashed(blocks, fanout, height).join(tops, ["tree", "block"])
        known = _unfold(joined, fanout, height, [] if i else carry, ["subroot"])
    return known


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of ``path`` give."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(docs: DataFrame, group: str, order: list[str], leaf: Column, carry: dict[str, Column], fanout: int = FANOUT, slots: int = SLOTS) -> DataFrame:
    """For every row of ``docs``: ``carry``, leaf, subroot, root, path and proof_sha256.

    Rows of one ``group`` are the leaves of a tree, by ``order`` (nulls first) and then by leaf; the trees' roots (subroot), by
    group (null first, then bytewise), are the leaves of a last tree, whose root covers the dataset. Every ``fanout``
    consecutive nodes make one above, the last run as many as there are; a single leaf is the root itself. ``path`` has an
    element per level from the leaf to ``root``, what stands left and right of the node in its run; ``fold`` recomputes the
    root from it; proof_sha256 is the hash of all siblings in that order.

    A null group is a tree of its own. Rows that repeat their order or are equal throughout each have a leaf and a proof.
    An empty table gives no rows. Other columns of ``docs`` play no part, whatever their names.
    """
    if fanout < 2 or slots < fanout:
        raise ValueError("a node has two children or more, and a block has a slot for each")
    order_names = [f"o{i}" for i in range(len(order))]
    own = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        *[F.col(c).alias(n) for c, n in zip(order, order_names, strict=True)], leaf.alias("node"), F.struct(*[c.alias(k) for k, c in carry.items()]).alias("with"),
    )
    leaves = ranked(own, "tree", [*[F.col(n).asc_nulls_first() for n in order_names], F.col("node")]).drop(*order_names)
    passes, subroots = _grow(leaves, fanout, slots, ["with"])

    crowns = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("node")), "tree", [F.col("of")])
    crown_passes, root = _grow(crowns, fanout, slots, ["of"])
    end = root.select("tree", F.col("root").alias("subroot"), F.expr("cast(array() as array<struct<left:string,right:string>>)").alias("above"))
    # `subroot` of the last tree is the root of all
    tops = _proofs(crown_passes, end, fanout, slots, ["of"]).select(F.col("of").alias("tree"), F.struct(F.col("node").alias("sub"), F.col("subroot").alias("root")).alias("subroot"), F.col("path").alias("above"))
    proofs = _proofs(passes, stored(tops), fanout, slots, ["with"])
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return proofs.select("with.*", F.col("node").alias("leaf"), F.col("subroot.sub").alias("subroot"), F.col("subroot.root").alias("root"), "path", F.sha2(siblings, 256).alias("proof_sha256"))


def document_manifest(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``, one tree per lang.

    folded_root is recomputed from the leaf that the row has where ``altered`` holds and one is added to n_chars, else from
    the leaf it had, and the original siblings; verified tells whether the root comes out. Any of the columns may be null.
    """
    columns = [F.col(c) for c in FIELDS]
    changed = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    found = leaf(columns) if altered is None else F.when(altered & F.col("n_chars").isNotNull(), leaf(changed))
    made = manifest(docs, "lang", ["doc_id"], leaf(columns), {"doc_id": F.col("doc_id"), "found": found})
    folded = made.withColumn("folded_root", fold(F.coalesce("found", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b:
  list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: i::BIGINT)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END))"""


def _sql_leaf(n_chars: str) -> str:
    value = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    return "sha256(" + " || ".join(value(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


def _sql_tree(name: str, leaves: str) -> str:
    """A recursive table (tree, level, place, size, node) from ``leaves`` (tree, place, size, node)."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, place, size, node FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, place // 2, any_value((size + 1) // 2), sha256(string_agg(node, '' ORDER BY place)) FROM {name} WHERE size > 1 GROUP BY tree, level, place // 2)"""


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_sql_leaf('n_chars')} AS leaf, {_sql_leaf('(n_chars + 1)')} AS changed,
    n_chars IS NOT NULL AND xor({_CRC}, 4294967295) % {DAMAGED} = 0 AS altered
  FROM documents),
leaves AS (SELECT *, leaf AS node, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size FROM d),
{_sql_tree('low', 'leaves')},
crowns AS (SELECT '' AS tree, tree AS of, node, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size FROM low WHERE size = 1),
{_sql_tree('high', 'crowns')},
low_paths AS (
  SELECT t.tree, l.place, list(CASE WHEN s.node IS NULL THEN '-' WHEN s.place < t.place THEN 'L' || s.node ELSE 'R' || s.node END ORDER BY t.level) AS path
  FROM leaves l JOIN low t ON t.tree = l.tree AND t.place = l.place >> t.level AND t.size > 1
  LEFT JOIN low s ON s.tree = t.tree AND s.level = t.level AND s.place = xor(t.place, 1) GROUP BY ALL),
high_paths AS (
  SELECT l.of, list(CASE WHEN s.node IS NULL THEN '-' WHEN s.place < t.place THEN 'L' || s.node ELSE 'R' || s.node END ORDER BY t.level) AS path
  FROM crowns l JOIN high t ON t.place = l.place >> t.level AND t.size > 1
  LEFT JOIN high s ON s.level = t.level AND s.place = xor(t.place, 1) GROUP BY ALL),
p AS (
  SELECT l.*, c.node AS subroot, (SELECT node FROM high WHERE size = 1) AS root, list_concat(coalesce(a.path, []), coalesce(b.path, [])) AS path
  FROM leaves l JOIN crowns c ON c.of = l.tree LEFT JOIN low_paths a ON a.tree = l.tree AND a.place = l.place LEFT JOIN high_paths b ON b.of = l.tree),
f AS (
  SELECT *, sha256(coalesce(array_to_string(list_transform(path, lambda s: substr(s, 2)), ''), '')) AS proof_sha256,
    list_reduce(list_prepend(CASE WHEN altered THEN changed ELSE leaf END, path), lambda node, s:
      CASE s[1] WHEN 'L' THEN sha256(substr(s, 2) || node) WHEN 'R' THEN sha256(node || substr(s, 2)) ELSE sha256(node) END) AS folded_root
  FROM p)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f
"""


@query("op11_merkle", ORACLE)
def op11(spark, sf_dir):
    altered = F.crc32(F.col("doc_id").cast("string")) % DAMAGED == 0
    return document_manifest(table(spark, sf_dir, "documents"), altered)
