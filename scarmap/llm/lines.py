"""Line dedup by distinct-site spread: lines that many sites share are boilerplate.

Lines are hashed to 128 bits. Per hash a HyperLogLog sketch of sites is built by partial aggregation, so a line that a
third of all documents have reaches the shuffle as a sketch per task. Hashes whose estimate is close to the
threshold are decided by exact distinct counts. Removals are numbers of lines per document, which are joined
with the texts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.llm.registry import query
from scarmap.llm.shared import fresh, stored, table

#: a line on at least so many sites is boilerplate
MIN_SITES = 5
#: a text of which at least this share of line characters recurs on so many sites is no page with boilerplate but a copy, exact
#: or near, of a widely copied document: nothing is removed, so that the deduplication of documents can choose one of them
COPY_SHARE = 0.9
#: log2 of the sketch's registers; its standard error is about 0.8 / sqrt(registers)
SKETCH_BITS = 10
#: estimates within so many standard errors of the threshold are counted exactly
ERRORS = 6


def _hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _lines(docs: DataFrame) -> DataFrame:
    """(key, site, no, a, b, n) of every line that is not blank; ``key`` is the document's id and the hash of its text."""
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    parts = docs.where("text is not null").select(key.alias("key"), F.col("source").cast("string").alias("site"), F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    bare = F.trim("line")
    return parts.where(bare != "").select("key", "site", "no", _hash(bare).alias("h"), F.length("line").alias("n")).select("key", "site", "no", "h.a", "h.b", "n")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(a, b): hashes of the lines found on at least ``min_sites`` distinct sites. Lines without a site do not count."""
    sited = lines.where("site is not null")
    error = ERRORS * 0.8 / (1 << SKETCH_BITS) ** 0.5
    sketched = sited.groupBy("a", "b").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("about"))
    likely = stored(sketched.where(F.col("about") >= min_sites * (1 - error) - 1))
    sure = F.col("about") > min_sites * (1 + error) + 1
    near = likely.where(~sure).select("a", "b")
    exact = sited.join(near, ["a", "b"], "left_semi").select("a", "b", "site").distinct().groupBy("a", "b").count().where(F.col("count") >= min_sites)
    return likely.where(sure).select("a", "b").unionByName(exact.select("a", "b"))


def removals(docs: DataFrame, min_sites: int = MIN_SITES, copy_share: float = COPY_SHARE) -> DataFrame:
    """(doc_id, text_hash, numbers): the lines to take out of each text that loses any."""
    lines = _lines(docs)
    common = stored(boilerplate(lines, min_sites)).withColumn("hit", F.lit(True))
    marked = lines.join(common, ["a", "b"], "left")
    # repeated rows of a document add the same line numbers and sizes again, so shares stay the same
    per_doc = marked.groupBy("key").agg(
        F.collect_set(F.when(F.col("hit"), F.col("no"))).alias("numbers"),
        F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("lost"), F.sum("n").alias("whole"),
    )
    return per_doc.where((F.size("numbers") > 0) & (F.col("lost") < copy_share * F.col("whole"))).select("key.doc_id", "key.text_hash", "numbers")


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, copy_share: float = COPY_SHARE) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with boilerplate lines taken out of the texts and n_chars, if there, counted anew.

    A line is what lies between line feeds, compared without blanks at its ends; blank lines stay. It is boilerplate if
    documents of at least ``min_sites`` distinct sources have it. A text of which boilerplate is at least ``copy_share`` of
    the line characters stays whole. Null texts stay null, empty ones empty; rows without a source count for no
    site but are cleaned; rows without a doc_id are cleaned too, rows that repeat a doc_id each by its own text.
    Rows and all other columns stay as they are.
    """
    id_, hash_, numbers = (fresh(docs, c) for c in ("r_id", "r_hash", "r_numbers"))
    found = removals(docs.select("doc_id", "text", "source"), min_sites, copy_share).toDF(id_, hash_, numbers)
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_)), "left")
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(numbers, i))
    text = F.when(F.col(numbers).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    changed = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(F.col(numbers).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return changed.select(*docs.columns)


ORACLE = f"""
WITH cut AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, source, unnest(range(len(parts))) AS no, unnest(parts) AS line FROM cut),
full_lines AS (SELECT doc_id, source, no, trim(line) AS bare, length(line) AS n FROM lines WHERE trim(line) <> ''),
common AS (SELECT bare FROM full_lines GROUP BY bare HAVING count(DISTINCT source) >= {MIN_SITES}),
lost AS (
  SELECT doc_id, list(no) FILTER (bare IN (SELECT bare FROM common)) AS numbers,
         coalesce(sum(n) FILTER (bare IN (SELECT bare FROM common)), 0) AS lost, sum(n) AS whole
  FROM full_lines GROUP BY doc_id)
SELECT c.doc_id, CASE WHEN l.lost > 0 AND l.lost < {COPY_SHARE} * l.whole
    THEN array_to_string(list_filter(parts, lambda x, i: NOT list_contains(numbers, i - 1)), chr(10)) ELSE text END AS text,
  CASE WHEN l.lost > 0 AND l.lost < {COPY_SHARE} * l.whole THEN len(numbers) ELSE 0 END AS n_removed
FROM cut c LEFT JOIN lost l ON c.doc_id = l.doc_id
"""


@query("op7_lines", ORACLE)
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    lines = lambda c: F.size(F.split(c, "\n", -1))
    cleaned = without_boilerplate(docs.withColumn("n_lines", lines("text")))
    return cleaned.select("doc_id", "text", (F.col("n_lines") - lines("text")).cast("long").alias("n_removed"))
