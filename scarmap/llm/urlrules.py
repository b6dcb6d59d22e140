"""URL filters: a trie over reversed host labels, then path segments; the longest rule that fits decides.

The tries go to the executors. A trie holds at most ``TRIE_RULES`` rules; longer lists are cut into several
tries, whose longest fits are compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.llm.registry import query
from scarmap.llm.shared import table

TRIE_RULES = 100_000
MAX_RULE_CHARS = 4_000


class Rule(NamedTuple):
    """``verdict`` (allow or block) for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def rank(self) -> tuple:
        """Longer first; of equal length the longer host; of equal rules the block."""
        return (len(self.host) + len(self.path), len(self.host), self.verdict == "block")


RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


class Node:
    """A host label or path segment: nodes below, the path trie of a host, rules by what begins the next segment."""

    __slots__ = ("below", "paths", "rules")

    def __init__(self):
        self.below: dict[str, Node] = {}
        self.paths: Node | None = None
        self.rules: list[tuple[str, Rule]] = []

    def child(self, label: str) -> Node:
        return self.below.setdefault(label, Node())


def build(rules: Iterable[Rule]) -> Node:
    root = Node()
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.child(label)
        node.paths = node.paths or Node()
        node = node.paths
        *whole, start = rule.path.split("/")
        for segment in whole:
            node = node.child(segment)
        node.rules.append((start, rule))
    return root


def _fits(root: Node, host: str, path: str) -> Iterator[Rule]:
    node, segments = root, path.split("/")
    for label in reversed(host.split(".")):
        node = node.below.get(label)
        if node is None:
            return
        inner = node.paths
        for segment in segments:
            if inner is None:
                break
            yield from (rule for start, rule in inner.rules if segment.startswith(start))
            inner = inner.below.get(segment)


def longest(root: Node, host: str, path: str) -> Rule | None:
    return max(_fits(root, host, path), key=lambda r: r.rank, default=None)


FIT = "chars int, host_chars int, block boolean, rule string"


def _fit(spark, rules: list[Rule], host: str, path: str) -> Column:
    sent = spark.sparkContext.broadcast(rules)
    trie: list[Node] = []

    @F.pandas_udf(FIT)
    def fit(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        if not trie:
            trie.append(build(sent.value))
        found = [longest(trie[0], h, p) for h, p in zip(hosts, paths, strict=True)]
        rows = [(*r.rank, r.host + r.path) if r else (None, None, None, None) for r in found]
        return pd.DataFrame(rows, columns=["chars", "host_chars", "block", "rule"]).astype({"chars": "Int32", "host_chars": "Int32", "block": "boolean"})

    return fit(host, path)


def judge(pages: DataFrame, rules: list[Rule] = RULES, otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z folded; the path goes on
    up to ``?``, ``#`` or the end. A null url or one without ``://`` has an empty host and path, which no rule fits.
    Without a fitting rule the verdict is ``otherwise`` and the rule null. Rows are judged one by one; repeated
    rows and null page_ids are returned as they are. With no rules all verdicts are ``otherwise``.
    """
    for rule in rules:
        if not rule.host or rule.verdict not in ("allow", "block") or len(rule.host) + len(rule.path) > MAX_RULE_CHARS:
            raise ValueError(f"not a rule: {rule}")
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce("url", F.lit(""))
    split = pages.select(
        "page_id",
        F.translate(F.regexp_extract(whole, parts, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.regexp_extract(whole, parts, 2).alias("path"),
    )
    fits = [_fit(pages.sparkSession, rules[i : i + TRIE_RULES], "host", "path") for i in range(0, len(rules), TRIE_RULES)]
    none = F.lit(None).cast(f"struct<{FIT.replace(' ', ':').replace(',:', ',')}>")
    best = F.greatest(*[F.when(f["rule"].isNotNull(), f) for f in fits], none, none)
    return split.withColumn("_fit", best).select(
        "page_id", "host", "path", F.col("_fit.rule").alias("rule"),
        F.when(F.col("_fit.block"), "block").when(~F.col("_fit.block"), "allow").otherwise(otherwise).alias("verdict"),
    )


ORACLE = r"""
WITH split AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM split), rules
  WHERE ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON s.host = f.host AND s.path = f.path
"""


@query("op9_url_rules", ORACLE)
def op9(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"))
