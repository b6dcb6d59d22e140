"""Secret scans with a trigram index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived that every text with a match satisfies. Postings
(trigram, document) of the trigrams in use are built over folded texts, grouped by document, which intersects
them, and the query decides which documents are candidates of which rule. Only candidates are matched against
the expression; a rule from which no trigram follows is matched against every text.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.llm.registry import query
from scarmap.llm.shared import table

#: alternatives that are told apart while a trigram query is derived
MOST_STRINGS = 64


class Rule(NamedTuple):
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters. ``first`` is a cheaper test that every
    text with such a match passes, for rules without trigrams. The syntax is what Java and RE2 share. With ``tail`` the span
    is that of the group, which ends the match: what stands before it only keeps matches from starting inside a run, where
    each start would read the run to its end."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    first: str | None = None
    tail: bool = False


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(either_case(w).replace("_", "_?") for w in ("password", "passwd", "secret", "token", "api_key"))
BASE = [
    Rule("assign", rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}", first="[0-9a-f]{24}"),
]
MORE = [
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"(^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})", 2, tail=True),
]

# A trigram query: True (no condition), a trigram, ("and", parts) or ("or", parts).


def _all(parts):
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _any(parts):
    parts = list(parts)
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", parts)


def _of_strings(strings: set[str]):
    """Condition that one of ``strings`` occurs."""
    return _any(_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings))


def _finite(node) -> set[str] | None:
    """All folded strings that a parsed expression can match, if they are few."""
    strings = {""}
    for kind, value in node:
        name = str(kind)
        if name == "LITERAL":
            more = {chr(value).lower()}
        elif name == "IN" and all(str(k) in ("LITERAL", "RANGE") for k, _ in value):
            sizes = sum(1 if str(k) == "LITERAL" else v[1] - v[0] + 1 for k, v in value)
            if sizes > MOST_STRINGS:
                return None
            more = {chr(c).lower() for k, v in value for c in ([v] if str(k) == "LITERAL" else range(v[0], v[1] + 1))}
        elif name == "SUBPATTERN":
            more = _finite(value[-1])
        elif name == "BRANCH":
            parts = [_finite(p) for p in value[1]]
            more = None if None in parts else set().union(*parts)
        elif name == "MAX_REPEAT" and value[1] <= 4:
            one = _finite(value[2])
            more = one and {"".join(p) for n in range(value[0], int(value[1]) + 1) for p in product(one, repeat=n)}
        else:
            more = None
        if more is None or len(strings) * len(more) > MOST_STRINGS:
            return None
        strings = {a + b for a, b in product(strings, more)}
    return strings


def _needs(node):
    """Trigram query of a parsed expression: runs of few strings, cut where anything else stands."""
    run, parts = {""}, []

    def flush():
        nonlocal run
        parts.append(_of_strings(run))
        run = {""}

    for kind, value in node:
        name = str(kind)
        few = _finite([(kind, value)])
        if few is not None and len(run) * len(few) > MOST_STRINGS:
            flush()
        if few is not None:
            run = {a + b for a, b in product(run, few)}
            continue
        flush()
        if name == "SUBPATTERN":
            parts.append(_needs(value[-1]))
        elif name == "BRANCH":
            parts.append(_any(_needs(p) for p in value[1]))
        elif name == "MAX_REPEAT" and value[0]:
            parts.append(_needs(value[2]))
    flush()
    return _all(parts)


def trigram_query(pattern: str):
    """A Boolean query over trigrams of the folded text that is true of every text ``pattern`` matches."""
    return _needs(re._parser.parse(pattern))


def _trigrams(q) -> set[str]:
    return set() if q is True else {q} if isinstance(q, str) else set().union(*map(_trigrams, q[1]))


def _holds(q, has: dict[str, Column]) -> Column:
    if isinstance(q, str):
        return has[q]
    return reduce((lambda a, b: a & b) if q[0] == "and" else (lambda a, b: a | b), [_holds(p, has) for p in q[1]])


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram number, doc_id): in which documents each of ``trigrams`` occurs, case aside."""
    found = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(t)), i) for i, t in enumerate(trigrams)]))
    return docs.select("doc_id", F.lower("text").alias("folded")).select("doc_id", F.explode(found).alias("trigram"))


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, one flag per kind): documents whose postings satisfy the trigram query of a rule that has one."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not True}
    trigrams = sorted(set().union(*map(_trigrams, queries.values())))
    number = {t: i for i, t in enumerate(trigrams)}
    together = postings(docs, trigrams).groupBy("doc_id").agg(*[F.max(F.col("trigram") == i).alias(f"_{i}") for i in range(len(trigrams))])
    flags = {kind: _holds(q, {t: F.col(f"_{number[t]}") for t in _trigrams(q)}) for kind, q in queries.items()}
    return together.select("doc_id", *[f.alias(k) for k, f in flags.items()]).where(reduce(lambda a, b: a | b, [F.col(k) for k in flags]))


SPAN = "array<struct<start:int,no:int,end:int>>"
#: matches of a text that are laid out together
TOGETHER = 256


def _spans(rule: Rule, no: int) -> Column:
    """Spans of the rule's matches in ``text``: what lies between matches and the matches add up to positions."""
    pattern = F.lit(rule.pattern)
    between, whole, part = F.split("text", rule.pattern, -1), F.regexp_extract_all("text", pattern, F.lit(0)), F.regexp_extract_all("text", pattern, F.lit(rule.group))
    sizes = F.zip_with(F.slice(between, F.lit(1), F.size(whole)), F.zip_with(whole, part, lambda a, b: F.struct(F.length(a).alias("n"), F.length(b).alias("part"))), lambda g, m: F.struct(F.length(g).alias("gap"), m["n"].alias("n"), m["part"].alias("part")))

    def add(done, m):
        start, end = done["at"] + m["gap"], done["at"] + m["gap"] + m["n"]
        own = end - m["part"] if rule.tail else start
        span = F.array(F.struct(own.alias("start"), F.lit(no).alias("no"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(m["part"] >= rule.least, F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    # an array that grows by one is copied each time, so some matches at a time are laid out, and then moved to their places
    empty = F.array().cast(SPAN)
    some = F.transform(F.sequence(F.lit(0), F.floor(F.size(sizes) / TOGETHER).cast("int")), lambda k: F.slice(sizes, k * TOGETHER + 1, F.lit(TOGETHER)))
    laid = F.transform(some, lambda m: F.aggregate(m, F.struct(F.lit(0).alias("at"), empty.alias("spans")), add))

    def move(done, part):
        moved = F.transform(part["spans"], lambda s: F.struct((s["start"] + done["at"]).alias("start"), s["no"].alias("no"), (s["end"] + done["at"]).alias("end")))
        return F.struct((done["at"] + part["at"]).alias("at"), F.concat(done["parts"], F.array(moved)).alias("parts"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("parts"))
    return F.aggregate(laid, none, move, lambda s: F.flatten(s["parts"]))


def scan(docs: DataFrame, base: list[Rule] = BASE, more: list[Rule] = MORE) -> DataFrame:
    """doc_id, n_<kind> per base rule, base_sha256, spans for every row of ``docs`` (doc_id, text).

    Spans are written kind:start:end in code points, end exclusive, by start and then by the order of rules, joined by
    commas; base_sha256 is taken of those of the base rules, spans has all. Matches of a rule are leftmost and do
    not overlap. A null text is empty. Every row is matched on its own text: rows that repeat a doc_id or have none
    are candidates together, and each gets its own result. An empty table gives no rows.
    """
    rules = [*base, *more]
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = candidates(docs, rules)
    marked = docs.join(found.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    empty = F.array().cast(SPAN)
    columns = {}
    for no, rule in enumerate(rules):
        may = F.col(rule.kind) if rule.kind in found.columns else F.col("text").rlike(rule.first or rule.pattern)
        columns[rule.kind] = F.when(may, _spans(rule, no)).otherwise(empty)
    spans = marked.select("doc_id", *[c.alias(f"s{i}") for i, c in enumerate(columns.values())])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    text = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", kinds[s["no"]], s["start"], s["end"])), ",")
    own = [F.col(f"s{i}") for i in range(len(base))]
    rest = [F.col(f"s{i}") for i in range(len(base), len(rules))]
    return spans.select(
        "doc_id", *[F.size(c).cast("long").alias(f"n_{r.kind}") for c, r in zip(own, base, strict=True)],
        F.sha2(text(F.concat(*own)), 256).alias("base_sha256"), text(F.concat(*own, *rest)).alias("spans"),
    )


def _sql(rules: list[Rule], n_base: int) -> str:
    """The scan as SQL, every rule matched against every text."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    found = ", ".join(f"string_split_regex(text, {quoted(r.pattern)}) AS g{i}, regexp_extract_all(text, {quoted(r.pattern)}, 0) AS m{i}, regexp_extract_all(text, {quoted(r.pattern)}, {r.group}) AS p{i}" for i, r in enumerate(rules))
    spans = ", ".join(
        f"""list_transform(list_filter(list_transform(range(1, len(m{i}) + 1), lambda k: {{'start': list_sum(list_transform(g{i}[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m{i}[1:k - 1], lambda x: length(x))), 0), 'no': {i}, 'n': length(m{i}[k]), 'part': length(p{i}[k])}}),
        lambda s: s.part >= {r.least}), lambda s: {{'start': s.start{' + s.n - s.part' if r.tail else ''}, 'no': s.no, 'kind': '{r.kind}', 'end': s.start + s.n}}) AS s{i}"""
        for i, r in enumerate(rules)
    )
    text = lambda n: f"coalesce(array_to_string(list_transform(list_sort(list_concat({', '.join(f's{i}' for i in range(n))})), lambda s: s.kind || ':' || s.start::BIGINT || ':' || s.end::BIGINT), ','), '')"
    counts = ", ".join(f"len(s{i}) AS n_{rules[i].kind}" for i in range(n_base))
    return f"WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), f AS (SELECT doc_id, {found} FROM d), s AS (SELECT doc_id, {spans} FROM f) SELECT doc_id, {counts}, sha256({text(n_base)}) AS base_sha256, {text(len(rules))} AS spans FROM s"


@query("op8_secrets", _sql([*BASE, *MORE], len(BASE)))
def op8(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
