"""Secret scans through a trigram index, with SQL functions only.

From each rule's regular expression a Boolean query over trigrams is derived that every matching text
satisfies.  The index has, for every trigram of any query, the rows whose lower-cased text holds it.
Postings are gathered by row and the queries decide which rows are candidates; only there is a rule's
expression run.  A rule from which no trigram follows runs on every row.
"""

from __future__ import annotations

from itertools import product
from re import _constants as C, _parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from respan.llm.spans import EMPTY, as_text, labelled, match_spans


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0  # the group whose length counts
    least: int = 1  # code points it must have


#: The base rules, in the order in which they are listed.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # a run of fewer is no match, and a longer one is one match
)
#: Public formats of keys that the base rules do not know.
MORE_RULES = (
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"\b[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
_MOST = 128  # strings kept apart while a query is derived; beyond, what is known so far becomes a condition


def trigram_query(pattern: str) -> list[frozenset[frozenset[str]]]:
    """Conditions that every text with a match meets: in each, all trigrams of one of the sets occur.

    Trigrams are lower case.  An empty list says nothing.
    """
    conditions: list[frozenset[frozenset[str]]] = []
    exact = _conditions(_parser.parse(pattern), {""}, conditions)
    _close(exact, conditions)
    return conditions


def _close(strings: set[str], conditions: list) -> None:
    """The text holds one of ``strings``."""
    if all(len(s) >= 3 for s in strings):
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        least = {s for s in sets if not any(o < s for o in sets)}
        conditions.append(frozenset(least))


def _conditions(nodes, before: set[str], conditions: list) -> set[str]:
    """Follows a sequence: the strings that end the part read so far; conditions are added on the way."""
    strings = before
    for op, value in nodes:
        piece = _strings(op, value)
        if piece is not None and len(strings) * len(piece) <= _MOST:
            strings = {a + b for a, b in product(strings, piece)}
            continue
        _close(strings, conditions)
        strings = {""}
        if op is C.SUBPATTERN:
            strings = _conditions(value[3], {""}, conditions)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[0] > 0:
            _close(_conditions(value[2], {""}, conditions), conditions)
            strings = {""}
    return strings


def _strings(op, value) -> set[str] | None:
    """All lower-cased strings a node can match, or None if they are many or unknown."""
    if op is C.LITERAL:
        return {chr(value).lower()}
    if op is C.AT:
        return {""}
    if op is C.IN:
        if all(o is C.LITERAL for o, _ in value):
            return {chr(v).lower() for _, v in value}
        return None
    if op is C.SUBPATTERN:
        return _sequence(value[3])
    if op is C.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[0] == 0 and value[1] == 1:
        inner = _sequence(value[2])
        return None if inner is None else inner | {""}
    return None


def _sequence(nodes) -> set[str] | None:
    out = {""}
    for op, value in nodes:
        piece = _strings(op, value)
        if piece is None or len(out) * len(piece) > _MOST:
            return None
        out = {a + b for a, b in product(out, piece)}
    return out


def trigram_index(rows: DataFrame, trigrams: list[str], row: str = "row", text: str = "text") -> DataFrame:
    """(trigram, row): the inverted index of ``text``, for the trigrams that queries ask for."""
    # lower-cased once, in a projection of its own, for all trigrams
    low = rows.select(F.col(row).alias("row"), F.lower(text).alias("low"))
    held = F.filter(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]), lambda t: t.isNotNull())
    return low.select(F.explode(held).alias("trigram"), "row").distinct()


def _holds(query, held: Column) -> Column:
    met = F.lit(True)
    for alternatives in query:
        one = F.lit(False)
        for trigrams in sorted(map(sorted, alternatives)):
            every = F.lit(True)
            for t in trigrams:
                every = every & F.array_contains(held, t)
            one = one | every
        met = met & one
    return met


def long_enough(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda x: F.length(x["value"]) >= least)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", more=MORE_RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row.

    ``spans`` has all spans as kind:start:end (code points, end exclusive) by start, then kind; the base
    kinds' spans alone make the digest.  Null and empty texts have none.  One row for each row given,
    repeated rows and null keys too.
    """
    rules = [*BASE_RULES, *more]
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))  # rows that share it are candidates together
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = sorted({t for q in queries.values() for c in q for s in c for t in s})
    postings = trigram_index(rows, asked).groupBy("row").agg(F.collect_set("trigram").alias("held"))
    candidates = postings.select("row", *[_holds(queries[r.kind], F.col("held")).alias(f"may_{r.kind}") for r in rules if queries[r.kind]])
    wanted = F.lit(False)
    for r in rules:
        if queries[r.kind]:
            wanted = wanted | F.col(f"may_{r.kind}")
    met = rows.join(candidates.where(wanted), "row", "left")

    spans = {}
    for r in rules:
        found = long_enough(match_spans(F.col("text"), r.pattern, r.group), r.least)
        spans[r.kind] = F.when(F.col(f"may_{r.kind}"), found).otherwise(F.array().cast(EMPTY)) if queries[r.kind] else found
    met = met.select("doc_id", *[s.alias(f"s_{k}") for k, s in spans.items()])
    marked = {r.kind: labelled(F.col(f"s_{r.kind}"), r.kind, i) for i, r in enumerate(rules)}
    base = F.array_sort(F.concat(*[marked[r.kind] for r in BASE_RULES]))
    return met.select(
        "doc_id",
        *[F.size(f"s_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"),
        as_text(F.array_sort(F.concat(*marked.values()))).alias("spans"),
    )
