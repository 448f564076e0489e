"""Where a regular expression matches in a text column, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EMPTY = "array<struct<start:int,stop:int,value:string>>"


def match_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: code-point ``start`` and ``stop``, and the ``value`` of ``group``.

    SQL tells the matches but not their places; these follow from the lengths of the matches and of the
    pieces between them.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))  # the last piece follows the last match
    sizes = F.zip_with(gaps, found, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size")))
    parts = F.zip_with(sizes, values, lambda x, v: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), v.alias("value")))
    empty = F.array().cast(EMPTY)
    state = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def add(s, x):
        start = s["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["size"]).alias("stop"), x["value"].alias("value"))
        return F.struct((start + x["size"]).alias("at"), F.concat(s["spans"], F.array(span)).alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(parts, state, add, lambda s: s["spans"])).otherwise(empty)


def labelled(spans: Column, kind: str, order: int) -> Column:
    """Spans as (start, rank, stop, kind), for sorting by start and then kind."""
    return F.transform(
        spans, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("rank"), x["stop"].alias("stop"), F.lit(kind).alias("kind"))
    )


def as_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
