"""Personal data by candidate spans and boosted trees, with SQL functions and Spark ML only.

Exact rules give the base spans, which always stay.  Generators of high recall propose more spans, which
may overlap; each is described by its format and by the text around it.  Gradient-boosted trees, fitted on
half of the labelled candidates, score every candidate; one is redacted too if its score reaches the
threshold of its kind, the lowest at which the other half had the wanted precision.

The labels do not repeat the exact rules.  Positive are base spans put, in their own surroundings, into a form
that the exact rules miss: " [at] " for "@", no plus, dots in a card.  Negative are candidates outside the base
spans that checksum, range or shape rule out, or numbers as long as a phone's without a cue before them.  What
is neither is left out of the fit and only scored.  No form is made for addresses, so none are added.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from respan.lineage import cut_lineage
from respan.llm.calibrate import least_right_scores
from respan.llm.spans import EMPTY, as_text, labelled, match_spans

#: The base kinds in the order in which they are listed.  Lookbehinds and possessive repeats
#: change no match; they keep the search linear in texts with very long runs of one class.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

#: Generators: what may be personal data of each kind.
GENERATORS = {
    "email": r"(?<![^\s<>,;:])[^\s@<>,;:]{1,64}+(?:@|\x20?[\[(]at[\])]\x20?)[^\s@<>,;:]{3,253}",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}[\x20.-]?[0-9]{4,6}[\x20.-]?[0-9]{4,5}[\x20.-]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9])[+(]?[0-9][\x20().0-9-]{5,20}[0-9](?![0-9])",
}
PRECISION = 0.99
_CONTEXT = 40
_CUES = {
    "email": "mail|contact|write|correo|courriel",
    "ip": r"\bip\b|address|server|host",
    "card": "card|visa|credit|pay|tarjeta|carte|karte",
    "phone": r"phone|\btel|call|mobile|teléfono|téléphone|telefon",
}
FEATURES = (
    "f_kind f_length f_digits f_letters f_groups f_dots f_spaces f_plus f_brackets f_at f_luhn f_largest f_cue f_before_word f_after_word f_repeat f_valid"
).split()


class Boosted(NamedTuple):
    """The fitted trees and the threshold of each kind (none: nothing of that kind is added)."""

    trees: object
    thresholds: dict[str, float]
    fitted: int = 0  # labelled candidates that the trees were fitted on
    held: int = 0  # labelled candidates that set the thresholds


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether 1 to 19 digits pass the Luhn sum."""
    places = F.sequence(F.lit(1), F.length(digits))
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(digits).between(1, 19), total % 10 == 0).otherwise(False)


def _valid(kind: str, value: Column) -> Column:
    digits = F.length(digits_of(value))
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(digits.between(13, 19), luhn(digits_of(value))).otherwise(False)
    if kind == "phone":
        return digits.between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Leftmost non-overlapping matches of a base kind, failing ones dropped."""
    return F.filter(match_spans(text, BASE_PATTERNS[kind]), lambda x: _valid(kind, x["value"]))


def candidates(rows: DataFrame) -> DataFrame:
    """Every proposed span of (row, text): kind, start, stop, value, the text around it, features, and ``base`` (1 if it overlaps a base span)."""
    spans = []
    for i, kind in enumerate(GENERATORS):
        found = match_spans(F.col("text"), GENERATORS[kind])
        spans.append(_with_base(found, kind, i))
    one = rows.select("row", "text", F.explode(F.concat(*spans)).alias("x")).select("row", "text", "x.*")
    head = F.substring(F.col("text"), F.greatest(F.lit(1), F.col("start") + 1 - _CONTEXT), F.least(F.lit(_CONTEXT), F.col("start")))
    tail = F.substring(F.col("text"), F.col("stop") + 1, F.lit(_CONTEXT))
    before, after = F.lower(head), F.substring(tail, 1, 1)
    value, digits = F.col("value"), digits_of(F.col("value"))
    count = lambda pattern: F.regexp_count(value, F.lit(pattern)).cast("double")
    cue = F.lit(False)
    for kind, words in _CUES.items():
        cue = cue | ((F.col("kind") == kind) & before.rlike(words))
    largest = F.array_max(F.transform(F.split(F.regexp_replace(value, "[^0-9]+", " "), " "), lambda x: F.length(x)))
    number = lambda c: c.cast("double")
    return one.select(
        "row", "kind", "start", "stop", "value", head.alias("head"), tail.alias("tail"), F.col("base").alias("base"),
        number(F.col("rank")).alias("f_kind"), number(F.length(value)).alias("f_length"), number(F.length(digits)).alias("f_digits"),
        count("[A-Za-z]").alias("f_letters"), count("[0-9]+").alias("f_groups"), count(r"\.").alias("f_dots"), count(" ").alias("f_spaces"),
        count(r"\+").alias("f_plus"), count(r"[\[\]()]").alias("f_brackets"), count("@").alias("f_at"), number(luhn(digits)).alias("f_luhn"),
        number(F.coalesce(largest, F.lit(0))).alias("f_largest"), number(cue).alias("f_cue"),
        number(before.rlike("[a-z0-9]$")).alias("f_before_word"), number(after.rlike("[A-Za-z0-9]")).alias("f_after_word"),
        number(value.rlike(r"^([0-9])\1{5}")).alias("f_repeat"), number(plausible(F.col("kind"), value)).alias("f_valid"),
    )


def plausible(kind: Column, value: Column) -> Column:
    """Whether shape, range and checksum of a candidate allow its kind, whatever form it is written in."""
    address = F.regexp_replace(value, r"\x20?[\[(]at[\])]\x20?", "@")
    email = address.rlike(rf"^[\"'(\[]*{_LOCAL}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+[^A-Za-z0-9]*$")
    return F.when(kind == "email", email).when(kind == "ip", _valid("ip", value)).when(kind == "card", _valid("card", value)).otherwise(_valid("phone", value))


def _with_base(found: Column, kind: str, rank: int) -> Column:
    text = F.col("text")
    base = F.when(F.size(found) > 0, base_spans(text, kind)).otherwise(F.array().cast(EMPTY))

    def describe(x):
        hit = F.exists(base, lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"]))
        return F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"), hit.cast("int").alias("base"))

    return F.transform(found, describe)


def fit_trees(found: DataFrame, precision: float = PRECISION) -> Boosted | None:
    """Trees and thresholds from all candidates, cut in halves by a hash; None if they have one label only.  Runs jobs over ``found``."""
    chosen = found.withColumn("fit", F.pmod(F.xxhash64("row", "kind", "start"), F.lit(2)) == 0)
    negative = chosen.where("base = 0 and (f_valid = 0 or (kind = 'phone' and f_cue = 0))").withColumn("label", F.lit(0.0))
    columns = ["kind", "fit", "label", *FEATURES]
    labelled_rows = cut_lineage(negative.select(columns).union(_reformatted(chosen).select(columns)))
    fit = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled_rows)
    sizes = {(r.fit, r.label): r.n for r in fit.groupBy("fit", "label").agg(F.count("*").alias("n")).collect()}
    if {label for own, label in sizes if own} != {0.0, 1.0}:
        return None
    trees = GBTClassifier(labelCol="label", maxIter=10, maxDepth=4, seed=1, checkpointInterval=-1).fit(fit.where("fit"))
    thresholds = least_right_scores(scored(fit.where("not fit"), trees).select("kind", "score", "label"), precision)
    return Boosted(trees, thresholds, *[sum(n for (own, _), n in sizes.items() if own == half) for half in (True, False)])


def _reformatted(chosen: DataFrame) -> DataFrame:
    """The candidates that the generators find in base spans once these are written in a form the exact rules miss."""
    value, digits = F.col("value"), digits_of(F.col("value"))
    dotted = F.regexp_replace(digits, "^([0-9]{4})([0-9]{4})([0-9]{4})([0-9]+)$", "$1.$2.$3.$4")
    form = F.when(F.col("kind") == "email", F.replace(value, F.lit("@"), F.lit(" [at] "))).when(F.col("kind") == "card", dotted)
    form = form.when(F.col("kind") == "phone", F.replace(value, F.lit("+"), F.lit("")))
    rows = chosen.where("base = 1 and f_valid = 1").withColumn("form", form).where("form <> value")
    place = F.struct(F.col("kind").alias("of"), "fit", F.length("head").alias("lo"), (F.length("head") + F.length("form")).alias("hi"))
    again = candidates(rows.select(place.alias("row"), F.concat("head", "form", "tail").alias("text")))
    inside = (F.col("kind") == F.col("row.of")) & (F.col("start") < F.col("row.hi")) & (F.col("row.lo") < F.col("stop"))
    return again.where(inside & (F.col("base") == 0) & (F.col("f_valid") == 1)).withColumn("label", F.lit(1.0)).withColumn("fit", F.col("row.fit"))


def scored(found: DataFrame, trees) -> DataFrame:
    """``found`` (with its vector of features) and ``score``, the trees' probability."""
    return trees.transform(found).withColumn("score", F.element_at(vector_to_array("probability"), 2))


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row.

    ``spans`` has all spans as kind:start:end (code points, end exclusive) by kind, then start; base spans
    alone make the digest.  Added spans never overlap a base span of their kind.  Null and empty texts have
    none.  One row for each row given, repeated rows and null keys too.  Runs jobs to fit the trees.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    found = cut_lineage(candidates(rows))  # found once, for the fit and for the scores
    model = fit_trees(found)
    base = rows.select("doc_id", "row", *[base_spans(F.col("text"), k).alias(f"s_{k}") for k in BASE_PATTERNS])
    kinds = list(BASE_PATTERNS)
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")
    if model is None or not model.thresholds:
        base = base.withColumn("added", none)
    else:
        reach = F.lit(False)
        for kind, least in model.thresholds.items():
            reach = reach | ((F.col("kind") == kind) & (F.col("score") >= least))
        fresh = scored(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found.where("base = 0").drop("value", "head", "tail").distinct()), model.trees).where(reach)
        one = F.struct("start", F.col("f_kind").cast("int").alias("rank"), "stop", "kind")
        base = base.join(fresh.groupBy("row").agg(F.collect_set(one).alias("added")), "row", "left").withColumn("added", F.coalesce("added", none))
    parts = [labelled(F.col(f"s_{k}"), k, i) for i, k in enumerate(kinds)]
    by_kind = lambda a, b: F.when(a["rank"] != b["rank"], a["rank"] - b["rank"]).when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["stop"] - b["stop"])
    return base.select(
        "doc_id",
        *[F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(as_text(F.concat(*parts)).cast("binary"), 256).alias("base_sha256"),
        as_text(F.array_sort(F.concat(*parts, F.col("added")), by_kind)).alias("spans"),
    )
