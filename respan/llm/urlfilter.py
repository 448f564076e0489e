"""URL filter: a list of rules decides first, boosted trees on lexical features decide the rest.

A url's host is what stands between its first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z
lower-cased; its path goes on to ``?``, ``#`` or the end.  The trees see lengths, depth, shares of digits and signs,
entropy, numbers of parameters, and how often urls below the same host suffixes were blocked among the
labelled ones.  Those statistics are kept in a fixed number of counters, to which suffixes are hashed, so what is
broadcast does not grow with the hosts, and no row is shuffled to be judged.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from respan.lineage import cut_lineage
from respan.llm.calibrate import least_right_scores

COUNTERS = 1 << 16  # for the suffixes of one length
SUFFIXES = (2, 3)  # labels of a suffix
PRECISION = 0.95  # share of right ones that blocked urls have on held-out hosts
_PRIOR = 5.0  # urls that the overall share counts as in a suffix's
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    action: str  # "block" or "allow"
    pattern: str  # host and path, like "example.net/en/"

    @property
    def host(self) -> str:
        return self.pattern.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


class UrlModel(NamedTuple):
    trees: object | None  # fitted trees; None if the labels were of one kind
    threshold: float
    suffixes: DataFrame  # (level, slot, n, blocked), at most len(SUFFIXES) * COUNTERS rows
    share: float  # of blocked urls among the labelled
    fitted: int = 0  # labelled urls that the trees were fitted on
    held: int = 0  # labelled urls that set the threshold


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Pattern and action of the longest rule that fits; null if none does.  Of equally long ones the first given counts."""
    ordered = sorted(rules, key=lambda r: -len(r.pattern))

    def fits(r: Rule) -> Column:
        return ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)

    chosen = lambda value: F.coalesce(*[F.when(fits(r), F.lit(value(r))) for r in ordered], F.lit(None).cast("string"))
    return chosen(lambda r: r.pattern), chosen(lambda r: r.action)


def _entropy(text: Column) -> Column:
    """Bits a character."""
    n = F.length(text).cast("double")
    times = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(c != "", n - F.length(F.replace(text, c, F.lit("")))).otherwise(F.lit(0.0)))
    bits = F.aggregate(F.filter(times, lambda k: k > 0), F.lit(0.0), lambda a, k: a - k / n * F.log2(k / n))
    return F.coalesce(F.when(n > 0, bits), F.lit(0.0))


FEATURES = [
    "f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digit_ratio", "f_host_digits", "f_entropy", "f_host_entropy",
    "f_parameters", "f_hyphens", "f_signs", "f_longest_label", "f_fragment", "f_secure", *(f"f_{what}_{k}" for k in SUFFIXES for what in ("blocked", "seen")),
]


def lexical(urls: DataFrame, url: str) -> DataFrame:
    """All columns, and __host, __path and the features that depend on the url alone."""
    u = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    out = urls.withColumn("__u", u).withColumn("__host", url_host(F.col("__u"))).withColumn("__path", url_path(F.col("__u")))
    u, host, path = F.col("__u"), F.col("__host"), F.col("__path")
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    size = lambda text: F.length(text).cast("double")
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    per = lambda n, text: F.when(size(text) > 0, n / size(text)).otherwise(0.0)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    return out.withColumns({
        "f_length": size(u), "f_host_length": size(host), "f_path_length": size(path), "f_depth": count(path, "/[^/]+"),
        "f_labels": F.size(labels).cast("double"), "f_digit_ratio": per(count(u, "[0-9]"), u), "f_host_digits": per(count(host, "[0-9]"), host),
        "f_entropy": _entropy(u), "f_host_entropy": _entropy(host), "f_parameters": count(query, "[^&]+"), "f_hyphens": count(host, "-"),
        "f_signs": count(u, r"[^A-Za-z0-9/.:]"), "f_longest_label": F.coalesce(F.array_max(F.transform(labels, lambda x: F.length(x))), F.lit(0)).cast("double"),
        "f_fragment": F.instr(u, "#").cast("boolean").cast("double"), "f_secure": F.lower(u).startswith("https:").cast("double"),
    })


def _slot(host: Column, level: int) -> Column:
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - level + 1, F.lit(1)), level), ".")
    return F.pmod(F.xxhash64(suffix), F.lit(COUNTERS)).cast("int")


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """(level, slot, n, blocked) over all labelled rows (__host, blocked)."""
    slots = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), _slot(F.col("__host"), k).alias("slot")) for k in SUFFIXES]))
    return labelled.select(slots.alias("s"), "blocked").groupBy("s.level", "s.slot").agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked"))


def with_suffixes(urls: DataFrame, suffixes: DataFrame, share: float, own: bool) -> DataFrame:
    """Adds the suffix features; with ``own`` a row's label (``blocked``) is left out of them."""
    for k in SUFFIXES:
        table = suffixes.where(F.col("level") == k).select(F.col("slot").alias("__slot"), F.col("n").alias("__n"), F.col("blocked").alias("__b"))
        urls = urls.withColumn("__slot", _slot(F.col("__host"), k)).join(F.broadcast(table), "__slot", "left")  # at most COUNTERS rows
        n, b = F.coalesce("__n", F.lit(0)), F.coalesce("__b", F.lit(0))
        if own:
            n, b = n - 1, b - F.col("blocked")
        urls = urls.withColumn(f"f_blocked_{k}", (b + _PRIOR * share) / (n + _PRIOR)).withColumn(f"f_seen_{k}", F.log1p(n.cast("double"))).drop("__slot", "__n", "__b")
    return urls


def fit_urls(labelled: DataFrame, url: str = "url", blocked: str = "blocked", precision: float = PRECISION) -> UrlModel | None:
    """Trees from labelled urls; None without any label.  Runs jobs.

    Suffix statistics count every different labelled url once.  Urls of a quarter of the hosts, chosen by a hash, are held
    out and set the threshold: the lowest score from which on the share ``precision`` of them is blocked rightly.  Trees are
    fitted on all others.  Null urls and labels are left out; a url with
    several labels counts as blocked.
    """
    flag = F.max(F.col(f"`{blocked}`").cast("int")).alias("blocked")
    rows = labelled.where(F.col(f"`{url}`").isNotNull() & F.col(f"`{blocked}`").isNotNull()).groupBy(F.col(f"`{url}`").cast("string").alias("url")).agg(flag)
    rows = rows.withColumn("__host", url_host(F.col("url")))
    total = rows.agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked")).first()
    if not total.n:
        return None
    share = total.blocked / total.n
    suffixes = suffix_statistics(rows)
    if total.blocked in (0, total.n):
        return UrlModel(None, 0.5, suffixes, share)
    rows = rows.orderBy(F.xxhash64("url"), "url")  # the trees do not depend on how the urls lie
    held = F.pmod(F.xxhash64(F.lit("held"), "__host"), F.lit(4)) == 0
    table = with_suffixes(lexical(rows, "url"), suffixes, share, own=True).select("url", held.alias("held"), F.col("blocked").cast("double").alias("label"), *FEATURES)
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table).select("url", "held", "label", "features").transform(cut_lineage)
    fit = table.where("not held")
    kinds = {r.label: r.n for r in fit.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        fit = table
    trees = GBTClassifier(labelCol="label", maxIter=12, maxDepth=4, seed=1, checkpointInterval=-1).fit(fit)
    kept = trees.transform(table.where("held")).select(_probability().alias("score"), "label")
    reached = least_right_scores(kept.withColumn("kind", F.lit("url")), precision)
    n_held = total.n - sum(kinds.values())
    threshold = 0.5
    if n_held:
        threshold = max(0.5, reached["url"]) if reached else 1.1  # never sure enough: nothing is blocked
    return UrlModel(trees, threshold, suffixes, share, total.n if len(kinds) < 2 else sum(kinds.values()), n_held)


def _probability() -> Column:
    return F.element_at(vector_to_array("probability"), 2)


def judge_urls(urls: DataFrame, model: UrlModel | None, rules: list[Rule], url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns if None), host, path, rule, score and verdict of every row.

    ``verdict`` is the action of the longest rule that fits, else "block" where the trees' ``score`` reaches the threshold.
    ``rule`` and ``score`` are null where there is none.  A null url, or one without ``://``, has an empty host and path and is judged by its
    features.  Without a model what no rule fits is allowed.  A column named like a new one is replaced.
    """
    new = ("host", "path", "rule", "score", "verdict")
    keep = [c for c in (urls.columns if keep is None else keep) if c not in new]
    names = {c: f"__k{i}" for i, c in enumerate(keep)}
    rows = urls.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col(f"`{url}`").cast("string").alias("__url"))
    rows = lexical(rows, "__url")
    if model is None or model.trees is None:
        score, least = F.lit(0.0 if model is None else model.share), 0.5
    else:
        rows = with_suffixes(rows, model.suffixes, model.share, own=False)
        rows = model.trees.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
        score, least = _probability(), model.threshold
    pattern, action = fitting_rule(F.col("__host"), F.col("__path"), rules)
    out = rows.select(*names.values(), F.col("__host").alias("host"), F.col("__path").alias("path"), pattern.alias("rule"), action.alias("action"), score.alias("score"))
    verdict = F.coalesce("action", F.when(F.col("score") >= least, "block").otherwise("allow"))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], "host", "path", "rule", F.when(F.col("rule").isNull(), F.col("score")).alias("score"), verdict.alias("verdict"))
