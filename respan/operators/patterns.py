"""Respondents by their answers: equal answer patterns, and patterns that differ in few items.

An answer is a respondent's 0 or 1 to an item; of contradicting answers to one item the least counts, others are left out.
Patterns are compared as bit masks (items answered, items right) in a few integers.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from respan.lineage import cut_lineage
from respan.operators.dedupe import answer_lists

LIST = 1024  # classes of one key that a task holds against the others; a longer list is dealt over several tasks
UNROLLED = 8  # words of a pattern up to which comparisons are written out


# ---- equal patterns ------------------------------------------------------

def answered_cells(resp: DataFrame, key: str = "global_id") -> DataFrame:
    """(key, QID, response), one row for each item that a respondent answered.  Repeats collapse before the shuffle."""
    known = resp.where(F.col("response").isNotNull() & F.col(key).isNotNull() & F.col("QID").isNotNull())
    return known.groupBy(key, "QID").agg(F.min("response").alias("response"))


def fingerprints(cells: DataFrame, key: str = "global_id") -> DataFrame:
    """(key, n_items, f1, f2): 128 bits that equal sets of answers share, whatever their order.

    The bits of all answers are combined by exclusive or, so a task sends one row for each of its respondents.
    """
    bits = [F.bit_xor(F.xxhash64(F.lit(s), "QID", "response")).alias(f"f{s}") for s in (1, 2)]
    return cells.groupBy(key).agg(F.count("*").alias("n_items"), *bits)


def _digest(cells: Column) -> Column:
    text = F.transform(F.array_sort(cells), lambda c: F.concat_ws("=", c["QID"], c["response"].cast("string")))
    return F.sha2(F.array_join(text, ","), 256)


def equal_pattern_groups(resp: DataFrame, key: str = "global_id") -> DataFrame:
    """``pattern, n_items, n_respondents, first_id`` of answer patterns that more than one respondent shows.

    Respondents are grouped by fingerprint; inside a group every answer must be given by all of it, which counts settle.  Answers are
    gathered (into the digest ``pattern``) for groups, not for respondents.  Members of a group in which fingerprints met by
    chance are told apart by all of their answers.
    """
    cells = answered_cells(resp, key)
    prints = fingerprints(cells, key)
    same = ["f1", "f2", "n_items"]
    groups = prints.groupBy(*same).agg(F.count("*").alias("n_respondents"), F.min(key).alias("first_id")).where("n_respondents > 1")
    members = prints.join(groups.select(*same, "n_respondents", "first_id"), same).select(key, "first_id", *same, "n_respondents")
    shared = cells.join(members, key).groupBy("first_id", *same, "n_respondents", "QID", "response").agg(F.count("*").alias("n"))
    told = shared.groupBy("first_id", *same, "n_respondents").agg(
        F.collect_list(F.struct("QID", "response")).alias("cells"), F.min(F.col("n") == F.col("n_respondents")).alias("equal")
    )
    good = told.where("equal").select(_digest(F.col("cells")).alias("pattern"), "n_items", "n_respondents", "first_id")
    mixed = told.where("not equal").select("first_id", *same)
    apart = cells.join(members.join(mixed, ["first_id", *same], "left_semi").select(key), key, "left_semi")
    lists = answer_lists(apart, key, F.col("QID"), F.col("response")).select(key, F.transform("cells", lambda c: F.struct(c["i"].alias("QID"), c["y"].alias("response"))).alias("cells"))
    split = lists.select(key, _digest(F.col("cells")).alias("pattern"), F.size("cells").cast("long").alias("n_items"))
    split = split.groupBy("pattern", "n_items").agg(F.count("*").alias("n_respondents"), F.min(key).alias("first_id")).where("n_respondents > 1")
    return good.unionByName(split)


# ---- similar patterns ----------------------------------------------------

def answer_masks(resp: DataFrame, items: list[str], word: int, key: str = "global_id") -> DataFrame:
    """(key, n, answered, correct): numbers and bits of the answered items, ``word`` items in each integer."""
    spark = resp.sparkSession
    index = spark.createDataFrame([(q, i // word, i % word) for i, q in enumerate(items)], "QID string, w int, b int")
    cells = answered_cells(resp.where("response in (0, 1)"), key).join(F.broadcast(index), "QID")  # the item list of the driver
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b"))
    words = range(-(-len(items) // word))
    sums = [F.sum(F.when(F.col("w") == w, bit * of).otherwise(0)).alias(f"{name}{w}") for name, of in (("a", F.lit(1)), ("c", F.col("response"))) for w in words]
    one = cells.groupBy(key).agg(F.count("*").cast("int").alias("n"), *sums)
    as_array = lambda name: F.array(*[F.col(f"{name}{w}") for w in words]).cast("array<long>")
    return one.select(key, "n", as_array("a").alias("answered"), as_array("c").alias("correct"))


def _bits(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + F.bit_count(x))


def _pair(a: Column, b: Column, f) -> Column:
    return F.zip_with(a, b, f)


def _tokens(word: int, width: int, n_items: int) -> Column:
    """The bands of ``width`` items in which something is answered, each with its answers, as one integer."""
    low = (1 << width) - 1

    def token(band: Column) -> Column:
        at, shift = F.floor(band * width / word).cast("int"), F.pmod(band * width, F.lit(word))
        part = lambda m: F.call_function("shiftright", F.get(m, at), shift).bitwiseAND(F.lit(low).cast("long"))
        return F.struct(part("answered").alias("a"), part("correct").alias("c"), band.alias("band"))

    bands = F.transform(F.sequence(F.lit(0), F.lit(-(-n_items // width) - 1)), token)
    return F.transform(F.filter(bands, lambda t: t["a"] > 0), lambda t: (t["band"].cast("long") * (1 << width) + t["a"]) * (1 << width) + t["c"])


def pattern_classes(masks: DataFrame, key: str = "global_id") -> tuple[DataFrame, DataFrame]:
    """Membership (key, class_id) and the classes (class_id, n_members, n, answered, correct) of equal patterns; the least key names a class."""
    same = ["n", "answered", "correct"]
    classes = masks.groupBy(*same).agg(F.min(key).alias("class_id"), F.count("*").alias("n_members"))
    return masks.join(classes, same).select(key, "class_id"), classes.select("class_id", "n_members", *same)


def meeting_keys(own: DataFrame, max_diff: int) -> DataFrame:
    """(class_id, key): the keys by which similar classes meet, from classes with ``tokens``, the bands' answers.

    Similar patterns share all but max_diff bands of the one with more.  Ordered by rarity, their first max_diff + 3 bands then have
    three in common if that one has so many, and the triples of those bands are keys.  Classes of max_diff + 2 bands or fewer meet each
    other by pairs.  A key is a hash; what meets by chance only costs a comparison.  Runs a job.
    """
    held = cut_lineage(own.select("class_id", "tokens"))  # read twice: made once
    often = held.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("times"))  # at most bands * 3^width rows
    first = held.select("class_id", F.explode("tokens").alias("t")).join(often, "t")
    ranked = first.groupBy("class_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("times", "t"))), 1, max_diff + 3)["t"].alias("p"))

    def keys(of: int, among: int) -> Column:
        known = lambda at: F.get("p", F.lit(max(at))).isNotNull()
        at = combinations(range(among), of)
        return F.array(*[F.when(known(c), F.xxhash64(F.lit(of), *[F.get("p", F.lit(i)) for i in sorted(c)])) for c in at])

    few = F.when(F.size("p") <= max_diff + 2, keys(2, max_diff + 2)).otherwise(F.array().cast("array<bigint>"))
    return ranked.select("class_id", F.explode(F.array_distinct(F.concat(keys(3, max_diff + 3), few))).alias("key")).where("key is not null")


def similar_classes(classes: DataFrame, n_items: int, word: int, max_diff: int = 2, min_joint: int = 12) -> DataFrame:
    """(a, b, n_joint, n_diff): pairs of classes, a < b, that differ in at most ``max_diff`` items and share ``min_joint``.

    An item counts as different if both answered it differently or one alone answered it.  Items are cut into bands of
    min_joint div (max_diff + 2) items, so that a pattern with enough answers has max_diff + 2 bands or more, of which two similar ones
    share all but max_diff.  They meet by the triples or pairs of their rarest bands (``meeting_keys``); what meets nothing is left out
    before answers are attached.  Long lists are dealt over tasks; in a list lengths and bits decide, so only similar pairs leave it.
    """
    width = max(1, min_joint // (max_diff + 2))
    if width > word or word % width:
        raise ValueError("a band must not cross words")
    own = classes.where(F.col("n") >= min_joint).withColumn("tokens", _tokens(word, width, n_items))
    entries = cut_lineage(meeting_keys(own, max_diff))
    lists = entries.groupBy("key").agg(F.count("*").alias("length")).where("length > 1")
    parts = F.ceil(F.col("length") / LIST).cast("int")
    held = cut_lineage(entries.join(lists.select("key", parts.alias("parts")), "key").join(own.select("class_id", "n", "answered", "correct"), "class_id"))
    left = held.withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("parts")).cast("int")).alias("l")
    right = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("r")
    a, b = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
    n_joint, wrong = _joint_and_wrong(a, b, -(-n_items // word))
    n_diff = a("n") + b("n") - 2 * n_joint + wrong
    meets = (a("key") == b("key")) & (a("part") == b("part")) & (a("class_id") < b("class_id")) & (F.abs(a("n") - b("n")) <= max_diff)
    found = left.join(right, meets & (n_joint >= min_joint) & (n_diff <= max_diff))
    return found.select(a("class_id").alias("a"), b("class_id").alias("b"), n_joint.alias("n_joint"), n_diff.alias("n_diff")).distinct()


def _joint_and_wrong(a, b, words: int) -> tuple[Column, Column]:
    """Numbers of items that both answered, and that both answered differently; few words are written out, which Spark compiles."""
    if words > UNROLLED:
        joint = _pair(a("answered"), b("answered"), lambda x, y: x.bitwiseAND(y))
        return _bits(joint), _bits(_pair(joint, _pair(a("correct"), b("correct"), lambda x, y: x.bitwiseXOR(y)), lambda x, y: x.bitwiseAND(y)))
    at = lambda c, i: F.get(c, F.lit(i))
    joint = [at(a("answered"), i).bitwiseAND(at(b("answered"), i)) for i in range(words)]
    wrong = [j.bitwiseAND(at(a("correct"), i).bitwiseXOR(at(b("correct"), i))) for i, j in enumerate(joint)]
    total = lambda masks: sum((F.bit_count(m) for m in masks), F.lit(0))
    return total(joint), total(wrong)


def likely_duplicates(resp: DataFrame, items: list[str], max_diff: int = 2, min_joint: int = 12, key: str = "global_id") -> tuple[DataFrame, DataFrame]:
    """Likely the same person twice, by the answers: membership of every respondent, and links between classes.

    The first table has ``key, class_id, n_members, n_links``: respondents with equal answers form a class, named by the least key, and
    ``n_links`` counts other classes similar to it.  The second has the links (``similar_classes``).  Respondents without an answer
    to ``items`` are left out.  Runs jobs.
    """
    width = max(1, min_joint // (max_diff + 2))
    word = max(60 // width, 1) * width
    members, classes = pattern_classes(cut_lineage(answer_masks(resp, items, word, key)), key)
    classes = cut_lineage(classes)
    links = cut_lineage(similar_classes(classes, len(items), word, max_diff, min_joint))
    ends = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    told = members.join(classes.select("class_id", "n_members"), "class_id").join(ends, "class_id", "left")
    return told.select(key, "class_id", "n_members", F.coalesce("n_links", F.lit(0)).alias("n_links")), links
