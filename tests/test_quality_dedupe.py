import pytest
from pyspark.sql import functions as F

from respan.operators import dedupe, patterns, quality as qa, selection as sel


def test_gates_stop_or_report(spark):
    df = spark.createDataFrame([(1, "accept"), (2, "maybe"), (3, None)], "audit_row int, d string")
    report = qa.check(df, [qa.allowed_values("d", ["accept"]), qa.not_null("d", "warn")], "audit_row")
    got = {r["gate"]: (r["n_violations"], r["sample"]) for r in report.collect()}
    assert got == {"d_allowed": (1, "2"), "d_present": (1, "3")}
    with pytest.raises(qa.GateError, match="d_allowed"):
        qa.enforce(report)
    qa.enforce(report.filter("severity = 'warn'"))


def test_hard_gates(spark):
    df = spark.createDataFrame([("a",), ("a",)], "global_id string")
    with pytest.raises(qa.GateError):
        qa.require_unique(df, ["global_id"])
    with pytest.raises(qa.GateError, match="wave"):
        qa.require_columns(df, ["global_id", "wave"])
    with pytest.raises(qa.GateError):
        qa.require_item_count(df, 180)
    with pytest.raises(qa.GateError):
        qa.require_rows(df.filter("false"))
    assert qa.require_rows(df) is df


def test_review_needs_its_decision_column(spark):
    cols = "audit_row int, source_name string, question_id string, domainId string, source_stem string, human_final_qid string"
    review = spark.createDataFrame([(1, "s", "q", "d", "t", " ")], cols)
    with pytest.raises(qa.GateError, match="human_final_decision"):
        qa.clean_review(review)
    clean = qa.clean_review(review.withColumn("human_final_decision", F.lit(" Accept "))).collect()[0]
    assert clean["human_final_decision"] == "accept" and clean["human_final_qid"] is None and clean["audit_status"] is None


def test_hot_duplicate_group_gives_linear_pairs(spark):
    """A third of all rows share one key: n - 1 pairs, not n squared."""
    df = spark.range(0, 6000).select(
        F.format_string("g%05d", "id").alias("global_id"),
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.when(F.col("id") == 0, "main").otherwise("trial").alias("wave"),
    )
    pairs = dedupe.duplicate_pairs(df, ["k"])
    assert pairs.count() == 1999 and pairs.select("survivor_id").distinct().collect()[0][0] == "g00000"


def test_patch_takes_first_known_value(spark):
    df = spark.createDataFrame(
        [("a", None, "x"), ("b", None, "y"), ("c", 5, None), ("d", 6, None)], "global_id string, age int, gender string"
    )
    pairs = spark.createDataFrame([("a", "b"), ("a", "d"), ("a", "c")], "survivor_id string, matched_id string")
    got = {r["global_id"]: (r["age"], r["gender"]) for r in dedupe.patch_rows(df, pairs, ["age", "gender"]).collect()}
    assert got == {"a": (5, "x"), "b": (None, "y"), "c": (5, None), "d": (6, None)}


def test_item_timing_crosses_buckets(spark):
    df = spark.sql("""select * from values ('u', timestamp'2024-01-01 00:00:10', 1), ('u', timestamp'2024-01-01 00:00:40', 2),
      ('u', timestamp'2024-01-01 05:00:00', 3), ('v', timestamp'2024-01-01 00:00:00', 4) as t(u, ts, i)""")
    got = {r["i"]: r["step_seconds"] for r in dedupe.item_timing(df, "u", "ts", 60).collect()}
    assert got == {1: None, 2: 30.0, 3: 17960.0, 4: None}


def test_patterns_ignore_row_order_and_repeats(spark):
    rows = [("a", "Q1", 1), ("a", "Q2", 0), ("b", "Q2", 0), ("b", "Q1", 1), ("b", "Q1", 1), ("c", "Q1", 0)]
    got = patterns.equal_pattern_groups(spark.createDataFrame(rows, "global_id string, QID string, response int")).collect()
    assert len(got) == 1 and got[0]["n_respondents"] == 2 and got[0]["first_id"] == "a" and got[0]["n_items"] == 2


def test_unknown_domain_counts_nowhere(spark):
    df = spark.createDataFrame([("inference", 400), (None, 400), ("summary_synthesis", 10)], "domain string, overall_n long")
    got = {r["domain"]: r["n_items"] for r in sel.domain_table(df, "overall_n", 300).collect()}
    assert got == {"identifying_details": 0, "inference": 1, "language_vocabulary": 0, "purpose_point_of_view": 0,
                   "summary_synthesis": 0, "Total": 1}


def test_factor_levels_can_follow_the_dif_groups(spark):
    counts = spark.createDataFrame(
        [("Q001s1", "gender", "F", 90), ("Q001s1", "gender", "M", 80), ("Q001s1", "gender", None, 3),
         ("Q001s1", "pell", "NA", 2), ("Q001s1", "pell", "Yes", 70), ("Q001s1", "wave", "w", 5)],
        "QID string, demographic string, group_value string, n_responded long",
    )
    a = sel.selection_metrics(counts, dif=["gender", "pell"], factors=["gender", "pell"], labels="b").collect()[0]
    b = sel.selection_metrics(counts, dif=["gender"]).collect()[0]
    assert (a["overall_n"], a["min_dif_n"], a["min_factor_n"], a["domain"]) == (173, 70, 70, "structure")
    assert (b["min_dif_n"], b["min_factor_n"], b["domain"]) == (80, 5, "summary_synthesis")


def test_missing_patterns_and_pairs(spark):
    """Over more columns than one integer holds."""
    import random

    rng = random.Random(2)
    cols = [f"c{i:03d}" for i in range(130)]
    sheets = [[None if rng.random() < 0.1 else 1 for _ in cols] for _ in range(60)] + [[None] * 130, [1] * 130, [1] * 130]
    df = spark.createDataFrame(sheets, ", ".join(f"{c} int" for c in cols)).repartition(4)
    gone = [[c for c, v in zip(cols, s) if v is None] for s in sheets]
    want = {}
    for g in gone:
        want[",".join(g)] = want.get(",".join(g), 0) + 1
    assert {r["missing"]: (r["n_missing"], r["n_rows"]) for r in qa.missing_patterns(df, cols).collect()} == {k: (len(k.split(",")) if k else 0, n) for k, n in want.items()}
    pairs = {}
    for g in gone:
        for i, a in enumerate(g):
            for b in g[i:]:
                pairs[a, b] = pairs.get((a, b), 0) + 1
    assert {(r["column_1"], r["column_2"]): r["n_rows"] for r in qa.co_missingness(df, cols).collect()} == pairs
    assert qa.co_missingness(df.limit(0), cols).isEmpty()
