import pytest
from pyspark.sql import functions as F

from respan.functions import columns as cf, qid as qf
from respan.operators import rows
from respan.operators.quantiles import exact_quantiles

import numpy as np


def test_row_id_is_a_total_order(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"), F.lit("x").alias("s"))
    got = rows.with_row_id(df.repartition(7), [("k", "desc")]).orderBy("row_id").collect()
    assert [r["row_id"] for r in got] == list(range(1, 5001))
    keys = [r["k"] for r in got]
    assert keys == sorted(keys, reverse=True)


def test_sort_puts_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r[0] for r in rows.sort_rows(df, [("v", "asc")]).collect()] == [1, 3, None]
    assert [r[0] for r in rows.sort_rows(df, [("v", "desc")]).collect()] == [3, 1, None]


def test_numeric_text_order(spark):
    df = spark.createDataFrame([("10",), ("2",), ("x",), (None,)], "t string")
    assert [r[0] for r in rows.sort_numeric_text(df, "t").collect()][:2] == ["2", "10"]


def test_first_row_of_a_hot_key(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("o"))
    got = {r["k"]: r["o"] for r in rows.distinct_first(df, ["k"], [("o", "asc")]).collect()}
    assert len(got) == 1001 and got[1] == -1999
    plan = rows.distinct_first(df, ["k"], [("o", "asc")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_subset_drops_nulls_and_tolerant_projection(spark):
    df = spark.createDataFrame([(17, "ua2"), (None, "ua2"), (18, None), (19, "ua2")], "age int, college string")
    assert rows.subset(df, age=(17, 18), college=("ua2", "ua23")).count() == 1
    out = rows.project_tolerant(df, {"age": "double", "QID": "string"})
    assert out.dtypes == [("age", "double"), ("QID", "string")]
    assert rows.missing_columns(df, ["age", "QID"]) == ["QID"]


def test_qid_parsers(spark):
    df = spark.createDataFrame([("Q014id3",), ("id",), ("Q1x",), ("Q017p30",)], "QID string")
    got = df.select(
        qf.domain_code(F.col("QID")), qf.domain_code(F.col("QID"), strict=False), qf.testlet(F.col("QID")),
        qf.domain_label(qf.domain_code(F.col("QID")), "a"),
    ).collect()
    assert [r[0] for r in got] == ["id", None, None, "p"]
    assert [r[1] for r in got] == ["id", "id", "q1x", "p"]
    assert [r[2] for r in got] == ["3", None, None, "30"]
    assert [r[3] for r in got] == ["identifying_details", None, None, "purpose_point_of_view"]


def test_recodes(spark):
    df = spark.createDataFrame([("hispanic", " yes"), ("Klingon", "0"), (None, "NA"), ("", None)], "e string, p string")
    got = df.select(qf.recode_ethnicity(F.col("e")), qf.recode_yes_no(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("Hispanic", "Yes"), ("Other", "No"), (None, None), (None, None)]


def test_lenient_cast_and_flags(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), ("NaN",), (None,)], "t string")
    assert [r[0] for r in df.select(cf.to_double(F.col("t"))).collect()] == [1.5, None, None, None]
    flags = spark.createDataFrame([(0.1,), (None,), (4.0,)], "a double").select(cf.range_flag(F.col("a"), 0.4, 3.0))
    assert [r[0] for r in flags.collect()] == [True, False, True]


def test_wide_long_round_trip(spark):
    wide = spark.createDataFrame([("g1", 1, None), ("g2", None, None)], "global_id string, Q001s1 int, Q002in1 int")
    long = rows.to_long(wide)
    assert [tuple(r) for r in long.collect()] == [("g1", "Q001s1", 1)]
    assert rows.to_wide(long, ["Q001s1", "Q002in1"]).collect()[0]["Q001s1"] == 1


@pytest.mark.parametrize("small_group", [0, 100_000])
def test_exact_quantiles(spark, small_group):
    """Both branches; a third of one group is one value."""
    rng = np.random.default_rng(5)
    n = 60_000
    v = rng.normal(size=n)
    v[: n // 3] = 0.25
    pdf = {"k": ["a" if i % 4 else "b" for i in range(n)], "v": v.tolist()}
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame(pdf)).unionByName(spark.createDataFrame([("a", None), ("c", None)], "k string, v double"))
    probs = {"q1": 0.25, "med": 0.5, "q3": 0.75, "p95": 0.95}
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", probs, small_group).collect()}
    assert set(got) == {"a", "b"}
    for k in "ab":
        mine = np.array([x for x, g in zip(pdf["v"], pdf["k"]) if g == k])
        assert np.allclose([got[k][p] for p in probs], np.quantile(mine, list(probs.values())), atol=1e-12)
    whole = exact_quantiles(df, [], "v", {"m": 0.5}, small_group).collect()[0]["m"]
    assert abs(whole - np.median(v)) < 1e-12


def test_quantiles_shuffle_no_data_by_variable(spark):
    from respan.operators.describe import box_stats, numeric_descriptives

    df = spark.range(20_000).selectExpr("id % 7 as a", "id % 11 as b", "id % 3 as g")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        for out in (numeric_descriptives(df, ["a", "b"]), box_stats(df, ["a", "b"], "g")):
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            joins = [line for line in plan.splitlines() if "Join" in line and "Inner" in line]
            assert joins and all("broadcast" in line for line in joins), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
