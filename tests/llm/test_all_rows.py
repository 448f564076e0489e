"""Trees and thresholds come from all labelled rows, and thresholds are those of a plain pass over the ranked scores."""

import random

from pyspark.sql import functions as F

from respan.llm.calibrate import least_right_scores
from respan.llm.pii import candidates, fit_trees
from respan.llm.urlfilter import fit_urls


def test_thresholds_against_a_plain_pass(spark):
    rng = random.Random(3)
    rows = [(kind, rng.randint(0, 300) / 300 if kind != "c" else 0.4, float(rng.random() < 0.9)) for kind in "abc" for _ in range(500)]
    rows += [("d", 0.5, 0.0), ("e", 1.0, 1.0), ("e", 0.0, 1.0)]
    for precision in (0.8, 0.9, 0.95):
        expected = {}
        for kind in "abcde":
            ranked = sorted(((s, y) for k, s, y in rows if k == kind), reverse=True)
            right = 0
            for i, (s, y) in enumerate(ranked, 1):
                right += y
                if right >= precision * i and (i == len(ranked) or ranked[i][0] < s):
                    expected[kind] = s
        assert least_right_scores(spark.createDataFrame(rows, "kind string, score double, label double"), precision) == expected
    assert least_right_scores(spark.createDataFrame([], "kind string, score double, label double"), 0.9) == {}


def test_all_urls_are_fitted_or_held_out(spark):
    n = 21_000
    rows = spark.range(n).select(F.format_string("http://h%d.example.org/%d", F.col("id") % 97, F.col("id")).alias("url"), (F.col("id") % 7 == 0).alias("blocked"))
    model = fit_urls(rows.unionByName(rows.limit(50)))
    assert model.fitted + model.held == n and 0 < model.held < n / 2


def test_all_candidates_are_fitted_or_held_out(spark):
    n = 2_500  # each text has an address that is none, by itself and as a phone, a number without a cue, and an e-mail address that gives a positive one
    text = F.format_string("mail to u%d@example.com now, host 999.1.2.3, num 12345%04d in the file", F.col("id"), F.col("id"))
    found = candidates(spark.range(n).select(F.col("id").alias("row"), text.alias("text")))
    model = fit_trees(found)
    assert model.fitted + model.held == 4 * n
    assert abs(model.fitted - model.held) < n
