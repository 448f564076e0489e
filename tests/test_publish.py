"""Versions that are published whole or not at all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from respan.irt import fit as irt
from respan.operators.quality import GateError, allowed_values, not_null
from respan.sources.publish import PublishError, publish, publish_model, read_model, read_published
from test_irt import simulate

def gates():
    return {"answers": [allowed_values("y", (0, 1)), not_null("who", "warn")]}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_gates_and_switch(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(PublishError):
        read_published(spark, path)
    good = spark.createDataFrame([("a", 1), (None, 0), ("b", None), ("b", 1), ("b", 1)], "who string, y int")
    other = spark.createDataFrame([], "q string")
    report = publish({"answers": good, "none": other}, path, gates())
    assert rows(report) == [("answers", "who_present", "warn", 1, None), ("answers", "y_allowed", "stop", 0, None)]
    found = read_published(spark, path)
    assert rows(found["answers"]) == rows(good) and found["none"].isEmpty() and found["none"].columns == ["q"]
    bad = good.union(spark.createDataFrame([("z", 7), ("c", 9)], good.schema))
    with pytest.raises(GateError, match="answers: y_allowed: 2 rows, e.g. c"):
        publish({"answers": bad}, path, gates())
    assert rows(read_published(spark, path)["answers"]) == rows(good)  # the version before is still the current one
    publish({"answers": good.limit(1)}, path, gates())
    assert read_published(spark, path)["answers"].count() == 1


def test_half_written_folders_are_refused(spark, tmp_path):
    path = tmp_path / "out"
    publish({"answers": spark.range(100)}, str(path))
    version = (path / "CURRENT").read_text()
    with pytest.raises(PublishError, match="rows"):
        spark.range(3).write.mode("append").parquet(str(path / version / "tables" / "answers"))
        read_published(spark, str(path))
    spark.range(100).withColumn("id", F.col("id") + 1).write.mode("overwrite").parquet(str(path / version / "tables" / "answers"))
    with pytest.raises(PublishError, match="values"):
        read_published(spark, str(path))
    (path / version / "manifest" / "_SUCCESS").unlink()
    with pytest.raises(PublishError, match="manifest"):
        read_published(spark, str(path))


@pytest.mark.parametrize("kind", ["rasch", "2pl", "bifactor"])
def test_read_model_scores_alike(spark, tmp_path, kind):
    resp, _, _ = simulate(spark, 300, np.full(6, 1.2), np.linspace(-1, 1, 6), spec=0.8, testlets=np.array([0, 0, 0, 1, 1, 2]), keep=0.9)
    model = irt.fit_irt(resp, kind, max_iter=5)
    publish_model(model, str(tmp_path / "model"))
    again = read_model(spark, str(tmp_path / "model"))
    assert rows(irt.score_eap(resp, again)) == rows(irt.score_eap(resp, model))
    assert (again.name, again.history, again.state.npar) == (model.name, model.history, model.state.npar)
    assert rows(again.params) == rows(model.params) and rows(irt.fit_table([again])) == rows(irt.fit_table([model]))
