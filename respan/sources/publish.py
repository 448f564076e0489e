"""Publishing tables together: gates watched while they are written, a manifest, and one switch.

A version is a folder of Parquet tables that readers do not see yet.  Each table's rows, checksum and gates are observed in the job
that writes it.  The manifest, written last, lists them; then one rename makes the version the current one.  A writer that
stops on the way, or a gate that fails, leaves the version before in place.  A reader counts and sums the tables again and refuses
what differs from the manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from respan.irt.fit import FittedModel
from respan.irt.model import Grid, ModelState
from respan.operators.quality import Gate, GateError

_MANIFEST = "table string, n_rows long, checksum long"
_REPORT = "table string, gate string, severity string, n_violations long, sample string"


class PublishError(Exception):
    """Nothing has been published there, or not all of it is there."""


def _checksum(df: DataFrame) -> Column:
    """Of all rows in any order: equal rows are told apart from none by the number of rows."""
    return F.coalesce(F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), F.lit(0))


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _switch(spark: SparkSession, root: str, version: str) -> None:
    """Makes ``version`` the current one by renaming a small file over the one before."""
    jvm = spark.sparkContext._jvm
    fresh, fs = _files(spark, f"{root}/CURRENT-{version}")
    out = fs.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, _files(spark, f"{root}/CURRENT")[0], how)


def publish(tables: Mapping[str, DataFrame], path: str, gates: Mapping[str, Sequence[Gate]] | None = None, key: Mapping[str, str] | None = None) -> DataFrame:
    """Writes the tables as the new version of ``path`` and returns the report of their gates, one row for each.

    One job a table, whatever the number of gates.  A failed gate of severity "stop" raises ``GateError`` and the version is
    deleted; the one before stays current.  ``key`` names the column that samples of violations are taken from (the first if not given).
    """
    first = next(iter(tables.values()))
    spark, root, version = first.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    folder = f"{root}/{version}"
    manifest, report = [], []
    for name, df in tables.items():
        rules = list((gates or {}).get(name, ()))
        by = F.col(f"`{(key or {}).get(name, df.columns[0])}`").cast("string")
        watched = [F.count("*").alias("n_rows"), _checksum(df).alias("checksum")]
        for i, g in enumerate(rules):
            wrong = F.coalesce(g.violation, F.lit(False))
            watched += [F.count_if(wrong).alias(f"n{i}"), F.min(F.when(wrong, by)).alias(f"sample{i}")]
        seen = Observation()
        df.observe(seen, *watched).write.parquet(f"{folder}/tables/{name}")
        got = seen.get
        manifest.append((name, got["n_rows"], got["checksum"]))
        report += [(name, g.name, g.severity, got[f"n{i}"], got[f"sample{i}"]) for i, g in enumerate(rules)]
    failed = [r for r in report if r[2] == "stop" and r[3]]
    if failed:
        place, fs = _files(spark, folder)
        fs.delete(place, True)
        raise GateError(f"{failed[0][0]}: {failed[0][1]}: {failed[0][3]} rows, e.g. {failed[0][4]}")
    spark.createDataFrame(manifest, _MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")
    _switch(spark, root, version)
    return spark.createDataFrame(report, _REPORT)


def read_published(spark: SparkSession, path: str, verify: bool = True) -> dict[str, DataFrame]:
    """The tables of the current version; ``PublishError`` if there is none or it differs from its manifest."""
    root = path.rstrip("/")
    place, fs = _files(spark, f"{root}/CURRENT")
    if not fs.exists(place):
        raise PublishError(f"nothing is published at {path}")
    folder = f"{root}/{spark.read.text(f'{root}/CURRENT').first()[0]}"
    place, _ = _files(spark, f"{folder}/manifest/_SUCCESS")
    if not fs.exists(place):
        raise PublishError(f"{folder} has no manifest")
    tables = {}
    for row in spark.read.parquet(f"{folder}/manifest").collect():  # a row for each table
        if not fs.exists(_files(spark, f"{folder}/tables/{row['table']}")[0]):
            raise PublishError(f"{row['table']} is missing")
        df = spark.read.parquet(f"{folder}/tables/{row['table']}")
        if verify:
            now = df.agg(F.count("*").alias("n_rows"), _checksum(df).alias("checksum")).first()
            if (now.n_rows, now.checksum) != (row.n_rows, row.checksum):
                raise PublishError(f"{row['table']} has {now.n_rows} rows, the manifest {row.n_rows}, or other values")
        tables[row["table"]] = df
    return tables


# ---- fitted models -------------------------------------------------------

def publish_model(model: FittedModel, path: str) -> DataFrame:
    """A fitted model with all that scoring needs: estimates, fit, items with their factors, and the grid."""
    spark, state = model.params.sparkSession, model.state
    factor = state.factor if len(state.factor) else np.zeros(len(state.items), int)
    items = [(i, q, [float(c) for c in state.coef[i]], [bool(f) for f in state.free[i]], int(factor[i])) for i, q in enumerate(state.items)]
    grid = state.grid
    settings = [(model.name, state.kind, float(grid.sd), grid.general.tolist(), None if grid.specific is None else grid.specific.tolist(), json.dumps(model.history))]
    gates = {"items": [Gate("QID_present", F.col("QID").isNull(), "stop"), Gate("coef_finite", F.exists("coef", lambda c: F.isnan(c)), "stop")]}
    tables = {
        "params": model.params,
        "fit": model.fit,
        "items": spark.createDataFrame(items, "place int, QID string, coef array<double>, free array<boolean>, factor int"),
        "settings": spark.createDataFrame(settings, "name string, kind string, sd double, general array<double>, specific array<double>, history string"),
    }
    return publish(tables, path, gates, {"items": "QID"})


def read_model(spark: SparkSession, path: str) -> FittedModel:
    """The model as it was published; it scores and compares as the fitted one did."""
    tables = read_published(spark, path)
    about = tables["settings"].first()
    rows = tables["items"].orderBy("place").collect()  # a row for each item
    grid = Grid(np.array(about.general), None if about.specific is None else np.array(about.specific), about.sd)
    width = len(grid.design()[0])
    coef = np.array([r.coef for r in rows], float).reshape(-1, width)
    free = np.array([r.free for r in rows], bool).reshape(-1, width)
    factor = np.array([r.factor for r in rows], int) if about.kind == "bifactor" else np.zeros(0, int)
    state = ModelState(about.kind, [r.QID for r in rows], grid, coef, free, factor)
    return FittedModel(about["name"], state, tables["params"], tables["fit"], json.loads(about.history))
