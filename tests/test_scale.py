"""Work that must not grow with the rows: passes over the answers, integrals for each pattern, memory of the wide table."""

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from respan.irt import estep, fit as irt
from respan.irt.model import start_state


def counted(spark, rows, ddl, folder):
    """A table that leaves a file in ``folder`` each time it is read."""

    def run(batches):
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield from batches

    return spark.createDataFrame(rows, ddl).coalesce(1).mapInArrow(run, ddl)


def answers(rng, people, items):
    return [(f"p{i:03d}", f"Q{j:03d}s1", int(rng.random() < 0.5)) for i in range(people) for j in range(items) if rng.random() < 0.8]


def test_answers_are_read_twice_to_prepare_them(spark, tmp_path):
    rows = answers(np.random.default_rng(1), 40, 5)
    packed = irt.prepare(counted(spark, rows, "global_id string, QID string, response int", str(tmp_path)))
    assert len(list(tmp_path.iterdir())) == 2
    assert packed.data.count() == len({r[0] for r in rows})


def test_one_integral_for_each_pattern_of_a_testlet(monkeypatch):
    """2,000 respondents show at most 3^4 - 1 patterns of a testlet of 4 items; the sums are those of the whole grid."""
    rng = np.random.default_rng(2)
    names = [f"q{i:02d}" for i in range(10)]
    state = start_state("bifactor", names, {q: 1 + i // 4 for i, q in enumerate(names[:8])})
    state.coef = state.coef + rng.normal(size=state.coef.shape) * 0.3 * state.free
    cells = [np.flatnonzero(rng.random(10) < 0.7).astype(np.int32) for _ in range(2000)]
    right = [rng.integers(0, 2, len(c)).astype(float) for c in cells]
    batch = pa.RecordBatch.from_arrays([pa.array(cells, pa.list_(pa.int32())), pa.array(right, pa.list_(pa.float64()))], names=["items", "answers"])
    done = []
    plain = estep.BifactorTables._joint
    monkeypatch.setattr(estep.BifactorTables, "_joint", lambda self, k, keys: done.append(len(keys)) or plain(self, k, keys))
    out = next(estep._sums(state)(iter([batch.slice(0, 700), batch.slice(700)])))
    assert sum(done) <= 2 * (3**4 + 3**4 + 3**2)  # once for the tables, once for the sums
    # the whole grid: one factor for each testlet
    g, u = state.grid.general, state.grid.specific
    expected, total = np.zeros((10, len(g) * len(u))), 0.0
    log_u = state.grid.log_prior_specific
    for c, y in zip(cells, right):
        eta = state.coef[c] @ state.grid.design().T
        cell = (y[:, None] * eta - np.logaddexp(0, eta)).reshape(len(c), len(g), len(u))
        joint = {t: cell[state.factor[c] == t].sum(0) + log_u for t in set(state.factor[c])}
        log_g = state.grid.log_prior + sum((np.logaddexp.reduce(j, axis=1) for j in joint.values()), 0)
        total += np.logaddexp.reduce(log_g)
        w = np.exp(log_g - np.logaddexp.reduce(log_g))
        for i in c:
            j = joint[state.factor[i]]
            expected[i] += (w[:, None] * np.exp(j - np.logaddexp.reduce(j, axis=1)[:, None])).ravel()
    got = np.array(out["n"])
    assert got[-2] == pytest.approx(total)
    mine = got[:-2].reshape(10, -1)
    assert np.allclose(mine[:8], expected[:8])
    # items without a factor: their own share of u is the prior, whatever else is answered
    assert np.allclose(mine[8:].reshape(2, len(g), len(u)).sum(2), expected[8:].reshape(2, len(g), len(u)).sum(2))


def test_only_patterns_that_meet_are_taken_apart(spark):
    rows = [([0, 1, 2], [1, 0, 0]), ([0, 1, 2], [0, 1, 0]), ([0, 1, 2], [0, 1, 0]), ([0, 1, 2], [1, 1, 0]), ([0, 2], [1, 0]), ([0, 2], [1, 0])]
    packed = spark.createDataFrame(rows, "items array<int>, answers array<tinyint>")
    made = estep.collapse(packed, "rasch")
    got = sorted((tuple(r["items"]), tuple(round(a, 9) for a in r.answers), r.weight) for r in made.collect())
    third = round(1 / 3, 9)
    assert got == [((0, 1, 2), (third, round(2 / 3, 9), 0.0), 3.0), ((0, 1, 2), (1.0, 1.0, 0.0), 1.0), ((0, 2), (1.0, 0.0), 2.0)]
