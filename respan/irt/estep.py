"""The respondent side of estimation and scoring: Arrow batches of packed answers.

A respondent is one row ``global_id, items, answers``.  Each task turns a batch into
matrices, works with dense linear algebra and emits item-sized sums (estimation) or one
row per respondent (scoring).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from respan.irt.model import ITEM_BLOCK, ModelState, update_items
from respan.operators.dedupe import answer_lists

CELLS = 4_000_000  # matrix cells held at a time per task


# ---- packing -------------------------------------------------------------

def item_list(resp: DataFrame) -> list[str]:
    """The item ids in order: one row per item of the bank."""
    return sorted(r["QID"] for r in resp.select("QID").distinct().collect() if r["QID"] is not None)


def pack_responses(resp: DataFrame, items: list[str], key: str = "global_id") -> DataFrame:
    """One row per respondent: positions of the answered items and the answers."""
    spark = resp.sparkSession
    index = spark.createDataFrame(pa.table({"QID": items, "_i": pa.array(range(len(items)), pa.int32())}))
    answered = resp.filter(F.col("response").isNotNull() & F.col(key).isNotNull()).select(key, "QID", "response")
    indexed = answered.join(F.broadcast(index), "QID")  # the item list of the driver
    lists = answer_lists(indexed, key, F.col("_i"), F.col("response").cast("byte"))
    return lists.select(
        F.col(key),
        F.transform("cells", lambda c: c["i"]).alias("items"),
        F.transform("cells", lambda c: c["y"]).alias("answers"),
    )


def collapse(packed: DataFrame, kind: str) -> DataFrame:
    """(items, answers, weight): respondents that a fit cannot tell apart as one row.

    Equal answers to equal items are one row.  Under the Rasch model the number of right answers is all that counts, so there
    respondents of equal items and equal number are one row, with each item's share of right answers.
    """
    patterns = packed.groupBy("items", "answers").agg(F.count("*").cast("double").alias("weight"))
    as_double = F.transform("answers", lambda y: y.cast("double")).alias("answers")
    if kind != "rasch":
        return patterns.select("items", as_double, "weight")
    total = F.aggregate("answers", F.lit(0), lambda s, y: s + y)
    sized = patterns.withColumn("total", total).withColumn("k", F.count("*").over(W.partitionBy("items", "total")))
    # only where several patterns meet are answers taken apart
    places = sized.where("k > 1").select("items", "total", "weight", F.posexplode("answers").alias("place", "y"))
    shares = places.groupBy("items", "total", "place").agg((F.sum(F.col("weight") * F.col("y")) / F.sum("weight")).alias("share"), F.sum("weight").alias("n"))
    met = shares.groupBy("items", "total").agg(F.array_sort(F.collect_list(F.struct("place", "share"))).alias("s"), F.max("n").alias("weight"))
    met = met.select("items", F.transform("s", lambda c: c["share"]).alias("answers"), "weight")
    return sized.where("k = 1").select("items", as_double, "weight").unionByName(met)


def matrices(batch: pa.RecordBatch, n_items: int, rows: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, correct, answered): 0/1 matrices of up to ``rows`` respondents."""
    lists, answers = batch["items"], batch["answers"]
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()
    values = answers.values.to_numpy()
    shift = answers.offsets.to_numpy()[0] - offsets[0]
    for lo in range(0, batch.num_rows, rows):
        hi = min(lo + rows, batch.num_rows)
        start, stop = offsets[lo], offsets[hi]
        who = np.repeat(np.arange(hi - lo), np.diff(offsets[lo : hi + 1]))
        cols = flat[start:stop]
        correct = np.zeros((hi - lo, n_items))
        answered = np.zeros((hi - lo, n_items))
        answered[who, cols] = 1.0
        correct[who, cols] = values[start + shift : stop + shift]
        yield lo, correct, answered


# ---- posteriors ----------------------------------------------------------

def posterior_1d(state: ModelState, correct: np.ndarray, answered: np.ndarray):
    """(weights respondents x nodes, log marginal)."""
    slope, shift = state.coef[:, 0], state.coef[:, 1]
    theta = state.grid.general
    log_wrong = -np.logaddexp(0.0, np.outer(slope, theta) + shift[:, None])
    log_post = np.outer(correct @ slope, theta) + (correct @ shift)[:, None] + answered @ log_wrong
    log_post += state.grid.log_prior
    top = log_post.max(axis=1, keepdims=True)
    w = np.exp(log_post - top)
    total = w.sum(axis=1, keepdims=True)
    return w / total, (top + np.log(total))[:, 0]


class BifactorTables:
    """The bifactor posterior, by the answers to one testlet at a time.

    Given g the testlets are independent, and what a testlet adds to a respondent's posterior depends on the answers to
    that testlet alone.  So the integral over u is worked out once for each different answer pattern of a testlet, and kept over the
    batches of a task; a respondent only adds up rows of these tables.  For the item sums the tables collect the
    respondents' weights over g.  ``CELLS`` bounds the tables: full ones are added to the sums and begun anew.
    """

    def __init__(self, state: ModelState, collect: bool = False):
        self.state, self.collect = state, collect
        grid = state.grid
        self.design, self.prior_u = grid.design(), grid.log_prior_specific
        self.shape = (len(grid.general), len(grid.specific))
        self.sums = [np.zeros((len(state.items), len(self.design))) for _ in range(2)] if collect else None
        self.groups = []
        for t in np.unique(state.factor):
            cols = np.flatnonzero(state.factor == t)
            alone = not state.coef[cols, 1].any()  # items without a slope on u are independent of each other
            self.groups += [cols[i : i + 6] for i in range(0, len(cols), 6)] if alone else [cols]
        self._levels(np.array([0.0, 1.0]))

    def _levels(self, levels: np.ndarray) -> None:
        """Answers as digits of words that a double holds exactly: 0 for none, then the place among ``levels``."""
        self.levels, self.base = levels, len(levels) + 1
        room = int(52 / np.log2(self.base))
        self.word, self.unit = np.zeros(len(self.state.items), int), np.zeros(len(self.state.items))
        self.words, at = [], 0
        for cols in self.groups:
            n = -(-len(cols) // room)
            self.words.append(slice(at, at + n))
            self.word[cols] = at + np.arange(len(cols)) // room
            self.unit[cols] = float(self.base) ** (np.arange(len(cols)) % room)
            at += n
        self.n_words = at
        self._empty()

    def _empty(self) -> None:
        g = self.shape[0]
        self.place = [{} for _ in self.groups]
        self.keys = [np.zeros((0, w.stop - w.start)) for w in self.words]
        self.log = [np.zeros((0, g)) for _ in self.groups]
        self.mass = [np.zeros((0, g)) for _ in self.groups]
        self.size = 0

    def _joint(self, k: int, keys: np.ndarray):
        """(log of the integral over u, share of each u, answered, answers) of patterns of a testlet."""
        cols = self.groups[k]
        digit = (keys[:, self.word[cols] - self.words[k].start] // self.unit[cols] % self.base).astype(int)
        m = (digit > 0).astype(float)
        y = np.where(digit > 0, self.levels[digit - 1], 0.0)
        eta = self.state.coef[cols] @ self.design.T
        joint = (y @ eta - m @ np.logaddexp(0.0, eta)).reshape(len(keys), *self.shape) + self.prior_u
        top = joint.max(axis=2, keepdims=True)
        joint = np.exp(joint - top)
        total = joint.sum(axis=2, keepdims=True)
        return (top + np.log(total))[:, :, 0], joint / total, m, y

    def _at_a_time(self, n: int):
        step = max(1, CELLS // len(self.design))
        return [slice(i, i + step) for i in range(0, n, step)]

    def _places(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Rows of the testlet's tables; patterns not met before are added to them."""
        names = keys[:, 0] if keys.shape[1] == 1 else np.ascontiguousarray(keys).view(f"V{8 * keys.shape[1]}")[:, 0]
        found, first, inverse = np.unique(names, return_index=True, return_inverse=True)
        known, names = self.place[k], found.tolist()
        fresh = [i for i, x in enumerate(names) if x not in known]
        if fresh:
            more = keys[first[fresh]]
            for i in fresh:
                known[names[i]] = len(known)
            self.keys[k] = np.concatenate([self.keys[k], more])
            self.log[k] = np.concatenate([self.log[k], *[self._joint(k, more[s])[0] for s in self._at_a_time(len(more))]])
            self.mass[k] = np.concatenate([self.mass[k], np.zeros((len(more), self.shape[0]))])
            self.size += len(more)
        return np.array([known[x] for x in names])[inverse.reshape(-1)]

    def posterior(self, who: np.ndarray, cols: np.ndarray, values: np.ndarray, n_rows: int, weight: np.ndarray | None = None):
        """(weights over general nodes, log marginal) of the respondents whose cells are given."""
        if self.size * self.shape[0] > CELLS:
            self.flush()
        other = np.setdiff1d(values, self.levels)
        if len(other):
            self.flush()
            self._levels(np.union1d(values, self.levels))
        codes = np.bincount(who * self.n_words + self.word[cols], (1.0 + np.searchsorted(self.levels, values)) * self.unit[cols], n_rows * self.n_words)
        codes = codes.reshape(n_rows, self.n_words)
        log_g = np.tile(self.state.grid.log_prior, (n_rows, 1))
        places = []
        for k, w in enumerate(self.words):
            rows = np.flatnonzero(codes[:, w].any(axis=1))
            if len(rows):
                at = self._places(k, codes[rows, w])
                log_g[rows] += self.log[k][at]
                places.append((k, rows, at))
        top = log_g.max(axis=1, keepdims=True)
        w = np.exp(log_g - top)
        total = w.sum(axis=1, keepdims=True)
        w /= total
        if self.collect:
            g = self.shape[0]
            own = w if weight is None else w * weight[:, None]
            for k, rows, at in places:
                cell = (at[:, None] * g + np.arange(g)).ravel()
                self.mass[k] += np.bincount(cell, own[rows].ravel(), len(self.mass[k]) * g).reshape(-1, g)
        return w, (top + np.log(total))[:, 0]

    def flush(self) -> None:
        """Adds the weights collected so far to the item sums."""
        if self.collect:
            for k, cols in enumerate(self.groups):
                for s in self._at_a_time(len(self.keys[k])):
                    _, share, m, y = self._joint(k, self.keys[k][s])
                    both = (share * self.mass[k][s][:, :, None]).reshape(len(m), -1)
                    self.sums[0][cols] += m.T @ both
                    self.sums[1][cols] += y.T @ both
        self._empty()


def _cells(batch: pa.RecordBatch, rows: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row, item, answer) of up to ``rows`` respondents at a time."""
    lists, answers = batch["items"], batch["answers"]
    offsets, flat, values = lists.offsets.to_numpy(), lists.values.to_numpy(), answers.values.to_numpy()
    shift = answers.offsets.to_numpy()[0] - offsets[0]
    for lo in range(0, batch.num_rows, rows):
        hi = min(lo + rows, batch.num_rows)
        start, stop = offsets[lo], offsets[hi]
        who = np.repeat(np.arange(hi - lo), np.diff(offsets[lo : hi + 1]))
        yield lo, hi - lo, who, flat[start:stop], values[start + shift : stop + shift].astype(float)


def posteriors_of(state: ModelState, batch: pa.RecordBatch, tables: BifactorTables | None, weight: np.ndarray | None = None) -> Iterator[tuple]:
    """(first row, weights over general nodes, log marginal, correct, answered); a bifactor model has no matrices."""
    if tables is None:
        for lo, correct, answered in matrices(batch, len(state.items), _rows_at_a_time(state)):
            yield (lo, *posterior_1d(state, correct, answered), correct, answered)
        return
    for lo, n_rows, who, cols, values in _cells(batch, max(1, CELLS // max(1, tables.n_words * tables.shape[0]))):
        part = None if weight is None else weight[lo : lo + n_rows]
        yield (lo, *tables.posterior(who, cols, values, n_rows, part), None, None)


def _rows_at_a_time(state: ModelState) -> int:
    return max(1, CELLS // max(1, len(state.items)))


# ---- estimation sums -----------------------------------------------------

_FITTED = ("items", "answers")
_SUMS_DDL = "item int, node int, n double, r double"
_BLOCK_DDL = "block int, n binary, r binary, loglik double, people double, second double"
_COEF_DDL = "block int, coef binary, loglik double, people double, second double"


def _sums(state: ModelState, blocks: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_items, n_nodes = len(state.items), len(state.grid.design())
        n, r = np.zeros((n_items, n_nodes)), np.zeros((n_items, n_nodes))
        loglik = count = second = 0.0
        tables = BifactorTables(state, collect=True) if state.kind == "bifactor" else None
        for batch in batches:
            times = batch["weight"].to_numpy() if "weight" in batch.schema.names else np.ones(batch.num_rows)
            for lo, w, marginal, correct, answered in posteriors_of(state, batch, tables, times):
                weight = times[lo : lo + len(w)]
                if tables is None:
                    n += answered.T @ (w * weight[:, None])
                    r += correct.T @ (w * weight[:, None])
                loglik += weight @ marginal
                count += weight.sum()
                second += weight @ (w @ state.grid.general**2)
        if tables is not None:
            tables.flush()
            n, r = tables.sums
        if count == 0:
            return
        if blocks:  # one row for each block of items
            for k, at in enumerate(range(0, n_items, ITEM_BLOCK)):
                some = slice(at, at + ITEM_BLOCK)
                own = (loglik, count, second) if k == 0 else (0.0, 0.0, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([n[some].tobytes()]), pa.array([r[some].tobytes()]), *(pa.array([float(x)]) for x in own)],
                    names=["block", "n", "r", "loglik", "people", "second"],
                )
            return
        # item -1 carries (log-likelihood, respondents) and (sum of E[theta^2], 0)
        item = np.concatenate([np.repeat(np.arange(n_items), n_nodes), [-1, -1]]).astype(np.int32)
        node = np.concatenate([np.tile(np.arange(n_nodes), n_items), [0, 1]]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item), pa.array(node),
                pa.array(np.concatenate([n.ravel(), [loglik, second]])),
                pa.array(np.concatenate([r.ravel(), [count, 0.0]])),
            ],
            names=["item", "node", "n", "r"],
        )

    return run


def expected_sums(packed: DataFrame, state: ModelState) -> DataFrame:
    """Expected answers ``n`` and correct answers ``r`` per (item, node).

    Every task sends items x nodes rows at most, whatever its number of respondents.
    """
    sums = packed.select(*_FITTED, *[c for c in ("weight",) if c in packed.columns]).mapInArrow(_sums(state), _SUMS_DDL)
    return sums.groupBy("item", "node").agg(F.sum("n").alias("n"), F.sum("r").alias("r"))


def _update(state: ModelState, slope_bound: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        design = state.grid.design()
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                n, r = (np.frombuffer(row[c]).reshape(-1, len(design)) for c in ("n", "r"))
                rest = [row["loglik"], row["people"], row["second"]]
                if row["block"] in held:
                    mine = held[row["block"]]
                    mine[0] += n
                    mine[1] += r
                    mine[2] = [a + b for a, b in zip(mine[2], rest)]
                else:
                    held[row["block"]] = [n.copy(), r.copy(), rest]
        for block, (n, r, rest) in held.items():
            some = slice(block * ITEM_BLOCK, block * ITEM_BLOCK + len(n))
            coef = update_items(state.coef[some], state.free[some], design, n, r, slope_bound=slope_bound)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([coef.tobytes()]), *(pa.array([x]) for x in rest)],
                names=["block", "coef", "loglik", "people", "second"],
            )

    return run


def em_step(packed: DataFrame, state: ModelState, slope_bound: float | None = None):
    """One E-step and item update: (coef, logLik, respondents, sum of E[theta^2]).

    A task sends one row for each block of items; blocks are summed and updated where they meet,
    and the driver gets the new coefficients.
    """
    n_blocks = max(1, -(-len(state.items) // ITEM_BLOCK))
    sums = packed.select(*_FITTED, *[c for c in ("weight",) if c in packed.columns]).mapInArrow(_sums(state, blocks=True), _BLOCK_DDL)
    rows = sums.repartition(n_blocks, "block").mapInArrow(_update(state, slope_bound), _COEF_DDL).collect()
    coef = state.coef.copy()
    for row in rows:
        new = np.frombuffer(row["coef"]).reshape(-1, coef.shape[1])
        coef[row["block"] * ITEM_BLOCK : row["block"] * ITEM_BLOCK + len(new)] = new
    total = [sum(row[c] for row in rows) for c in ("loglik", "people", "second")]
    return coef, float(total[0]), int(round(total[1])), float(total[2])


# ---- per respondent ------------------------------------------------------

def _per_respondent(state: ModelState, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        theta = state.grid.general
        tables = BifactorTables(state) if state.kind == "bifactor" else None
        for batch in batches:
            for lo, w, marginal, _, _ in posteriors_of(state, batch, tables):
                mean = w @ theta
                sd = np.sqrt((w * (theta[None, :] - mean[:, None]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [batch[key].slice(lo, len(mean)), pa.array(mean), pa.array(sd), pa.array(marginal)],
                    names=[key, "theta", "SE_theta", "log_marginal"],
                )

    return run


def respondent_posteriors(packed: DataFrame, state: ModelState, key: str = "global_id") -> DataFrame:
    """theta (posterior mean), SE_theta and the log marginal of every packed respondent."""
    ddl = f"{key} string, theta double, SE_theta double, log_marginal double"
    return packed.mapInArrow(_per_respondent(state, key), ddl)


# ---- margins -------------------------------------------------------------

def _pair_sums(n_items: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, right = np.zeros((n_items, n_items)), np.zeros((n_items, n_items))
        for batch in batches:
            for _, correct, answered in matrices(batch, n_items, max(1, CELLS // n_items)):
                both += answered.T @ answered
                right += correct.T @ correct
        i, j = np.nonzero(np.triu(both))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                pa.array(both[i, j].astype(np.int64)), pa.array(right[i, j].astype(np.int64)),
            ],
            names=["i", "j", "n", "n_correct"],
        )

    return run


def pair_sums(packed: DataFrame, n_items: int) -> DataFrame:
    """(i, j, n, n_correct) for i <= j: respondents with both answers, and with both correct.

    Cross products per task; no pair of responses is ever a row.
    """
    sums = packed.select("items", "answers").mapInArrow(
        _pair_sums(n_items), "i int, j int, n long, n_correct long"
    )
    return sums.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("n_correct").alias("n_correct"))
