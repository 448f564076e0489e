"""A toxicity classifier whose score must not depend on which group a text mentions.

Logistic regression on which words and word beginnings a text has, once, twice or more often.  They are
those that tell the labels apart best (log-likelihood ratio over the training rows), and the identity terms.  For every training text that
mentions a group, a counterfactual copy has the term swapped for another or taken out; the squared change
of the score's logit is a penalty of the fit.  So a term that stands in many toxic texts earns no weight of
its own, and neutral mentions are not taken for toxic ones.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from respan.llm.words import Powers, Words, add_columns, item_words, slices, words

#: Group mentions, one word each, in the languages of the corpus.
IDENTITY_TERMS = (
    "woman women man men girl boy gay lesbian bisexual transgender queer straight black white asian african "
    "european american arab latino hispanic immigrant refugee muslim christian jewish jew hindu buddhist catholic "
    "atheist disabled blind deaf old young mujer mujeres hombre hombres negro blanco judío musulmán cristiano "
    "inmigrante femme femmes homme hommes noir blanc juif musulman chrétien immigré frau frauen mann männer schwarz "
    "weiß jude muslim christ ausländer flüchtling"
).split()
SAMPLE_ROWS = 12_000  # labelled rows the model is fitted on, at most
N_TOKENS = 600  # words and word beginnings with weights, besides the identity terms
PREFIXES = (5, 6, 8)  # lengths of word beginnings, in bytes
LEVELS = np.array([1, 2, 4])  # a token has a weight for each of these numbers of occurrences that it reaches
THRESHOLD = 0.7


class ToxicityModel(NamedTuple):
    """Sorted token hashes, their weights by level and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float


def _tokens(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of every word and of its beginnings, each kind apart."""
    kinds = [(w.row, w.hash)]
    for k in PREFIXES:
        at, h = w.prefixes(k)
        kinds.append((w.row[at], h))
    return kinds


def _present(w: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature): feature ``len(LEVELS) * i + j`` if the row has token ``i`` LEVELS[j] times or more."""
    if not len(hashes) or not len(w.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    may = np.zeros(1 << 16, bool)
    may[hashes >> np.uint64(48)] = True
    keys = []
    for row, h in _tokens(w):
        some = np.flatnonzero(may[h >> np.uint64(48)])
        at = np.searchsorted(hashes, h[some]).clip(0, len(hashes) - 1)
        hit = hashes[at] == h[some]
        keys.append(row[some[hit]] * len(hashes) + at[hit])
    key, times = np.unique(np.concatenate(keys), return_counts=True)
    i, j = np.nonzero(times[:, None] >= LEVELS)
    return key[i] // len(hashes), key[i] % len(hashes) * len(LEVELS) + j


def scores(column: pa.Array, powers: Powers, hashes: np.ndarray, weights: np.ndarray, intercept: float) -> np.ndarray:
    """Of each text, null and empty ones too."""
    row, at = _present(words(column, item_words(), powers), hashes)
    z = intercept + np.bincount(row, weights=weights[at], minlength=len(column))
    return 1 / (1 + np.exp(-z.clip(-40, 40)))


def term_hashes(terms) -> np.ndarray:
    return np.unique(words(pa.array(list(terms), pa.string()), item_words(), Powers()).hash)


def _token_counts(batches):
    """Rows of each token and level by label, summed over the task; the token None counts the rows themselves."""
    powers, total = Powers(), {}
    rows = np.zeros(2, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            kinds = _tokens(words(part.column("text"), item_words(), powers))
            label = part.column("label").to_numpy(zero_copy_only=False)
            rows += np.bincount(label, minlength=2)
            row, h = np.concatenate([k[0] for k in kinds]), np.concatenate([k[1] for k in kinds])
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[: len(h)])
            times = np.diff(np.append(first, len(h)))
            for level in LEVELS.tolist():
                some = first[times >= level]
                found, at = np.unique(h[some], return_inverse=True)
                toxic = np.bincount(at, weights=label[row[some]], minlength=len(found)).astype(int)
                n = np.bincount(at, minlength=len(found))
                for k, a, b in zip(found.view(np.int64).tolist(), toxic.tolist(), n.tolist()):
                    x = total.get((k, level), (0, 0))
                    total[k, level] = x[0] + a, x[1] + b
    out = [(*k, a, b) for k, (a, b) in total.items()] + [(None, 0, int(rows[1]), int(rows.sum()))]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["token", "level", "toxic", "n"])


def _ratio(toxic, n, all_toxic, all_n):
    """Twice the log-likelihood ratio of a token's rows by label against independence."""
    cells = (
        (toxic, n, all_toxic),
        (n - toxic, n, all_n - all_toxic),
        (all_toxic - toxic, all_n - n, all_toxic),
        (all_n - all_toxic - n + toxic, all_n - n, all_n - all_toxic),
    )
    return 2 * sum(F.when(o > 0, o * F.log(o * all_n / (r * c))).otherwise(0.0) for o, r, c in cells)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """At most ``rows`` labelled documents (text, label), chosen by a hash of the key.

    Labels that are null are left out; of several labels of a key the largest counts.  The chosen keys,
    bounded by ``rows``, are broadcast, so the documents are not shuffled.
    """
    y = labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
    y = y.groupBy(F.col(f"`{key}`").alias("k")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("label"))
    y = y.orderBy(F.xxhash64("k"), "k").limit(rows)
    x = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("text"))
    return x.join(F.broadcast(y), "k").select("text", "label")


def fit_toxicity(sample: DataFrame, terms=IDENTITY_TERMS, n_tokens: int = N_TOKENS, counterfactual: float = 1.0, ridge: float = 2e-4, toxic_weight: float = 2.0, steps: int = 250) -> ToxicityModel:
    """Fits the classifier on (text, label 0/1) rows, of which there are at most as many as the caller chose.

    The driver gets the counts of ``n_tokens`` tokens and, for each row, which of them it has.
    Without rows, or with one label only, the score is the share of that label for every text.
    """
    counts = sample.mapInArrow(_token_counts, "token long, level long, toxic long, n long").groupBy("token", "level").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    total = counts.where("token is null").first()
    if total is None or total.n == 0:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    rate = (total.toxic + 0.5) / (total.n + 1)
    base = float(np.log(rate / (1 - rate)))
    ratio = _ratio(F.col("toxic"), F.col("n"), F.lit(float(total.toxic)), F.lit(float(total.n)))
    ratios = counts.where("token is not null and n > 1").groupBy("token").agg(F.max(ratio).alias("ratio"))
    best = ratios.orderBy(F.desc("ratio"), "token").limit(n_tokens).select("token").collect()
    identity = term_hashes(terms)
    hashes = np.unique(np.concatenate([np.array([r.token for r in best], np.int64).view(np.uint64), identity]))

    def rows(batches):
        powers = Powers()
        for batch in batches:
            for part in slices(batch, "text"):
                row, at = _present(words(part.column("text"), item_words(), powers), hashes)
                lists = np.split(at, np.cumsum(np.bincount(row, minlength=part.num_rows))[:-1])
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))], ["label", "at"])

    data = sample.mapInArrow(rows, "label int, at array<int>").toPandas()
    y = data["label"].to_numpy(float)
    sizes = data["at"].map(len).to_numpy()
    row = np.repeat(np.arange(len(y)), sizes)
    at = np.concatenate([np.asarray(x, np.int64) for x in data["at"]]) if len(y) else np.zeros(0, np.int64)
    levels = len(LEVELS)
    terms = (np.flatnonzero(np.isin(hashes, identity))[:, None] * levels + np.arange(levels)).T
    weights, intercept = _fit(row, at, y, len(hashes) * levels, terms, base, counterfactual, ridge, toxic_weight, steps)
    return ToxicityModel(hashes, weights, intercept)


def _fit(row, at, y, width, terms, base, counterfactual, ridge, toxic_weight, steps):
    """Gradient descent (Adam) on mean log loss + ridge + mean squared change of the logit under swaps."""
    theta = np.zeros(width + 1)
    theta[-1] = base
    first = second = np.zeros(width + 1)
    # each mention is swapped for the next term (at the same level), and taken out
    swap = np.full(width, -1)
    for same_level in terms:
        swap[same_level] = np.roll(same_level, -1)
    term, texts = at[swap[at] >= 0], len(y)
    other = swap[term]
    cost = np.where(y > 0, toxic_weight, 1.0) / texts
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(row, weights=theta[at], minlength=texts)
        error = cost * (1 / (1 + np.exp(-z.clip(-40, 40))) - y)
        gradient = np.append(np.bincount(at, weights=error[row], minlength=width) + ridge * theta[:-1], error.sum())
        if len(term):
            swapped, gone = theta[term] - theta[other], theta[term]
            scale = 2 * counterfactual / len(term)
            gradient[:-1] += scale * (
                np.bincount(term, weights=swapped + gone, minlength=width) - np.bincount(other, weights=swapped, minlength=width)
            )
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta = theta - 0.1 * (1 - step / (steps + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` (default: all columns) with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Every text gets a score, null and empty ones the intercept's.  One row for each row given.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def start():
        powers = Powers()

        def make(column):
            score = scores(column, powers, *shared.value)
            return [pa.array(score), pa.array((score >= threshold).astype(np.int32))]

        return make

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return add_columns(docs, text, docs.columns if keep is None else keep, fields, start)
