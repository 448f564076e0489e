"""Quality rules: how much of a text repeats itself, measured with rolling hashes.

For several n-gram lengths, every character of a word that lies in an n-gram found twice or more in
the same text counts as repeated (first copies too), and likewise every character of a line equal to an
earlier one.  The shares of repeated characters and the number of symbols for each word are held against fixed
thresholds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from respan.llm.words import Powers, Words, add_columns, covered, mix, white_space_words, words

#: n-gram length -> highest share of word characters inside repeated n-grams.
NGRAM_LIMITS = {4: 0.45, 6: 0.40, 8: 0.35, 10: 0.30}
LINE_LIMIT = 0.30  # highest share of word characters in lines equal to an earlier one
SYMBOL_LIMIT = 0.25  # highest number of symbols for each word
MIN_WORDS = 50
BASE_NGRAM = 3
SYMBOLS = b"#*$%&|<>"

_LONG, _DOUBLE, _BOOLEAN = T.LongType(), T.DoubleType(), T.BooleanType()
COLUMNS = [
    *(T.StructField(c, _LONG) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", _BOOLEAN),
    *(T.StructField(f"dup_share_{n}", _DOUBLE) for n in NGRAM_LIMITS),
    T.StructField("dup_line_share", _DOUBLE),
    T.StructField("kept", _BOOLEAN),
]


def _repeated(w: Words, n: int) -> np.ndarray:
    """Which words lie in an ``n``-word window found twice or more in its row."""
    at, h = w.windows(n)
    key = mix(h + w.row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    a, b = at[order[:-1][same]], at[order[1:][same]]
    for j in range(n):  # the hash proposes, the words decide
        equal = w.hash[a + j] == w.hash[b + j]
        a, b = a[equal], b[equal]
    equal = w.row[a] == w.row[b]
    return covered(len(w.hash), np.unique(np.concatenate([a[equal], b[equal]])), n)


def _sum_by_row(w: Words, value: np.ndarray) -> np.ndarray:
    return np.bincount(w.row, weights=value, minlength=len(w.first) - 1).astype(np.int64)


def _start():
    powers, kind = Powers(), white_space_words()
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    def make(column: pa.Array) -> list[pa.Array]:
        w = words(column, kind, powers)
        rows = len(w.first) - 1
        points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
        chars = points[w.end] - points[w.start]
        word_chars = _sum_by_row(w, chars)
        symbols = np.concatenate([[0], np.cumsum(symbol[w.data])])
        n_symbols = symbols[w.offsets[1:]] - symbols[w.offsets[:-1]]
        n_repeat = _sum_by_row(w, _repeated(w, BASE_NGRAM))
        dup_lines, dup_line_chars = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        data = w.data.tobytes()
        for i in np.flatnonzero(w.counts):
            seen = set()
            for line in data[w.offsets[i] : w.offsets[i + 1]].split(b"\n"):
                if not line.strip(b" \t\n\r\x0b\x0c"):
                    continue
                if line in seen:
                    dup_lines[i] += 1
                    dup_line_chars[i] += sum(len(x.decode("utf-8", "replace")) for x in line.split())
                seen.add(line)
        n_words = w.counts
        failed = (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words)
        size = np.maximum(word_chars, 1)
        shares = {n: _sum_by_row(w, chars * _repeated(w, n)) / size for n in NGRAM_LIMITS}
        line_share = dup_line_chars / size
        kept = ~failed & (n_symbols <= SYMBOL_LIMIT * n_words) & (line_share <= LINE_LIMIT)
        for n, limit in NGRAM_LIMITS.items():
            kept &= shares[n] <= limit
        out = [n_words, word_chars, n_symbols, dup_lines, n_repeat, failed, *shares.values(), line_share, kept]
        return [pa.array(x) for x in out]

    return make


def measure_quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) with the measures and the verdict ``kept``.

    One row for each row given, repeated rows too.  A null or empty text has no words and is not kept.
    A column named like a measure is replaced.  An empty table gives an empty table.
    """
    return add_columns(docs, text, docs.columns if keep is None else keep, COLUMNS, _start)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text passes every rule, with the columns of ``docs``."""
    names = {c: f"__{i}" for i, c in enumerate(docs.columns)}
    given = docs.select([F.col(f"`{c}`").alias(n) for c, n in names.items()])
    good = measure_quality(given, names[text]).where("kept")
    return good.select([F.col(n).alias(c) for c, n in names.items()])
