"""Words, lines and rolling hashes of an Arrow text column, computed on its bytes with numpy.

A word is a maximal run of bytes of one class inside one row.  Word hashes are differences of a
polynomial prefix sum, so no Python object is made for a word.  A hash decides nothing where two
different texts could share it by design; at 64 bits, chance collisions are left out of account.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

_BASE = 0x9E3779B97F4A7C55
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
CHUNK_BYTES = 1 << 19  # rows are worked on in slices of about this many bytes; a longer text is one slice


def white_space_words() -> tuple[np.ndarray, np.ndarray]:
    """``[^\\x20\\x09-\\x0D]+``, unchanged: which bytes are in words, and what each byte counts as."""
    inside = np.ones(256, bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    return inside, np.arange(256, dtype=np.uint64)


def lower(values: np.ndarray) -> np.ndarray:
    values = values.copy()
    values[0x41:0x5B] += np.uint64(32)
    return values


def item_words() -> tuple[np.ndarray, np.ndarray]:
    """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    inside = np.zeros(256, bool)
    inside[0x30:0x3A] = inside[0x61:0x7B] = inside[0x41:0x5B] = inside[0x80:] = True
    return inside, lower(np.arange(256, dtype=np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of the hash base and of its inverse modulo 2^64, made once and grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            up, down = np.full(size, _BASE, np.uint64), np.full(size, _BASE_INVERSE, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        return self.up, self.down


class Words(NamedTuple):
    data: np.ndarray  # bytes of all rows
    offsets: np.ndarray  # of the rows in data
    start: np.ndarray  # of each word
    end: np.ndarray
    row: np.ndarray  # row of each word
    first: np.ndarray  # first word of each row, and the number of words at the end
    hash: np.ndarray
    sums: np.ndarray  # polynomial prefix sums of the bytes
    down: np.ndarray  # inverse powers of the hash base

    def prefixes(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index, and hash of the first ``k`` bytes, of every longer word."""
        at = np.flatnonzero(self.end - self.start > k)
        begin = self.start[at]
        return at, mix((self.sums[begin + k] - self.sums[begin]) * self.down[begin] + np.uint64(k))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and hash, of every run of ``k`` words of one row."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = self.hash[:n].copy()
        for j in range(1, k):
            h *= _STEP
            h += self.hash[j : n + j]
        at = np.flatnonzero(self.row[:n] == self.row[k - 1 :])
        return at, mix(h[at] + np.uint64(k))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bytes and their offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array, kind: tuple[np.ndarray, np.ndarray], powers: Powers) -> Words:
    data, offsets = bytes_of(column)
    inside, value = kind
    mask = inside[data]
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = mask[edges]
    ends[edges - 1] = mask[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((value[data] + np.uint64(1)) * up[: len(data)], out=sums[1:])
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, row, first, mix((sums[end] - sums[start]) * down[start]), sums, down)


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash), sorted and distinct: the ``k``-word shingles; a row of fewer words has one of all its words."""
    at, h = w.windows(k)
    rows, hashes = [w.row[at]], [h]
    for m in range(1, k):
        short = np.flatnonzero(w.counts == m)
        if len(short):
            h = w.hash[w.first[short]].copy()
            for j in range(1, m):
                h = h * _STEP + w.hash[w.first[short] + j]
            rows.append(short)
            hashes.append(mix(h + np.uint64(m)))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def covered(n: int, begin: np.ndarray, length) -> np.ndarray:
    """Which of ``n`` places lie in one of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + length, -1)
    return np.cumsum(edge[:-1]) > 0


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of about CHUNK_BYTES of text."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // CHUNK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def add_columns(docs: DataFrame, text: str, keep: list[str], fields: list[T.StructField], start: Callable) -> DataFrame:
    """``keep`` and the new columns.

    ``start()`` runs once in each task and gives a function from a text column to the new columns.
    A column of ``docs`` that has a new column's name is replaced.
    """
    names = {f.name for f in fields}
    keep = [c for c in keep if c not in names]
    schema = T.StructType([docs.schema[c] for c in keep] + fields)

    def run(batches):
        make = start()
        for batch in batches:
            for part in slices(batch, "__text"):
                new = make(part.column("__text"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *new], [*keep, *(f.name for f in fields)])

    chosen = [docs[f"`{c}`"] for c in keep] + [docs[f"`{text}`"].cast("string").alias("__text")]
    return docs.select(*chosen).mapInArrow(run, schema)
