"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item is cut into windows of WINDOW consecutive words (a shorter item is one window), and
each window is a set of word shingles.  A document can hold a window only if it holds all of its shingles,
so the rarest one alone has to be joined: how often each benchmark shingle occurs is counted over all
documents first.  Where a document has that shingle, its place fixes where the window would begin; the
window must lie inside the document (length and positional bounds) and all its words must be equal.

The benchmark is held by every task while it is smaller than BLOCK_BYTES; a larger one is cut into blocks
of items of that size, each joined on its own.  Documents are never shuffled for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from respan.llm.words import Powers, Words, add_columns, covered, item_words, slices, words

WINDOW = 10
SHINGLE = 5
BLOCK_BYTES = 32 << 20  # of benchmark text that a task holds at once


class Windows:
    """The distinct windows of a block of items, and the shingles each has at its places."""

    def __init__(self, ids: list[str], texts: list[str], window: int, shingle: int):
        w = words(pa.array(texts, pa.string()), item_words(), Powers())
        owners: dict[tuple, set[str]] = {}
        for item, a, b in zip(ids, w.first, w.first[1:]):
            size = min(window, b - a)
            for at in range(a, b - size + 1) if size else ():
                owners.setdefault(tuple(w.hash[at : at + size].tolist()), set()).add(item)
        self.items = [sorted(x) for x in owners.values()]
        self.size = np.array([len(x) for x in owners], np.int64)
        self.words = np.zeros((len(owners), window), np.uint64)
        self.shingles = []
        for i, x in enumerate(owners):
            self.words[i, : len(x)] = x
            row = np.zeros(len(x), np.int64)
            one = Words(*[None] * 4, row, np.array([0, len(x)]), self.words[i, : len(x)], None, None)
            self.shingles.append(one.windows(min(len(x), shingle))[1])
        self.widths = sorted({min(n, shingle) for n in self.size.tolist()})

    def every_shingle(self) -> np.ndarray:
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *self.shingles]))

    def rarest(self, keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each window's shingle of lowest (occurrences, hash), and its place in the window."""
        place = [min(range(len(x)), key=lambda j, x=x: (times[np.searchsorted(keys, x[j])], x[j])) for x in self.shingles]
        return np.array([x[j] for x, j in zip(self.shingles, place)], np.uint64), np.array(place, np.int64)


def _find(h: np.ndarray, keys: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``h``, place in the sorted ``keys``) of every hash that is a key."""
    some = np.flatnonzero(may[h >> np.uint64(48)])
    at = np.searchsorted(keys, h[some]).clip(0, max(len(keys) - 1, 0))
    hit = keys[at] == h[some] if len(some) else np.zeros(0, bool)
    return some[hit], at[hit]


def _table(keys: np.ndarray) -> np.ndarray:
    may = np.zeros(1 << 16, bool)
    may[keys >> np.uint64(48)] = True
    return may


def _occurrences(docs: DataFrame, text: str, keys: np.ndarray, widths: list[int]) -> np.ndarray:
    """How often each shingle of the block occurs in all documents; tasks send at most one row for each."""
    may = _table(keys)

    def count(batches):
        powers, total = Powers(), np.zeros(len(keys), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"), item_words(), powers)
                for k in widths:
                    total += np.bincount(_find(w.windows(k)[1], keys, may)[1], minlength=len(keys))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["k", "n"])

    found = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(count, "k long, n long")
    times = np.zeros(len(keys), np.int64)
    for r in found.groupBy("k").agg(F.sum("n").alias("n")).collect():
        times[r.k] = r.n
    return times


def _mark(docs: DataFrame, text: str, keep: list[str], names: list[str], windows: Windows, key: np.ndarray, place: np.ndarray) -> DataFrame:
    """``keep`` with the number of words, the places of hit words and the items found, for one block of items."""
    keys = np.unique(key)
    order = np.argsort(key, kind="stable")
    begins, ends = np.searchsorted(key[order], keys), np.searchsorted(key[order], keys, "right")
    may, size, content, items, widths = _table(keys), windows.size, windows.words, windows.items, windows.widths

    def start():
        powers = Powers()

        def make(column):
            w = words(column, item_words(), powers)
            at, of = [], []
            for k in widths if len(keys) else ():
                first, h = w.windows(k)
                i, j = _find(h, keys, may)
                n = ends[j] - begins[j]
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                window = order[np.repeat(begins[j], n) + nth]
                at.append(np.repeat(first[i], n) - place[window])
                of.append(window)
            none = [np.zeros(0, np.int64)]
            at, of = np.concatenate(at + none), np.concatenate(of + none)
            row = w.row[(at + place[of]).clip(0, max(len(w.row) - 1, 0))] if len(at) else at
            inside = (at >= w.first[row]) & (at + size[of] <= w.first[row + 1])
            at, of, row = at[inside], of[inside], row[inside]
            for j in range(content.shape[1]):
                same = (j >= size[of]) | (w.hash[np.minimum(at + j, len(w.hash) - 1)] == content[of, j])
                at, of, row = at[same], of[same], row[same]
            hit = covered(len(w.hash), at, size[of])
            found = [set() for _ in range(len(column))]
            for r, o in set(zip(row.tolist(), of.tolist())):
                found[r].update(items[o])
            hits = [np.flatnonzero(hit[a:b]).astype(np.int32) for a, b in zip(w.first, w.first[1:])]
            return [pa.array(w.counts), pa.array(hits, pa.list_(pa.int32())), pa.array([sorted(x) for x in found], pa.list_(pa.string()))]

        return make

    kinds = (T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType()))
    return add_columns(docs, text, keep, [T.StructField(n, k) for n, k in zip(names, kinds)], start)


def mark_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``keep`` (default: all columns) with n_words, n_hit, items (sorted ids as strings) and hits (places of hit words).

    One row for each row given.  A null or empty text has no words; items that are null, have a null id or
    no words are left out; items with equal ids count as one.  A column named like a new one is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "n_hit", "items", "hits")]
    bank = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").cast("string").alias("t"))
    bank = bank.where("id is not null and t is not null")
    blocks = 1 + int(bank.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // block_bytes
    out = docs.select(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("__t"))
    hits, items = [], []
    for b in range(blocks):
        rows = bank.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id", "t").collect()
        windows = Windows([r.id for r in rows], [r.t for r in rows], window, shingle)
        keys = windows.every_shingle()
        key, place = windows.rarest(keys, _occurrences(docs, text, keys, windows.widths))
        hits.append(f"__hits{b}")
        items.append(f"__items{b}")
        carried = [c for c in out.columns if c != "__n" and (c != "__t" or b + 1 < blocks)]
        out = _mark(out, "__t", carried, ["__n", hits[-1], items[-1]], windows, key, place)
    both = [F.array_sort(F.array_distinct(F.flatten(F.array(*x)))) if blocks > 1 else F.col(x[0]) for x in (hits, items)]
    return out.select(
        *[F.col(f"__{i}").alias(c) for i, c in enumerate(keep)],
        F.col("__n").alias("n_words"),
        F.size(both[0]).cast("long").alias("n_hit"),
        both[1].alias("items"),
        both[0].alias("hits"),
    )
