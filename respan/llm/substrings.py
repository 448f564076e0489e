"""Removal of long passages that an earlier document has word for word, found with fixed-block anchors.

Every document's non-overlapping BLOCK-word blocks are the index, and every run of BLOCK words of every
document probes it.  A repeated window of 2 * BLOCK - 1 words or more holds a whole block of either
document, so a window without a hit cannot repeat.  Hits are extended on both sides to all windows around
them, and the windows themselves then meet: the smallest document that has a window keeps it.  The union of
windows removed from a document is its maximal exact repeats with earlier documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from respan.llm.meeting import Entries, groups, meet
from respan.llm.words import Powers, Words, covered, slices, white_space_words, words

WINDOW = 13
_ALIGNED, _SETTLED = 1, 2


def _docs(part: pa.RecordBatch, mark: bool) -> np.ndarray:
    """doc_id and, to tell rows of one doc_id apart, a part of the text's hash."""
    doc = part.column("doc_id").to_numpy()
    return np.stack([doc, part.column("mark").to_numpy() if mark else np.zeros_like(doc)]).T


def _distinct(e: Entries) -> Entries:
    """One entry for each row and hash, with the union of its flags."""
    order = np.lexsort((e.row, e.hash))
    e = e.take(order)
    new = np.append(True, (e.hash[1:] != e.hash[:-1]) | (e.row[1:] != e.row[:-1]))[: len(order)]
    first = np.flatnonzero(new)
    flag = np.bitwise_or.reduceat(e.flag, first) if len(first) else e.flag
    return e.take(first)._replace(flag=flag)


def _hit(e: Entries, first: np.ndarray) -> np.ndarray:
    """Of each hash: whether a document's block has it and another document has it anywhere."""
    if not len(first):
        return np.zeros(0, bool)
    flags = np.bitwise_or.reduceat(e.flag, first)
    several = np.minimum.reduceat(e.row, first) != np.maximum.reduceat(e.row, first)
    return (flags & _ALIGNED > 0) & (several | (flags & _SETTLED > 0))


def _settle_blocks(e: Entries) -> tuple[Entries, Entries]:
    e, first, group = groups(_distinct(e))
    hit = _hit(e, first)
    told = hit[group]
    one = np.zeros(len(group), bool)
    one[first[hit]] = True
    sent = e._replace(flag=np.where(one, _ALIGNED | _SETTLED, e.flag))
    return e.take(told), sent.take(~told | one)


def _decide_blocks(e: Entries) -> Entries:
    e, first, group = groups(e)
    return e.take(_hit(e, first)[group] & (e.flag & _SETTLED == 0))


def _earliest(e: Entries, first: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(e.docs[e.row, 0], first) if len(first) else np.zeros(0, np.int64)


def _settle_windows(e: Entries) -> tuple[Entries, Entries]:
    e, first, group = groups(e)
    least = _earliest(e, first)[group] if len(first) else np.zeros(0, np.int64)
    later = e.docs[e.row, 0] > least
    # every place of the task's earliest document may still be removed by an earlier one elsewhere
    return e.take(later), e.take(~later)


def _decide_windows(e: Entries) -> Entries:
    e, first, group = groups(e)
    return e.take(e.docs[e.row, 0] > _earliest(e, first)[group]) if len(first) else e


def _blocks(block: int):
    def start():
        powers, kind = Powers(), white_space_words()

        def entries(batch):
            for part in slices(batch, "text"):
                w = words(part.column("text"), kind, powers)
                at, h = w.windows(block)
                place = at - w.first[w.row[at]]
                yield Entries(_docs(part, False), w.row[at], place, h, np.where(place % block == 0, _ALIGNED, 0))

        return entries

    return start


def _places(told: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, "<i4"), *(np.frombuffer(x, "<i4") for x in told)]).astype(np.int64)


def _windows(block: int, window: int):
    """Windows around a hit: those that hold a run of words equal to one told back."""

    def start():
        powers, kind = Powers(), white_space_words()

        def entries(batch):
            for part in slices(batch.filter(pc.is_valid(batch.column("told"))), "text"):
                w = words(part.column("text"), kind, powers)
                at, h = w.windows(block)
                hit = np.zeros(len(w.hash), bool)
                for i, cell in enumerate(part.column("told")):
                    begin, end = np.searchsorted(at, w.first[i : i + 2])
                    own = h[begin:end]
                    told = _places(cell.as_py())
                    hit[at[begin:end][np.isin(own, own[told[told < len(own)]])]] = True
                upto = np.concatenate([[0], np.cumsum(hit)])
                at, h = w.windows(window)
                some = upto[at + window - block + 1] > upto[at]
                at = at[some]
                yield Entries(_docs(part, True), w.row[at], at - w.first[w.row[at]], h[some], np.zeros(len(at), np.int64))

        return entries

    return start


def _kept_words(w: Words, i: int, data: bytes, removed: np.ndarray) -> bytes:
    a, b = w.first[i], w.first[i + 1]
    return b" ".join(data[s:e] for s, e in zip(w.start[a:b][~removed], w.end[a:b][~removed]))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``: the words left, joined by one space (``digest``: kept_sha256 instead).

    A word goes if a window of ``window`` words of its document that covers it also starts in a document
    with a smaller key; windows are judged on the texts given, so no order of work matters.  One row for
    each row given.  Keys are integers; rows with one key never remove one another's words; a row with a
    null key loses nothing and removes nothing.  Null and empty texts have no words.
    """
    block = (window + 1) // 2
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text").bitwiseAND(F.lit((1 << 32) - 1)))
    anchors = meet(rows.where("doc_id is not null"), _blocks(block), _settle_blocks, _decide_blocks, exact=False)
    told = anchors.groupBy("doc_id").agg(F.collect_list("places").alias("told"))
    # both joins are left joins of the same rows on the same key, so the texts are shuffled once
    around = rows.join(told, "doc_id", "left").select("doc_id", "mark", "text", "told")
    repeats = meet(around, _windows(block, window), _settle_windows, _decide_windows, exact=True)
    removed = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("mark", "places")).alias("removed"))
    whole = rows.join(removed, "doc_id", "left").select("doc_id", "mark", "text", "removed")
    last = "kept_sha256" if digest else "kept"
    schema = T.StructType.fromDDL(f"doc_id long, n_words long, n_removed long, {last} string")

    def finish(batches):
        powers, kind = Powers(), white_space_words()
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"), kind, powers)
                data = w.data.tobytes()
                n_removed, kept = [], []
                for i, (cell, mark) in enumerate(zip(part.column("removed"), part.column("mark").to_pylist())):
                    own = [x["places"] for x in cell.as_py() or () if x["mark"] == mark]
                    removed = covered(int(w.counts[i]), _places(own), window)
                    left = _kept_words(w, i, data, removed)
                    n_removed.append(int(removed.sum()))
                    kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(w.counts), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], schema.names)

    return whole.mapInArrow(finish, schema)
