"""Hashes of places in documents meet their equals from other documents, and the places that matter are told back.

Rows of a plain table (hash, document, place) would be several times the text.  Here each task packs what it
has for a hash range into one binary value (in text order, byte planes side by side, which the shuffle's
compression shortens), after settling by itself what its own rows settle.  So a hash that many documents
have leaves a task once, not once for each of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

REPLY = "doc_id long, mark long, places binary"


class Entries(NamedTuple):
    """Places of some rows: ``docs`` has (doc_id, mark) of each row, ``row`` points into it."""

    docs: np.ndarray
    row: np.ndarray
    place: np.ndarray
    hash: np.ndarray
    flag: np.ndarray

    def take(self, at: np.ndarray) -> Entries:
        return Entries(self.docs, self.row[at], self.place[at], self.hash[at], self.flag[at])


def joined(parts: list[Entries]) -> Entries:
    shift = np.cumsum([0, *(len(p.docs) for p in parts)])
    rows = [p.row + s for p, s in zip(parts, shift)]
    return Entries(
        np.concatenate([p.docs for p in parts]),
        np.concatenate(rows),
        *(np.concatenate([getattr(p, c) for p in parts]) for c in ("place", "hash", "flag")),
    )


def groups(e: Entries) -> tuple[Entries, np.ndarray, np.ndarray]:
    """The entries in order of hash, where each hash begins, and the group of each entry."""
    e = e.take(np.argsort(e.hash, kind="stable"))
    first = np.flatnonzero(np.append(True, e.hash[1:] != e.hash[:-1])[: len(e.hash)])
    return e, first, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(e.hash))))


def _planes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unplanes(data: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(width, n).T
    return out.view("<u8").reshape(-1)


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=0)


def _pack(e: Entries, key: np.ndarray, width: int) -> bytes:
    """Entries in the order of rows and places, which then take about a byte besides their hash."""
    used, row = np.unique(e.row, return_inverse=True)
    size = e.place[np.flatnonzero(np.append(row[1:] != row[:-1], True))] + 1 if len(row) else e.place
    at = (np.cumsum(size) - size)[row] + e.place
    head = np.array([len(row), len(used)], "<u4").tobytes()
    flags = [np.packbits(e.flag & f > 0).tobytes() for f in (1, 2)]
    docs = [_planes(_steps(e.docs[used, 0]).view(np.uint64), 8), _planes(e.docs[used, 1], 4), _planes(size, 4)]
    return b"".join([head, *docs, _planes(key, width), _planes(_steps(at), 4), *flags])


def _unpack(data: bytes, width: int) -> Entries:
    n, m = np.frombuffer(data, "<u4", 2).tolist()
    view, at = memoryview(data), 8
    columns = []
    for count, w in ((m, 8), (m, 4), (m, 4), (n, width), (n, 4)):
        columns.append(_unplanes(view[at:], count, w))
        at += count * w
    ids, mark, size, key, step = columns
    docs = np.stack([np.cumsum(ids.view(np.int64)), mark.astype(np.int64)]).T
    first = np.cumsum(size.astype(np.int64))
    place = np.cumsum(step.astype(np.int64))
    row = np.searchsorted(first, place, "right")
    bits = [np.unpackbits(np.frombuffer(view[at + i * ((n + 7) // 8) :], np.uint8, (n + 7) // 8), count=n) for i in (0, 1)]
    return Entries(docs, row, place - (first - size.astype(np.int64))[row], key, bits[0].astype(np.int64) + 2 * bits[1])


def _replies(e: Entries) -> list[tuple[int, int, bytes]]:
    """(doc_id, mark, places) of each row among the entries."""
    order = np.lexsort((e.place, e.row))
    row, place = e.row[order], e.place[order].astype("<i4")
    cut = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)])
    ends = np.append(cut[1:], len(row))
    return [(*e.docs[row[a]].tolist(), place[a:b].tobytes()) for a, b in zip(cut, ends)]


def _told(e: Entries, keys: np.ndarray) -> list[tuple[int, bytes]]:
    """Answers packed for the partitions that gather them by document."""
    to = (e.docs[:, 0] % len(keys))[e.row]
    order = np.lexsort((e.place, e.row, to))
    e, cuts = e.take(order), np.searchsorted(to[order], np.arange(len(keys) + 1))
    spans = [(d, slice(a, z)) for d, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
    return [(int(keys[d]), _pack(e.take(at), e.hash[at], 0)) for d, at in spans]


def _by_document(told: list[bytes]) -> list[tuple[int, int, bytes]]:
    e = joined([_unpack(x, 0) for x in told])
    docs, row = np.unique(e.docs, axis=0, return_inverse=True)
    return _replies(e._replace(docs=docs, row=row.reshape(-1)[e.row]))


def bucket_keys(spark: SparkSession, n: int) -> list[int]:
    """A key for each of ``n`` partitions, so that a repartition by key gives each partition one range."""
    found: dict[int, int] = {}
    tried = 0
    while len(found) < n:
        some = spark.range(tried, tried + 32 * n).select("id", F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p"))
        for r in some.groupBy("p").agg(F.min("id").alias("id")).collect():
            found.setdefault(r.p, r.id)
        tried += 32 * n
    return [found[p] for p in range(n)]


def meet(
    rows: DataFrame,
    entries: Callable[[], Callable[[pa.RecordBatch], Iterable[Entries]]],
    settle: Callable[[Entries], tuple[Entries, Entries]],
    decide: Callable[[Entries], Entries],
    exact: bool,
) -> DataFrame:
    """doc_id, mark and places (little-endian 32-bit integers): what tasks settled and what the meeting decided.

    ``entries()`` makes, once in each task, a function from a batch to entries.  ``settle`` splits a task's
    entries into those already answered and those to send; ``decide`` picks, among all entries of a hash
    range, those to answer.  Unless ``exact``, only 32 bits of a hash are sent besides its range, so a few
    different hashes may be taken for equal.  A hash range is held by one task: its size is the number of entries that tasks
    send, divided by spark.sql.shuffle.partitions.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = np.array(bucket_keys(rows.sparkSession, n))
    sent = T.StructType.fromDDL("bucket int, payload binary, gather int, told binary")
    types = [pa.int32(), pa.binary(), pa.int32(), pa.binary()]

    def batch_of(rows_: list) -> pa.RecordBatch:
        cols = zip(*rows_) if rows_ else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], sent.names)

    def send(batches: Iterator[pa.RecordBatch]):
        of_batch, held, size = entries(), [], 0

        def flush():
            known, rest = settle(joined(held))
            scaled = (rest.hash >> np.uint64(16)) * np.uint64(n)  # n is below 2^16
            key = rest.hash if exact else (scaled >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
            order = np.lexsort((rest.place, rest.row, scaled >> np.uint64(48)))
            rest, key = rest.take(order), key[order]
            cuts = np.searchsorted((scaled >> np.uint64(48))[order], np.arange(n + 1, dtype=np.uint64))
            spans = [(b, slice(a, z)) for b, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
            packed = [(int(keys[b]), _pack(rest.take(at), key[at], 8 if exact else 4)) for b, at in spans]
            return batch_of([(*x, None, None) for x in packed] + [(int(keys[i % n]), None, *x) for i, x in enumerate(_told(known, keys))])

        for batch in batches:
            for e in of_batch(batch):
                held.append(e)
                size += len(e.hash)
                if size > 1_000_000:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def answer(batches: Iterator[pa.RecordBatch]):
        held = []
        for batch in batches:
            yield batch.filter(pc.is_valid(batch.column("told")))
            held += [_unpack(x, 8 if exact else 4) for x in batch.column("payload").drop_null().to_pylist()]
        if held:
            yield batch_of([(None, None, *x) for x in _told(decide(joined(held)), keys)])

    def gather(batches: Iterator[pa.RecordBatch]):
        told = [x for batch in batches for x in batch.column("told").to_pylist()]
        replies = _by_document(told) if told else []
        for a in range(0, len(replies), 10_000):
            cols = zip(*replies[a : a + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "mark", "places"])

    told = rows.mapInArrow(send, sent).repartition(n, "bucket").mapInArrow(answer, sent)
    return told.select("gather", "told").repartition(n, "gather").mapInArrow(gather, REPLY)
