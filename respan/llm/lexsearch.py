"""Ranked lexical search: an index of posting lists in shards of documents, and the best documents of every item.

A shard is a run of documents of bounded size, indexed by the task that reads them, so documents are never shuffled.  Its posting
lists are rows (shard, term, documents, counts) of a table; one more row for each shard has the lengths and the keys.
To search, the lists of the items' terms meet in a task for each shard and block of items, get their impacts from the
counts of the whole collection, and are searched interval by interval (``rmq``).  The shards' best are ranked together.

Terms are compared as texts.  Scores are integers: with N documents that have terms, L their terms in all, n those of a
document, a term weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))) and a document has m = 10 + (90 n N) div L; it scores
the sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the item's different terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from respan.lineage import cut_lineage, scratch_path
from respan.llm.rmq import Shard
from respan.llm.words import bytes_of, item_words

SHARD_BYTES = 12 << 20  # of text
SHARD_DOCUMENTS = 8192
BLOCK_ITEMS = 512  # items that a task searches for in a shard
TOP = 10
SMALL_TERMS = 200_000  # rows of wanted terms that are broadcast; more are joined by shuffles
_SALTS = 32  # over which the lists of one term are then dealt
_INDEX = "shard long, term string, df long, total long, docs binary, counts binary, keys binary"


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and number of every term of the texts, and the different terms by number."""
    data, offsets = bytes_of(column)
    inside, value = item_words()
    mask = inside[data]
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = mask[edges]
    start = np.flatnonzero(begins)
    row = np.searchsorted(offsets, start, side="right") - 1
    before = np.cumsum(mask, dtype=np.int64)  # bytes of terms up to here
    cuts = np.append(before[start] - 1, before[-1] if len(before) else 0)
    packed = value.astype(np.uint8)[data[mask]]
    spelled = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(packed)]).dictionary_encode()
    return row, spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64), spelled.dictionary.cast(pa.large_string()).cast(pa.string())


def _ipc(column: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("key", column.type)])) as out:
        out.write_batch(pa.RecordBatch.from_arrays([column], ["key"]))
    return sink.getvalue().to_pybytes()


def _indexed(rows: pa.Table, shard: int):
    """Record batches of the index of some documents (key, text); documents are placed in ascending order of their key."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("key", "ascending")], null_placement="at_end")).combine_chunks()
    n = rows.num_rows
    place, term, spelled = terms(rows.column("text").chunk(0) if n else pa.array([], pa.string()))
    lengths = np.bincount(place, minlength=n).astype(np.int64)
    pairs, counts = np.unique(term * n + place, return_counts=True)
    first = np.searchsorted(pairs, np.arange(len(spelled) + 1, dtype=np.int64) * n)
    docs, counts = (pairs % n).astype(np.int32), counts.astype(np.int32)
    cuts = pa.py_buffer((first * 4).astype(np.int32))
    lists = lambda x: pa.Array.from_buffers(pa.binary(), len(spelled), [None, cuts, pa.py_buffer(x)])
    schema = ["shard", "term", "df", "total", "docs", "counts", "keys"]
    none = pa.nulls(len(spelled), pa.int64())
    whole = pa.RecordBatch.from_arrays([pa.array(np.full(len(spelled), shard)), spelled, pa.array(np.diff(first).astype(np.int64)), none, lists(docs), lists(counts), pa.nulls(len(spelled), pa.binary())], schema)
    head = [pa.array([x], t) for x, t in ((shard, pa.int64()), (None, pa.string()), (int((lengths > 0).sum()), pa.int64()), (int(lengths.sum()), pa.int64()), (None, pa.binary()), (lengths.tobytes(), pa.binary()), (_ipc(rows.column("key").chunk(0)), pa.binary()))]
    yield pa.RecordBatch.from_arrays(head, schema)
    for at in range(0, len(spelled), 10_000):
        yield whole.slice(at, 10_000)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, shard_documents: int = SHARD_DOCUMENTS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the index of all rows to ``path`` (a new one below the shared folder if None) and returns it.  Runs a job.

    Each row is a document of its own, whatever its key.  Null and empty texts have no terms.  A shard ends with the row that
    takes it to ``shard_documents`` rows or ``shard_bytes`` bytes of text.
    """

    def run(batches):
        shard = TaskContext.get().partitionId() << 32
        held, rows, size = [], 0, 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            while batch.num_rows:
                full = np.flatnonzero((np.arange(1, batch.num_rows + 1) + rows >= shard_documents) | (np.cumsum(lengths) + size >= shard_bytes))
                end = int(full[0]) + 1 if len(full) else batch.num_rows
                held.append(batch.slice(0, end))
                rows, size = rows + end, size + int(lengths[:end].sum())
                batch, lengths = batch.slice(end), lengths[end:]
                if len(full):
                    yield from _indexed(pa.Table.from_batches(held), shard)
                    shard, held, rows, size = shard + 1, [], 0, 0
        if rows:
            yield from _indexed(pa.Table.from_batches(held), shard)

    spark = docs.sparkSession
    path = path or scratch_path(spark, "lexical-index")
    chosen = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    chosen.mapInArrow(run, _INDEX).write.parquet(path)
    return spark.read.schema(_INDEX).parquet(path)


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term): the different terms of every item; the rows of one key are one item."""

    def run(batches):
        for batch in batches:
            row, term, spelled = terms(batch.column("text"))
            pairs = np.unique(row * max(len(spelled), 1) + term)
            row, term = pairs // max(len(spelled), 1), pairs % max(len(spelled), 1)
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(row)), spelled.take(pa.array(term))], ["item", "term"])

    chosen = items.select(F.col(f"`{key}`").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("item", items.schema[key].dataType), T.StructField("term", T.StringType())])
    return chosen.mapInArrow(run, schema).distinct()


def _impacts(weight: np.ndarray, tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    wide = 90 * int(length.max(initial=0)) * n >= 1 << 63
    m = 10 + (np.array([90 * int(x) * n // total for x in length], np.int64) if wide else 90 * length * n // total)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _searched(group: pa.Table, n: int, total: int, top: int, key_type: pa.DataType) -> pa.Table:
    """The best documents of one shard for every item of one block."""
    head = group.filter(pc.is_null(group.column("id"))).to_pylist()[0]
    lists = group.filter(pc.is_valid(group.column("id"))).sort_by("id")
    lengths = np.frombuffer(head["counts"], np.int64)
    joined = lambda name: np.frombuffer(b"".join(lists.column(name).to_pylist()), np.int32).astype(np.int64)
    docs, tf = joined("docs"), joined("counts")
    sizes = lists.column("df").to_numpy()
    weights = np.repeat(lists.column("w").to_numpy(), sizes)
    impact = _impacts(weights, tf, lengths[docs], n, total) if len(docs) else weights
    shard = Shard(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), docs, impact, len(lengths))
    ids = lists.column("id").to_numpy()
    item, score, place = [], [], []
    for i, wanted in enumerate(head["items"]):
        at = np.searchsorted(ids, wanted)
        at = at[(at < len(ids))]
        at = at[np.isin(ids[at], wanted)]
        for s, d in shard.search(np.unique(at), top):
            item.append(i)
            score.append(s)
            place.append(d)
    keys = pa.ipc.open_stream(head["keys"]).read_all().column("key").combine_chunks().cast(key_type)
    block = pa.array(np.full(len(item), head["block"], np.int64))
    return pa.table({"block": block, "i": pa.array(item, pa.int64()), "score": pa.array(score, pa.int64()), "doc": keys.take(pa.array(place, pa.int64()))})


def search(index: DataFrame, items: DataFrame, key_type: T.DataType, item: str = "item_id", text: str = "text", top: int = TOP, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item, rank, doc, score): the ``top`` documents of highest positive score for every item.  Runs jobs.

    Equal scores come in ascending order of the document's key, a null key last; rows of one key are different documents.  The rows of
    one item key, null included, are one item with the terms of all of them.  An item without terms, or none that a document has, has no rows.
    ``key_type`` is the type of the documents' key.  Up to ``SMALL_TERMS`` wanted terms are broadcast.
    """
    spark = index.sparkSession
    asked = cut_lineage(item_terms(items, item, text))
    heads, postings = index.where("term is null"), index.where("term is not null")
    whole = heads.agg(F.sum("df").alias("n"), F.sum("total").alias("total")).first()
    n, total = int(whole.n or 0), int(whole.total or 0)
    n_blocks = max(1, -(-asked.select("item").distinct().count() // block_items))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n_blocks)))
    distinct = asked.select("term").distinct()
    few = asked.count() <= SMALL_TERMS
    if few:
        distinct = F.broadcast(distinct)
    frequency = postings.select("term", "df").join(distinct, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    known = asked.join(frequency.select("term", weight.alias("w")), "term").where("w > 0")
    # numbers of terms and items within their block
    known = cut_lineage(
        known.withColumn("id", F.dense_rank().over(Window.partitionBy("block").orderBy("term")).cast("long"))
        .withColumn("i", F.dense_rank().over(Window.partitionBy("block").orderBy("item")) - 1)
    )
    packed = known.groupBy("block", "i").agg(F.collect_list("id").alias("ids")).groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "ids"))), lambda x: x["ids"]).alias("items"))
    wanted = known.select("block", "term", "id", "w").distinct()
    if few:
        lists = postings.join(F.broadcast(wanted), "term")
    else:
        dealt = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        lists = postings.withColumn("salt", F.pmod("shard", F.lit(_SALTS)).cast("int")).join(dealt, ["term", "salt"])
    lists = lists.select("shard", "block", "id", "w", "df", "docs", "counts", F.lit(None).cast("binary").alias("keys"), F.lit(None).cast("array<array<bigint>>").alias("items"))
    every = heads.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))).join(packed, "block")
    none = F.lit(None).cast("long")
    every = every.select("shard", "block", none.alias("id"), none.alias("w"), "df", "docs", "counts", "keys", "items")
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("i", T.LongType()), T.StructField("score", T.LongType()), T.StructField("doc", key_type)])
    arrow_type = pa.schema(spark.createDataFrame([], T.StructType([T.StructField("k", key_type)])).toArrow().schema).field("k").type

    def run(group: pa.Table) -> pa.Table:
        return _searched(group, n, total, top, arrow_type)

    best = every.unionByName(lists).groupBy("shard", "block").applyInArrow(run, schema)
    order = Window.partitionBy("block", "i").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = known.select("block", "i", "item").distinct()
    return best.join(names, ["block", "i"]).select("item", "rank", "doc", "score")
