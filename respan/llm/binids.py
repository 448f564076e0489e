"""Token ids in files of independently coded, checksummed blocks.

Documents are put in order by range partitioning; each partition is a shard.  In a shard the ids of all
documents follow one another and are cut into blocks.  A block row has the coded ids, their crc32, and the
list of the documents (or parts of long ones) it holds, so any block can be read and checked alone.  The
files are Parquet tables of block rows, so any store that Spark reaches can hold them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from respan.llm.pieces import read_model
from respan.llm.rangecoder import BLOCK_IDS, ID_LIMIT
from respan.llm.tokenids import coded, decoded, tables, token_ids

_GROUP = 64  # blocks that are handed on at a time


class ChecksumError(ValueError):
    """A block's ids do not have the checksum written with them."""


def _parts(key: T.DataType) -> T.ArrayType:
    fields = [T.StructField("id", key)] + [T.StructField(c, T.LongType()) for c in ("ordinal", "offset", "part", "parts", "n")]
    return T.ArrayType(T.StructType(fields))


def _block_schema(key: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(c, T.LongType()) for c in ("shard", "block", "n_ids", "crc32")]
        + [T.StructField("payload", T.BinaryType()), T.StructField("docs", _parts(key))]
    )


class _Shard:
    """Cuts a shard's documents into blocks."""

    def __init__(self, shard: int):
        self.shard, self.block, self.ordinal, self.offset = shard, 0, 0, 0
        self.closed: list[tuple[np.ndarray, list]] = []
        self.ids: list[np.ndarray] = []
        self.docs: list[dict] = []
        self.size = 0

    def add(self, key, ids: np.ndarray) -> None:
        pieces = self._cut(ids)
        for i, piece in enumerate(pieces):
            if self.size + len(piece) > BLOCK_IDS:
                self.close()
            self.ids.append(piece)
            self.size += len(piece)
            self.docs.append({"id": key, "ordinal": self.ordinal, "offset": self.offset, "part": i, "parts": len(pieces), "n": len(piece)})
        self.ordinal += 1
        self.offset += len(ids)

    def _cut(self, ids: np.ndarray) -> list[np.ndarray]:
        room = BLOCK_IDS - self.size
        if len(ids) <= max(room, BLOCK_IDS // 8) or not room:
            room = 0
        cuts = [0, *([room] if room else []), *range(room + BLOCK_IDS, len(ids), BLOCK_IDS), len(ids)]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def close(self) -> None:
        if self.docs:
            self.closed.append((np.concatenate(self.ids), self.docs))
            self.ids, self.docs, self.size = [], [], 0

    def rows(self) -> list[dict]:
        """The closed blocks; their payload is yet to be coded."""
        blocks, self.closed = self.closed, []
        out = []
        for ids, docs in blocks:
            if ids.min() < 0 or ids.max() >= ID_LIMIT:
                raise ValueError(f"ids must lie in 0 to {ID_LIMIT - 1}")
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            out.append({"shard": self.shard, "block": self.block, "n_ids": len(ids), "crc32": crc, "payload": ids.astype("<u2").tobytes(), "docs": docs})
            self.block += 1
        return out


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, key: str = "doc_id", text: str = "text", shards: int | None = None) -> None:
    """Encodes whole texts and writes the ids, ``end_id`` after each document, in ascending order of ``key``.

    A null text counts as empty; a null key comes last; rows with equal keys are ordered by text.  An
    empty table gives an empty file.  Plain byte-level BPE is encoded by ``tokenids``, any other tokenizer by its library.
    """
    spark = docs.sparkSession
    model = read_model(spark, tokenizer_path)
    held = tables(model)
    library = held is None
    shared = spark.sparkContext.broadcast(model if library else None)
    kind = docs.schema[key].dataType
    schema = _block_schema(kind)
    arrow = pa.schema([*((c, pa.int64()) for c in ("shard", "block", "n_ids", "crc32")), ("payload", pa.binary())])

    def by_library():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value.decode())
        return lambda texts: [e.ids for e in tokenizer.encode_batch([x or "" for x in texts], add_special_tokens=False)]

    def run(batches):
        encode = by_library() if library else lambda ids: [np.frombuffer(x, "<u2") for x in ids]
        shard, docs_type = None, None

        def flush():
            rows = shard.rows()
            fixed = pa.RecordBatch.from_pylist([{c: r[c] for c in arrow.names} for r in rows], schema=arrow)
            return pa.RecordBatch.from_arrays([*fixed.columns, pa.array([r["docs"] for r in rows], docs_type)], [*arrow.names, "docs"])

        for batch in batches:
            if docs_type is None:
                long = pa.int64()
                docs_type = pa.list_(pa.struct([("id", batch.schema.field("k").type), *((c, long) for c in ("ordinal", "offset", "part", "parts", "n"))]))
            for a in range(0, batch.num_rows, 256):
                rows = batch.slice(a, 256).to_pydict()
                for number, k, ids in zip(rows["shard"], rows["k"], encode(rows["t"])):
                    if shard is None or shard.shard != number:
                        if shard is not None:
                            shard.close()
                            yield flush()
                        shard = _Shard(number)
                    shard.add(k, np.append(np.asarray(ids, np.int64), end_id))
                    if len(shard.closed) >= _GROUP:
                        yield flush()
        if shard is not None:
            shard.close()
            yield flush()

    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
        .repartitionByRange(n, F.col("k").asc_nulls_last())
        .sortWithinPartitions(F.col("k").asc_nulls_last(), F.col("t").asc_nulls_first())
        .select("k", "t" if library else token_ids(spark, held, F.col("t")).alias("t"), F.spark_partition_id().cast("long").alias("shard"))
    )
    blocks = ordered.mapInArrow(run, schema)
    blocks.withColumn("payload", coded(spark, F.col("payload"))).write.mode("overwrite").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document part: shard, ordinal, doc_id, offset in the shard, part, parts, n, ids (little-endian bytes).

    Fails with ChecksumError on a block whose ids are not those written.
    """
    table = spark.read.parquet(path)
    part = table.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("doc_id", part["id"].dataType), *part.fields[1:], T.StructField("crc", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, _GROUP):
                some = batch.slice(a, _GROUP)
                rows = some.to_pydict()
                out = []
                for i, ids in enumerate(rows["payload"]):
                    data = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    if zlib.crc32(data) != rows["crc32"][i]:
                        raise ChecksumError(f"shard {rows['shard'][i]}, block {rows['block'][i]}")
                    at = 0
                    for d in rows["docs"][i]:
                        own = data[at : at + 4 * d["n"]]
                        at += 4 * d["n"]
                        out.append((rows["shard"][i], *d.values(), zlib.crc32(own), own))
                types = [pa.int64(), some.schema.field("docs").type.value_type.field("id").type, *[pa.int64()] * 6, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema.names)

    ids = decoded(spark, F.col("payload"), F.col("n_ids")).alias("payload")
    return table.select("shard", "block", "n_ids", "crc32", ids, "docs").mapInArrow(run, schema)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document in the files.

    Only documents cut into parts carry ids on; a document's own ids are gathered in one row.
    """
    parts = read_blocks(spark, path)
    held = F.when(F.col("parts") > 1, F.struct("part", "ids"))
    docs = parts.groupBy("shard", "ordinal").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("offset").alias("offset"),
        F.sum("n").alias("n_tokens"),
        F.max("parts").alias("parts"),
        F.max("crc").alias("crc"),
        F.sort_array(F.collect_list(held)).alias("held"),
    )
    joined = F.aggregate("held", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    crc = F.when(F.col("parts") > 1, F.crc32(joined)).otherwise(F.col("crc"))
    # one row for each shard: a running total over as many rows as the writer had partitions
    shards = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(starts), "shard").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", crc.alias("ids_crc32")
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (the end id included) of every document, as an array of integers."""
    unpack = T.ArrayType(T.LongType())

    def run(batches):
        for batch in batches:
            ids = [np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in batch.column("held").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    parts = read_blocks(spark, path)
    held = parts.groupBy("shard", "ordinal").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("held"))
    held = held.select("doc_id", F.transform("held", lambda x: x["ids"]).alias("held"))
    return held.mapInArrow(run, T.StructType([held.schema["doc_id"], T.StructField("ids", unpack)]))
