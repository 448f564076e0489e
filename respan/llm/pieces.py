"""SentencePiece encoding that keeps, for every piece, the byte span of the original text it stands for.

The text is normalised here by the model's own rules: at each place the longest key of the compiled
character map is replaced, and every byte of the result remembers the source byte it came from.  Pieces
are laid along the normalised bytes and carried back through that record.  The ids are the library's.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from respan.llm.words import add_columns

SPACE_MARK = "▁"
_MARK = SPACE_MARK.encode()


class CharMap:
    """The compiled map of a model: a double-array trie of source strings and the strings put in their place."""

    def __init__(self, blob: bytes):
        self.units, self.values = [], b""
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
            self.values = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that starts at ``at``, and its replacement."""
        if not self.units:
            return None
        found = None
        node = self._offset(self.units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.values[found[1] : self.values.index(b"\0", found[1])]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class PieceEncoder:
    """Ids, spans and decoded texts of one model, given as its file's bytes."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.rules = proto.normalizer_spec
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that put the space mark behind a word are not supported")
        self.map = CharMap(self.rules.precompiled_charsmap)
        kinds = proto.SentencePiece
        self.length = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.unknown = {i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN}
        self.needs_surface = not proto.trainer_spec.byte_fallback
        self.identity = not self.map.units and not self.rules.remove_extra_whitespaces and self.rules.escape_whitespaces
    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its bytes and for its end, the place in ``text``."""
        out, source, at = bytearray(), [], 0
        parts = []
        while at < len(text):
            hit = self.map.longest(text, at)
            if hit is None:
                size = next(n for n in range(1, 5) if at + n >= len(text) or text[at + n] & 0xC0 != 0x80)
                hit = size, text[at : at + size]
            parts.append((at, hit[1]))
            at += hit[0]
        squeeze = self.rules.remove_extra_whitespaces
        if squeeze:
            while parts and not parts[0][1].strip(b" "):
                parts.pop(0)
        mark = _MARK if self.rules.escape_whitespaces else b" "
        if parts and self.rules.add_dummy_prefix:
            out += mark
            source += [parts[0][0]] * len(mark)
        after_space = squeeze
        end = len(text)
        for place, value in parts:
            if squeeze and after_space:
                value = value.lstrip(b" ")
            if not value:
                continue
            after_space = value.endswith(b" ")
            put = value.replace(b" ", mark)
            out += put
            source += [place] * len(put)
        while squeeze and out.endswith(mark):
            end = source[-1]
            del out[-len(mark) :], source[-len(mark) :]
        return bytes(out), np.array([*source, end], np.int64)

    def source(self, text: bytes, places: np.ndarray) -> np.ndarray:
        """Places in ``text`` of places in its normalised form; fails if the last is not its end."""
        if self.identity:  # only spaces change: one byte becomes three
            prefix = 3 if self.rules.add_dummy_prefix and text else 0
            spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
            marks = prefix + 3 + spaces + 2 * np.arange(len(spaces))
            size, found = prefix + len(text) + 2 * len(spaces), np.maximum(places - prefix, 0)
            found -= 2 * np.searchsorted(marks, places, "right")
        else:
            normal, record = self.normalise(text)
            size, found = len(normal), record[places]
        if places[-1] != size:
            raise ValueError("pieces do not cover the normalised text")
        return found

    def spans(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Byte places in the UTF-8 text where the pieces ``ids`` of ``text`` begin; the last is the end."""
        length = self.length[ids]
        if not self.unknown.isdisjoint(ids.tolist() if self.needs_surface else ()):
            pieces = self.library.encode(text, out_type=str)
            length = np.array([len(p.encode()) if i in self.unknown else n for i, p, n in zip(ids.tolist(), pieces, length.tolist())])
        places = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(length, out=places[1:])
        return self.source(text.encode(), places)


def read_model(spark, path: str) -> bytes:
    """A model file's bytes; ``path`` is a path for Spark or one of the driver's own files."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])
    with open(path, "rb") as f:
        return f.read()


_IDS = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("begins", T.ArrayType(T.IntegerType())), T.StructField("ends", T.ArrayType(T.IntegerType()))]
_DIGESTS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
    T.StructField("spans_sha256", T.StringType()),
]


def _encoder(docs: DataFrame, text: str, keep: list[str], fields, model: bytes, result) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        encoder = PieceEncoder(shared.value)

        def make(column: pa.Array) -> list[pa.Array]:
            texts = [x or "" for x in column.to_pylist()]
            rows = []
            for value, ids in zip(texts, encoder.library.encode(texts, num_threads=1, add_bos=True, add_eos=True)):
                ids = np.array(ids, np.int32)
                places = encoder.spans(value, ids[1:-1])
                rows.append(result(encoder, ids, np.concatenate([[0], places]), np.concatenate([places, places[-1:]])))
            return [pa.array(c, type=t) for c, t in zip(zip(*rows), result.types)]

        return make

    return add_columns(docs, text, keep, fields, start)


def _whole(encoder, ids, begins, ends):
    return ids, begins, ends


def _digest(encoder, ids, begins, ends):
    both = np.stack([begins, ends]).T.astype("<u4").tobytes()
    return (
        len(ids),
        hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
        hashlib.sha256(encoder.library.decode(ids.tolist()).encode()).hexdigest(),
        hashlib.sha256(both).hexdigest(),
    )


_whole.types = [pa.list_(pa.int32())] * 3
_digest.types = [pa.int64(), pa.string(), pa.string(), pa.string()]


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) with ``ids``, ``begins`` and ``ends``, begin and end ids included.

    ``begins`` and ``ends`` are byte places in the UTF-8 text; the begin and end ids stand for nothing at
    its two ends.  A null text counts as empty: two ids.  One row for each row given; a column named like
    a new one is replaced.
    """
    return _encoder(docs, text, docs.columns if keep is None else keep, _IDS, read_model(docs.sparkSession, model_path), _whole)


def piece_digests(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """As ``encode_pieces``, with digests of the ids, of their decoded text and of the spans instead."""
    return _encoder(docs, text, docs.columns if keep is None else keep, _DIGESTS, read_model(docs.sparkSession, model_path), _digest)


def decode_pieces(encoded: DataFrame, model_path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns and the library's decoding of the ids as column ``to``; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(encoded.sparkSession, model_path))
    kept = [c for c in encoded.columns if c != to]

    def run(batches):
        library = PieceEncoder(shared.value).library
        for batch in batches:
            texts = [None if x is None else library.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, to])

    schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(to, T.StringType())])
    return encoded.select([encoded[f"`{c}`"] for c in dict.fromkeys([*kept, ids])]).mapInArrow(run, schema)
