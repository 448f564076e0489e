"""Byte-level BPE and the block coder as functions of Spark columns, in Java: per id, numpy takes some fifty times as long.

``TokenIds.java`` is compiled in the driver by the compiler that Spark itself uses for generated code, and reaches the
executors in a jar, together with the tables of the tokenizer: merges, added tokens, and which characters are letters,
numbers or white space, the latter as the tokenizers library itself splits them.
"""

from __future__ import annotations

import atexit
import hashlib
import json
import shutil
import tempfile
import zipfile
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark.sql import Column, SparkSession, functions as F, types as T

from respan.llm.rangecoder import ID_LIMIT

_SOURCE = Path(__file__).with_name("TokenIds.java")
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_jars: dict[str, tuple[str, dict[str, object]]] = {}


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def _starts(split, text: str) -> np.ndarray:
    return np.array([a for _, (a, _) in split(text)])


def character_kinds(split) -> np.ndarray:
    """What every character counts as in the library's ``split`` (pre_tokenize_str): what it stays together with.

    Characters that follow one another and stay together are of one kind, so the first of them is asked about.
    """
    points = np.array([*range(0x80, 0xD800), *range(0xE000, 0x110000)])
    first = _starts(split, "".join(map(chr, points)))
    asked = np.concatenate([np.arange(0x80), points[first]])
    found = np.full(len(asked), _SPACE, np.int8)
    for kind, before in ((_OTHER, "!"), (_NUMBER, "1"), (_LETTER, "a")):
        text = "".join(f"{before}{chr(c)}\n" for c in asked)
        alone = np.isin(np.arange(1, len(text), 3), _starts(split, text))
        found[~alone] = kind
    kinds = np.full(0x110000, _OTHER, np.int8)
    kinds[:0x80] = found[:0x80]
    kinds[points] = np.repeat(found[0x80:], np.diff(np.append(first, len(points))))
    return kinds


@lru_cache(maxsize=4)
def tables(model: bytes) -> bytes | None:
    """What TokenIds.java reads, or None for a tokenizer that is not plain byte-level BPE with ids below ID_LIMIT."""
    spec = json.loads(model)
    bpe, pre, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
    vocab = bpe.get("vocab")
    plain = (
        not any(spec.get(c) for c in ("normalizer", "post_processor", "truncation", "padding"))
        and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) == ("ByteLevel", False, True)
        and bpe.get("type", "BPE") == "BPE"
        and not any(bpe.get(c) for c in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(x[c] for x in added for c in ("lstrip", "rstrip", "single_word", "normalized"))
        and all(x["content"] for x in added)
    )
    if not plain or any(s not in vocab for s in byte_symbols()):
        return None
    pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in bpe["merges"]]
    merges = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], ">i4").reshape(-1, 3)
    ids = [*vocab.values(), *(x["id"] for x in added)]
    if max(ids) >= ID_LIMIT or len(np.unique(merges[:, 2])) < len(merges):
        return None
    from tokenizers import Tokenizer

    kinds = character_kinds(Tokenizer.from_str(model.decode()).pre_tokenizer.pre_tokenize_str)
    ends = np.append(np.flatnonzero(np.diff(kinds)) + 1, len(kinds))
    runs = np.zeros(len(ends), [("end", ">i4"), ("kind", "i1")])
    runs["end"], runs["kind"] = ends, kinds[ends - 1]

    def number(*n: int) -> bytes:
        return np.array(n, ">i4").tobytes()

    out = [number(*(vocab[s] for s in byte_symbols())), number(len(merges)), merges.tobytes(), number(len(ends)), runs.tobytes(), number(len(added))]
    for x in added:
        content = x["content"].encode()
        out += [number(x["id"], len(content)), content]
    return b"".join(out)


def _jar(spark: SparkSession, held: bytes) -> tuple[str, dict[str, object]]:
    """The jar with the classes and ``held``, and an object of each function; its package is named after its content."""
    source = _SOURCE.read_text()
    name = f"respan_{hashlib.sha256(source.encode() + held).hexdigest()[:16]}"
    sc = spark.sparkContext
    if (done := f"{sc.applicationId} {name}") not in _jars:
        compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(sc._jvm.java.lang.Thread.currentThread().getContextClassLoader())
        compiler.cook(source.replace("package respan;", f"package {name};"))
        folder = tempfile.mkdtemp(prefix="respan-jar-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(f"{folder}/{name}.jar", "w", zipfile.ZIP_DEFLATED) as jar:
            for path, code in compiler.getBytecodes().items():
                jar.writestr(f"{path.replace('.', '/')}.class", bytes(code))
            jar.writestr(f"{name}/tables", held)
        sc._jsc.addJar(f"{folder}/{name}.jar")
        classes = compiler.getClassLoader()
        made = {c: classes.loadClass(f"{name}.TokenIds${c}").getDeclaredConstructors()[0].newInstance(None) for c in ("Tokenize", "Encode", "Decode")}
        _jars[done] = name, made
    return _jars[done]


def _call(spark: SparkSession, held: bytes, function: str, *columns: Column) -> Column:
    package, made = _jar(spark, held)
    name = f"{package}_{function}".lower()
    if not spark.catalog.functionExists(name):
        binary = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(T.BinaryType().json())
        spark._jsparkSession.udf().register(name, made[function], binary)
    return F.call_udf(name, *columns)


def token_ids(spark: SparkSession, held: bytes, text: Column) -> Column:
    """The ids of the texts, as little-endian 16-bit numbers; ``held`` is from ``tables``.  A null text has none."""
    return _call(spark, held, "Tokenize", text.cast("binary"))


def coded(spark: SparkSession, ids: Column) -> Column:
    """Blocks of ids, as little-endian 16-bit numbers, coded as ``rangecoder.encode_blocks`` codes them."""
    return _call(spark, b"", "Encode", ids)


def decoded(spark: SparkSession, payload: Column, n: Column) -> Column:
    """The ``n`` ids of each coded block."""
    return _call(spark, b"", "Decode", payload, n.cast("long"))
