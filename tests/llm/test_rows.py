"""Operators that look at one text at a time, against plain versions."""

import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from brute import SF, contamination, luhn, private, quality, secrets, sha
from respan.llm import queries

ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "é secret=token:abcdef Token='abc' PASSWORD : \"abcdef\" x@y.z 🙂 a.b_c@d.e_f@g.h"),
    (5, "AKIAAKIA0000 AKIA" + "Z" * 16 + " " + "deadbeef" * 3 + "g 1.2.3.4.5.6.7.8 999.1.1.1 0001.02.255.9"),
    (6, "4111 1111 1111 1111 4111-1111-1111-1112 +1 (555) 555-5555 ++49 30 123456 +1" + " " * 2000 + "x"),
    (7, "one two three " * 40 + "\nsame line here\nsame line here"), (7, "one two three " * 40 + "\nsame line here\nsame line here"),
    (8, "Alpha beta gamma delta"), (9, "q" * 50_000 + " " + "w " * 30_000), (None, "null key me@x.y 8.8.8.8"),
    (10, "x one two three four five six seven eight nine ten eleven y alpha BETA ### | $"), (11, "▁x ▁▁ y  z <s></s> <0x0A> 漢字\x00 "),
]


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def same(rows, want):
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_contamination(spark, table):
    from respan.llm.decontaminate import mark_contamination

    items = [(1, "one two three four five six seven eight nine ten eleven twelve"), (10, "alpha, beta"), (2, None), (3, ""), (10, "alpha beta"), (4, "TWO three four five six seven eight nine ten eleven")]
    bank = spark.createDataFrame([*items, (None, "x")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    for block in (1 << 20, 40):  # in one block, in several
        got = mark_contamination(table(ODD), bank, keep=["doc_id", "lang"], block_bytes=block)
        same(got.select("doc_id", "n_words", "n_hit", F.array_join("items", ",")).collect(), contamination(ODD, items))
    assert mark_contamination(table(ODD), bank.limit(0)).where("n_hit > 0").isEmpty()
    assert mark_contamination(table(ODD).limit(0), bank).isEmpty()
    want = contamination(documents(spark), [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert any(w[2] for w in want)
    same(queries.op1_decontamination(spark, SF).collect(), [(i, n, h, len(x.split(",")) if x else 0, sha(x), h > 0) for i, n, h, x in want])


def test_quality(spark, table):
    from respan.llm.repetition import keep_good, measure_quality

    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]

    def want(docs):
        for i, t in docs:
            q = quality(t)
            yield (i, *q, q[0] < 50 or 100 * q[4] > 50 * q[0])

    same(measure_quality(table(ODD)).select(cols).collect(), list(want(ODD)))
    got = queries.op3_quality_rules(spark, SF)
    same(got.select(cols).collect(), list(want(documents(spark))))
    assert got.where("base_failed and kept").isEmpty()
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(got, "doc_id").where("not base_failed")
    assert labels.where("(quality = 1) <> kept").count() <= 0.05 * labels.count()
    docs = table(documents(spark))
    assert keep_good(docs).columns == docs.columns and keep_good(docs).count() == got.where("kept").count()


def test_secrets(spark, table):
    from respan.llm.secrets import BASE_RULES, find_secrets, trigram_query

    cols = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    same(find_secrets(table(ODD)).select(cols).collect(), [(i, *secrets(t)) for i, t in ODD])
    same(queries.op2_secrets(spark, SF).select(cols).collect(), [(i, *secrets(t)) for i, t in documents(spark)])
    assert find_secrets(table(ODD).limit(0)).isEmpty()
    conditions = {r.kind: trigram_query(r.pattern) for r in BASE_RULES}
    assert conditions["hex"] == [] and conditions["access"] == [frozenset([frozenset(["aki", "kia"])])]
    assert all(any(s <= set("pas ass ssw swo wor ord".split()) for s in c) for c in conditions["assign"])
    more = find_secrets(table([(1, "ghp_" + "Gz" * 18 + " xoxb-1234567890")])).first()
    assert more.spans == "github:0:40,slack:41:56"


def test_private(spark, table):
    from respan.llm.pii import find_pii

    cols = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    same(find_pii(table(ODD)).select(cols).collect(), [(i, *private(t)) for i, t in ODD])
    assert find_pii(table(ODD).limit(0)).isEmpty()
    got = queries.op5_pii(spark, SF)
    same(got.select(cols).collect(), [(i, *private(t)) for i, t in documents(spark)])
    # what the trees add is not found where nothing was planted
    clean = got.where("n_email + n_ip + n_card + n_phone = 0")
    assert clean.where("spans <> ''").count() <= 0.01 * clean.count()


def test_toxicity(spark, table):
    from respan.llm import toxicity

    got = queries.op4_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    hits = [r for r in rows if r.toxic and r.predicted]
    assert len(hits) > 0.75 * sum(r.toxic for r in rows) and sum(r.predicted for r in rows) <= 1.03 * len(hits)
    assert got.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 3 == 1)).isEmpty()

    # a term that stands in every toxic text and in few others earns little weight under the penalty
    rng = np.random.default_rng(1)
    texts = [(i, " ".join(rng.choice(["sun", "sea", "road", "tree"], 6)) + (" idiot women" if i % 3 == 0 else " women" if i % 15 == 1 else "")) for i in range(600)]
    sample = spark.createDataFrame([(t, int(i % 3 == 0)) for i, t in texts], "text string, label int")
    probe = table([(1, "women sea"), (2, "sea"), (3, "idiot sea"), (4, None), (5, "")])

    def gap(weight):
        model = toxicity.fit_toxicity(sample, counterfactual=weight)
        score = {r.doc_id: r["score"] for r in toxicity.score_toxicity(probe, model, keep=["doc_id"]).collect()}
        assert score[4] == score[5] and score[3] > 0.7
        return score[1] - score[2]

    assert abs(gap(20.0)) < 0.3 * gap(0.0)
    empty = toxicity.fit_toxicity(sample.limit(0))
    assert [r.score for r in toxicity.score_toxicity(probe.limit(1), empty).collect()] == [0.5]


def test_obfuscated_personal_data(spark, table):
    """Forms that the exact rules miss are added; numbers and words that only look alike are not."""
    from respan.llm.pii import find_pii

    rng = random.Random(7)

    def card():
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    def digits(n):
        return "".join(rng.choice("123456789") for _ in range(n))

    docs, planted, decoys = [], {}, {}
    for i in range(600):
        name, host = f"n{digits(3)}", f"h{digits(2)}.example.org"
        plain = [f"please mail {name}@{host} soon", f"phone +{digits(2)} {digits(3)} {digits(5)} today", f"card {card()} paid"]
        odd = [f"order {digits(10)} shipped", f"see user{i}@local now", f"serial {digits(4)}.{digits(4)}.{digits(4)}.{digits(4)} end"]
        docs.append((i, f"{rng.choice(plain)} and {rng.choice(odd)} with {rng.choice(plain)}"))
    for i in range(1000, 1030):
        c = card()
        form = (f"n{digits(3)} [at] h{digits(2)}.example.org", f"{digits(2)} {digits(3)} {digits(5)}", ".".join(c[j : j + 4] for j in range(0, 16, 4)))[i % 3]
        lead = ("please mail ", "phone ", "card ")[i % 3]
        docs.append((i, f"{lead}{form} today"))
        planted[i] = f"{('email', 'phone', 'card')[i % 3]}:{len(lead)}:{len(lead + form)}"
    for i in range(2000, 2030):
        docs.append((i, (f"order {digits(10)} shipped", f"see user{i}@local now")[i % 2]))
        decoys[i] = ""
    rows = {r.doc_id: r for r in find_pii(table(docs)).collect()}
    missed = {i: rows[i].spans for i, span in planted.items() if span not in rows[i].spans.split(",")}
    assert not missed and {i: rows[i].spans for i in decoys} == decoys
    assert all((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == private(dict(docs)[i]) for i, r in rows.items())


def test_pieces(spark, table):
    import sentencepiece
    from respan.llm.pieces import decode_pieces, encode_pieces, piece_digests

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)

    def want(docs):
        for i, t in docs:
            ids = library.encode(t or "", add_bos=True, add_eos=True)
            yield i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(library.decode(ids))

    cols = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    same(piece_digests(table(ODD), path).select(cols).collect(), list(want(ODD)))
    same(queries.op7_sentencepiece(spark, SF).select(cols).collect(), list(want(documents(spark))))
    for r in encode_pieces(table(ODD), path).collect():
        raw = (r.text or "").encode()
        assert b"".join(raw[a:b] for a, b in zip(r.begins, r.ends)) == raw
        for id_, a, b in zip(r.ids[1:-1], r.begins[1:-1], r.ends[1:-1]):
            if not library.is_byte(id_):
                assert library.id_to_piece(id_).replace("▁", " ").lstrip(" ") == raw[a:b].decode().replace("▁", " ").lstrip(" ")
    back = decode_pieces(encode_pieces(table(ODD), path), path).where("doc_id = 10").first()
    assert back.decoded == back.text


def test_char_map():
    """A compiled map made by hand: the longest key wins, and every byte remembers its source."""
    from respan.llm.pieces import CharMap

    keys = {b"a": b"X", b"ab": b"YZ"}
    values = b"X\0YZ\0"
    units = [0] * 1024
    root, at_a, at_ab = 256, 512, 768  # nodes reached by the empty string, "a" and "ab"

    def unit(label, offset_to, here, leaf):
        return (here ^ offset_to) << 10 | leaf << 8 | label

    units[0] = unit(0, root, 0, 0)
    a = root ^ ord("a")
    units[a] = unit(ord("a"), at_a, a, 1)
    units[at_a] = 1 << 31 | 0
    b = at_a ^ ord("b")
    units[b] = unit(ord("b"), at_ab, b, 1)
    units[at_ab] = 1 << 31 | 2
    blob = np.array(units, "<u4").tobytes()
    m = CharMap(len(blob).to_bytes(4, "little") + blob + values)
    assert m.longest(b"abc", 0) == (2, keys[b"ab"]) and m.longest(b"ac", 0) == (1, keys[b"a"]) and m.longest(b"c", 0) is None


def test_token_files(spark, table, tmp_path):
    from tokenizers import Tokenizer
    from respan.llm.binids import ChecksumError, read_digests, read_ids, write_ids

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = [*documents(spark)[:40], *((i + 10**6 if i else i, t) for i, t in ODD)]
    write_ids(table(docs), str(tmp_path / "ids"), path, shards=3)
    start, want = 0, []
    for i, t in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    same(read_digests(spark, str(tmp_path / "ids")).collect(), want)
    assert sum(len(r.ids) for r in read_ids(spark, str(tmp_path / "ids")).collect()) == start
    write_ids(table(docs).limit(0), str(tmp_path / "none"), path, shards=3)
    assert read_digests(spark, str(tmp_path / "none")).isEmpty()
    broken = spark.read.parquet(str(tmp_path / "ids")).withColumn("crc32", F.col("crc32") + 1)
    broken.write.parquet(str(tmp_path / "broken"))
    with pytest.raises(Exception, match=ChecksumError.__name__):
        read_digests(spark, str(tmp_path / "broken")).collect()


def test_token_query_equals_the_library(spark):
    """Every document of the table, through the files."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    start, want = 0, []
    for (i, _), coded in zip(docs, tokenizer.encode_batch([t or "" for _, t in docs], add_special_tokens=False)):
        ids = [*coded.ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = queries.op10_token_ids(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    same(got, want)


def test_range_coder():
    from respan.llm.rangecoder import decode_blocks, encode_blocks

    rng = np.random.default_rng(1)
    blocks = [np.zeros(0, int), np.array([65535]), rng.integers(0, 65536, 4096), np.zeros(4096, int), rng.zipf(1.3, 3000) % 50257, np.tile(rng.integers(0, 50000, 37), 100)]
    coded = encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, decode_blocks(coded, [len(b) for b in blocks])))
    assert len(coded[5]) < 0.05 * 2 * len(blocks[5])
    with pytest.raises(ValueError):
        encode_blocks([np.array([65536])])


def test_token_ids_equal_the_library(spark, tmp_path):
    """Odd characters, long words and added tokens, with tokenizers that are encoded here and by the library."""
    import json
    from tokenizers import Tokenizer
    from respan.llm.binids import read_ids, write_ids
    from respan.llm.tokenids import tables

    rng = np.random.default_rng(2)
    pool = [*" \n\t'aZ1!", "  ", " the", "'s", "'re", "'ll", "<|endoftext|>", "<|endof", "\xa0", "\u3000", "\u2003", "\x85", "\x1c", "\x00", "é", "ß", "中文", "٣", "½", "Ⅷ", "😀", "\u200b", "\u0301", "ि", "\U0001d504", "\U0010ffff"]
    texts = ["".join(rng.choice(pool, n)) for n in rng.integers(0, 40, 2000)]
    texts += ["".join(map(chr, rng.choice([*range(0xD800), *range(0xE000, 0x33000)], 50))) for _ in range(500)]
    texts += ["".join(rng.choice([*"etaoinshr"], n)) for n in (39, 40, 41, 200, 30000)] + ["ab" * 20000, "a" * 3000, "中" * 3000, "", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    plain = json.loads(Path(public_tokenizers.path("byte_bpe_50k.json")).read_text())
    for i, (change, here) in enumerate([({}, True), ({"pre_tokenizer": plain["pre_tokenizer"] | {"add_prefix_space": True}}, False), ({"normalizer": {"type": "NFC"}}, False)]):
        model = json.dumps(plain | change)
        (tmp_path / f"{i}.json").write_text(model)
        assert (tables(model.encode()) is not None) == here
        write_ids(docs, str(tmp_path / f"ids{i}"), str(tmp_path / f"{i}.json"), shards=2)
        got = {r.doc_id: r.ids for r in read_ids(spark, str(tmp_path / f"ids{i}")).collect()}
        coded = Tokenizer.from_str(model).encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert [got[k] for k in range(len(texts))] == [[*e.ids, 0] for e in coded]


def test_coders_are_equal(spark):
    """Blocks in columns get the bytes of the plain version and are read back."""
    from respan.llm.rangecoder import encode_blocks
    from respan.llm.tokenids import coded, decoded

    rng = np.random.default_rng(3)
    blocks = [np.zeros(0, int), np.array([65535]), rng.integers(0, 65536, 4096), np.zeros(4096, int), np.tile(rng.integers(0, 50000, 37), 100), *(rng.zipf(1.2, n) % 50257 for n in (2, 100, 4095, 4096))]
    rows = spark.createDataFrame([(i, bytearray(b.astype("<u2").tobytes()), len(b)) for i, b in enumerate(blocks)], "i int, ids binary, n long")
    rows = rows.withColumn("coded", coded(spark, F.col("ids"))).withColumn("read", decoded(spark, F.col("coded"), F.col("n"))).orderBy("i").collect()
    assert [bytes(r.coded) for r in rows] == encode_blocks(blocks)
    assert all(r.read == r.ids for r in rows)
