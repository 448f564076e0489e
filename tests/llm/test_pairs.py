"""Operators that compare texts, and the pipeline, against plain versions."""

import collections
import random

import pytest

from pyspark.sql import functions as F

from brute import LOWER, SF, contamination, linked, near, quality, removed_lines, sha, shingles, white_words, without_repeats
from respan.llm import queries


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def copies():
    """A family of near copies, exact copies, texts around a common passage, and odd rows."""
    rng = random.Random(1)
    base, passage, docs = [f"w{i}" for i in range(60)], " ".join(f"p{i}" for i in range(40)), []
    for i in range(120):
        words = base[:]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"z{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    for i in range(120, 200):
        docs.append((i, " ".join(f"u{rng.randrange(10**7)}" for _ in range(rng.randint(3, 30))) + " " + passage))
    return docs + [(500, None), (501, ""), (502, " \n"), (503, "a b"), (504, "A  b"), (505, "a b c"), (506, docs[10][1]), (507, docs[10][1])]


def test_near_copies(spark, table, copies):
    from respan.llm.jaccard import jaccard_components

    want = linked(copies)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(table(copies)).collect()}
    assert got == want
    rows = jaccard_components(table([(None, "a b c d e f"), (3, "a b c d e f"), (3, "x y z"), (9, "x y z")])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in rows) == [(0, 2, 0), (3, 1, 3), (3, 2, 3), (9, 1, 3)]
    assert jaccard_components(table(copies).limit(0)).isEmpty()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op9_jaccard_join(spark, SF).collect()}
    assert got == linked(documents(spark))


def test_near_copies_when_all_lists_are_long(spark, table, copies, monkeypatch):
    """Dealt lists and all rounds of the search, on lists of any length."""
    from respan.llm import jaccard

    monkeypatch.setattr(jaccard, "HOT", 10)
    monkeypatch.setattr(jaccard, "SHORT", 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(table(copies)).collect()}
    assert got == linked(copies)


def test_every_link_is_counted(spark, table, copies, monkeypatch):
    """All links between different texts, also inside a component that a few of them connect."""
    from respan.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK", 20)
    sets = {i: shingles(white_words((t or "").translate(LOWER))) for i, t in copies}
    first = {s: min(i for i in sets if sets[i] == s) for s in sets.values() if s}
    ids = sorted(first.values())
    want = {(a, b) for a in ids for b in ids if a < b and near(sets[a], sets[b])}
    got = [tuple(r) for r in jaccard.jaccard_links(table(copies)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    number = collections.Counter(x for pair in want for x in pair)
    assert len(want) > 1.5 * len(number)  # a tree of each component has fewer
    rows = jaccard.jaccard_components(table(copies), count_links=True).collect()
    assert {r.doc_id: r.n_links for r in rows} == {i: number[first[s]] if s else 0 for i, s in sets.items()}


def test_bits_never_rule_out_a_link():
    import numpy as np
    from respan.llm.jaccard import _bits, _may_link, reaches

    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        kept = a[rng.random(len(a)) < rng.uniform(0.6, 1)]
        b = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        link = len(b) > 0 and 100 * shared >= 75 * (len(a) + len(b) - shared)
        assert reaches(a, b, 75) == link
        assert not link or _may_link(len(a), _bits(a), len(b), _bits(b), 75)


def test_components(spark):
    from respan.llm.graph import components

    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7), (300, 299)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 150: 100, 300: 299, 299: 299}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_repeated_passages(spark, table):
    from respan.llm.substrings import remove_repeats

    rng = random.Random(2)
    words = [f"v{i}" for i in range(40)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(10, 40))) for _ in range(12)]
    docs = []
    for _ in range(200):
        parts = [rng.choice([" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))), rng.choice(passages)]) for _ in range(rng.randint(0, 8))]
        docs.append((rng.randrange(150), " ".join(parts)))
    docs += [(None, passages[3] * 2), (7, None), (8, ""), (9, "a " * 40), (10, "a " * 13), (11, "a " * 12), (7, docs[0][1]), (7, docs[0][1])]
    got = sorted((tuple(r) for r in remove_repeats(table(docs)).collect()), key=str)
    assert got == sorted(without_repeats(docs), key=str)
    assert remove_repeats(table(docs).limit(0)).isEmpty()
    got = sorted(tuple(r) for r in queries.op8_substring_dedup(spark, SF).collect())
    want = sorted(without_repeats(documents(spark)))
    assert got == [(i, n, gone, sha(t)) for i, n, gone, t in want] and any(w[2] for w in want)


def test_similar_lines(spark, table):
    from respan.llm.linededup import remove_lines

    rng = random.Random(3)
    bases = [[f"b{k}w{i}" for i in range(rng.randint(3, 60))] for k in range(8)]
    docs = []
    for i in range(80):
        lines = []
        for _ in range(rng.randint(0, 6)):
            x = rng.choice(bases)[:]
            for _ in range(rng.randint(0, 2)):
                x[rng.randrange(len(x))] = f"z{rng.randrange(50)}"
            lines.append(rng.choice([" ", "  ", "\t"]).join(x))
        docs.append((i, "\n".join(lines + rng.choice([[], [""], ["  "]]))))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in remove_lines(table(docs)).collect()}
    assert got == removed_lines(docs)
    odd = table([(1, None), (None, "a b c"), (2, "a b c"), (3, "a b c\nx"), (3, "a b c\nx"), (4, "x")])
    rows = sorted(((r.doc_id or 0, r.text, r.n_lines, r.n_removed) for r in remove_lines(odd).collect()), key=str)
    assert rows == sorted([(1, None, 0, 0), (0, "a b c", 1, 0), (2, "a b c", 1, 0), (3, "x", 2, 1), (3, "x", 2, 1), (4, "", 1, 1)], key=str)
    assert remove_lines(odd.limit(0)).isEmpty()
    assert remove_lines(odd.withColumns({c: F.lit("x") for c in ("n_lines", "n_removed", "rows", "m", "i", "e", "tokens")})).where("n_removed > 0").count() == 3
    # one key, many texts: no text loses a line for another's sake
    many = [(1, "keep42256 x y")] + [(2, f"keep{k} x y\nother{k} z w\nkeep42256 x y") for k in range(3000)]
    rows = remove_lines(table(many)).collect()
    assert len(rows) == len(many) and all(r.n_removed == (r.doc_id == 2) and ("keep42256 x y" in r.text) == (r.doc_id == 1) for r in rows)
    assert {r.text for r in rows} == {t.removesuffix("\nkeep42256 x y") for _, t in many}
    # very long texts: many lines, and a line of many words
    block = [f"line {k} of many that are not alike {k * 7919}" for k in range(20_000)]
    long = [(1, "\n".join(block)), (2, "\n".join(["only here", *block])), (3, " ".join(f"w{k}" for k in range(60_000))), (4, "\n".join([" ".join(f"w{k}" for k in range(59_000)), "only there"]))]
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in remove_lines(table(long)).collect()} == {1: (20_000, 0, long[0][1]), 2: (20_001, 20_000, "only here"), 3: (1, 0, long[2][1]), 4: (2, 1, "only there")}
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in queries.op6_line_dedup(spark, SF).collect()}
    assert got == {i: (n, gone, sha(t)) for i, (n, gone, t) in removed_lines(documents(spark)).items()}


def test_pipeline(spark):
    """Every stage's decisions, from plain versions of the operators."""
    import corpus_pipeline
    import public_tokenizers
    import sentencepiece

    assert [n for n, _ in corpus_pipeline.STAGES][1] == "line dedup" and len(corpus_pipeline.STAGES) == 5
    kept = {r.doc_id for r in queries.op3_quality_rules(spark, SF).where("kept").collect()}
    docs = [(i, t) for i, t in documents(spark) if i in kept]
    assert all(quality(t)[0] >= 50 for _, t in docs)
    docs = [(i, x[2]) for i, x in removed_lines(docs).items()]
    group = linked(docs)
    docs = [(i, t) for i, t in docs if group[i][1] == i]
    bank = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [d for d, c in zip(docs, contamination(docs, bank)) if c[2] == 0]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: (r.ids, r.decoded) for r in corpus_pipeline.run(spark, SF).collect()}
    want = {i: library.encode(t, add_bos=True, add_eos=True) for i, t in docs}
    assert got == {i: (ids, library.decode(ids)) for i, ids in want.items()}
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, raw.limit(0), SF).columns == raw.columns


def test_stages_on_odd_rows(spark):
    """Nulls, empty and repeated texts, and columns named like the operators' own, stage by stage."""
    import corpus_pipeline

    good = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"thing{i}" for i in range(80))
    rows = [(1, None), (2, ""), (None, good), (3, good), (3, good), (4, other + "\n" + good), (5, "too short"), (6, good + " more")]
    clashing = {c: F.lit(f"own {c}") for c in ("n_words", "kept", "items", "n_hit", "hits", "ids", "decoded", "begins", "n_lines", "n_removed", "component_id", "n_shingles", "rows", "m", "d", "gone")}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns(clashing)
    bank = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = docs.union(docs.where("doc_id = 5").withColumn("doc_id", F.lit(7)).withColumn("text", F.lit(other.replace("thing", "x") + " " + bank[0])))
    stages = dict(corpus_pipeline.STAGES)

    def after(name, given):
        out = stages[name](spark, given, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert all(r[c] == f"own {c}" for r in out.collect() for c in clashing)
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str) if "text" in out.columns else out.collect()

    held = bank[0]
    assert after("quality rules", docs) == sorted([x for x in rows if x[1] and len(x[1].split()) >= 50] + [(7, other.replace("thing", "x") + " " + held)], key=str)
    left = dict(rows) | {7: other.replace("thing", "x") + " " + held}
    lines = after("line dedup", docs)
    assert (None, good) in lines and (1, None) in lines and (2, "") in lines and lines.count((3, good)) == 2
    assert (4, other) in lines and (6, "") in lines and len(lines) == len(rows) + 1
    near = after("n-gram Jaccard join", docs)
    assert near == sorted([x for x in rows if x[0] != 6] + [(7, left[7])], key=str)
    assert after("benchmark decontamination", docs) == sorted(rows, key=str)
    ids = after("SentencePiece encoding and decoding", docs)
    assert len(ids) == len(rows) + 1 and all(len(r.ids) == 2 and r.decoded == "" for r in ids if r.doc_id in (1, 2))
    assert {r.decoded for r in ids if r.doc_id == 3} == {good}


def test_jaccard_classes_enter_lists_once(spark, table, monkeypatch):
    """Copies of a text in other tasks add nothing to the lists."""
    from respan.llm import jaccard

    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(30)]
    entered, enter = [], jaccard._enter_lists

    def noted(*args):
        entered.append(enter(*args))
        return entered[-1]

    monkeypatch.setattr(jaccard, "_enter_lists", noted)
    rows = jaccard.jaccard_components(table([(30 * c + i, t) for c in range(20) for i, t in enumerate(texts)])).collect()
    assert {(r.doc_id, r.class_id, r.component_id) for r in rows} == {(d, d % 30, d % 30) for d in range(600)}
    assert entered[0].select("doc").distinct().count() < 40


def test_jaccard_lists_are_read_alike_in_any_batches(spark):
    """Short, long and dealt lists that lie inside a batch, and such as go over many."""
    from respan.llm.jaccard import SHORT, _merge_lists

    rng = random.Random(4)
    rows, want = [], set()
    for key in range(-100, 100):
        hash_, docs = key + 1000 * (key % 3 == 0), sorted({rng.randrange(50) for _ in range(rng.choice([1, 1, 2, 3, SHORT, SHORT + 1, 20]))})
        rows += [(key, hash_, d, 100 * key + d) for d in docs]
        if len(docs) <= SHORT:
            want |= {(0, a, b, None) for a in docs for b in docs if a < b}
        else:
            want |= {(0, docs[0], b, None) for b in docs[1:]}
        if key != hash_:
            want.add((1, hash_, docs[0], 100 * key + docs[0]))
        if key != hash_ or len(docs) > SHORT:
            want |= {(2, hash_, d, 100 * key + d) for d in docs}
    lists = spark.createDataFrame(rows + rows[::5], "key long, hash long, doc long, place long")
    try:
        for size in ("1", "7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert {tuple(r) for r in _merge_lists(lists).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
