"""Ranked lexical search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from brute import SF
from respan.llm import lexsearch, queries
from respan.llm.lexsearch import build_index, search
from respan.llm.rmq import Shard

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top=10):
    bags = [(k, Counter(words(t))) for k, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for k, t in items:
        asked.setdefault(k, set()).update(words(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for (k, b), size in zip(bags, sizes):
            if size:
                m = 10 + 90 * size * n // total
                s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in wanted if b[t])
                if s > 0:
                    scores.append((-s, k is None, k or 0, k))
        out += [(item, r, k, -s) for r, (s, _, _, k) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=str)


def rows(found):
    return sorted(map(tuple, found.select("item", "rank", "doc", "score").collect()), key=str)


@pytest.mark.parametrize("seed", range(20))
def test_shard_finds_what_a_scan_finds(seed):
    rng = np.random.default_rng(seed)
    n_docs, n_lists = int(rng.integers(1, 400)), int(rng.integers(1, 12))
    lists = [np.flatnonzero(rng.random(n_docs) < rng.random()) for _ in range(n_lists)]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    doc = np.concatenate(lists)
    impact = rng.integers(1, rng.choice([3, 10**9]), len(doc))  # many ties, or hardly any
    shard = Shard(first, doc, impact, n_docs)
    for k in (1, 5, 10):
        asked = np.flatnonzero(rng.random(n_lists) < 0.6)
        score = np.zeros(n_docs, np.int64)
        for t in asked:
            score[lists[t]] += impact[first[t] : first[t + 1]]
        want = sorted(((-s, d) for d, s in enumerate(score.tolist()) if s > 0))[:k]
        assert shard.search(asked, k) == [(-s, d) for s, d in want]


@pytest.mark.parametrize("small", [0, 200_000])
def test_odd_texts(spark, table, monkeypatch, small):
    monkeypatch.setattr(lexsearch, "SMALL_TERMS", small)  # joined by shuffles, broadcast
    docs = [(1, None), (2, ""), (3, "!? .."), (4, "Émile ÉMILE émile x1"), (5, "a b c a"), (6, "a b c a"), (6, "a b c a"), (None, "a b c a"), (7, "b " * 40_000 + "zz"), (8, "zz"), (9, "A-B_c@d"), (-3, "c")]
    items = [(1, "a b"), (2, None), (3, "nothing here"), (4, "Émile"), (5, "ZZ zz, b"), (5, "c"), (None, "x1 d"), (7, "")]
    bank = spark.createDataFrame(items, "item_id long, text string").withColumns({"doc_id": F.lit(1), "score": F.lit("x"), "term": F.lit("y")})
    for size in (3, 100):  # several shards in a task, one
        index = build_index(table(docs).withColumn("term", F.lit("t")), shard_documents=size)
        for block in (2, 512):
            assert rows(search(index, bank, T.LongType(), top=4, block_items=block)) == ranked(docs, items, 4)
    assert search(index, bank.limit(0), T.LongType()).isEmpty()
    assert search(build_index(table(docs).limit(0)), bank, T.LongType()).isEmpty()
    named = build_index(table(docs).where("doc_id is not null").withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))
    assert {r.doc for r in search(named, bank, T.StringType()).where("item = 4").collect()} == {"d4"}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op11_ranked_search(spark, SF)
    assert got.schema["rank"].dataType == T.IntegerType()
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == ranked(docs, items)


def test_many_copies(spark):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(30)]
    docs = [(i, "the same text over and over") for i in range(600)] + [(600 + i, " ".join(random.choices(vocabulary, k=30))) for i in range(300)]
    items = [(1, "same text w3 w4"), (2, "w1 w2 w3 w4 w5 w6 w7"), (3, "over")]
    index = build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shard_documents=128)
    assert rows(search(index, spark.createDataFrame(items, "item_id long, text string"), T.LongType())) == ranked(docs, items)
