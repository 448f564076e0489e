"""Answer patterns against comparing all pairs of respondents."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from respan.operators import patterns

DDL = "global_id string, QID string, response int"


def answers(rng, n_people, items, low):
    """Families of similar answer sheets, with changes, gaps and repeats."""
    people = {}
    for i in range(n_people):
        if people and rng.random() < 0.7:
            sheet = dict(people[rng.choice(list(people))])
            for _ in range(rng.randint(0, 3)):
                q = rng.choice(items)
                sheet[q] = rng.randint(0, 1)
                if rng.random() < 0.4:
                    sheet.pop(q)
        else:
            sheet = {q: rng.randint(0, 1) for q in rng.sample(items, rng.randint(low, len(items)))}
        people[f"p{i:03d}"] = sheet
    return people


def table(spark, people, rng):
    rows = [(p, q, y) for p, sheet in people.items() for q, y in sheet.items()]
    rows += rng.sample(rows, len(rows) // 5) + [("p000", None, 1), (None, "q1", 1), ("p001", "q9", None)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DDL).repartition(5)


@pytest.mark.parametrize("max_diff, min_joint, length", [(2, 12, 1024), (2, 12, 3), (0, 6, 1024), (3, 11, 2)])
def test_similar_patterns_equal_all_pairs(spark, monkeypatch, max_diff, min_joint, length):
    monkeypatch.setattr(patterns, "LIST", length)
    rng = random.Random(max_diff * 100 + min_joint)
    items = [f"q{i}" for i in range(70)]  # more than one word
    people = answers(rng, 90, items, 3)
    people = {p: s for p, s in people.items() if s}
    members, links = patterns.likely_duplicates(table(spark, people, rng), items, max_diff, min_joint)
    first = {}
    for p in sorted(people):
        first.setdefault(frozenset(people[p].items()), p)
    classes = {p: first[frozenset(s.items())] for p, s in people.items()}
    want = {}
    for a, b in combinations(sorted(first.values()), 2):
        x, y = people[a], people[b]
        joint = x.keys() & y.keys()
        diff = len(x.keys() ^ y.keys()) + sum(x[q] != y[q] for q in joint)
        if len(joint) >= min_joint and diff <= max_diff:
            want[a, b] = (len(joint), diff)
    assert {(r.a, r.b): (r.n_joint, r.n_diff) for r in links.collect()} == want and (want or max_diff == 0)
    got = {r.global_id: (r.class_id, r.n_members, r.n_links) for r in members.collect()}
    assert got == {p: (c, list(classes.values()).count(c), sum(c in pair for pair in want)) for p, c in classes.items()}


def test_two_shared_bands_do_not_meet(spark):
    """Where patterns have bands enough, three must be shared, so that the lists of a large table stay short."""
    rows = [("a", [1, 2, 3, 4, 5, 6]), ("b", [1, 2, 13, 14, 15, 16]), ("c", [1, 2, 3, 4, 25, 26]), ("d", [1, 2, 7, 8]), ("e", [1, 2, 9, 10])]
    keys = {}
    for r in patterns.meeting_keys(spark.createDataFrame(rows, "class_id string, tokens array<bigint>"), 2).collect():
        keys.setdefault(r.key, set()).add(r.class_id)
    met = {pair for ids in keys.values() for pair in combinations(sorted(ids), 2)}
    assert met == {("a", "c"), ("d", "e")}  # those of four bands may differ in two of them


def test_no_answers(spark):
    members, links = patterns.likely_duplicates(spark.createDataFrame([], DDL), ["q1", "q2"])
    assert members.isEmpty() and links.isEmpty()


@pytest.mark.parametrize("chance", [False, True])
def test_equal_patterns(spark, monkeypatch, chance):
    """Also where all fingerprints meet by chance."""
    if chance:
        monkeypatch.setattr(patterns, "fingerprints", lambda cells, key="global_id": cells.groupBy(key).agg(F.count("*").alias("n_items"), F.lit(1).cast("long").alias("f1"), F.lit(2).cast("long").alias("f2")))
    rng = random.Random(5)
    people = answers(rng, 60, [f"q{i}" for i in range(4)], 1)
    people = {p: s for p, s in people.items() if s}
    groups = {}
    for p, s in people.items():
        groups.setdefault(frozenset(s.items()), []).append(p)
    want = {(min(g), len(g), len(k)) for k, g in groups.items() if len(g) > 1}
    got = patterns.equal_pattern_groups(table(spark, people, rng)).collect()
    assert {(r.first_id, r.n_respondents, r.n_items) for r in got} == want and len({r.pattern for r in got}) == len(got) == len(want)
