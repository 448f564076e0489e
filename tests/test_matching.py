import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from respan.operators import matching, nearstem
from test_text import brute_edit, brute_jaro, words

CASES = "audit_row int, source_name string, question_id string, domainId string, stem string"


def brute_pool(cases, bank, k):
    out = set()
    for row, _, _, domain, stem in cases:
        pool = [b for b in bank if not domain or (b[1] or "").lower() == domain.lower()]
        if stem:
            scored = [
                (-brute_jaro(b[2].lower(), stem.lower()), brute_edit(stem.lower(), b[2].lower()), b[0]) for b in pool
            ]
            best = [(s[2], -s[0], s[1]) for s in sorted(scored)[:k]]
        else:
            best = [(q, None, None) for q in sorted(b[0] for b in pool)[:k]]
        out |= {(row, i + 1, *b) for i, b in enumerate(best)} or {(row, None, None, None, None)}
    return out


@pytest.mark.parametrize("broadcast_chars", [0, 1_000_000])
def test_candidates_equal_brute_force(spark, monkeypatch, broadcast_chars):
    """Several bank and probe blocks, with and without broadcast; a third of the cases are copies."""
    monkeypatch.setattr(nearstem, "BANK_BLOCK", 7)
    monkeypatch.setattr(nearstem, "PROBE_BLOCK", 9)
    monkeypatch.setattr(nearstem, "BROADCAST_CHARS", broadcast_chars)
    monkeypatch.setattr(nearstem, "FIRST_LOOK", 1)
    rng = random.Random(4)
    domains = ["ideas", "Inference", "purpose"]
    bank = [(f"Q{i:03d}", rng.choice(domains), words(rng, 25)) for i in range(40)]
    bank += [(f"Q{i:03d}", "ideas", "same stem") for i in range(40, 52)]
    cases = []
    for i in range(90):
        stem = "Same Stem" if i % 3 == 0 else rng.choice([None, "", words(rng, 30).upper()])
        cases.append((i, "s", str(i), rng.choice([None, "", "IDEAS", "inference", "unknown"]), stem))
    pool = matching.candidate_pool(
        spark.createDataFrame(cases, CASES), spark.createDataFrame(bank, "QID string, domain string, stem string"), 3
    )
    got = {
        (r["audit_row"], r["candidate_rank"], r["candidate_QID"], r["similarity_jw"], r["distance_lv"])
        for r in pool.collect()
    }
    assert got == brute_pool(cases, bank, 3)


def test_empty_pool_prints_na(spark):
    cases = spark.createDataFrame([(1, "s", "q", "nowhere", "text")], CASES)
    bank = spark.createDataFrame([("Q001s1", "ideas", "abc")], "QID string, domain string, stem string")
    pool = matching.candidate_pool(cases, bank)
    assert matching.prompt_table(pool).collect()[0]["candidates_text"] == "NA. NA [NA]: NA"


def test_null_keys_match_null(spark):
    cases = spark.createDataFrame([(None, "q1", "Q9", "fuzzy"), ("s", "q2", None, None)], "source_name string, question_id string, QID string, match_method string")
    patches = spark.createDataFrame(
        [(None, "q1", "Q001s1", "llm_human_review", "accept")],
        "source_name string, question_id string, approved_QID string, approval_source string, human_final_decision string",
    )
    got = {r["question_id"]: (r["final_QID"], r["final_match_method"]) for r in matching.final_id(matching.attach_patches(cases, patches)).collect()}
    assert got == {"q1": ("Q001s1", "llm_human_review"), "q2": (None, None)}


def test_staged_identity(spark):
    bank = spark.createDataFrame([("Q001s1", "ideas", "What is the main idea?"), ("Q002s1", "ideas", "Who tells the story?")], "QID string, domain string, stem string")
    t = spark.createDataFrame(
        [("a", "1", None, "  what is   the MAIN idea? "), ("a", "2", "ideas", "who told the story?"), ("a", "3", None, "zzzz"), ("a", "4", None, None), ("a", "5", "purpose", "who told the story?")],
        "source_name string, question_id string, domainId string, stem string",
    )
    repairs = spark.createDataFrame([("a", "3", "Q777p1"), ("a", "1", "Q888p1")], "source_name string, question_id string, QID string")
    got = {r["question_id"]: (r["QID"], r["match_method"]) for r in matching.match_items(t, bank, repairs, 0.25).collect()}
    assert got == {"1": ("Q001s1", "exact"), "2": ("Q002s1", "fuzzy"), "3": ("Q777p1", "manual_repair"), "4": (None, None), "5": (None, None)}


def test_audit_cases_keep_the_first_source(spark):
    ddl = "source_name string, question_id string, stem string"
    unmatched = spark.createDataFrame([("a", "1", "x")], ddl)
    fuzzy = spark.createDataFrame([("a", "1", "x", 0.5), ("a", "2", "y", 0.08), ("a", "3", "z", 0.07), ("a", "4", "z", None)], ddl + ", string_distance double")
    manual = spark.createDataFrame([("a", "2", "y", "manual_repair"), ("a", "5", "w", "manual_repair"), ("a", "6", "w", "exact")], ddl + ", match_method string")
    got = {r["question_id"]: r["audit_reason"] for r in matching.audit_cases(unmatched, fuzzy, manual).collect()}
    assert got == {"1": "unmatched_after_exact_fuzzy", "2": "high_distance_fuzzy_match", "5": "manual_repair_secondary_check"}
    shell = matching.add_review_shell(unmatched).collect()[0]
    assert shell["audit_status"] == "pending" and shell["human_final_qid"] is None


@pytest.mark.parametrize("least, rows", [(0.8, 1_000), (0.65, 9), (0.95, 5)])
def test_similar_stems_equal_brute_force(spark, monkeypatch, least, rows):
    """All pairs that reach the similarity, whatever the blocks; the bound never rules one out."""
    monkeypatch.setattr(nearstem, "BANK_BLOCK", rows)
    rng = random.Random(11)
    stems = [words(rng, rng.choice([1, 4, 25, 60])) for _ in range(60)] + ["", None, "ß ß", "aaaa", "aaab"]
    bank = [(f"Q{i:03d}", rng.choice(["ideas", "Purpose", None]), s) for i, s in enumerate(stems)] + [("Q900", "ideas", "aaaa"), ("Q900", "ideas", "aaaa")]
    near = [s[: rng.randint(1, len(s))] + rng.choice(["", "x", s[:1]]) for s in stems[:40]]
    probes = [(rng.choice([None, "ideas", "purpose", "nowhere"]), s.lower()) for s in near] + [(None, "aaaa"), ("ideas", "aaaa"), (None, None), ("ideas", "")]
    given = spark.createDataFrame(probes, "domain_key string, stem_key string"), spark.createDataFrame(bank, "QID string, domain string, stem string")
    got = {(r.domain_key, r.stem_key, r.candidate_QID): r.similarity_jw for r in nearstem.similar_stems(*given, least).collect()}
    want, possible = {}, {}
    for d, p in set(probes):
        if not p:
            continue
        pool = {b for b in bank if d is None or (b[1] or "").lower() == d}
        for q, _, s in pool:
            sim = brute_jaro((s or "").lower(), p) if s else 0.0
            if sim >= least:
                want[d, p, q] = sim
        common = lambda s: sum((Counter(ord(c) % 32 for c in s.lower()) & Counter(ord(c) % 32 for c in p)).values())
        bounds = [(common(s) / len(p) + common(s) / len(s) + 1) / 3 if s and common(s) else 0.0 for _, _, s in pool]
        possible[d, p] = (len(pool), sum(b >= least - 1e-9 for b in bounds))
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    counts = {(r.domain_key, r.stem_key): (r.n_domain, r.n_possible) for r in nearstem.stem_bounds(*given, least).collect()}
    assert counts == possible
    assert nearstem.similar_stems(given[0], given[1].limit(0), least).isEmpty()
    assert nearstem.similar_stems(given[0].limit(0), given[1], least).isEmpty()
