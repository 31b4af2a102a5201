import math
from collections import Counter, defaultdict
from random import Random

import pytest

from corpuscle.llm import distinctive, pairs

CHUNK = "chunk_id bigint, doc_id bigint, acronyms array<struct<short:string,long:string>>, entities array<struct<surface:string,label:string,id:string,qid:string,rdf_safe:string>>, term string, n bigint"


def entity(surface):
    return None if surface is None else (surface if surface != "-" else None, "ORG", None, None, None)


def chunks(spark, rows):
    made = [(c, d, [(a, None) if a else None for a in short] if short is not None else None, [entity(e) for e in names] if names is not None else None, "x", 1) for c, d, short, names in rows]
    return spark.createDataFrame(made, CHUNK)


def plain(text):
    return " ".join(text.split()).lower()


@pytest.mark.parametrize("block", [2, 3, 64])
def test_pairs_against_brute_force(spark, block):
    random = Random(4)
    rows = [(i, i % 3, None, [random.choice(["A", "b ", " B", "c\u00a0d", "C D", "e", "F", "g", "-", None]) for _ in range(random.randrange(9))]) for i in range(40)]
    rows += [(100, 1, None, None), (101, 1, [], []), rows[0], (None, 1, None, ["A", "b"])]
    got = {(r.term_a, r.term_b): (r.n_ab, r.n_a, r.n_b, r.n, round(r.ratio, 9)) for r in pairs.associations(chunks(spark, rows), block).collect()}
    sets = {c: {plain(e) for e in names or [] if e not in (None, "-") and plain(e)} for c, _, _, names in rows if c is not None}
    single, both = Counter(t for s in sets.values() for t in s), Counter((a, b) for s in sets.values() for a in s for b in s if a < b)
    n = len(sets)
    assert got == {(a, b): (k, single[a], single[b], n, round(k * n / (single[a] * single[b]), 9)) for (a, b), k in both.items()}


def test_pairs_of_a_huge_basket(spark):
    rows = [(1, 1, None, [f"t{i:03}" for i in range(150)])]
    assert pairs.associations(chunks(spark, rows), 16).count() == 150 * 149 // 2
    assert pairs.associations(chunks(spark, []), 16).count() == 0
    assert pairs.associated(chunks(spark, []), 1).count() == 0


def test_ties_at_the_threshold(spark):
    rows = [(i, 1, None, ["a", "b"]) for i in range(6)] + [(10 + i, 1, None, ["z"]) for i in range(42)]
    assert [tuple(r) for r in pairs.associated(chunks(spark, rows)).collect()] == [("a", "b")]
    assert pairs.associated(chunks(spark, rows[:-1])).count() == 0


def parsimonious(tf, background, share=distinctive.OWN_SHARE, rounds=3_000):
    total = sum(tf.values())
    p = {t: n / total for t, n in tf.items()}
    for _ in range(rounds):
        e = {t: tf[t] * share * p[t] / (share * p[t] + (1 - share) * background[t]) for t in tf}
        p = {t: v / sum(e.values()) for t, v in e.items()}
    return p


def test_scores_against_plain_expectation_maximisation(spark):
    random = Random(6)
    rows = [(i, random.choice([1, 2, 3, None]), [random.choice(["AB", "cd", "", None]) for _ in range(3)], [random.choice(["x", "Y", "z", "-", None, " "]) for _ in range(4)]) for i in range(60)]
    got = {(r.doc_id, r.kind, r.term): (r.n_doc, r.n_all, r.score) for r in distinctive.scores(chunks(spark, [*rows, rows[3]]), settled=1e-12).collect()}
    counts = defaultdict(Counter)
    for _, d, short, names in rows:
        for kind, values in (("acronym", short), ("entity", names)):
            for t in {plain(v) for v in values if v not in (None, "-") and plain(v)}:
                counts[d, kind][t] += 1
    overall = {k: sum((c for (_, kind), c in counts.items() if kind == k), Counter()) for k in ("acronym", "entity")}
    seen = 0
    for (d, kind), tf in counts.items():
        if d is not None:
            background = {t: n / sum(overall[kind].values()) for t, n in overall[kind].items()}
            for t, score in parsimonious(tf, background).items():
                n_doc, n_all, s = got[d, kind, t]
                assert (n_doc, n_all) == (tf[t], overall[kind][t]) and math.isclose(s, score, rel_tol=1e-6, abs_tol=1e-8)
                seen += 1
    assert seen == len(got)


def test_characteristic(spark):
    rows = [(i, 1, ["AB"], ["own", "common"]) for i in range(4)] + [(10 + i, 2, ["AB"] if i == 0 else [], ["common"]) for i in range(4)] + [(20, 3, None, ["own"])]
    assert sorted(map(tuple, distinctive.characteristic(chunks(spark, rows)).collect())) == [(1, "acronym", "ab"), (1, "entity", "own")]
    assert distinctive.scores(chunks(spark, [])).count() == 0


def test_a_term_and_a_class_of_most_rows(spark, monkeypatch):
    """A term of every record, and a record of a third of all terms, are spread; results are those without it."""
    from corpuscle.llm import common

    frame = chunks(spark, [(k, k, None, ["common", f"own {k}"]) for k in range(60)] + [(100 + k, 999, None, [f"rare {k}"]) for k in range(60)])
    found = {}
    for hot in (1, 3, 1_000):
        monkeypatch.setattr(common, "HOT", hot)
        found[hot] = sorted((r.doc_id, r.term, r.n_doc, r.n_all, round(r.score, 9)) for r in distinctive.scores(frame).collect())
    assert found[1] == found[3] == found[1_000] and len(found[1]) == 180


def test_records_settle_by_themselves():
    """A record's probabilities don't depend on what it is batched with, and are a fixed point."""
    import numpy as np

    random = np.random.default_rng(1)
    one = (np.ones(6), random.integers(1, 9, 6).astype(float), random.random(6) / 9)
    two = (np.ones(40), random.integers(1, 99, 40).astype(float), random.random(40) / 99)
    both = distinctive.fit(*(np.concatenate(x) for x in zip(one, two, strict=True)), np.array([0, 6]))
    assert (both[:6] == distinctive.fit(*one, np.array([0]))).all() and (both[6:] == distinctive.fit(*two, np.array([0]))).all()
    e = two[1] * 0.1 * both[6:] / (0.1 * both[6:] + 0.9 * two[2])
    assert np.allclose(e / e.sum(), both[6:], rtol=0, atol=2e-6)
