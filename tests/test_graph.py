import tracemalloc
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pyarrow as pa
import pytest

from corpuscle.operators import cocommunities, cograph, metadata, triples
from corpuscle.operators.linker import closure, fuzzy
from corpuscle.plans import catalog

RECORD = "id string, display_title string, last_modified_date string, docty string, count string, trustfund string, trustfund_key string, projn string, projectid string, owner string, pdfurl string, year string"


def record(spark, *rows):
    names = [c.split()[0] for c in RECORD.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RECORD)


def test_latest_version(spark):
    rows = record(spark, {"id": "1", "last_modified_date": "2020-01-01", "owner": "a"}, {"id": "1", "last_modified_date": "02/01/2020", "owner": "b"}, {"id": "1", "last_modified_date": "?", "owner": "z"}, {"id": None}, {"id": "2"}, {"id": "2"})
    got = {r.id: r.owner for r in metadata.latest_versions(rows).collect()}
    assert got == {"1": "b", "2": None}


def test_document_triples(spark):
    rows = metadata.sanitized(metadata.latest_versions(record(spark, {"id": "123", "display_title": "A b", "pdfurl": "http://x/1.pdf", "docty": "Note"}, {"id": "9"})))
    got = {(r.s.rsplit("/", 2)[-2:][1], r.p.rsplit("/")[-1].split("#")[-1], r.o) for r in triples.document_triples(rows).collect()}
    assert got == {("123", "type", triples.EX + "document"), ("123", "name", "A_b"), ("123", "identifier", "123"), ("123", "url", "http://x/1.pdf"), ("123", "genre", "Note")}


def test_zip_and_links(spark):
    rows = metadata.sanitized(record(spark, {"id": "1", "display_title": "t", "trustfund": "A, B", "trustfund_key": "TF10,TF20,TF30", "count": "Côte - X"}))
    assert {(r.id, r.name) for r in triples.zipped(rows, "trustfund_key", "trustfund").collect()} == {("TF10", "A"), ("TF20", "_B")}
    assert {r.o.rsplit("/")[-1] for r in triples.link_triples(rows, "trustfund_key").collect()} == {"TF10", "TF20", "TF30"}
    funds = triples.instance_triples(triples.zipped(rows, "trustfund_key", "trustfund"), "trustfund", "id", "name")
    assert {r.o for r in triples.fallback_triples(rows, "trustfund_key", funds).collect()} == {"TF30", triples.EX + "trustfund"}
    assert {(r.p.rsplit("/")[-1], r.o) for r in triples.country_triples(rows).where("lang = 'en'").collect()} == {("name", "Cote   X")}


def test_entities_and_identifiers(spark):
    rows = spark.createDataFrame([(1, "Global Bank", "ORG", None, "Global_Bank"), (1, "Global Bank", "ORG", None, "Global_Bank"), (1, "UN", "ORG", "Q1", "Q1"), (1, "", "ORG", None, "x"), (None, "A", "ORG", None, "A")], "doc_id bigint, surface string, label string, qid string, safe string")
    graph = triples.entity_triples(rows)
    assert {r.o for r in triples.with_predicate(graph, triples.MENTIONS).collect()} == {triples.EX + "entity/Global_Bank", triples.WD + "Q1"}
    assert graph.count() == 2 * 3 + 2


def test_empty_tables(spark):
    empty = record(spark)
    assert triples.document_triples(metadata.latest_versions(empty)).count() == 0
    assert cograph.edges(spark.createDataFrame([], "chunk_id bigint, entity string")).count() == 0
    assert cograph.components(spark.createDataFrame([], "u bigint, v bigint, weight bigint")).count() == 0


@pytest.mark.parametrize("block", [1, 2, 512])
def test_edges_against_brute_force(spark, block):
    random = Random(3)
    members = {(random.randrange(20), f"e{random.randrange(6)}") for _ in range(60)}
    got = {(r.u, r.v): r.weight for r in cograph.edges(spark.createDataFrame(sorted(members), "chunk_id bigint, entity string"), block=block).collect()}
    by = defaultdict(set)
    for c, e in members:
        by[c].add(e)
    want = {(a, b): len(by[a] & by[b]) for a in by for b in by if a < b and by[a] & by[b]}
    assert got == want


def test_pairs_of_chunks_are_not_shuffled(spark):
    """A hub makes the square of its members in pairs; those leave the task that counts them only as the result."""
    members = spark.range(3000).selectExpr("id as chunk_id", "explode(array('hub', concat('e', id % 700))) as entity")
    graph = cograph.edges(members)
    assert graph.selectExpr("count(*)", "sum(weight)").first()[:] == (3000 * 2999 // 2, 3000 * 2999 // 2 + 200 * 10 + 500 * 6)
    assert graph.where("weight = 2 and (v - u) % 700 <> 0 or u >= v").isEmpty()
    plan = graph._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[: plan.index("MapInArrow")]


@pytest.mark.parametrize("same", [False, True])
def test_pairs_of_two_blocks_over_many_batches(monkeypatch, same):
    """Each pair of nodes comes once, with all values it shares, though only narrower values are counted and batches are small."""
    monkeypatch.setattr(cograph, "ROWS_OUT", 7)
    random = Random(23)
    left = {(random.randrange(40) * (1 if same else 2), f"e{random.randrange(5) * random.randrange(5)}") for _ in range(90)}
    right = left if same else {(random.randrange(40) * 2 + 1, f"e{random.randrange(5) * random.randrange(5)}") for _ in range(90)}

    def packed(members, prefix=""):
        by = defaultdict(list)
        for n, e in members:
            by[e].append(n)
        columns = {"names": [*by], "sizes": [len(x) for x in by.values()], "nodes": [n for x in by.values() for n in x]}
        return {prefix + k: pa.array([v])[0] for k, v in columns.items()}

    batches = list(cograph._block_pairs(packed(left) | packed(right, "right_"), same))
    got = [(*sorted((r["u"], r["v"])), r["weight"]) for b in batches for r in b.to_pylist()]
    by, other = defaultdict(set), defaultdict(set)
    for members, of in ((left, by), (right, other)):
        for n, e in members:
            of[n].add(e)
    want = [(min(a, b), max(a, b), len(by[a] & other[b])) for a in by for b in other if by[a] & other[b] and (a < b or not same)]
    assert sorted(got) == sorted(want) and len(batches) > 2
    assert all(r["u"] < r["v"] for b in batches for r in b.to_pylist())


def brute_components(pairs):
    of = {}
    for u, v in pairs:
        of.setdefault(u, {u}), of.setdefault(v, {v})
        if of[u] is not of[v]:
            of[u] |= of[v]
            for n in of[v]:
                of[n] = of[u]
    return {n: min(group) for n, group in of.items()}


def test_components(spark):
    random = Random(5)
    pairs = sorted({(min(p), max(p)) for p in (random.sample(range(60), 2) for _ in range(40))}) + [(100 + i, 101 + i) for i in range(30)]
    got = {r.node: r.component for r in cograph.components(spark.createDataFrame([(*p, 1) for p in pairs], "u bigint, v bigint, weight bigint")).collect()}
    assert got == brute_components(pairs)
    members = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "b"), (4, "c"), (10, "d"), (9, "d")], "chunk_id bigint, entity string")
    assert {r.node: r.component for r in cograph.member_components(members).collect()} == {1: 1, 2: 1, 3: 1, 9: 9, 10: 9}


def cliques():
    return [(a + i, a + j, 2.0) for a in (0, 10, 20) for i in range(5) for j in range(i + 1, 5)] + [(4, 10, 1.0), (14, 20, 1.0)]


def test_partition_finds_cliques_and_is_repeatable():
    found = cograph.partition(cliques())
    assert {frozenset(n for n in found if found[n] == c) for c in set(found.values())} == {frozenset(range(a, a + 5)) for a in (0, 10, 20)}
    assert found == cograph.partition(list(reversed(cliques())))


@pytest.mark.parametrize("large", [1, 1000])
def test_communities_stay_within_components(spark, large):
    graph = spark.createDataFrame([(u, v, int(w)) for u, v, w in [*cliques(), (100, 101, 1.0)]], "u bigint, v bigint, weight bigint")
    found = {r.node: r.community for r in cograph.communities(graph, large=large).collect()}
    nodes = brute_components([(u, v) for u, v, _ in cliques()] + [(100, 101)])
    assert set(found) == set(nodes)
    for n, c in found.items():
        assert nodes[n] == nodes[c]


def test_communities_are_the_same_wherever_they_are_found(spark):
    random = Random(11)
    weights = {(a, b): random.randint(1, 3) for a in range(80) for b in range(a + 1, 80) if random.random() < (0.5 if a // 16 == b // 16 else 0.03)}
    pairs = [(u, v, w) for (u, v), w in weights.items()]
    graph = spark.createDataFrame(pairs, "u bigint, v bigint, weight bigint")
    one, spread = ({r.node: r.community for r in cograph.communities(graph, large=n).collect()} for n in (1_000_000, 1))
    assert one == spread == cograph.partition(pairs)
    assert {frozenset(n for n in one if one[n] == c) for c in set(one.values())} == {frozenset(range(a, a + 16)) for a in range(0, 80, 16)}


def test_chunks_have_components_and_communities(spark, data):
    edges = [(r.u, r.v) for r in catalog.chunk_graph_edges(spark, data).collect()]
    brute = brute_components(edges)
    assert {r.node: r.component for r in catalog.chunk_components(spark, data).collect()} == brute
    found = {r.node: r.community for r in catalog.communities(spark, data).collect()}
    assert set(found) == set(brute) and all(brute[n] == brute[c] for n, c in found.items())
    abstracts = {r.community for r in catalog.community_summaries(spark, data).collect()}
    assert abstracts and abstracts <= set(found.values())


def grouped_members(hub: bool = True):
    """Six groups with values of their own, some mixed, and a value that nearly all have."""
    random = Random(17)
    rows = {(n, f"g{n % 6}-{random.randrange(5)}") for n in range(150) for _ in range(2)}
    rows |= {(random.randrange(150), f"m{random.randrange(12)}") for _ in range(60)} | ({(n, "hub") for n in range(140)} if hub else set())
    return sorted(rows) + [(500, "alone")]


def pairs_of(rows):
    by, weights = defaultdict(list), Counter()
    for n, e in rows:
        by[e].append(n)
    for nodes in by.values():
        weights.update((a, b) for a in nodes for b in nodes if a < b)
    return [(u, v, w) for (u, v), w in weights.items()]


@pytest.mark.parametrize(("dense", "heavy", "spread"), [(8_192, 4_000, 20_000_000), (0, 3, 20_000_000), (0, 10_000, 1), (2, 3, 1)])
def test_communities_from_rows_are_those_of_the_pairs(spark, monkeypatch, dense, heavy, spread):
    for name, value in (("DENSE", dense), ("HEAVY", heavy), ("HEAVY_SHARE", 0), ("SPREAD", spread), ("TASKS", 3)):
        monkeypatch.setattr(cocommunities, name, value)
    rows = grouped_members()
    members = spark.createDataFrame(rows, "chunk_id bigint, entity string")
    got = {r.node: r.community for r in cocommunities.member_communities(members, most=None).collect()}
    assert got == cograph.partition(pairs_of(rows)) and len(set(got.values())) > 2


@pytest.mark.parametrize("dense", [8_192, 0])
def test_nodes_come_in_by_shares(spark, monkeypatch, dense):
    """However the graph is given, a few nodes are there first, and at the end none gains by a move of its own."""
    monkeypatch.setattr(cograph, "FIRST", 9)
    monkeypatch.setattr(cocommunities, "DENSE", dense)
    rows = grouped_members()
    pairs = pairs_of(rows)
    found = cograph.partition(pairs)
    members = spark.createDataFrame(rows, "chunk_id bigint, entity string")
    assert {r.node: r.community for r in cocommunities.member_communities(members, most=None).collect()} == found
    graph = spark.createDataFrame(pairs, "u bigint, v bigint, weight bigint")
    assert {r.node: r.community for r in cograph.communities(graph, large=1, most=None).collect()} == found
    total, k, between = 2 * sum(w for *_, w in pairs), Counter(), Counter()
    for a, b, w in pairs:
        k.update({a: w, b: w})
        between.update({(a, found[b]): w, (b, found[a]): w})
    volume = Counter()
    for n, c in found.items():
        volume[c] += k[n]
    alone = sum(-(k[n] ** 2) for n in found) / total**2
    assert sum(between[n, found[n]] / total - 1.25 * k[n] * volume[found[n]] / total**2 for n in found) > 1.25 * alone
    names = np.arange(1_000)
    shares = list(cograph.arrivals(names, 42, 0))
    assert shares[0][0].sum() < 30 and not any((a & b).any() for a, b in shares)
    assert all((a[0] | a[1]).sum() == b[0].sum() for a, b in zip(shares, shares[1:], strict=False)) and (shares[-1][0] | shares[-1][1]).all()


@pytest.mark.parametrize("level", [0, 1])
def test_nodes_that_may_gain_are_looked_at(level):
    """Looks that are left out change nothing, and a graph is looked at whole only once."""
    random = Random(29)
    rows = sorted({(n, n % 8 if random.random() < 0.7 else random.randrange(40)) for n in range(400) for _ in range(4)})
    node, value = np.array(rows).T
    x = np.ones(len(rows)) if level == 0 else np.array([random.randint(1, 4) for _ in rows], float)
    g = cocommunities._Level(np.arange(400), node, np.unique(value, return_inverse=True)[1], x, 1.25)
    looked = []

    def search(g, s, nodes):
        looked.append(len(nodes))
        assert s.key.tolist() == cocommunities._Labels.of(g, s.own).key.tolist() and s.count.tolist() == cocommunities._Labels.of(g, s.own).count.tolist()
        return cocommunities._here(g, s, nodes)

    own = cocommunities._moved(g, 42, level, search)
    assert sum(looked) < len(looked) * g.n / 2 and 3 < len(set(own.tolist())) < 400
    s, every = cocommunities._Labels.of(g, own), np.arange(g.n)
    best, score = cocommunities._here(g, s, every)
    gain = score - (s.inside(g, every) - 1.25 * g.k / g.total * (s.volume[own] - g.k))
    assert not (gain > cograph.LEAST * g.k).any()


@pytest.mark.parametrize("wide", [1, 60, 17_000])
def test_dense_looks_sum_narrow_whole_numbers(wide):
    """Few communities are looked at in lines of narrow whole numbers, which take no more room than their sums need, and none overflows."""
    random = Random(31)
    rows = sorted({(n, random.randrange(400)) for n in range(2_000) for _ in range(4)})
    node, value = np.array(rows).T
    g = cocommunities._Level(np.arange(2_000), node, value, np.ones(len(rows)), 1.25)
    s = cocommunities._Labels.of(g, np.arange(2_000) % 100)
    s.count *= wide
    every = np.arange(g.n)
    tracemalloc.start()
    best, score = cocommunities._best_of_all(g, s, every)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3_000_000
    shared = np.zeros((g.n, 100))
    counts = np.zeros((g.n_values, 100))
    counts[s.key // g.n, s.c] = s.count
    for n, v in rows:
        shared[n] += counts[v]
    gains = shared - g.share[:, None] * s.volume[:100]
    gains[every, s.own] = -np.inf
    gains[shared <= 0] = -np.inf
    assert (gains.max(1) == score).all() and (gains.argmax(1) == best).all()


def test_large_communities_from_rows_are_split_again(spark, monkeypatch):
    rows = grouped_members()
    members = spark.createDataFrame(rows, "chunk_id bigint, entity string")
    found = {}
    for large in (100_000, 10):
        monkeypatch.setattr(cocommunities, "LARGE", large)
        found[large] = {r.node: r.community for r in cocommunities.member_communities(members, most=8).collect()}
    assert found[10] == found[100_000] and set(found[10]) == {n for n, e in rows if e != "alone"}
    whole = cograph.partition(pairs_of(rows))
    assert len(set(found[10].values())) > len(set(whole.values()))
    assert all(whole[n] == whole[c] and c == min(m for m in found[10] if found[10][m] == c) for n, c in found[10].items())
    assert cocommunities.member_communities(members.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["communities", "chunk_community_context", "chunk_community_texts", "chunk_community_triples", "chunk_community_docs_new", "community_summaries"])
def test_chunk_communities_make_no_pairs(spark, data, monkeypatch, name):
    def pairs(*_):
        raise AssertionError("pairs of chunks are made")

    monkeypatch.setattr(cograph, "edges", pairs)
    assert catalog.REGISTRY[name](spark, data).limit(1).count() <= 1


def test_closure(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(9)] + [("x", "n3"), ("c1", "c2"), ("c2", "c1"), (None, "n1")], "child string, parent string")
    got = {(r.node, r.ancestor) for r in closure(edges).collect()}
    assert ("n0", "n9") in got and ("x", "n9") in got and ("n9", "n9") in got and ("c1", "c1") in got and ("n9", "n0") not in got
    assert len(got) == sum(10 - i for i in range(10)) + 1 + 7 + 4


def test_fuzzy_misses_no_pair(spark):
    random = Random(7)
    word = lambda: "".join(random.choice("abc") for _ in range(random.randint(1, 9)))
    names, labels = sorted({word() for _ in range(40)}), sorted({word() for _ in range(40)})

    def levenshtein(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            new = [i]
            for j, d in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return row[-1]

    got = {(r.name, r.qid, r.distance) for r in fuzzy(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([("q" + v, v) for v in labels], "qid string, label string"), 1000, 2).collect()}
    want = {(n, "q" + v, d) for n in names for v in labels if (d := levenshtein(n, v)) <= 2}
    assert got == want


@pytest.mark.parametrize("large", [1_000_000, 1])
def test_large_communities_are_split_again(spark, large):
    """A ring of dense groups in denser pairs: what is too large is partitioned as a graph of its own, and a clique stays whole."""
    pairs = []
    for g in range(12):
        pairs += [(10 * g + a, 10 * g + b, 3) for a in range(10) for b in range(a + 1, 10)]
        pairs += [(10 * g + a, 10 * ((g + 1) % 12) + a, 1) for a in range(5)]
    clique = [(1_000 + a, 1_000 + b, 1) for a in range(30) for b in range(a + 1, 30)]
    graph = spark.createDataFrame(pairs + clique, "u bigint, v bigint, weight bigint")
    sizes = {}
    for most in (None, 20, 5):
        found = {r.node: r.community for r in cograph.communities(graph, resolution=0.1, large=large, most=most).collect()}
        assert len(found) == 150
        sizes[most] = sorted(Counter(found.values()).values())
    assert sizes[None].count(30) > 1 and sizes[20][-1] == 30 and all(n <= 20 or n == 30 for n in sizes[20]) and len(sizes[20]) > len(sizes[None])
    assert cograph.communities(graph.limit(0), large=large).count() == 0
