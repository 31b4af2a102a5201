import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuscle.llm import containers, tokens

pytest.importorskip("tiktoken")


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("ab '\n\t1,.;中。é  <|>sStTrReEvVmMlLdD")), st.characters(exclude_categories=["Cs"])), max_size=120), st.integers(2, 20), st.integers(1, 6))
def test_tree_is_the_tokenizer(text, leaf, window):
    tree = tokens.Tree(leaf=leaf, window=window)
    ids = tree.encode(text)
    assert ids == tree.plain(text)
    assert tree.decode(ids) == text


@pytest.mark.parametrize("text", ["x" * 30_000, "'s" * 9_000, " " * 20_000, "a \n" * 9_000, "中文。" * 6_000, "<|endoftext|>" * 2_000, "don't we'll " * 3_000])
def test_long_texts(text):
    tree = tokens.Tree(leaf=1_000)
    assert tree.encode(text) == tree.plain(text)


def test_ids(spark):
    rows = [(1, "Hello <|endoftext|>", "x"), (2, "", "y"), (3, None, None), (3, None, None), (None, " \n ", None), (5, "a" * 100_000, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = tokens.token_ids(frame).collect()
    plain = tokens.Tree().plain
    assert len(got) == 6
    assert {r.doc_id: r.ids for r in got} == {1: plain("Hello <|endoftext|>"), 2: [], 3: [], None: plain(" \n "), 5: plain("a" * 100_000)}
    assert 50256 not in [i for r in got for i in r.ids]
    assert tokens.token_ids(frame.limit(0)).count() == 0
    assert all(r.same for r in tokens.round_trip(frame).collect())


def sizes_of(spark, sizes):
    return spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, n_tokens bigint")


@pytest.mark.parametrize("salts", [1, 7])
def test_containers(spark, salts):
    from random import Random

    random = Random(2)
    sizes = [0, 1, 100, 101, 350, 100] + [min(400, int(random.expovariate(1 / 30)) + 1) for _ in range(500)]
    got = containers.assign(sizes_of(spark, sizes), capacity=100, salts=salts).collect()
    filled, parts = {}, {}
    for r in got:
        filled[r.container_id] = filled.get(r.container_id, 0) + r.n_tokens
        parts.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
    assert max(filled.values()) <= 100
    for doc, size in enumerate(sizes):
        own = sorted(parts.get(doc, []))
        assert sum(n for _, n in own) == size
        assert [s for s, _ in own] == [100 * i for i in range(len(own))]
        assert len(own) == -(-size // 100)
    assert len(filled) <= 1.02 * -(-sum(sizes) // 100) + 1
    assert sorted(filled) == list(range(len(filled)))


def test_plan_holds_every_item_once():
    import numpy as np

    for seed in range(6):
        histogram = np.random.default_rng(seed).poisson(2 ** seed / 4, 65)
        histogram[0] = 0
        used = np.zeros(65, int)
        for times, content in containers.plan(histogram, 64):
            assert times > 0 and sum(s * n for s, n in content) <= 64
            for s, n in content:
                used[s] += n * times
        assert (used == histogram).all()


def test_least_squares_fill_most_containers():
    import numpy as np

    for seed in range(3):
        random = np.random.default_rng(seed)
        histogram = np.bincount(np.minimum(2_048, random.lognormal(5.4, 0.8, 10_000).astype(int) + 10), minlength=2_049)
        least = -(-int((histogram * np.arange(2_049)).sum()) // 2_048)
        left = histogram.copy()
        solved, rest = containers.solved(left, 2_048), containers.fill(left, 2_048)
        by = [sum(times for times, _ in runs) for runs in (solved, rest)]
        assert by[0] >= 0.8 * sum(by) and sum(by) <= 1.002 * least + 1


def test_containers_of_odd_tables(spark):
    assert containers.assign(sizes_of(spark, [])).count() == 0
    assert containers.assign(sizes_of(spark, [0, 0])).count() == 0
    same = containers.assign(sizes_of(spark, [7] * 1000), capacity=20, salts=3).collect()
    assert len({r.container_id for r in same}) == 500
    docs = spark.createDataFrame([(1, "one two", 9), (1, "one two", 9), (2, None, 1), (3, "", 2), (4, " ", 3)], "doc_id bigint, text string, n_tokens int")
    got = containers.containers(docs).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 4] and {r.container_id for r in got} == {0}
