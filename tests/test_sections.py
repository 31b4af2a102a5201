import pytest

from corpuscle.operators import ordered, sections, splitting, windows

SCHEMA = "doc_id bigint, pos int, type string, text string, text_level int, table_body string"
TABLE = "<table><tr><td>Cell 1</td><td>Cell 2</td></tr></table>"


def rows(spark, *elements, doc=1):
    return spark.createDataFrame([(doc, i, *e) for i, e in enumerate(elements)], SCHEMA)


def header(level, text):
    return ("text", text, level, None)


def body(text):
    return ("text", text, None, None)


def test_header_levels(spark):
    content = rows(spark, header(1, "Main Header"), body("t1"), header(2, "Sub-header"), body("t2"), header(3, "Sub-sub-header"), body("t3"), header(1, "New title"))
    got = [(r.header_path, r.text) for r in sections.chunks(content).orderBy("ordinal").collect()]
    assert got == [
        ("/Main Header/", "# Main Header\nt1"), ("/Main Header/Sub-header/", "## Sub-header\nt2"), ("/Main Header/Sub-header/Sub-sub-header/", "### Sub-sub-header\nt3"), ("/New title/", "# New title"),
    ]


def test_text_before_a_header(spark):
    got = [(r.header_path, r.text) for r in sections.chunks(rows(spark, body("before."), header(1, "H"), body("after"))).orderBy("ordinal").collect()]
    assert got == [("/", "before."), ("/H/", "# H\nafter")]


def test_table_comes_first(spark):
    got = sections.chunks(rows(spark, header(1, "H"), ("table", None, None, TABLE), body("text"))).orderBy("ordinal").collect()
    assert [("Cell 1" in r.text, r.header_path) for r in got] == [(True, "/H/"), (False, "/H/")]
    assert (got[0].prev_id, got[0].next_id, got[1].prev_id, got[1].next_id) == (None, got[1].chunk_id, got[0].chunk_id, None)


def test_blank_header_ends_the_section_only(spark):
    got = [(r.header_path, r.text) for r in sections.text_chunks(rows(spark, header(1, "A"), body("x"), header(2, " "), body("y"))).orderBy("section").collect()]
    assert got == [("/A/", "# A\nx"), ("/A/", "y")]


def test_other_types_nulls_and_repeats(spark):
    content = rows(spark, ("image", "i", None, None), ("odd", "o", None, None), ("table", None, None, None), ("table", None, None, "no table"), body(None), header(1, None))
    assert sections.chunks(content.union(content)).count() == 0
    assert sections.chunks(content.limit(0)).count() == 0


def test_skipped_levels_and_deep_headers(spark):
    got = {r.pos: r.header_path for r in sections.with_paths(rows(spark, header(3, "c"), header(2, "b"), header(3, "d"), header(1, "a"), header(3, "e"))).collect()}
    assert got == {0: "/c/", 1: "/b/", 2: "/b/d/", 3: "/a/", 4: "/a/e/"}


@pytest.mark.parametrize("stretch", [1, 2, 3, 100])
def test_running_last_does_not_depend_on_stretches(spark, stretch):
    from pyspark.sql import functions as F

    data = spark.createDataFrame([(k, i, i * 7 % 5 if i * 7 % 3 else None) for k in ("a", None) for i in range(12)], "k string, i int, v int")
    got = {(r.k, r.i): r.last.v if r.last else None for r in ordered.running_last(data, ["k"], "i", {"last": F.when(F.col("v").isNotNull(), F.struct("i", "v"))}, stretch).collect()}
    for k in ("a", None):
        last = None
        for i in range(12):
            last = i * 7 % 5 if i * 7 % 3 else last
            assert got[k, i] == last


def test_word_windows(spark):
    docs = spark.createDataFrame([(1, " ".join(map(str, range(25)))), (2, "one"), (3, " \n "), (4, None)], "doc_id bigint, text string")
    got = [(r.doc_id, r.ordinal, r.text.split()[0], r.text.split()[-1]) for r in windows.word_windows(docs, size=10, overlap=3).orderBy("doc_id", "ordinal").collect()]
    assert got == [(1, 0, "0", "9"), (1, 1, "7", "16"), (1, 2, "14", "23"), (1, 3, "21", "24"), (2, 0, "one", "one")]


def test_batches_and_budgets(spark):
    from pyspark.sql import functions as F

    data = spark.createDataFrame([(1, i, " ".join(["w"] * n)) for i, n in enumerate([3, 3, 5, 9, 1])], "k int, position int, item string")
    got = [(r.batch, r.tokens) for r in windows.batches(data, "k", "position", F.col("item"), 7).orderBy("position").collect()]
    assert got == [(0, 3), (0, 3), (1, 5), (2, 9), (3, 1)]
    kept = windows.within_budget(data.withColumn("n", F.size(F.split("item", " "))), "k", [F.col("position")], "n", 11)
    assert sorted(r.position for r in kept.collect()) == [0, 1]


def greedy(units, counts, size, overlap):
    """Chunks as (first, after last) by a plain loop."""
    out, s = [], 0
    while s < len(units):
        e = s
        while e < len(units) and sum(counts[s : e + 1]) <= size:
            e += 1
        out.append((s, e))
        if e == len(units):
            return out
        s = next(k for k in range(s + 1, e + 1) if sum(counts[k:e]) <= overlap and sum(counts[k : e + 1]) <= size)
    return out


@pytest.mark.parametrize(("size", "overlap"), [(7, 3), (5, 0), (30, 10)])
def test_splitting_against_a_plain_loop(spark, size, overlap):
    import re
    from random import Random

    from pyspark.sql import functions as F

    random = Random(size)
    texts = [" ".join(random.choice(["a", "bb", "ccc.", "d!\n", "\n\n", "3.5", "...........", "x,y", "é?"]) for _ in range(random.randrange(90))) for _ in range(40)]
    texts += ["", " ", None, "." * 50, "w " * 40, "one", "\n"]
    split = splitting.sentence_splitter(size, overlap)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: (r.units, r.split) for r in frame.select("i", splitting.units(F.col("text"), size).alias("units"), split(F.col("text")).alias("split")).collect()}
    count = lambda t: len(re.findall(r"\w+|[^\w\s]", t))
    for i, text in enumerate(texts):
        if text is None:
            assert not got[i][1]
            continue
        units, chunks = got[i]
        assert "".join(units) == text and all(count(u) <= size for u in units)
        want = [text] if count(text) <= size else ["".join(units[a:b]) for a, b in greedy(units, [count(u) for u in units], size, overlap)]
        assert chunks == [t.strip() for t in want if t.strip()] and all(count(c) <= size for c in chunks)


def test_long_sections_are_split(spark):
    content = rows(spark, header(1, "H"), body("Words of a sentence. " * 600), header(1, "I"), body("short"))
    got = sections.chunks(content).orderBy("ordinal").collect()
    assert len(got) == 4 and [r.header_path for r in got] == ["/H/"] * 3 + ["/I/"] and got[0].text.startswith("# H\nWords")
    assert got[1].text.startswith("Words of a sentence.") and got[1].prev_id == got[0].chunk_id
    assert sections.chunks(content, lambda t: F_array(t)).count() == 2


def F_array(text):
    from pyspark.sql import functions as F

    return F.array(text)
