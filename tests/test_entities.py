from corpuscle.operators import acronyms, annotate, chat, gazetteer, linker, summaries, vectors
from corpuscle.plans import catalog


def test_acronyms(spark):
    rows = spark.createDataFrame([(1, "AI", "Artificial&nbsp;Intelligence"), (1, "ml", "machine learning"), (1, "X", "x"), (1, "Ab", None)], "doc_id bigint, short string, long string")
    assert {(r.short, r.long) for r in acronyms.cleaned(rows).collect()} == {("AI", "Artificial Intelligence"), ("Ab", None)}
    other = spark.createDataFrame([(1, "AI", "Another"), (2, "AI", "Second")], "doc_id bigint, short string, long string")
    got = {(r.doc_id, r.short): (r.long, r.conflict) for r in acronyms.merged(rows, other).collect()}
    assert got[1, "AI"] == ("Artificial&nbsp;Intelligence", True) and got[2, "AI"] == ("Second", False)
    step = spark.createDataFrame([(1, "STEP", "Systematic Tracking and Exchanges in Procurement")], "doc_id bigint, short string, long string")
    assert {(r.label, tuple(r.tokens), r.id) for r in acronyms.patterns(step).collect()} == {
        ("ACRONYM", ("step",), "STEP"), ("ACRONYM_EXPANDED", ("systematic", "tracking", "and", "exchanges", "in", "procurement"), "Systematic Tracking and Exchanges in Procurement"),
    }


def test_gazetteer(spark):
    patterns = spark.createDataFrame([("T", ["public", "debt"], "1"), ("T", ["debt"], "2"), ("T", ["debt", "relief"], "3"), ("T", [], "4")], "label string, tokens array<string>, id string")
    docs = spark.createDataFrame([(1, "Public  debt relief; DEBT."), (2, None), (3, "")], "doc_id bigint, text string")
    found = gazetteer.mentions(docs, patterns)
    assert {(r.start, r.length, r.id) for r in found.collect()} == {(0, 2, "1"), (1, 1, "2"), (1, 2, "3"), (3, 1, "2")}
    assert {(r.start, r.length, r.id) for r in gazetteer.resolved(found).collect()} == {(0, 2, "1"), (3, 1, "2")}
    assert gazetteer.mentions(docs, patterns.limit(0)).count() == 0


def test_scrape_takes_the_last_link(spark):
    pages = spark.createDataFrame([(1, '<a class="bc-link" href="/thesaurus/1?lang=en"> Water </a><a class="bc-link" href="/thesaurus/2?x=1&y=2">Water</a><a class="other" href="/thesaurus/3">No</a><a class="bc-link" href="/else/4">No</a>')], "page_id int, html string")
    assert [tuple(r) for r in gazetteer.scraped(pages).collect()] == [("Water", "/thesaurus/2")]


def test_label_filter(spark):
    rows = spark.createDataFrame([(1, 1, "Global Bank", "ORG", None), (2, 1, "2020", "DATE", None), (3, 1, "STEP", "ACRONYM", None), (3, 1, "STEP", "ACRONYM", None), (4, 1, " ", "ORG", None), (5, 1, "x", None, None)], "entity_id bigint, doc_id bigint, surface string, label string, qid string")
    assert sorted(r.surface for r in gazetteer.entities(rows).collect()) == ["Global Bank", "STEP"]


def test_cascade_and_cache(spark):
    labels = spark.createDataFrame([("Q1", "Global Bank"), ("Q0", "Global Bank"), ("Q2", "Ministry of Energy")], "qid string, label string")
    mentions = spark.createDataFrame([("Global Bank", "ORG"), ("Ministry of Enegy", "ORG"), ("Elsewhere", "GPE"), ("<b>123</b>", "ORG")], "surface string, label string")
    wanted = linker.lookups(mentions)
    got = {r.name: (r.qid, r.how) for r in linker.cascade(wanted, labels, 2).collect()}
    assert got == {"Global Bank": ("Q0", "exact"), "Ministry of Enegy": ("Q2", "fuzzy"), "Elsewhere": (None, None)}
    cache = linker.cache_entries(spark.createDataFrame([("Global Bank|ORG", "http://x/Q9"), ("elsewhere|gpe", None), ("nobar", "u")], "key string, url string"))
    assert {r.name for r in linker.with_cache(wanted, cache, "literal").collect()} == {"Ministry of Enegy"}
    assert {r.name: (r.qid, r.known) for r in linker.with_cache(wanted, cache).collect()} == {"Global Bank": ("Q9", True), "Elsewhere": (None, True), "Ministry of Enegy": (None, False)}


def test_annotation(spark):
    chunks = spark.createDataFrame([(1, 1, "The Global Bank funds SEMARNAT programs and STEP initiatives."), (2, 1, "Completely unrelated text"), (3, 2, "Global Bank"), (4, 1, None)], "chunk_id bigint, doc_id bigint, text string")
    entities = spark.createDataFrame([(1, "global bank", "ORG", None), (1, "SEMARNAT", "ORG", None), (1, "", "ORG", None)], "doc_id bigint, surface string, label string, qid string")
    short = spark.createDataFrame([(1, "STEP", ""), (1, "ZZ", None)], "doc_id bigint, short string, long string")
    got = {r.chunk_id: ([a.short for a in r.acronyms], [e.surface for e in r.entities]) for r in annotate.annotated(chunks, short, entities).collect()}
    assert got == {1: (["STEP"], ["SEMARNAT", "global bank"]), 2: ([], []), 3: ([], []), 4: ([], [])}


def test_nearest_against_brute_force(spark):
    from random import Random

    random = Random(1)
    vectors_ = [(i, i % 3, [random.gauss(0, 1) for _ in range(5)]) for i in range(40)] + [(40, 0, [0.0] * 5)]
    rows = spark.createDataFrame(vectors_, "vec_id bigint, label int, embedding array<double>")

    def cosine(a, b):
        dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))
        return round(dot(a, b) / (dot(a, a) ** 0.5 * dot(b, b) ** 0.5), 6)

    for same, block in ((None, 256), ("label", 256), (None, 1), ("label", 1)):
        got = {(r.query_id, r.rank): r.vec_id for r in vectors.nearest(rows, rows.where("vec_id in (3, 7)"), 4, same, block).collect()}
        for query in (3, 7):
            others = sorted((-cosine(v, vectors_[query][2]), i) for i, lab, v in vectors_ if i != query and any(v) and (not same or lab == vectors_[query][1]))
            assert [got[query, k + 1] for k in range(4)] == [i for _, i in others[:4]]


def test_summaries_and_chat(spark):
    members = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "node bigint, community bigint")
    texts = spark.createDataFrame([(1, "one two."), (2, "three"), (3, None)], "chunk_id bigint, text string")
    contexts = summaries.contexts(summaries.members_within(members, texts, 100))
    assert [tuple(r) for r in contexts.collect()] == [(7, 2, "one two.\n\nthree")]
    cache = spark.createDataFrame([(7, "known")], "community bigint, abstract string")
    assert {r.community: r.abstract for r in summaries.summarised(contexts, cache).collect()} == {7: "known"}
    graph = summaries.community_triples(members).unionByName(summaries.summary_triples(cache))
    assert [r.id for r in summaries.community_documents(graph, spark.createDataFrame([], "id string")).collect()] == ["community-7"]
    assert summaries.community_documents(graph, spark.createDataFrame([("community-7",)], "id string")).count() == 0
    turns = spark.createDataFrame([(1, 1, "user", "a b c"), (1, 2, "user", "d e"), (1, 3, "user", "f")], "conv_id int, turn int, role string, text string")
    assert sorted(r.turn for r in chat.memory(turns, 3).collect()) == [2, 3]


def answer_links(prompts):
    """A model's answers, one of them spoilt."""
    return ['Here: [["Global Bank", "ORG", "Q7164", 5], ["X", "ORG", "None", "None"], ["short"], ["Y", "LOC", null, 1]]' if "Global Bank" in p else "sorry" for p in prompts]


def answer_acronyms(prompts):
    return ["{'AI': 'Artificial Intelligence',}" if "AI" in p else "none" for p in prompts]


def test_models(spark):
    batches = spark.createDataFrame([(0, ["Global Bank (ORG)"]), (1, ["Else (LOC)"])], "batch int, lines array<string>")
    got = {r["name"]: (r.qid, r.confidence) for r in linker.by_model(batches, answer_links).collect()}
    assert got == {"Global Bank": ("Q7164", 5), "X": (None, None), "Y": (None, 1)}
    docs = spark.createDataFrame([(1, "About AI."), (2, None), (3, "else")], "doc_id bigint, text string")
    assert [tuple(r) for r in acronyms.by_model(docs, answer_acronyms).collect()] == [(1, "AI", "Artificial Intelligence")]
    assert linker.allowed_classes(spark).count() == 21


def test_names_of_every_label_are_linked(spark, tmp_path):
    rows = [(1, 1, "World Bank", "ORG", "Q1"), (2, 1, "Wrold Bank", "ORG", None), (3, 2, "Kenya", "GPE", "Q2"), (4, 2, "Kenia", "GPE", None), (5, 3, "enérgy", "UNBIS_TERM", None), (6, 3, "Elsewhere", "LOC", None)]
    spark.createDataFrame(rows, "entity_id bigint, doc_id bigint, surface string, label string, qid string").write.parquet(str(tmp_path / "entities.parquet"))
    spark.createDataFrame([("T1", "energy")], "id string, pattern string").write.parquet(str(tmp_path / "unbis_vocab.parquet"))
    got = {r["name"]: (r.qid, r.how) for r in catalog.link_cascade(spark, str(tmp_path)).collect()}
    assert got == {"World Bank": ("Q1", "exact"), "Wrold Bank": ("Q1", "fuzzy"), "Kenya": ("Q2", "exact"), "Kenia": ("Q2", "fuzzy"), "energy": ("T1", "exact"), "Elsewhere": (None, None)}
    near = {(r["name"], r.qid, r.distance) for r in catalog.fuzzy_candidates(spark, str(tmp_path)).collect()}
    assert near == {("World Bank", "Q1", 0), ("Wrold Bank", "Q1", 2), ("Kenya", "Q2", 0), ("Kenia", "Q2", 1), ("energy", "T1", 0)}


def test_tagger_and_patterns_together(spark):
    from pyspark.sql import functions as F

    documents = spark.createDataFrame([(1, "The Lake Water Board reads on air pollution control and WB air pollution."), (2, "air pollution"), (3, None), (4, "Nothing here.")], "doc_id bigint, text string")
    tagger = lambda texts: [[("Lake Water Board", "ORG"), ("Water Board", "ORG"), ("pollution control", "LAW")] if "Lake" in t else [] for t in texts]
    patterns = spark.createDataFrame([(None, "UNBIS_TERM", ["air", "pollution"], "t1"), (None, "UNBIS_TERM", ["pollution"], "t2"), (None, "UNBIS_TERM", ["water"], "t3"), (1, "ACRONYM", ["wb"], "WB"), (2, "ACRONYM", ["on"], "ON")], "doc_id bigint, label string, tokens array<string>, id string")
    spans = gazetteer.recognised(documents, tagger, patterns)
    assert sorted((r.doc_id, r.start, r.length, r.label, r.id) for r in spans.collect()) == [(1, 1, 3, "ORG", None), (1, 7, 2, "LAW", None), (1, 10, 1, "ACRONYM", "WB"), (1, 11, 2, "UNBIS_TERM", "t1"), (2, 0, 2, "UNBIS_TERM", "t1")]
    named = {(r.surface, r.label) for r in gazetteer.spans_as_entities(spans, documents).collect()}
    assert ("lake water board", "ORG") in named and ("air pollution", "UNBIS_TERM") in named
    assert gazetteer.recognised(documents.where(F.lit(False)), tagger, patterns.drop("doc_id")).count() == 0


def test_acronym_extraction(spark):
    from corpuscle.operators import acronyms

    text = "x " * 6_000 + "The World Road Fund (WRF) met. " + "y " * 6_000 + "see ABC"
    documents = spark.createDataFrame([(1, text), (2, None), (3, "plain")], "doc_id bigint, text string")
    asked = []

    def chat(prompts_):
        asked.extend(prompts_)
        return ['{"WRF": "World Rail Fund", "low": "no"}' if "WRF" in p else '{"ABC": "A &amp; BC"}' if "ABC" in p else "none" for p in prompts_]

    both, names = acronyms.extracted(documents, chat)
    assert sorted((r.short, r.long, r.conflict) for r in both.collect()) == [("ABC", "A & BC", False), ("WRF", "World Rail Fund", True)]
    assert {r.long: r.short for r in names.collect()} == {"A & BC": "ABC", "World Rail Fund": "WRF", "World Road Fund": "WRF"}
    assert [tuple(r) for r in acronyms.extracted(documents)[0].collect()] == [(1, "WRF", "World Road Fund", False)]
    parts = [r.piece for r in documents.where("doc_id = 1").selectExpr("text as piece").collect()]
    assert len(parts[0]) > 20_000


def test_tree_summaries_and_limits(spark):
    from time import monotonic

    from corpuscle.models import limited

    found = spark.createDataFrame([(1, k, k) for k in range(5)] + [(2, 0, 0)], "query_id bigint, rank bigint, vec_id bigint")
    texts = spark.createDataFrame([(k, "abcde"[k]) for k in range(5)], "vec_id bigint, text string")
    got = {r.query_id: r.answer for r in vectors.tree_summarised(found, texts, lambda asked: ["(" + t.replace("\n\n", "+") + ")" for t in asked], 2).collect()}
    assert got[1] == "(((a+b)+(c+d))+((e)))" and got[2].strip("()") == "a"
    began = monotonic()
    assert limited(lambda t: t, calls=1, seconds=0.05)(["a", "b", "c"]) == ["a", "b", "c"] and monotonic() - began >= 0.1


def test_links_in_any_order(spark):
    html = '<a href="/thesaurus/1?x=1" title="t" class="bc-link big">One</a><a class=\'bc-link\' href=\'/thesaurus/2\'> Two </a><a class="other" href="/thesaurus/3">No</a><a class="bc-link" href="/else/4">No</a>'
    got = {r.term: r.href for r in gazetteer.scraped(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()}
    assert got == {"One": "/thesaurus/1", "Two": "/thesaurus/2"}


def test_long_words_before_a_bracket():
    from corpuscle.functions.pandas_text import abbreviations

    assert abbreviations("International " + "x" * 600 + " Bank (IXB)") == [("IXB", "International " + "x" * 600 + " Bank")]
    assert abbreviations("WRF (World " + "r" * 300 + " Fund)") == [("WRF", "World " + "r" * 300 + " Fund")]
