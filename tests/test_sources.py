import json

from corpuscle.operators import triples
from corpuscle.sources import readers, sinks
from corpuscle.streaming import ingest


def pages(number):
    """Response pages for the paged source."""
    return json.dumps({"documents": {f"D{number}": {"id": number, "display_title": f"t{number}"}, "facets": [], "bad": {"display_title": "no id"}}} if number < 3 else {"documents": {}})


def test_metadata_pages(spark, tmp_path):
    for k in (1, 2, 3):
        (tmp_path / f"{k}.json").write_text(pages(k))
    assert sorted(r.id for r in readers.metadata_pages(spark, str(tmp_path)).collect()) == ["1", "2"]


def test_paged_source(spark, tmp_path, monkeypatch):
    spark.dataSource.register(readers.PagedMetadata)
    got = spark.read.format("paged_metadata").option("pages", 3).option("module", "tests.test_sources").option("function", "pages").load()
    assert sorted(r.id for r in got.collect()) == ["1", "2"]


def test_graph_round_trip(spark, tmp_path):
    rows = [("http://s", "http://p", 'a "quoted"\nline \\n end', "literal", "en"), ("http://s", "http://p", "http://o", "uri", None), ("http://s", "http://q", "", "literal", None)]
    graph = spark.createDataFrame(rows, readers.TRIPLE)
    sinks.save_graph(graph, str(tmp_path / "g"))
    assert sorted(map(str, readers.ntriples(spark, str(tmp_path / "g")).collect())) == sorted(map(str, graph.collect()))


def test_cache_and_content(spark, tmp_path):
    (tmp_path / "cache.json").write_text(json.dumps({"entities": {"a|org": "http://x/Q1", "b|gpe": None}, "countries": {"Q1": [{"predicate": "P30", "object": "o", "type": "uri"}]}}))
    links, facts = readers.knowledge_cache(spark, str(tmp_path / "cache.json"))
    assert {r.key: r.url for r in links.collect()} == {"a|org": "http://x/Q1", "b|gpe": None}
    assert [tuple(r) for r in facts.collect()] == [("Q1", "P30", "o", "uri")]
    (tmp_path / "c").mkdir()
    (tmp_path / "c/77_content_list.json").write_text(json.dumps([{"type": "text", "text": "H", "text_level": 1}, {"type": "table", "table_body": "<table/>"}]))
    (tmp_path / "c/78_content_list.json").write_text("not json")
    got = [(r.doc_id, r.pos, r.type, r.text_level) for r in readers.content_lists(spark, str(tmp_path / "c")).orderBy("pos").collect()]
    assert got == [("77", 0, "text", 1), ("77", 1, "table", None)]
    (tmp_path / "v.json").write_text(json.dumps({"Public Debt": "/thesaurus/1"}))
    assert [tuple(r) for r in readers.vocabulary_file(spark, str(tmp_path / "v.json")).collect()] == [("public debt", "/thesaurus/1", "UNBIS_TERM")]


def test_empty_and_upsert(spark, tmp_path):
    stored = readers.stored_or_empty(spark, str(tmp_path / "none"), "id string, v int")
    assert stored.count() == 0
    new = spark.createDataFrame([("a", 1)], "id string, v int")
    both = sinks.upserted(spark.createDataFrame([("a", 0), ("b", 2)], "id string, v int"), new, ["id"])
    assert sorted(map(tuple, both.collect())) == [("a", 1), ("b", 2)]
    sinks.save_table(both, str(tmp_path / "t"))
    assert readers.stored_or_empty(spark, str(tmp_path / "t"), "id string, v int").count() == 2
    sinks.save_json(both, str(tmp_path / "j"))
    sinks.save_csv(both, str(tmp_path / "csv"))
    groups = spark.createDataFrame([(1, 0, "## Chunk 1\n\nx")], "doc_id int, ordinal int, text string")
    sinks.save_markdown(groups, str(tmp_path / "md"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2


def test_stream_keeps_the_latest(spark, tmp_path, data):
    arrivals = spark.read.parquet(f"{data}/doc_metadata.parquet")
    arrivals.repartition(3).write.parquet(str(tmp_path / "in"))
    query = ingest.keep_latest(ingest.files(spark, str(tmp_path / "in"), arrivals), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    from corpuscle.operators import metadata

    want = metadata.latest_versions(arrivals)
    assert sorted(map(str, ingest.current(spark, str(tmp_path / "out")).select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_artifacts_and_tagger(spark, tmp_path):
    from corpuscle.models import capitalised_phrases
    from corpuscle.operators import gazetteer, vectors

    (tmp_path / "7.md").write_text("# Title\nGlobal Bank Group met.")
    (tmp_path / "7.pdf").write_bytes(b"%PDF")
    found = readers.artifacts(spark, str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [("7", "# Title\nGlobal Bank Group met.")]
    assert [r.length for r in readers.source_files(spark, str(tmp_path)).collect()] == [4]
    assert [tuple(r) for r in gazetteer.tagged(found, capitalised_phrases, "name").collect()] == [("7", "Global Bank Group", "ORG")]
    assert vectors.new_only(found, spark.createDataFrame([("7",)], "name string"), "name").count() == 0


def test_stream_of_elements(spark, tmp_path, data):
    from corpuscle.operators import sections

    arrivals = spark.read.parquet(f"{data}/content_list.parquet")
    arrivals.repartition(1).write.parquet(str(tmp_path / "in"))
    query = ingest.chunk_arrivals(ingest.files(spark, str(tmp_path / "in"), arrivals), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    got, want = ingest.newest_chunks(spark, str(tmp_path / "out")), sections.chunks(arrivals)
    assert sorted(r.chunk_id for r in got.collect()) == sorted(r.chunk_id for r in want.collect())


def test_whole_pipeline(spark, data):
    from pyspark.sql import functions as F

    from corpuscle.plans import pipeline

    read = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    made = pipeline.run(read("doc_metadata"), read("content_list"), read("documents"), read("entities"), read("entities").where("qid is not null").select("qid", F.col("surface").alias("label")).distinct())
    assert made.chunks.count() == made.annotated.count() > 0
    assert made.graph.count() == made.graph.distinct().count() > 1000
    assert made.index.where("kind = 'chunk'").count() == made.chunks.count()
    assert made.communities.count() >= made.communities.select("community").distinct().count() > 0
    assert made.abstracts.count() > 0 and made.acronyms.count() > 0
    assert triples.identifiers(made.graph, "document").count() > 0
    assert pipeline.new_documents(read("documents"), made.chunks).count() < read("documents").count()


def many_pages(number):
    """Response pages up to the 20th."""
    return json.dumps({"documents": {f"D{number}": {"id": number}} if number <= 20 else {}})


def test_pages_until_an_empty_one(spark):
    spark.dataSource.register(readers.PagedMetadata)
    read = lambda **options: sorted(int(r.id) for r in spark.read.format("paged_metadata").options(module="tests.test_sources", function="many_pages", **options).load().collect())
    assert read(pages="all", tasks=3) == list(range(1, 21)) == read(pages="all")
    assert read(pages=4, start=3) == [3, 4, 5, 6] and read() == [1] and read(pages="all", start=21) == []


def test_turtle_round_trip(spark, tmp_path):
    rows = [(triples.SCHEMA + "x", triples.TYPE, triples.EX + "document", "uri", None), (triples.EX + "document/1", triples.NAME, 'a "b"\n\\ ; , . #c', "literal", "en"), ("http://s/é", "http://p", "", "literal", None)]
    graph = spark.createDataFrame(rows, readers.TRIPLE)
    sinks.save_turtle(graph, str(tmp_path / "t"))
    assert sorted(map(str, readers.turtle(spark, str(tmp_path / "t")).collect())) == sorted(map(str, graph.collect()))


def test_turtle_as_others_write_it():
    text = '''@prefix ex: <http://e/> .
PREFIX s: <http://s/>
# a comment
ex:a a ex:Doc, s:Thing ;
    s:name "one"@en, """two
lines""" ;
    s:n 5 ;
    s:when "2020"^^<http://t> ;
    s:url <http://u/x;y,z.w> .
ex:b s:name "x\\u00e9\\"y" .
'''
    e, s, t = "http://e/", "http://s/", triples.TYPE
    assert list(readers.parsed_turtle(text)) == [
        (e + "a", t, e + "Doc", "uri", None), (e + "a", t, s + "Thing", "uri", None), (e + "a", s + "name", "one", "literal", "en"), (e + "a", s + "name", "two\nlines", "literal", None),
        (e + "a", s + "n", "5", "literal", None), (e + "a", s + "when", "2020", "literal", None), (e + "a", s + "url", "http://u/x;y,z.w", "uri", None), (e + "b", s + "name", 'xé"y', "literal", None),
    ]
    assert list(readers.parsed_turtle("")) == [] == list(readers.parsed_turtle("ex:a ex:b ex:c ."))


def test_converted_files(spark, tmp_path):
    for name in ("1.pdf", "2.PNG", "3.png", "bad.pdf", "odd.pdf"):
        (tmp_path / name).write_bytes(name.encode())

    def converter(files):
        ((name, content, lang),) = files
        if name == "bad":
            raise ValueError(name)
        return ["no json" if name == "odd" else json.dumps([{"type": "text", "text": f"{content.decode()} {lang} {k}", "page_idx": k} for k in range(3)])]

    files = readers.source_files(spark, str(tmp_path))
    got = sorted((r.doc_id, r.pos, r.text) for r in readers.converted(files, converter, first=1, last=1).collect())
    assert got == [("1", 1, "1.pdf en 1"), ("3", 1, "3.png en 1")]
    assert readers.converted(files, converter).count() == 6


def test_load_or_build(spark, tmp_path):
    from corpuscle.plans import pipeline

    path, cache = str(tmp_path / "g"), tmp_path / "cache.json"
    cache.write_text("{}")
    graph = lambda n: spark.createDataFrame([(f"http://{k}", "http://p", "o", "literal", None) for k in range(n)], readers.TRIPLE)
    assert pipeline.load_or_build(spark, path, lambda: graph(2)).count() == 2
    assert pipeline.load_or_build(spark, path, lambda: graph(3)).count() == 2 and cache.exists()
    assert pipeline.load_or_build(spark, path, lambda: graph(3), rebuild=True, caches=(str(cache),)).count() == 3 and not cache.exists()


def test_store(spark, tmp_path):
    from corpuscle.sources.store import Store

    rows = lambda *found: spark.createDataFrame(list(found), "chunk_id string, doc_id string, text string")
    store = Store(spark, str(tmp_path / "s"))
    assert store.documents() is None and store.new(rows(("a", "1", "x"))).count() == 1
    store.add(rows(("a", "1", "one"), ("b", "1", "two"), ("c", "2", "three")))
    store.add(rows(("d", "1", "four"), ("e", "3", None)))
    assert {r.doc_id: r.n_chunks for r in store.documents().collect()} == {"1": 1, "2": 1, "3": 1}
    assert sorted((r.chunk_id, len(r.embedding)) for r in store.table("vectors").collect()) == [("c", 64), ("d", 64)]
    assert [r.doc_id for r in store.new(rows(("x", "1", ""), ("y", "9", ""))).collect()] == ["9"]
    assert [r.chunk_id for r in store.chunks_of(rows(("x", "2", ""))).collect()] == ["c"]
    store.rebuild(rows(("z", "7", "t")))
    assert [r.doc_id for r in store.documents().collect()] == ["7"]
    store.reset()
    assert store.table("chunks") is None
