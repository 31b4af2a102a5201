"""The queries of the reference's operators: each a function of the session and the folder of the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import text as x
from corpuscle.functions.pandas_text import parse_answer
from corpuscle.models import capitalised_phrases, leading_sentences
from corpuscle.operators import acronyms, annotate, chat, cocommunities, cograph, gazetteer, linker, metadata, sections, summaries, triples, vectors, windows
from corpuscle.operators.splitting import sentence_splitter
from corpuscle.plans import pipeline
from corpuscle.session import checkpoint_folder, written_table
from corpuscle.sources import readers, sinks
from corpuscle.sources.store import Store
from corpuscle.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    return metadata.sanitized(metadata.latest_versions(table(spark, folder, "doc_metadata")))


def _entities(spark: SparkSession, folder: str) -> DataFrame:
    return gazetteer.entities(table(spark, folder, "entities"))


def _once(chunk: DataFrame) -> DataFrame:
    return chunk.where("chunk_id is not null").dropDuplicates(["chunk_id"])


# ---- metadata and scalar functions ------------------------------------------------------------------------------------


@query
def metadata_latest_version(spark, folder):
    return metadata.latest_versions(table(spark, folder, "doc_metadata")).drop("fetched_at")


@query
def metadata_versions(spark, folder):
    return metadata.version_numbers(table(spark, folder, "doc_metadata"))


@query
def sanitize_keys(spark, folder):
    return _latest(spark, folder).select("id", *(F.col(f"`{c}`") for c in metadata.KEYED))


@query
def clean_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", x.clean_text(F.col("text")).alias("cleaned"))


@query
def sanitize_entities(spark, folder):
    rows = table(spark, folder, "entities").where("surface is not null").select("surface").distinct()
    return rows.select("surface", x.sanitize_entity(F.col("surface")).alias("sanitized"))


@query
def rdf_safe_ids(spark, folder):
    rows = table(spark, folder, "entities").where("surface is not null").select("surface", "qid").distinct()
    return gazetteer.with_safe_id(rows)


@query
def token_counts(spark, folder):
    return table(spark, folder, "entities").where("surface is not null").select("surface").distinct().select("surface", x.token_count(F.col("surface")).cast("bigint").alias("n_tokens"))


@query
def kb_id_and_cache_keys(spark, folder):
    rows = table(spark, folder, "entities").where("surface is not null and label is not null")
    url = F.concat(F.lit(triples.WD), F.col("qid"))
    keyed = rows.select(x.cache_key(F.col("surface"), F.col("label")).alias("key"), x.last_segment(url).alias("qid"), url.alias("url")).distinct()
    entries = linker.cache_entries(keyed.select("key", "url")).select("name_lc", "type_lc", "url").distinct()
    return entries.withColumn("qid", x.last_segment(F.col("url")))


# ---- the graph ---------------------------------------------------------------------------------------------------------


@query
def document_triples(spark, folder):
    return triples.document_triples(_latest(spark, folder))


@query
def class_triples(spark, folder):
    rows = table(spark, folder, "doc_metadata")
    made = [triples.class_triples(rows, k, n, p) for k, n, p in (("document", "Document", tuple(triples.PROPERTIES.values())), ("project", "Project", ()), ("trustfund", "Trust Fund", ()))]
    return triples.union(*made)


@query
def subclass_triples(spark, folder):
    return triples.subclass_triples(_latest(spark, folder).where("docty is not null and docty <> ''"), "document", "docty")


@query
def split_zip_ids(spark, folder):
    return triples.zipped(_latest(spark, folder), "trustfund_key", "trustfund")


def _listed_instances(spark: SparkSession, folder: str) -> DataFrame:
    latest = _latest(spark, folder)
    funds = triples.instance_triples(triples.zipped(latest, "trustfund_key", "trustfund"), "trustfund", "id", "name")
    projects = triples.instance_triples(triples.zipped(latest, "projectid", "projn"), "project", "id", "name")
    return funds.unionByName(projects)


@query
def fund_and_project_triples(spark, folder):
    return _listed_instances(spark, folder)


def _kb(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    return nation.select(F.initcap("n_name").alias("key"), F.concat(F.lit("Q"), F.col("n_nationkey")).alias("qid"))


@query
def country_triples(spark, folder):
    latest = _latest(spark, folder).select("id", "count")
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").cast("string").alias("id"), x.sanitize_key(F.initcap("n_name")).alias("count"))
    kb = _kb(spark, folder).select(x.sanitize_key(F.col("key")).alias("key"), "qid")
    return triples.country_triples(latest.unionByName(nations), kb)


@query
def link_doc_country(spark, folder):
    return triples.link_triples(_latest(spark, folder), "count")


@query
def link_doc_project(spark, folder):
    return triples.link_triples(_latest(spark, folder), "projectid")


@query
def link_doc_trustfund(spark, folder):
    return triples.link_triples(_latest(spark, folder), "trustfund_key")


@query
def fallback_entities(spark, folder):
    return triples.fallback_triples(_latest(spark, folder), "trustfund_key", _listed_instances(spark, folder))


def _graph(spark: SparkSession, folder: str) -> DataFrame:
    """The whole graph: the latest metadata is found once and read by each producer, and triples are made distinct once."""
    latest = written_table(_latest(spark, folder))
    made = [triples.instance_triples(triples.zipped(latest, ids, names), kind, "id", "name", once=False) for ids, names, kind in (("trustfund_key", "trustfund", "trustfund"), ("projectid", "projn", "project"))]
    links = [triples.link_triples(latest, c, once=False) for c in triples.LINKS]
    said = triples.entity_triples(gazetteer.with_safe_id(_entities(spark, folder)), once=False)
    return triples.union(triples.document_triples(latest, once=False), *made, *links, said)


@query
def typed_entity_triples(spark, folder):
    return triples.entity_triples(gazetteer.with_safe_id(_entities(spark, folder)))


@query
def kg_union_distinct(spark, folder):
    return _graph(spark, folder)


@query
def triples_by_predicate(spark, folder):
    return _graph(spark, folder).groupBy("p").agg(F.count("*").alias("n_triples"))


@query
def triples_by_subject(spark, folder):
    return triples.by_subject(_graph(spark, folder))


@query
def mentions_of_documents(spark, folder):
    return triples.with_predicate(_graph(spark, folder), triples.MENTIONS).select("s", "o")


@query
def graph_identifiers(spark, folder):
    return triples.identifiers(_graph(spark, folder))


@query
def document_ids(spark, folder):
    return triples.identifiers(_graph(spark, folder), "document")


@query
def url_by_id(spark, folder):
    return triples.urls(triples.document_triples(_latest(spark, folder)))


@query
def graph_ntriples(spark, folder):
    return triples.ntriples(triples.document_triples(_latest(spark, folder)))


@query
def chunk_triples(spark, folder):
    return triples.chunk_triples(_once(table(spark, folder, "chunk")), typed_entity_triples(spark, folder))


@query
def mention_existing_only(spark, folder):
    return triples.chunk_mentions(_once(table(spark, folder, "chunk")), typed_entity_triples(spark, folder)).select("s", "o")


# ---- sections and chunks -----------------------------------------------------------------------------------------------


@query
def header_path(spark, folder):
    return sections.with_paths(table(spark, folder, "content_list")).select("doc_id", "pos", "section", "header_path")


@query
def sections_text(spark, folder):
    return sections.text_chunks(table(spark, folder, "content_list"))


@query
def sections_split(spark, folder):
    return sections.text_chunks(table(spark, folder, "content_list"), sentence_splitter(100, 20))


@query
def section_tables(spark, folder):
    return sections.table_places(table(spark, folder, "content_list"))


@query
def table_markdown(spark, folder):
    return sections.table_chunks(table(spark, folder, "content_list"))


@query
def content_chunks(spark, folder):
    return sections.chunks(table(spark, folder, "content_list"))


@query
def chunk_windows(spark, folder):
    return windows.word_windows(table(spark, folder, "documents"))


@query
def chunk_prev_next(spark, folder):
    return windows.neighbours(windows.word_windows(table(spark, folder, "documents")))


@query
def group_into_windows(spark, folder):
    return windows.grouped_lines(table(spark, folder, "documents"))


@query
def chunk_markdown(spark, folder):
    return windows.markdown_dump(windows.grouped_lines(table(spark, folder, "documents")))


@query
def token_batches(spark, folder):
    rows = gazetteer.numbered(_entities(spark, folder).where("doc_id is not null"))
    return windows.batches(rows, "doc_id", "position", F.col("surface"), 20)


# ---- acronyms and entities ---------------------------------------------------------------------------------------------


@query
def inline_acronyms(spark, folder):
    return acronyms.inline(table(spark, folder, "documents"))


@query
def clean_acronyms(spark, folder):
    return acronyms.cleaned(acronyms.of_chunks(_once(table(spark, folder, "chunk"))))


def _initials(spark: SparkSession, folder: str) -> DataFrame:
    """Organisations' initials, as the acronyms that a detector would offer."""
    rows = _entities(spark, folder).where("label = 'ORG' and doc_id is not null")
    words = F.filter(F.split("surface", r"\s+"), lambda w: w.rlike("^[A-Z]"))
    short = F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    return rows.select("doc_id", short.alias("short"), F.col("surface").alias("long")).where(F.length("short") >= 2).groupBy("doc_id", "short").agg(F.min("long").alias("long"))


@query
def merge_acronyms(spark, folder):
    return acronyms.merged(acronyms.of_chunks(_once(table(spark, folder, "chunk"))), _initials(spark, folder))


@query
def invert_acronyms(spark, folder):
    return acronyms.inverted(acronyms.of_chunks(_once(table(spark, folder, "chunk"))), _initials(spark, folder))


@query
def acronym_patterns(spark, folder):
    made = acronyms.patterns(acronyms.of_chunks(_once(table(spark, folder, "chunk"))))
    return made.select("label", F.array_join("tokens", " ").alias("tokens"), "id").distinct()


@query
def llm_json_repair(spark, folder):
    said = acronyms.of_chunks(_once(table(spark, folder, "chunk")))
    pair = F.concat(F.lit("Here it is: {'"), F.col("short"), F.lit("': '"), F.replace("long", F.lit("'"), F.lit(" ")), F.lit("',}"))
    return acronyms.from_answers(said.select("doc_id", pair.alias("answer")))


@query
def llm_json_sizes(spark, folder):
    said = acronyms.of_chunks(_once(table(spark, folder, "chunk")))
    return said.select("doc_id", F.size(parse_answer(F.to_json(F.create_map("short", "long")))).alias("n_parsed"))


@query
def vocab_scrape(spark, folder):
    link = F.concat(F.lit('<li><a class="bc-link" href="'), F.col("id"), F.lit('?lang=en">'), F.col("pattern"), F.lit("</a></li>"))
    terms = table(spark, folder, "unbis_vocab").select(F.ascii("pattern").alias("page_id"), link.alias("link"))
    return gazetteer.scraped(terms.groupBy("page_id").agg(F.array_join(F.collect_list("link"), "\n").alias("html")))


@query
def vocabulary_patterns(spark, folder):
    return gazetteer.vocabulary_patterns(table(spark, folder, "unbis_vocab")).select("label", F.array_join("tokens", " ").alias("tokens"), "id")


@query
def gazetteer_mentions(spark, folder):
    return gazetteer.mentions(table(spark, folder, "documents"), gazetteer.vocabulary_patterns(table(spark, folder, "unbis_vocab")))


@query
def resolve_overlaps(spark, folder):
    return gazetteer.resolved(gazetteer_mentions(spark, folder))


@query
def entity_label_filter(spark, folder):
    return _entities(spark, folder).select("entity_id", "doc_id", "surface", "label")


@query
def dedupe_mentions(spark, folder):
    return gazetteer.first_mentions(table(spark, folder, "entities"))


# ---- linking -----------------------------------------------------------------------------------------------------------


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "entities").where("qid is not null and surface is not null")
    return known.select("qid", F.col("surface").alias("label")).distinct()


@query
def link_exact(spark, folder):
    return linker.exact(linker.lookups(_entities(spark, folder)), _labels(spark, folder)).select("name_lc", "type_lc", "name", "label", "qid")


def _all_lookups(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Every name to look up, and all that is known: labels of the knowledge base and the vocabulary's terms, which have no accents."""
    name = F.when(F.col("label") == "UNBIS_TERM", x.unaccent(F.col("name"))).otherwise(F.col("name"))
    terms = table(spark, folder, "unbis_vocab").select(F.col("id").alias("qid"), F.col("pattern").alias("label"))
    return linker.lookups(_entities(spark, folder)).withColumn("name", name), _labels(spark, folder).unionByName(terms)


@query
def link_cascade(spark, folder):
    return linker.cascade(*_all_lookups(spark, folder), 2)


@query
def fuzzy_candidates(spark, folder):
    found = linker.fuzzy(*_all_lookups(spark, folder))
    return found.withColumns({"rank": F.col("rank").cast("bigint"), "distance": F.col("distance").cast("bigint")})


def _tree(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    low = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
    return low.unionByName(region.select(F.col("r_name").alias("child"), F.lit("WORLD").alias("parent")))


@query
def class_closure(spark, folder):
    return linker.closure(_tree(spark, folder))


@query
def link_typed_closure(spark, folder):
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    candidates = customer.select(F.col("c_mktsegment").alias("name"), F.lit("ORG").alias("label"), F.col("c_custkey").alias("rank"), F.col("c_name").alias("qid"))
    kinds = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(F.col("c_name").alias("qid"), F.col("n_name").alias("class"))
    allowed = spark.createDataFrame([("ORG", "EUROPE")], "label string, class string")
    return linker.typed(candidates, kinds, linker.closure(_tree(spark, folder)), allowed)


def _cache(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "entities").where("surface is not null and label is not null")
    url = F.when(F.col("qid").isNotNull(), F.concat(F.lit(triples.WD), F.col("qid")))
    return rows.groupBy(F.lower("surface").alias("name_lc"), F.lower("label").alias("type_lc")).agg(F.min(url).alias("url"))


@query
def link_cache_literal(spark, folder):
    return linker.with_cache(linker.lookups(_entities(spark, folder)), _cache(spark, folder), "literal")


@query
def link_cache_intended(spark, folder):
    return linker.with_cache(linker.lookups(_entities(spark, folder)), _cache(spark, folder))


@query
def cache_upsert(spark, folder):
    return linker.updated_cache(_cache(spark, folder), link_exact(spark, folder))


@query
def country_facts(spark, folder):
    nation, region, customer = (table(spark, folder, t) for t in ("nation", "region", "customer"))
    qid = F.concat(F.lit("Q"), F.col("n_nationkey"))
    continent = nation.join(region, nation.n_regionkey == region.r_regionkey).select(qid.alias("qid"), F.lit("P30").alias("predicate"), F.col("r_name").alias("object"))
    counted = customer.groupBy("c_nationkey").agg(F.count("*").alias("n")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    population = counted.select(qid.alias("qid"), F.lit("P1082").alias("predicate"), F.col("n").cast("string").alias("object"))
    other = nation.select(qid.alias("qid"), F.lit("P999").alias("predicate"), F.lit("unwanted").alias("object"))
    return linker.country_facts(_kb(spark, folder), continent.unionByName(population).unionByName(other), ["P30", "P38", "P1082"])


# ---- annotation --------------------------------------------------------------------------------------------------------


@query
def annotate_entities(spark, folder):
    return annotate.entity_hits(_once(table(spark, folder, "chunk")), _entities(spark, folder))


@query
def annotate_acronyms(spark, folder):
    chunk = _once(table(spark, folder, "chunk"))
    return annotate.acronym_hits(chunk, acronyms.of_chunks(chunk))


@query
def annotated_chunks(spark, folder):
    chunk = _once(table(spark, folder, "chunk"))
    made = annotate.annotated(chunk.select("chunk_id", "doc_id", "text"), acronyms.of_chunks(chunk), _entities(spark, folder))
    short = F.transform("acronyms", lambda a: F.struct(F.lit("acronym").alias("kind"), a["short"].alias("said"), a["long"].alias("meant")))
    names = F.transform("entities", lambda e: F.struct(F.lit("entity").alias("kind"), e["surface"].alias("said"), F.lit(None).cast("string").alias("meant")))
    return made.select("chunk_id", F.explode(F.concat(short, names)).alias("a")).select("chunk_id", "a.*")


@query
def replace_doc_chunks(spark, folder):
    stored = _once(table(spark, folder, "chunk")).select("doc_id", "header_path", "text")
    return annotate.replaced(stored, sections.text_chunks(table(spark, folder, "content_list")).select("doc_id", "header_path", "text"))


# ---- the chunk graph ---------------------------------------------------------------------------------------------------


@query
def chunk_graph_edges(spark, folder):
    return cograph.edges(cograph.chunk_entities(table(spark, folder, "chunk")))


def _explained(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the acronyms they explain, each with its long form."""
    said = acronyms.of_chunks(_once(table(spark, folder, "chunk")))
    return said.select("doc_id", F.concat_ws("=", "short", "long").alias("entity")).distinct()


@query
def acronym_graph_edges(spark, folder):
    return cograph.edges(_explained(spark, folder), "doc_id")


@query
def graph_components(spark, folder):
    return cograph.member_components(_explained(spark, folder), "doc_id")


@query
def chunk_components(spark, folder):
    return cograph.member_components(cograph.chunk_entities(table(spark, folder, "chunk")))


@query
def communities(spark, folder):
    return cocommunities.member_communities(cograph.chunk_entities(table(spark, folder, "chunk")))


@query
def community_sizes(spark, folder):
    return cograph.largest(cograph.member_components(_explained(spark, folder), "doc_id"), "component")


@query
def chunk_community_sizes(spark, folder):
    return cograph.largest(communities(spark, folder))


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where("doc_id is not null").select(F.col("doc_id").alias("chunk_id"), "text")


def _members(spark: SparkSession, folder: str) -> DataFrame:
    """Documents grouped by their project, as communities known beforehand."""
    rows = table(spark, folder, "documents").where("projectid is not null and doc_id is not null")
    return rows.select(F.col("doc_id").alias("node"), F.substring("projectid", 2, 20).cast("bigint").alias("community"))


@query
def community_context(spark, folder):
    kept = summaries.members_within(_members(spark, folder), _texts(spark, folder), 2_000)
    return kept.select("community", "chunk_id", "tokens", "tokens_so_far")


@query
def community_texts(spark, folder):
    return summaries.contexts(summaries.members_within(_members(spark, folder), _texts(spark, folder), 2_000))


@query
def community_summaries(spark, folder):
    return summaries.summarised(chunk_community_texts(spark, folder), chat=leading_sentences)


@query
def community_triples(spark, folder):
    return summaries.community_triples(_members(spark, folder))


@query
def community_docs_new(spark, folder):
    members = _members(spark, folder)
    abstracts = members.groupBy("community").agg(F.concat(F.lit("Documents: "), F.count("*").cast("string")).alias("abstract"))
    graph = summaries.community_triples(members).unionByName(summaries.summary_triples(abstracts))
    # those of projects that have a document without a kind are stored already
    stored = table(spark, folder, "documents").where("docty is null and projectid is not null").select(F.concat(F.lit("community-"), F.substring("projectid", 2, 20).cast("bigint").cast("string")).alias("id"))
    return summaries.community_documents(graph, stored)


def _within(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of the chunk graph's communities, within the budget."""
    return summaries.members_within(communities(spark, folder), _once(table(spark, folder, "chunk")))


@query
def chunk_community_context(spark, folder):
    return _within(spark, folder).select("community", "chunk_id", "tokens", "tokens_so_far")


@query
def chunk_community_texts(spark, folder):
    return summaries.contexts(_within(spark, folder))


@query
def chunk_community_triples(spark, folder):
    return summaries.community_triples(communities(spark, folder))


@query
def chunk_community_docs_new(spark, folder):
    chunk, found = _once(table(spark, folder, "chunk")), communities(spark, folder)
    abstracts = summaries.summarised(summaries.contexts(summaries.members_within(found, chunk)), chat=leading_sentences)
    graph = summaries.community_triples(found).unionByName(summaries.summary_triples(abstracts))
    # those named after a chunk of a document without a kind are stored already
    kindless = table(spark, folder, "documents").where("docty is null").select("doc_id").distinct()
    stored = chunk.join(kindless, "doc_id").select(F.concat(F.lit("community-"), F.col("chunk_id").cast("string")).alias("id"))
    return summaries.community_documents(graph, stored)


# ---- vectors and chat --------------------------------------------------------------------------------------------------


def _asked(vectors_: DataFrame) -> DataFrame:
    """The stated queries: every vector whose id is divisible by 50."""
    return vectors_.where("vec_id % 50 = 0")


@query
def vector_topk(spark, folder):
    all_ = table(spark, folder, "embeddings")
    return vectors.nearest(all_, _asked(all_), 3).withColumn("rank", F.col("rank").cast("bigint"))


@query
def vector_topk_filtered(spark, folder):
    all_ = table(spark, folder, "embeddings")
    return vectors.nearest(all_, _asked(all_), 5, "label").withColumn("rank", F.col("rank").cast("bigint"))


def _vector_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select((F.col("doc_id") - 10_000_000).alias("vec_id"), F.coalesce("text", F.lit("")).alias("text"))


@query
def acronym_section(spark, folder):
    return vectors.joined_texts(vector_topk_filtered(spark, folder), _vector_texts(spark, folder), "---\n\n")


@query
def rag_prompt(spark, folder):
    questions = _asked(table(spark, folder, "embeddings")).select(F.col("vec_id").alias("query_id"), F.concat(F.lit("What is said of "), F.col("vec_id").cast("string"), F.lit("?")).alias("question"))
    return vectors.prompts(vectors.joined_texts(vector_topk(spark, folder), _vector_texts(spark, folder)), questions)


@query
def source_snippets(spark, folder):
    found = vector_topk(spark, folder).join(_vector_texts(spark, folder), "vec_id").withColumn("kind", F.lit(None).cast("string"))
    return vectors.snippets(found).select("query_id", "rank", "vec_id", "snippet")


@query
def embedded_chunks(spark, folder):
    rows = _once(table(spark, folder, "chunk")).select("chunk_id", "text")
    return vectors.embedded(rows).select("chunk_id", F.size("embedding").alias("n"))


@query
def chat_memory(spark, folder):
    turns = sections.elements(table(spark, folder, "content_list")).where("text is not null").select(F.col("doc_id").alias("conv_id"), F.col("pos").alias("turn"), F.col("type").alias("role"), "text")
    return chat.memory(turns, 200).select("conv_id", "turn", "role", "tokens", "tokens_so_far")


@query
def condensed_question(spark, folder):
    turns = sections.elements(table(spark, folder, "content_list")).where("text is not null").select(F.col("doc_id").alias("conv_id"), F.col("pos").alias("turn"), F.col("type").alias("role"), "text")
    questions = turns.select("conv_id").distinct().withColumn("question", F.lit("What changed?"))
    return chat.condensed(chat.memory(turns, 200), questions)


@query
def result_records(spark, folder):
    counted = _entities(spark, folder).where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n_entities"))
    short = acronyms.of_chunks(_once(table(spark, folder, "chunk"))).groupBy("doc_id").agg(F.count("*").alias("n_acronyms"))
    joined = counted.join(short, "doc_id", "full")
    return joined.select("doc_id", F.coalesce("n_acronyms", F.lit(0)).alias("n_acronyms"), F.coalesce("n_entities", F.lit(0)).alias("n_entities"))


# ---- sources and sinks, written and read again -----------------------------------------------------------------------


def _place(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query
def pages_read(spark, folder):
    """Metadata landed as response pages of 20 records."""
    numbered = table(spark, folder, "doc_metadata").withColumn("page", F.pmod(F.xxhash64("id", "fetched_at"), F.lit(50)))
    record = F.struct(*readers.FIELDS)
    entry = F.struct(F.concat(F.lit("D"), F.monotonically_increasing_id().cast("string")).alias("key"), F.to_json(record).alias("record"))
    joined = numbered.select("page", entry.alias("e")).groupBy("page").agg(F.array_join(F.collect_list(F.concat(F.lit('"'), F.col("e.key"), F.lit('":'), F.col("e.record"))), ",").alias("all"))
    path = _place(spark, "pages")
    # a page is a file, so it has a partition of its own
    joined.select("page", F.concat(F.lit('{"documents":{'), F.col("all"), F.lit(',"facets":[1]}}')).alias("value")).write.partitionBy("page").text(path)
    return readers.metadata_pages(spark, path).select(*readers.FIELDS)


@query
def graph_saved(spark, folder):
    """The documents' graph by load-or-build: built and saved, then loaded."""
    path = _place(spark, "graph")
    build = lambda: triples.document_triples(_latest(spark, folder))
    pipeline.load_or_build(spark, path, build)
    return pipeline.load_or_build(spark, path, lambda: build().limit(0))


@query
def graph_turtle(spark, folder):
    """The documents' graph as Turtle with prefixes."""
    path = _place(spark, "turtle")
    sinks.save_turtle(triples.document_triples(_latest(spark, folder)), path)
    return readers.turtle(spark, path)


@query
def vocabulary_saved(spark, folder):
    path = _place(spark, "vocabulary")
    sinks.save_vocabulary(table(spark, folder, "unbis_vocab"), path)
    return readers.vocabulary_file(spark, path)


@query
def table_saved(spark, folder):
    """Entities written as a CSV table and read again."""
    path = _place(spark, "csv")
    sinks.save_csv(_entities(spark, folder).select("entity_id", "label", "qid"), path)
    return spark.read.csv(path, header=True, schema="entity_id bigint, label string, qid string")


@query
def records_saved(spark, folder):
    """Chunks' annotations written as JSON lines and read again."""
    path = _place(spark, "json")
    sinks.save_json(acronyms.of_chunks(_once(table(spark, folder, "chunk"))), path)
    return spark.read.json(path, schema="doc_id bigint, short string, long string")


@query
def markdown_saved(spark, folder):
    """Windows of documents written as Markdown: the numbered headings that are read again."""
    path = _place(spark, "markdown")
    sinks.save_markdown(chunk_markdown(spark, folder), path)
    return spark.read.text(path).where(F.col("value").rlike("^## Chunk [0-9]+$")).groupBy("value").agg(F.count("*").alias("n"))


@query
def store_documents(spark, folder):
    """The index after a reset, chunks added, and those of some documents added again in place of theirs."""
    store, chunk = Store(spark, _place(spark, "store")), _once(table(spark, folder, "chunk")).select("chunk_id", "doc_id", "text").where("doc_id is not null and text is not null")
    store.rebuild(chunk)
    store.add(chunk.join(chunk.groupBy("doc_id").agg(F.min("chunk_id").alias("chunk_id"), F.count("*").alias("n")).where("n > 3").drop("n"), ["doc_id", "chunk_id"]).select(*chunk.columns))
    return store.documents()


@query
def store_new_documents(spark, folder):
    """Documents that are not in the index, which holds those of the chunks."""
    store = Store(spark, _place(spark, "store"))
    store.add(_once(table(spark, folder, "chunk")).select("chunk_id", "doc_id", "text").where("doc_id is not null and text is not null"))
    return store.new(table(spark, folder, "documents").select("doc_id").where("doc_id is not null"))


@query
def metadata_languages(spark, folder):
    return table(spark, folder, "documents").select("doc_id", readers.language(F.col("lang")).alias("code"))


@query
def same_as_links(spark, folder):
    """Countries of the graph that are items of the knowledge base."""
    linked = country_triples(spark, folder).where(F.col("p") == triples.SCHEMA + "sameAs")
    return linked.where(F.contains("o", F.lit("wikidata.org/entity/"))).select("s", x.last_segment(F.col("o")).alias("qid"))


@query
def tree_summaries(spark, folder):
    """The texts of each query's three vectors made one in two steps, by a stand-in for a model that keeps 60 characters."""
    return vectors.tree_summarised(vector_topk(spark, folder), _vector_texts(spark, folder), lambda texts: [t[:60] for t in texts], fan=2)


@query
def extracted_acronyms(spark, folder):
    """Acronyms that texts explain, as a document's whole extraction gives them."""
    return acronyms.extracted(table(spark, folder, "documents"))[0]


@query
def recognised_spans(spark, folder):
    """Spans of the default tagger, of the vocabulary and of each document's acronyms, without overlaps."""
    documents = table(spark, folder, "documents")
    listed = gazetteer.vocabulary_patterns(table(spark, folder, "unbis_vocab")).withColumn("doc_id", F.lit(None).cast("bigint"))
    own = acronyms.of_chunks(_once(table(spark, folder, "chunk"))).select("doc_id", F.lit("ACRONYM").alias("label"), F.array(F.lower("short")).alias("tokens"), F.col("short").alias("id"))
    return gazetteer.recognised(documents, capitalised_phrases, listed.unionByName(own))


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
