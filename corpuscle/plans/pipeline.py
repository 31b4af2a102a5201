"""The whole pipeline as composed tables: graph, chunks, annotation, chunk graph, communities, index."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.models import Chat, Embedder, hashed_embedding, leading_sentences
from corpuscle.operators import acronyms, annotate, cograph, gazetteer, linker, metadata, sections, summaries, triples, vectors
from corpuscle.session import cut_lineage, deleted, exists
from corpuscle.sources import readers, sinks


def build_graph(records: DataFrame, kb: DataFrame | None = None) -> DataFrame:
    """Metadata to triples: classes, documents, countries, trust funds, projects, the links between them, and fallbacks."""
    latest = cut_lineage(metadata.sanitized(metadata.latest_versions(records)))
    classes = [triples.class_triples(latest, k, n, p) for k, n, p in (("document", "Document", tuple(triples.PROPERTIES.values())), ("trustfund", "Trust Fund", ()), ("project", "Project", ()))]
    funds = triples.instance_triples(triples.zipped(latest, "trustfund_key", "trustfund"), "trustfund", "id", "name")
    projects = triples.instance_triples(triples.zipped(latest, "projectid", "projn"), "project", "id", "name")
    own = cut_lineage(triples.union(triples.identifier_property(latest.sparkSession), *classes, triples.document_triples(latest), triples.country_triples(latest, kb), funds, projects))
    links = [triples.link_triples(latest, c) for c in triples.LINKS]
    fallbacks = [triples.fallback_triples(latest, c, own) for c in triples.LINKS]
    return triples.union(own, *links, *fallbacks)


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False, caches: tuple[str, ...] = ()) -> DataFrame:
    """The graph saved at ``path``; one made by ``build`` and saved there where there is none, or on ``rebuild``, which also deletes ``caches``."""
    if rebuild:
        for place in (path, *caches):
            deleted(spark, place)
    if not exists(spark, path):
        sinks.save_graph(build(), path)
    return readers.ntriples(spark, path)


def new_documents(incoming: DataFrame, stored: DataFrame, key: str = "doc_id") -> DataFrame:
    """Those of ``incoming`` that have no chunks in ``stored`` yet."""
    return incoming.join(stored.select(key).distinct(), key, "left_anti")


@dataclass
class Corpus:
    """The tables that a run makes; each is a plan until it is read or written."""

    chunks: DataFrame
    acronyms: DataFrame
    entities: DataFrame
    annotated: DataFrame
    graph: DataFrame
    edges: DataFrame
    communities: DataFrame
    abstracts: DataFrame
    index: DataFrame


def run(
    records: DataFrame, content: DataFrame, documents: DataFrame, mentions: DataFrame, labels: DataFrame, kb: DataFrame | None = None, embed: Embedder = hashed_embedding, chat: Chat = leading_sentences, budget: int = summaries.BUDGET
) -> Corpus:
    """Every stage for the documents of ``content``.

    ``documents`` has ``doc_id, text``; ``mentions`` what taggers and gazetteers collected (``entity_id, doc_id, surface,
    label, qid``); ``labels`` the names of the knowledge base (``qid, label``).
    """
    chunks = cut_lineage(sections.chunks(content))
    explained = cut_lineage(acronyms.cleaned(acronyms.inline(documents)))
    kept = gazetteer.entities(mentions)
    known = linker.exact(linker.lookups(kept), labels).select(F.col("name_lc").alias("n"), F.col("type_lc").alias("t"), F.col("qid").alias("found"))
    named = kept.join(known, (F.lower("surface") == F.col("n")) & (F.lower("label") == F.col("t")), "left").drop("n", "t")
    entities = cut_lineage(gazetteer.with_safe_id(named.withColumn("qid", F.coalesce("qid", "found")).drop("found")))
    marked = cut_lineage(annotate.annotated(chunks, explained, entities))
    built = triples.union(build_graph(records, kb), triples.entity_triples(entities))
    safe = gazetteer.with_safe_id(marked.select("chunk_id", F.explode("entities").alias("e")).select("chunk_id", "e.surface", "e.qid"))
    numbers = chunks.select("chunk_id").distinct().withColumn("node", F.xxhash64("chunk_id"))
    members = safe.join(numbers, "chunk_id").select(F.col("node"), F.col("safe").alias("entity")).distinct()
    edges = cut_lineage(cograph.edges(members, "node"))
    found = cut_lineage(cograph.communities(edges))
    texts = chunks.join(numbers, "chunk_id").select(F.col("node").alias("chunk_id"), "text")
    abstracts = cut_lineage(summaries.summarised(summaries.contexts(summaries.members_within(found, texts, budget)), chat=chat))
    graph = triples.union(built, summaries.community_triples(found), summaries.summary_triples(abstracts))
    rows = chunks.select(F.col("chunk_id").alias("id"), F.col("doc_id").cast("string").alias("ref_doc_id"), F.lit("chunk").alias("kind"), "text")
    stored = rows.select("id").limit(0)
    communities = summaries.community_documents(graph, stored).select("id", F.lit(None).cast("string").alias("ref_doc_id"), "kind", "text")
    index = vectors.embedded(rows.unionByName(communities), embed=embed)
    return Corpus(chunks, explained, entities, marked, graph, edges, found, abstracts, index)
