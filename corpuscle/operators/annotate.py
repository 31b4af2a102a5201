"""Chunks annotated with the acronyms and entities of their document, by substring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def acronym_hits(chunks: DataFrame, acronyms: DataFrame) -> DataFrame:
    """``chunk_id, short, long``: acronyms of a chunk's document whose short or long form stands in its text, case and all.

    Chunks meet the acronyms of their own document only, which is an equality; empty forms match nothing.
    """
    pairs = chunks.select("chunk_id", "doc_id", "text").join(acronyms.select("doc_id", "short", "long"), "doc_id")
    has = lambda c: (F.coalesce(F.col(c), F.lit("")) != "") & F.contains("text", c)
    return pairs.where(has("short") | has("long")).select("chunk_id", "short", "long").distinct()


def entity_hits(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """``chunk_id, surface``: entities of a chunk's document whose surface stands in its text, whatever the case."""
    pairs = chunks.select("chunk_id", "doc_id", F.lower("text").alias("text")).join(entities.where("surface is not null and surface <> ''").select("doc_id", "surface").distinct(), "doc_id")
    return pairs.where(F.contains("text", F.lower("surface"))).select("chunk_id", "surface").distinct()


def annotated(chunks: DataFrame, acronyms: DataFrame, entities: DataFrame) -> DataFrame:
    """``chunks`` with arrays ``acronyms`` and ``entities`` of what was found, empty where nothing was."""
    short = acronym_hits(chunks, acronyms).groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("short", "long"))).alias("acronyms"))
    names = entity_hits(chunks, entities).groupBy("chunk_id").agg(F.array_sort(F.collect_list("surface")).alias("surfaces"))
    details = entities.select("doc_id", "surface", "label", "qid").dropDuplicates(["doc_id", "surface"])
    said = (
        names.select("chunk_id", F.explode("surfaces").alias("surface")).join(chunks.select("chunk_id", "doc_id"), "chunk_id").join(details, ["doc_id", "surface"])
        .groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("surface", "label", "qid"))).alias("entities"))
    )
    bare = chunks.drop("acronyms", "entities")
    joined = bare.join(short, "chunk_id", "left").join(said, "chunk_id", "left")
    nothing = F.expr("cast(array() as array<struct<surface:string,label:string,qid:string>>)")
    return joined.withColumn("acronyms", F.coalesce("acronyms", F.expr("cast(array() as array<struct<short:string,long:string>>)"))).withColumn("entities", F.coalesce("entities", nothing))


def replaced(stored: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """``stored`` with all rows of the documents in ``new`` replaced by those of ``new``."""
    kept = stored.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new.select(*stored.columns))
