"""Entities linked with a knowledge base: cache, exact label, typed closure, fuzzy candidates."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle import prompts
from corpuscle.functions.text import cache_key, last_segment, sanitize_entity
from corpuscle.models import Chat
from corpuscle.session import cut_lineage

#: The classes of the knowledge base that an entity of a label may belong to.
CLASSES = {
    "CARDINAL": ["Q11229"], "DATE": ["Q205892"], "EVENT": ["Q1656682"], "FAC": ["Q13226383", "Q17334923"], "GPE": ["Q6256", "Q3624078"], "LANGUAGE": ["Q34770"], "LAW": ["Q7748"], "LOC": ["Q2221906"], "MONEY": ["Q1368"],
    "NORP": ["Q16334295", "Q9174"], "ORDINAL": ["Q628523"], "ORG": ["Q43229"], "PERCENT": ["Q11229"], "PERSON": ["Q5"], "PRODUCT": ["Q2424752"], "QUANTITY": ["Q47574"], "TIME": ["Q186408"], "WORK_OF_ART": ["Q838948"],
}
#: The properties of countries that are taken over, and the labels of their values.
COUNTRY_PROPERTIES = {"continent": "P30", "form_of_government": "P122", "political_system": "P1387", "currency": "P38", "official_language": "P37", "population": "P1082", "gdp_per_capita": "P2299"}
VALUE_LABELS = {"P30": "LOC", "P122": "ORG", "P1387": "ORG", "P38": "MONEY", "P37": "LANGUAGE", "P1082": "CARDINAL", "P2299": "MONEY"}


def lookups(mentions: DataFrame) -> DataFrame:
    """``name_lc, type_lc, name, label``: what is to be looked up, once, with a name that is fit for it."""
    named = mentions.where("surface is not null and surface <> '' and label is not null and label <> ''").withColumn("name", sanitize_entity(F.col("surface")))
    keyed = named.where("name is not null").groupBy(F.lower("name").alias("name_lc"), F.lower("label").alias("type_lc"))
    return keyed.agg(F.min("name").alias("name"), F.min("label").alias("label"))


def exact(wanted: DataFrame, labels: DataFrame) -> DataFrame:
    """``wanted`` with the ``qid`` whose label is the name itself; of several the smallest."""
    best = labels.where("label is not null").groupBy(F.col("label").alias("name")).agg(F.min("qid").alias("qid"))
    return wanted.join(best, "name", "left")


def closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """``node, ancestor``: every pair joined by edges, each node with itself too.

    Paths double in each round, so that a hierarchy takes rounds as the logarithm of its depth; rounds go on until none is new.
    """
    direct = edges.where(f"{child} is not null and {parent} is not null").select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).distinct()
    nodes = direct.select("node").union(direct.select(F.col("ancestor").alias("node"))).distinct()
    reach = cut_lineage(direct.union(nodes.select("node", F.col("node").alias("ancestor"))).distinct())
    size = reach.count()
    while True:
        further = reach.join(reach.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("far")), "ancestor").select("node", F.col("far").alias("ancestor"))
        reach = cut_lineage(reach.union(further).distinct())
        if (now := reach.count()) == size:
            break
        size = now
    return reach


def typed(candidates: DataFrame, kinds: DataFrame, above: DataFrame, allowed: DataFrame) -> DataFrame:
    """Of each name's ``candidates`` (``name, label, rank, qid``) the first of an allowed class, else the first of all.

    ``kinds`` has ``qid, class``, ``above`` is a closure of classes, ``allowed`` has ``label, class``.
    """
    classes = kinds.join(above.select(F.col("node").alias("class"), "ancestor"), "class").select("qid", F.col("ancestor").alias("class")).distinct()
    valid = candidates.select("qid", "label").distinct().join(classes, "qid").join(allowed, ["label", "class"]).select("qid", "label").distinct().withColumn("valid", F.lit(1))
    marked = candidates.join(valid, ["qid", "label"], "left").withColumn("valid", F.coalesce("valid", F.lit(0)))
    order = Window.partitionBy("name", "label").orderBy(F.desc("valid"), "rank", "qid")
    return marked.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("name", "label", "qid", (F.col("valid") == 1).alias("valid"))


def fuzzy(wanted: DataFrame, labels: DataFrame, limit: int = 10, most: int = 3) -> DataFrame:
    """``name, rank, qid, distance``: the ``limit`` nearest labels of each name, up to ``most`` edits.

    A name meets the labels that share one of ``most`` + 1 pieces with it at nearly the same place: with fewer edits than
    pieces, one piece is whole. So the join is an equality on pieces, and no pair within ``most`` edits is missed.
    """

    def pieces(n_of: str):
        return F.expr(
            f"transform(sequence(0, {most}), k -> struct(k as k, cast(floor(k * {n_of} / {most + 1}) as int) as at, "
            f"cast(floor((k + 1) * {n_of} / {most + 1}) as int) - cast(floor(k * {n_of} / {most + 1}) as int) as len))"
        )

    names = wanted.select("name").distinct().withColumn("n", F.length("name"))
    known = labels.where("label is not null").select("qid", "label").distinct().withColumn("m", F.length("label"))
    cut = known.select("qid", "label", "m", F.explode(pieces("m")).alias("p"))
    keyed = cut.select("qid", "label", "m", "p.k", "p.at", "p.len", F.substring("label", F.col("p.at") + 1, F.col("p.len")).alias("piece"))
    # where a piece of a label of length m may stand in a name of nearly that length
    asked = (
        names.select("name", F.explode(F.sequence(F.greatest(F.lit(1), F.col("n") - most), F.col("n") + most)).alias("m"))
        .select("name", "m", F.explode(pieces("m")).alias("p"))
        .select("name", "m", "p.k", "p.len", F.explode(F.sequence(F.greatest(F.lit(0), F.col("p.at") - most), F.col("p.at") + most)).alias("place"))
        .select("name", "m", "k", F.substring("name", F.col("place") + 1, F.col("len")).alias("piece")).distinct()
    )
    pairs = asked.join(keyed.select("qid", "label", "m", "k", "piece"), ["m", "k", "piece"]).select("name", "qid", "label").distinct()
    near = pairs.withColumn("distance", F.levenshtein("name", "label")).where(F.col("distance") <= most)
    order = Window.partitionBy("name").orderBy("distance", "label", "qid")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).select("name", "rank", "qid", "distance")


def cascade(wanted: DataFrame, labels: DataFrame, most: int = 3) -> DataFrame:
    """``name_lc, type_lc, name, label, qid, how``: by the exact label, else by the nearest, else null."""
    hit = exact(wanted, labels)
    rest = hit.where("qid is null")
    nearest = fuzzy(rest, labels, 1, most).select("name", F.col("qid").alias("near"))
    found = hit.join(nearest, "name", "left")
    how = F.when(F.col("qid").isNotNull(), "exact").when(F.col("near").isNotNull(), "fuzzy")
    return found.select("name_lc", "type_lc", "name", "label", F.coalesce("qid", "near").alias("qid"), how.alias("how"))


def allowed_classes(spark: SparkSession) -> DataFrame:
    """``label, class`` of CLASSES."""
    return spark.createDataFrame([(label, c) for label, classes in CLASSES.items() for c in classes], "label string, class string")


def by_model(batches: DataFrame, chat: Chat) -> DataFrame:
    """``name, label, qid, confidence`` from a model's answers about batches of ``name (label)`` lines.

    ``batches`` has ``batch`` and ``lines`` (see windows.batches for batches within a budget of tokens). Answers that
    can't be read, and items of another form, give nothing.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = chat([prompts.LINKING + "\n".join(lines) for lines in frame["lines"]])
            found = [item for answer in answers for item in _items(answer)]
            yield pd.DataFrame(found, columns=["name", "label", "qid", "confidence"])

    return batches.mapInPandas(run, "name string, label string, qid string, confidence int")


def _items(answer: str | None) -> list[tuple]:
    listed = re.search(r"\[.*\]", answer or "", re.S)
    try:
        items = json.loads(listed[0]) if listed else []
    except ValueError:
        return []
    out = []
    for item in items if isinstance(items, list) else []:
        if isinstance(item, list) and len(item) == 4 and item[0]:
            qid = item[2] if isinstance(item[2], str) and re.fullmatch(r"Q\d+", item[2]) else None
            out.append((str(item[0]), str(item[1]), qid, item[3] if isinstance(item[3], int) else None))
    return out


def with_cache(wanted: DataFrame, cache: DataFrame, mode: str = "intended") -> DataFrame:
    """``wanted`` against a cache of ``name_lc, type_lc, url`` (null for names known to have none).

    ``intended`` gives hits with their qid and names that aren't cached with null and ``known`` false; ``literal`` leaves
    everything cached out of the result.
    """
    known = cache.select("name_lc", "type_lc", "url").dropDuplicates(["name_lc", "type_lc"]).withColumn("known", F.lit(True))
    if mode == "literal":
        return wanted.join(known, ["name_lc", "type_lc"], "left_anti")
    joined = wanted.join(known, ["name_lc", "type_lc"], "left")
    return joined.select(*wanted.columns, last_segment(F.col("url")).alias("qid"), F.coalesce("known", F.lit(False)).alias("known"))


def cache_entries(cached: DataFrame) -> DataFrame:
    """``name_lc, type_lc, url`` from rows of ``key`` (name|type) and ``url``; keys without a bar are left out."""
    parts = F.split("key", r"\|", 2)
    usable = cached.where(F.col("key").contains("|"))
    return usable.select(F.lower(parts[0]).alias("name_lc"), F.lower(parts[1]).alias("type_lc"), "url")


def updated_cache(cache: DataFrame, linked: DataFrame) -> DataFrame:
    """``cache`` with the results of ``linked`` (``name_lc, type_lc, qid``), which replace what it had; misses are kept as null."""
    new = linked.select("name_lc", "type_lc", F.when(F.col("qid").isNotNull(), F.concat(F.lit("http://www.wikidata.org/entity/"), F.col("qid"))).alias("url")).dropDuplicates(["name_lc", "type_lc"])
    kept = cache.select("name_lc", "type_lc", "url").join(new, ["name_lc", "type_lc"], "left_anti")
    return kept.unionByName(new)


def keys(mentions: DataFrame) -> DataFrame:
    """``key`` of each mention in the cache."""
    return mentions.select(cache_key(F.col("surface"), F.col("label")).alias("key")).distinct()


def country_facts(countries: DataFrame, facts: DataFrame, properties: list[str]) -> DataFrame:
    """``key, predicate, object, named``: the facts of each country by its qid, of the given properties; an object is named once."""
    wanted = facts.where(F.col("predicate").isin(*properties))
    joined = countries.join(wanted, "qid").select("key", "predicate", "object").distinct()
    order = Window.partitionBy("object").orderBy("key", "predicate")
    return joined.withColumn("named", F.row_number().over(order) == 1)
