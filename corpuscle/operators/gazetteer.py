"""Patterns found in texts by their words, overlaps resolved, and the entities that come of it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.text import rdf_safe, without_query

#: Labels that are no entities of the graph.
EXCLUDED = ("DATE", "TIME", "PERCENT", "MONEY", "QUANTITY", "ORDINAL", "CARDINAL", "PERSON")
#: Words are runs of letters and digits; hyphens and apostrophes may stand within.
TOKEN = r"[\p{L}\p{N}]+(?:[-'’][\p{L}\p{N}]+)*"


def vocabulary_patterns(vocabulary: DataFrame) -> DataFrame:
    """``label, tokens, id`` of each term of a controlled vocabulary."""
    usable = vocabulary.where("pattern is not null and pattern <> ''")
    return usable.select(F.col("label"), F.filter(F.split(F.lower("pattern"), r"(?U)\s+"), lambda w: w != "").alias("tokens"), "id")


def scraped(pages: DataFrame, html: str = "html") -> DataFrame:
    """``term, href`` of the vocabulary links of HTML pages: of one term the last link, without its query.

    Links are those of class bc-link into /thesaurus/, whatever the order of their attributes.
    """
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*>[^<]*</a>"), F.lit(0))
    own = lambda a, pattern: F.regexp_extract(a, pattern, 1)
    read = F.transform(anchors, lambda a: F.struct(own(a, r"(?is)^<a\s[^>]*?\bclass=[\"']([^\"']*)[\"']").alias("class"), own(a, r"(?is)^<a\s[^>]*?\bhref=[\"']([^\"']*)[\"']").alias("href"), own(a, r"(?is)>([^<]*)</a>$").alias("term")))
    wanted = F.filter(read, lambda x: F.array_contains(F.split(x["class"], r"\s+"), "bc-link") & x["href"].contains("/thesaurus/"))
    each = pages.select("page_id", F.posexplode(wanted).alias("at", "x"))
    named = each.select(F.struct("page_id", "at").alias("place"), F.trim("x.term").alias("term"), without_query(F.col("x.href")).alias("href"))
    return named.where("term <> ''").groupBy("term").agg(F.max_by("href", "place").alias("href"))


def tokens(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, words``: the words of each text in lower case."""
    return documents.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)).alias("words"))


def mentions(documents: DataFrame, patterns: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, start, length, label, id``: where the words of a pattern stand in a text.

    Each word of a text, with as many after it as the longest pattern has, meets the patterns that begin with it; so the
    join is an equality, with no pass over all pairs of texts and patterns.
    """
    usable = patterns.where(F.size("tokens") > 0).select("label", "id", "tokens", F.get("tokens", F.lit(0)).alias("first"), F.size("tokens").alias("length")).distinct()
    most = usable.agg(F.max("length")).first()[0] or 1
    cell = lambda w, i: F.struct(i.alias("start"), w.alias("first"), F.slice("words", i + 1, F.lit(most)).alias("run"))
    each = tokens(documents, key, text).select(key, F.explode(F.transform("words", cell)).alias("r")).select(key, "r.*")
    return each.join(usable, "first").where(F.slice("run", F.lit(1), F.col("length")) == F.col("tokens")).select(key, "start", "length", "label", "id")


def resolved(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``found`` without overlaps: the longest first, then the earliest. A text's own mentions make one group."""
    kinds = found.select(key, "start", "length", "label", "id").schema

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        taken: set[int] = set()
        kept = []
        for row in frame.sort_values(["length", "start", "label", "id"], ascending=[False, True, True, True]).itertuples():
            span = range(row.start, row.start + row.length)
            if taken.isdisjoint(span):
                taken.update(span)
                kept.append(row.Index)
        return frame.loc[sorted(kept)]

    return found.select(key, "start", "length", "label", "id").groupBy(key).applyInPandas(run, kinds)


def entities(collected: DataFrame) -> DataFrame:
    """Mentions with a surface and a label that isn't excluded; identical repeated rows count once."""
    usable = collected.where("surface is not null and trim(surface) <> '' and label is not null")
    return usable.where(~F.col("label").isin(*EXCLUDED)).dropDuplicates(["entity_id"])


def with_safe_id(collected: DataFrame) -> DataFrame:
    """``collected`` with ``safe``: the entity's qid, or its surface as an identifier."""
    return collected.withColumn("safe", F.coalesce(F.nullif("qid", F.lit("")), rdf_safe(F.col("surface"))))


def first_mentions(collected: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, name_lc, type_lc, surface, label, n``: each name and type of a document once, as first written."""
    usable = collected.where(F.col(key).isNotNull() & F.col("surface").isNotNull() & (F.col("surface") != "") & F.col("label").isNotNull() & (F.col("label") != ""))
    grouped = usable.groupBy(key, F.lower("surface").alias("name_lc"), F.lower("label").alias("type_lc"))
    return grouped.agg(F.min(F.struct("entity_id", "surface", "label")).alias("m"), F.count_distinct("entity_id").alias("n")).select(key, "name_lc", "type_lc", "m.surface", "m.label", "n")


def numbered(collected: DataFrame, key: str = "doc_id") -> DataFrame:
    """``collected`` with ``position`` by entity_id within each document."""
    order = Window.partitionBy(key).orderBy("entity_id")
    return collected.withColumn("position", F.row_number().over(order))


def tagged(documents: DataFrame, tagger, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, surface, label`` by a tagger (texts -> lists of (surface, label)), in Arrow batches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(k, s, label) for k, said in zip(frame[key], tagger(list(frame[text])), strict=True) for s, label in said]
            yield pd.DataFrame(found, columns=[key, "surface", "label"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.where(F.col(text).isNotNull()).select(key, text).mapInPandas(run, f"{key} {kind}, surface string, label string")


def located(found: DataFrame, documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, start, length, label, id``: where the words of a tagger's ``surface`` stand in its document; ``id`` is null.

    Each word of a text, with as many after it as the document's longest surface has, meets the surfaces of the document
    that begin with it.
    """
    words = F.regexp_extract_all(F.lower("surface"), F.lit(TOKEN), F.lit(0))
    named = found.where("surface is not null and label is not null").select(key, "label", words.alias("tokens")).where(F.size("tokens") > 0).distinct()
    named = named.withColumns({"first": F.get("tokens", F.lit(0)), "length": F.size("tokens")})
    most = named.groupBy(key).agg(F.max("length").alias("most"))
    each = tokens(documents, key, text).join(most, key).select(key, "words", "most", F.posexplode("words").alias("start", "first"))
    runs = each.select(key, "start", "first", F.slice("words", F.col("start") + 1, F.col("most")).alias("run"))
    return runs.join(named, [key, "first"]).where(F.slice("run", F.lit(1), F.col("length")) == F.col("tokens")).select(key, "start", "length", "label", F.lit(None).cast("string").alias("id"))


def recognised(documents: DataFrame, tagger, patterns: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, start, length, label, id`` of a tagger and of patterns together, without overlaps.

    What the tagger found stays, as patterns are applied to a text that is already tagged; of patterns the longest goes first,
    then the earliest. Of spans of the tagger that overlap, the longest stays. ``patterns`` are those of vocabularies and of
    the documents' acronyms (with a column ``key`` for patterns of one document only).
    """
    seen = resolved(located(tagged(documents, tagger, key, text), documents, key, text), key)
    if key in patterns.columns:
        everywhere, own = patterns.where(F.col(key).isNull()).drop(key), patterns.where(F.col(key).isNotNull())
        local = own.select(key, F.array_join("tokens", " ").alias("surface"), "label", "id")
        at_home = located(local.select(key, "surface", F.concat_ws("\u0001", "label", "id").alias("label")), documents, key, text)
        split = F.split("label", "\u0001")
        ruled = mentions(documents, everywhere, key, text).unionByName(at_home.select(key, "start", "length", split[0].alias("label"), split[1].alias("id")))
    else:
        ruled = mentions(documents, patterns, key, text)
    cover = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("at")
    taken = seen.select(key, cover).distinct()
    free = ruled.select(key, "start", "length", "label", "id", cover).join(taken.withColumn("taken", F.lit(1)), [key, "at"], "left")
    kept = free.groupBy(key, "start", "length", "label", "id").agg(F.max("taken").alias("taken")).where("taken is null").drop("taken")
    return seen.unionByName(resolved(kept, key))


def spans_as_entities(spans: DataFrame, documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, surface, label, id, qid`` of spans whose label isn't excluded; the surface is the span's words in lower case."""
    words = spans.join(tokens(documents, key, text), key)
    surface = F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ")
    return words.where(~F.col("label").isin(*EXCLUDED)).select(key, surface.alias("surface"), "label", "id", F.lit(None).cast("string").alias("qid"))
