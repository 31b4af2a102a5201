"""Acronyms: found in running text, cleaned, merged, inverted, and turned into patterns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle import prompts
from corpuscle.functions.pandas_text import inline_abbreviations, parse_answer, unescape
from corpuscle.functions.text import token_count
from corpuscle.models import Chat

#: An acronym's length and share of capitals at least.
LEAST_LENGTH, LEAST_UPPER = 2, 0.5


def inline(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, short, long``: the abbreviations that a text explains; of one short form its first long form."""
    usable = documents.where(F.col(key).isNotNull() & F.col(text).contains("("))
    found = usable.select(key, F.explode(inline_abbreviations(text)).alias("a"))
    return found.select(key, "a.short", "a.long").dropDuplicates([key, "short"])


def from_answers(answers: DataFrame, key: str = "doc_id", answer: str = "answer") -> DataFrame:
    """``key, short, long`` from a model's answers; what can't be repaired gives nothing."""
    parsed = answers.select(key, F.explode(parse_answer(answer)).alias("short", "long"))
    return parsed.where("short is not null and short <> ''")


def by_model(documents: DataFrame, chat: Chat, key: str = "doc_id", text: str = "text", most: int = prompts.MOST, shared: int = prompts.SHARED) -> DataFrame:
    """``key, short, long`` as a model finds them; of one short form the first in the text.

    A text above ``most`` characters is put into several prompts, each with the last ``shared`` characters of the one before.
    """
    kind = documents.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({key: frame[key], "part": frame["part"], "answer": chat([prompts.ACRONYMS + t for t in frame["piece"]])})

    starts = F.sequence(F.lit(0), F.floor(F.greatest(F.length(text) - shared - 1, F.lit(0)) / (most - shared)).cast("int"))
    parts = documents.where(F.col(text).isNotNull()).select(key, F.col(text).alias("piece"), F.explode(starts).alias("part"))
    asked = parts.select(key, "part", F.substring("piece", F.col("part") * (most - shared) + 1, F.lit(most)).alias("piece")).mapInPandas(run, f"{key} {kind}, part int, answer string")
    found = asked.select(key, "part", F.explode(parse_answer("answer")).alias("short", "long")).where("short is not null and short <> ''")
    return found.groupBy(key, "short").agg(F.min_by("long", "part").alias("long"))


def extracted(documents: DataFrame, chat: Chat | None = None, sections: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``key, short, long, conflict`` and ``key, long, short`` of documents: what a model finds in their acronym sections goes before what texts explain.

    ``sections`` has ``key`` and ``text`` (see vectors.joined_texts for sections that were looked up); without a model only
    what texts explain is taken.
    """
    told = cleaned(inline(documents, key, text)).withColumnRenamed(key, "doc_id")
    asked = cleaned(by_model(sections if sections is not None else documents, chat, key, text)).withColumnRenamed(key, "doc_id") if chat else told.limit(0)
    both, names = merged(asked, told), inverted(asked, told)
    return both.withColumnRenamed("doc_id", key), names.withColumnRenamed("doc_id", key)


def keepable(acronyms: DataFrame) -> DataFrame:
    """Those that are long enough and mostly capitals."""
    upper = F.length(F.regexp_replace("short", r"[^\p{Lu}]", "")) / F.length("short")
    return acronyms.where((F.length("short") >= LEAST_LENGTH) & (upper >= LEAST_UPPER))


def cleaned(acronyms: DataFrame) -> DataFrame:
    """Those worth keeping, with character references of their long form read."""
    return keepable(acronyms).withColumn("long", unescape("long"))


def of_chunks(chunk: DataFrame) -> DataFrame:
    """``doc_id, short, long`` of the chunks' acronyms; of one short form in a document the smallest long form."""
    usable = chunk.where("chunk_id is not null and doc_id is not null")
    each = usable.select("doc_id", F.explode("acronyms").alias("a")).select("doc_id", "a.short", "a.long")
    return each.where("short is not null and short <> '' and long is not null").groupBy("doc_id", "short").agg(F.min("long").alias("long"))


def merged(primary: DataFrame, detected: DataFrame) -> DataFrame:
    """``doc_id, short, long, conflict``: both dictionaries; where they differ the primary one holds, marked as a conflict."""
    p = primary.select("doc_id", "short", F.col("long").alias("p_long"))
    d = detected.select("doc_id", "short", F.col("long").alias("d_long"))
    both = p.join(d, ["doc_id", "short"], "full")
    conflict = F.coalesce(F.col("p_long") != F.col("d_long"), F.lit(False))
    return both.select("doc_id", "short", F.coalesce("p_long", "d_long").alias("long"), conflict.alias("conflict"))


def inverted(primary: DataFrame, detected: DataFrame) -> DataFrame:
    """``doc_id, long, short`` over both, the primary first; of several short forms the smallest."""
    ranked = primary.select("doc_id", "long", "short", F.lit(0).alias("rank")).unionByName(detected.select("doc_id", "long", "short", F.lit(1).alias("rank")))
    return ranked.where("long is not null").groupBy("doc_id", "long").agg(F.min(F.struct("rank", "short"))["short"].alias("short"))


def patterns(acronyms: DataFrame) -> DataFrame:
    """``label, tokens, id``: a pattern for each short form, and one for each long form."""
    short = acronyms.select(F.lit("ACRONYM").alias("label"), F.array(F.lower("short")).alias("tokens"), F.col("short").alias("id"))
    words = F.filter(F.split(F.lower("long"), r"(?U)\s+"), lambda w: w != "")
    long = acronyms.where("long is not null and long <> ''").select(F.lit("ACRONYM_EXPANDED").alias("label"), words.alias("tokens"), F.col("long").alias("id"))
    return short.unionByName(long).distinct()


def sizes(acronyms: DataFrame) -> DataFrame:
    """``doc_id, n_acronyms, n_tokens`` of each dictionary."""
    return acronyms.groupBy("doc_id").agg(F.count("*").alias("n_acronyms"), F.sum(token_count(F.col("long"))).alias("n_tokens"))
