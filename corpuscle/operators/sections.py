"""Page elements to header-aware chunks: an ordered fold over each document, as running values.

A header is a text element with a level; it ends the section before it and puts its text in place of the headers of its
own and deeper levels. A blank header only ends the section. A table is a chunk of its own under the path at its place
and stands before the text chunks of its section; images and other types give nothing. The text of a section is split into
chunks of a bounded number of tokens (see splitting). Deliveries of an element are made one before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.pandas_text import table_to_markdown
from corpuscle.functions.text import header_line, stripped
from corpuscle.operators.ordered import running_last
from corpuscle.operators.splitting import Splitter, sentence_splitter

LEVELS = 6


def elements(content: DataFrame) -> DataFrame:
    """Each (doc_id, pos) once; elements without either are left out."""
    usable = content.where("doc_id is not null and pos is not null")
    return usable.select("doc_id", "pos", "type", "text", "text_level", "table_body").dropDuplicates(["doc_id", "pos"])


def with_paths(content: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Elements with ``section`` (the position of the section's first element) and ``header_path``."""
    rows = elements(content)
    header = (F.col("type") == "text") & F.col("text_level").isNotNull()
    title = stripped(F.coalesce("text", F.lit("")))
    named = header & (title != "")
    values: dict[str, Column] = {"mark": F.when(header, F.struct("pos"))}
    for k in range(1, levels + 1):
        values[f"h{k}"] = F.when(named & (F.col("text_level") == k), F.struct(F.col("pos"), title.alias("h")))
    placed = running_last(rows, ["doc_id"], "pos", values)
    # a header holds until one of its own or a higher level follows
    held = [
        F.when(F.col(f"h{k}.pos") > F.greatest(F.lit(-1), F.lit(-1), *(F.coalesce(F.col(f"h{j}.pos"), F.lit(-1)) for j in range(1, k))), F.col(f"h{k}.h"))
        for k in range(1, levels + 1)
    ]
    joined = F.concat_ws("/", *held)
    path = F.when(joined == "", F.lit("/")).otherwise(F.concat(F.lit("/"), joined, F.lit("/")))
    return placed.select("doc_id", "pos", "type", "text", "text_level", "table_body", F.coalesce(F.col("mark.pos"), F.lit(-1)).alias("section"), path.alias("header_path"))


def section_texts(content: DataFrame) -> DataFrame:
    """``doc_id, section, header_path, text`` of each section with text, its header line first."""
    rows = with_paths(content).where("type = 'text'")
    header = F.col("text_level").isNotNull()
    title = stripped(F.coalesce("text", F.lit("")))
    line = F.when(header, F.when(title != "", header_line(F.col("text_level"), title))).otherwise(F.coalesce("text", F.lit("")))
    lines = rows.select("doc_id", "section", "header_path", "pos", line.alias("line")).where("line is not null")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    grouped = lines.groupBy("doc_id", "section", "header_path").agg(ordered.alias("lines"))
    text = stripped(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"))
    return grouped.select("doc_id", "section", "header_path", text.alias("text")).where("text <> ''")


def text_chunks(content: DataFrame, splitter: Splitter | None = None) -> DataFrame:
    """``doc_id, section, header_path, split, text``: the texts of sections in chunks by ``splitter``, 1,024 tokens with an overlap of 20 if none is given."""
    split = (splitter or sentence_splitter())(F.col("text"))
    return section_texts(content).select("doc_id", "section", "header_path", F.posexplode(split).alias("split", "text"))


def table_places(content: DataFrame) -> DataFrame:
    """``doc_id, section, pos, header_path, table_body`` of each table with a body."""
    return with_paths(content).where("type = 'table' and table_body is not null").select("doc_id", "section", "pos", "header_path", "table_body")


def table_chunks(content: DataFrame) -> DataFrame:
    """Tables as Markdown; bodies without a table are left out."""
    return table_places(content).select("doc_id", "section", "pos", "header_path", table_to_markdown("table_body").alias("text")).where("text is not null")


def chunks(content: DataFrame, splitter: Splitter | None = None) -> DataFrame:
    """``chunk_id, doc_id, ordinal, header_path, text, prev_id, next_id``: tables before the texts of their section."""
    texts = text_chunks(content, splitter).select("doc_id", "section", F.lit(1).alias("is_text"), F.col("split").alias("pos"), "header_path", "text")
    both = texts.unionByName(table_chunks(content).withColumn("is_text", F.lit(0)).select(*texts.columns))
    order = Window.partitionBy("doc_id").orderBy("section", "is_text", "pos")
    numbered = both.withColumn("ordinal", F.row_number().over(order) - 1)
    named = numbered.withColumn("chunk_id", F.md5(F.concat_ws("#", F.col("doc_id").cast("string"), F.col("ordinal").cast("string"))))
    return named.select("chunk_id", "doc_id", "ordinal", "header_path", "text", F.lag("chunk_id").over(order).alias("prev_id"), F.lead("chunk_id").over(order).alias("next_id"))
