"""Sinks: graph files, tables replaced by key, records as JSON, windows as Markdown."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.operators.triples import PREFIXES, ntriples, turtle


def save_graph(graph: DataFrame, path: str) -> None:
    """N-Triples text, replacing what was there."""
    ntriples(graph).write.mode("overwrite").text(path)


def save_table(rows: DataFrame, path: str, partition: str | None = None) -> None:
    """Parquet, replacing what was there; never the path that ``rows`` are read from."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def upserted(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``stored`` with the rows of ``new`` in place of those of the same keys, to be written to a new path."""
    return stored.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.select(*stored.columns))


def save_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def save_json(rows: DataFrame, path: str) -> None:
    """An object a line, of all columns."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(path)


def save_markdown(groups: DataFrame, path: str, key: str = "doc_id", buckets: int = 256) -> None:
    """The numbered chunks of documents as lines of Markdown; a document's are in order in one of ``buckets`` folders by its hash."""
    placed = groups.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    ordered = placed.repartition("bucket").sortWithinPartitions("bucket", key, "ordinal")
    ordered.select("bucket", F.col("text").alias("value")).write.mode("overwrite").partitionBy("bucket").text(path)


def save_vocabulary(vocabulary: DataFrame, path: str) -> None:
    """A JSON object from terms to links, a file of one; a controlled vocabulary is small."""
    terms = F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("pattern", "id")))))
    vocabulary.where("pattern is not null").groupBy("pattern").agg(F.min("id").alias("id")).agg(terms.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def save_turtle(graph: DataFrame, path: str, prefixes: dict[str, str] = PREFIXES) -> None:
    """Turtle text with prefixes, replacing what was there; each part begins with the prefixes, so that it is a whole file."""
    head = "\n".join(f"@prefix {name}: <{uri}> ." for name, uri in prefixes.items())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [head]})
        yield from frames

    turtle(graph, prefixes).withColumnRenamed("line", "value").mapInPandas(run, "value string").write.mode("overwrite").text(path)
