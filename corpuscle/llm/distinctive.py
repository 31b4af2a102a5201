"""Problem 6: how distinctive a term is of its record, by a parsimonious language model.

A record (document) is a mixture of its own model and of the background, the share of each term among all chunks.
Expectation-maximisation moves mass that the background explains out of the record's model:

    e(t)  = tf(t) * w * p(t) / (w * p(t) + (1 - w) * q(t));      p(t) = e(t) / sum of e

Rounds go on until no probability of the record moves by more than ``SETTLED`` of the record's largest; each record stops by
its own, whatever it is batched with.

Two terms of a record with the same tf and the same background move alike, so a record is folded into classes of
(tf, background count) with their sizes. As classes differ in one of two counts and these add up to the record's mentions and
to all mentions, m mentions make at most about m^(2/3) classes: what one row carries stays small even if a record holds a
third of all rows.

Defined results: repeated deliveries of a chunk count once; null arrays, elements, surfaces and blank terms hold no
term; terms of chunks without doc_id count in the background and are scored for no record; ties have equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import hot_looked_up, term
from corpuscle.session import written_table

OWN_SHARE, SETTLED = 0.1, 1e-6


def chunk_terms(chunk: DataFrame) -> DataFrame:
    """``record, kind, term`` for each chunk that holds a term; ``record`` is a struct of the doc_id, which may be null.

    Arrays are cut down to their terms before chunks delivered twice are made one, so that little is shuffled.
    """

    def of(column: str, field: str, kind: str):
        terms = F.transform(F.coalesce(F.col(column), F.array()), lambda e: term(e[field]))
        kept = F.array_distinct(F.filter(terms, lambda t: t.isNotNull()))
        return F.transform(kept, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term")))

    both = F.concat(of("entities", "surface", "entity"), of("acronyms", "short", "acronym"))
    terms = chunk.where(F.col("chunk_id").isNotNull()).select("chunk_id", "doc_id", both.alias("terms")).where(F.size("terms") > 0)
    once = terms.dropDuplicates(["chunk_id"])
    return once.select(F.struct("doc_id").alias("record"), F.explode("terms").alias("t")).select("record", "t.kind", "t.term")


def record_counts(chunk: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """``record, kind, term, n_doc, n_all`` (the chunks that hold a term, in the document and in all), ``kind, n_kind``, and the number of rows.

    Counts are made by document before they are joined, so that a term of very many chunks has one row a document. They are
    written once, as all that follows reads them.
    """
    by_doc = written_table(chunk_terms(chunk).groupBy("record", "kind", "term").agg(F.count("*").alias("n_doc")))
    overall = by_doc.groupBy("kind", "term").agg(F.sum("n_doc").alias("n_all"), F.count("*").alias("n_records"))
    totals, n_rows = by_doc.groupBy("kind").agg(F.sum("n_doc").alias("n_kind")), by_doc.agg(F.count("*")).scalar()
    # a term may be in any share of all records
    return hot_looked_up(by_doc, overall, ["kind", "term"], "n_records", n_rows, "record"), totals, n_rows


def fit(sizes: np.ndarray, tf: np.ndarray, background: np.ndarray, starts: np.ndarray, share: float = OWN_SHARE, settled: float = SETTLED) -> np.ndarray:
    """Each class's probability of one of its terms in its record's model; records begin at ``starts``."""
    if not len(tf):
        return np.zeros(0)
    lengths = np.diff(np.append(starts, len(tf)))
    weights, p = sizes * tf, np.zeros(len(tf))
    total = lambda x, first, n: np.repeat(np.add.reduceat(x, first), n)
    own = tf / total(weights, starts, lengths)
    # the classes, and the records, that haven't settled
    at, first, n = np.arange(len(tf)), starts, lengths
    while len(at):
        e = share * own / (share * own + (1 - share) * background[at])
        new = tf[at] * e / np.maximum(total(weights[at] * e, first, n), 1e-300)
        moves = np.maximum.reduceat(np.abs(new - own), first) > settled * np.maximum.reduceat(new, first)
        own = new
        if not moves.all():
            stay = np.repeat(moves, n)
            p[at[~stay]] = own[~stay]
            at, own, n = at[stay], own[stay], n[moves]
            first = np.cumsum(n) - n
    return p


def scores(chunk: DataFrame, share: float = OWN_SHARE, settled: float = SETTLED) -> DataFrame:
    """``doc_id, kind, term, n_doc, n_all, score`` of every term of every document; kinds have models of their own."""
    counts, totals, n_rows = record_counts(chunk)
    # totals has a row for each of the two kinds
    classes = counts.groupBy("record", "kind", "n_doc", "n_all").agg(F.count("*").alias("size")).join(F.broadcast(totals), "kind")
    models = classes.groupBy("record", "kind").agg(F.collect_list(F.struct("n_doc", "n_all", "size", "n_kind")).alias("classes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            column = batch.column(2)
            starts = column.offsets.to_numpy()
            columns = column.flatten().flatten()
            tf, n_all, size, n_kind = (c.to_numpy(zero_copy_only=False).astype(float) for c in columns)
            p = fit(size, tf, n_all / n_kind, (starts[:-1] - starts[0]).astype(int), share, settled)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(starts)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), columns[0], columns[1], columns[2], pa.array(p)], ["doc_id", "kind", "n_doc", "n_all", "size", "score"])

    kind = chunk.schema["doc_id"].dataType.simpleString()
    fitted = models.select("record.doc_id", "kind", "classes").mapInArrow(run, f"doc_id {kind}, kind string, n_doc bigint, n_all bigint, size bigint, score double")
    # a class may have any share of the terms of all records
    joined = hot_looked_up(counts, fitted.withColumn("record", F.struct("doc_id")).drop("doc_id"), ["record", "kind", "n_doc", "n_all"], "size", n_rows, "term", classes)
    return joined.select(F.col("record.doc_id").alias("doc_id"), "kind", "term", "n_doc", "n_all", "score")


def characteristic(chunk: DataFrame, least: int = 3, of_all: tuple[int, int] = (4, 5)) -> DataFrame:
    """The scored terms found in at least ``least`` chunks of the document, these being at least the share ``of_all``."""
    kept = (F.col("n_doc") >= least) & (F.col("n_doc") * of_all[1] >= F.col("n_all") * of_all[0])
    return scores(chunk).where(kept).select("doc_id", "kind", "term")
