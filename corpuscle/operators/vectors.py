"""Vectors: embedding, exact filtered nearest neighbours, prompts made of what was found."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.models import Chat, Embedder, hashed_embedding
from corpuscle.session import written_tables

#: Queries of a block, and vectors that meet them at once.
BLOCK, SLICE = 4_096, 512


def embedded(rows: DataFrame, text: str = "text", embed: Embedder = hashed_embedding) -> DataFrame:
    """``rows`` with ``embedding`` of their text; null texts have none and are left out."""
    usable = rows.where(F.col(text).isNotNull())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(embedding=embed(list(frame[text])))

    return usable.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in usable.schema) + ", embedding array<double>")


class _Best:
    """The best ``k`` vectors of each query of a block so far, from matrices of vectors that come one by one."""

    def __init__(self, asked: tuple[np.ndarray, np.ndarray, np.ndarray], k: int):
        self.ids, self.matrix, kinds = asked
        self.k = k
        # queries of one kind are a slice, so that each kind is a product of its own
        self.slices = {kinds[at]: (at, at + n) for at, n in zip(*np.unique(kinds, return_index=True, return_counts=True)[1:], strict=True)}
        self.scores = np.full((len(self.ids), k), -np.inf)
        self.found = np.zeros((len(self.ids), k), np.int64)

    def take(self, ids: np.ndarray, matrix: np.ndarray, kinds: np.ndarray) -> None:
        for kind in np.unique(kinds):
            if kind in self.slices:
                a, b = self.slices[kind]
                own = kinds == kind
                self._merge(a, b, ids[own], matrix[own])

    def _merge(self, a: int, b: int, ids: np.ndarray, matrix: np.ndarray) -> None:
        new = np.round(self.matrix[a:b] @ matrix.T, 6) + 0.0
        new[self.ids[a:b, None] == ids] = -np.inf
        # by score, then by id: candidates of each query, sorted
        scores = np.concatenate([self.scores[a:b], new], axis=1)
        found = np.concatenate([self.found[a:b], np.broadcast_to(ids, new.shape)], axis=1)
        order = np.lexsort((found, -scores), axis=1)[:, : self.k]
        self.scores[a:b], self.found[a:b] = np.take_along_axis(scores, order, 1), np.take_along_axis(found, order, 1)

    def rows(self) -> pa.RecordBatch:
        good = np.isfinite(self.scores)
        query = np.broadcast_to(self.ids[:, None], good.shape)
        return pa.RecordBatch.from_arrays([pa.array(query[good]), pa.array(self.found[good]), pa.array(self.scores[good])], ["query_id", "vec_id", "score"])


def _units(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, vectors of length one, kinds as text) of ``vec_id, embedding, same``; null vectors and those of length nought are left out."""
    rows = rows.filter(pc.and_(pc.is_valid(rows.column(1)), pc.is_valid(rows.column(0))))
    if not rows.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, 1)), np.zeros(0, object)
    lengths = pc.list_value_length(rows.column(1)).to_numpy(zero_copy_only=False)
    rows, size = rows.filter(pa.array(lengths == lengths.max())), int(lengths.max())
    matrix = rows.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)
    norm = np.sqrt((matrix * matrix).sum(axis=1))
    good = norm > 0
    kinds = np.array(rows.column(2).to_pylist(), object)
    good &= np.array([k is not None for k in kinds], bool)
    return rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[good], matrix[good] / norm[good, None], kinds[good]


def nearest(vectors: DataFrame, queries: DataFrame, k: int, same: str | None = None, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` most similar vectors of each query by cosine, but for itself.

    The queries are a stated set, taken in blocks of about ``block``, which are broadcast one at a time, as their size is
    bounded. Vectors are neither joined nor shuffled: each task multiplies what it reads with a block and passes on its best
    ``k`` of each query. ``same`` names a column in which both must agree (nulls agree with nothing): vectors meet the
    queries of their own value only. More blocks than one are done one after the other, each written where checkpoints go.
    Scores are rounded to six places before ranks are given, and ties go to the smaller id; vectors of length nought are
    like none.
    """
    spark = vectors.sparkSession
    columns = ["vec_id", "embedding", (F.col(same).cast("string") if same else F.lit("")).alias("same")]
    known, asked = vectors.select(*columns), queries.select(*columns)
    blocks = max(1, -(-queries.count() // block))

    def found(number: int) -> DataFrame:
        ids, matrix, kinds = _units(_arrow(asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number)))
        order = np.argsort(kinds.astype(str), kind="stable")
        shared = spark.sparkContext.broadcast((ids[order], matrix[order], kinds[order].astype(str)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _Best(shared.value, k)
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    ids, matrix, kinds = _units(batch.slice(at, SLICE))
                    if len(ids) and len(best.ids):
                        best.take(ids, matrix, kinds.astype(str))
            yield best.rows()

        return known.mapInArrow(run, "query_id bigint, vec_id bigint, score double")

    scored = found(0) if blocks == 1 else written_tables(found(n) for n in range(blocks))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _arrow(rows: DataFrame) -> pa.RecordBatch:
    """A bounded table on the driver."""
    table = rows.toArrow().combine_chunks()
    return table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)


def joined_texts(found: DataFrame, texts: DataFrame, separator: str = "\n\n") -> DataFrame:
    """``query_id, context``: the texts of what each query found, best first. ``texts`` has ``vec_id, text``."""
    joined = found.join(texts.select("vec_id", "text"), "vec_id")
    parts = F.array_sort(F.collect_list(F.struct("rank", "vec_id", "text")))
    return joined.groupBy("query_id").agg(parts.alias("parts")).select("query_id", F.array_join(F.transform("parts", lambda p: p["text"]), separator).alias("context"))


def prompts(contexts: DataFrame, questions: DataFrame) -> DataFrame:
    """``query_id, prompt``: the context and the question. ``questions`` has ``query_id, question``."""
    both = contexts.join(questions, "query_id")
    return both.select("query_id", F.concat(F.lit("Context:\n"), F.col("context"), F.lit("\n\nQuestion: "), F.col("question"), F.lit("\nAnswer:")).alias("prompt"))


def tree_summarised(found: DataFrame, texts: DataFrame, chat: Chat, fan: int = 4) -> DataFrame:
    """``query_id, answer``: the texts of what each query found, ``fan`` at a time made one by ``chat``, until one is left.

    A query has as many texts as it found vectors.
    """
    parts = F.array_sort(F.collect_list(F.struct("rank", "vec_id", "text")))
    grouped = found.join(texts.select("vec_id", "text"), "vec_id").groupBy("query_id").agg(parts.alias("parts")).select("query_id", F.transform("parts", lambda p: p["text"]).alias("texts"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            levels = [list(t) for t in frame["texts"]]
            while True:
                asked = [(i, "\n\n".join(x for x in level[at : at + fan] if x is not None)) for i, level in enumerate(levels) for at in range(0, len(level), fan)]
                levels = [[] for _ in levels]
                for (i, _), answer in zip(asked, chat([text for _, text in asked]), strict=True):
                    levels[i].append(answer)
                if max(map(len, levels), default=0) <= 1:
                    break
            yield pd.DataFrame({"query_id": frame["query_id"], "answer": [level[0] for level in levels]})

    return grouped.mapInPandas(run, f"query_id {found.schema['query_id'].dataType.simpleString()}, answer string")


def new_only(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    return rows.join(stored.select(key).distinct(), key, "left_anti")


def snippets(found: DataFrame, text: str = "text", kind: str = "kind", most: int = 140) -> DataFrame:
    """``found`` with ``snippet``: its kind, and the beginning of its text in one line."""
    line = F.replace(F.substring(F.coalesce(F.col(text), F.lit("")), 1, most), F.lit("\n"), F.lit(" "))
    return found.withColumn("snippet", F.concat(F.lit("["), F.coalesce(F.col(kind), F.lit("chunk")), F.lit("] "), line, F.lit("...")))
