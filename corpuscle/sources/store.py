"""Stored tables by version: documents' chunks and vectors that are added to, replaced, reset and rebuilt.

Each change is written to a folder of its own before the one it came from is deleted, so that no table is overwritten while
it is read, and a change that fails leaves the table as it was.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.models import Embedder, hashed_embedding
from corpuscle.operators import annotate, vectors
from corpuscle.session import _place, deleted


@dataclass
class Store:
    """The index of a corpus under ``path``: ``chunks`` (a row a chunk, with ``doc_id`` and ``text``) and their ``vectors``."""

    spark: SparkSession
    path: str
    embed: Embedder = hashed_embedding

    def _versions(self, name: str) -> list[int]:
        system, place = _place(self.spark, f"{self.path}/{name}")
        found = system.listStatus(place) if system.exists(place) else []
        # a folder counts once Spark has marked it as whole
        return sorted(int(f.getPath().getName()) for f in found if _done(system, f.getPath()))

    def table(self, name: str) -> DataFrame | None:
        """The newest version of a table, or none."""
        versions = self._versions(name)
        return self.spark.read.parquet(f"{self.path}/{name}/{versions[-1]}") if versions else None

    def _write(self, name: str, rows: DataFrame) -> None:
        versions = self._versions(name)
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/{versions[-1] + 1 if versions else 0}")
        for old in versions:
            deleted(self.spark, f"{self.path}/{name}/{old}")

    def add(self, chunks: DataFrame) -> None:
        """Chunks of documents, in place of any that these documents have; only their texts are embedded."""
        made = vectors.embedded(chunks, embed=self.embed)
        for name, rows in (("chunks", chunks), ("vectors", made.select(*[c for c in chunks.columns if c != "text"], "embedding"))):
            stored = self.table(name)
            self._write(name, rows if stored is None else annotate.replaced(stored, rows.select(*stored.columns)))

    def reset(self) -> None:
        """Nothing is left."""
        deleted(self.spark, self.path)

    def rebuild(self, chunks: DataFrame) -> None:
        """The index of ``chunks`` only."""
        self.reset()
        self.add(chunks)

    def documents(self) -> DataFrame | None:
        """``doc_id, n_chunks`` of what is stored."""
        stored = self.table("chunks")
        return None if stored is None else stored.groupBy("doc_id").agg(F.count("*").alias("n_chunks"))

    def chunks_of(self, doc_ids: DataFrame) -> DataFrame | None:
        """The stored chunks of the documents ``doc_id``."""
        stored = self.table("chunks")
        return None if stored is None else stored.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi")

    def new(self, doc_ids: DataFrame) -> DataFrame:
        """Those of ``doc_id`` that are not stored yet."""
        stored = self.table("chunks")
        return doc_ids if stored is None else vectors.new_only(doc_ids, stored, "doc_id")


def _done(system, path) -> bool:
    return path.getName().isdigit() and system.exists(path.suffix("/_SUCCESS"))
