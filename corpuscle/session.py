"""Session helpers shared by operators and queries."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "corpuscle", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for checkpoints: the session's own setting, and one of ours only where none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = Path(tempfile.gettempdir(), "corpuscle-checkpoints").as_uri()
    sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder.

    Used where a result is read several times or feeds an iteration; the files outlive a lost executor.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written_table(df: DataFrame) -> DataFrame:
    """``df`` written to a compressed table in the checkpoint folder and read from there.

    Where several parts of a plan read the same rows it takes less room than a checkpoint, and readers take only the columns
    they need. The table is deleted when the driver ends.
    """
    return written_tables([df])


def written_tables(frames: Iterable[DataFrame]) -> DataFrame:
    """The rows of all ``frames``, of one schema, written one after the other; see ``written_table``."""
    path = schema = None
    for df in frames:
        if path is None:
            spark, schema = df.sparkSession, df.schema
            path = f"{checkpoint_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
            atexit.register(_delete, spark, path)
        df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def deleted(spark: SparkSession, path: str) -> bool:
    """Whether there was something at ``path``, which is gone then."""
    system, place = _place(spark, path)
    return system.delete(place, True)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        deleted(spark, path)
    except Exception:  # the session is gone, and the folder is the cluster's to clean
        pass
