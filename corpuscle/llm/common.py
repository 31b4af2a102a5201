"""Pieces that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: every character that str.split() takes as white space (no-break spaces too).
BLANKS = r"[\s\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


#: A value of more than one in so many rows is hot.
HOT = 1_000


def term(value: Column) -> Column:
    """A string as a *term*: no white space at the ends, inner runs one space, lower case; null if nothing is left."""
    one_space = F.trim(F.regexp_replace(value, BLANKS, " "))
    return F.nullif(F.lower(one_space), F.lit(""))


def distinct_elements(content: DataFrame, *columns: str) -> DataFrame:
    """``content_list`` with each element once; identical repeated deliveries count once."""
    keep = ["element_id", *[c for c in columns if c != "element_id"]]
    return content.where(F.col("element_id").isNotNull()).select(*keep).dropDuplicates(["element_id"])


def looked_up(rows: DataFrame, found: DataFrame, keys: list[str], spread: str, how: str = "left", salts: int = 16) -> DataFrame:
    """``rows`` joined with ``found``, which has a row for each value of ``keys``; rows of one value are spread over ``salts`` tasks.

    ``spread`` is a column of ``rows`` that tells rows of one value apart. ``found`` is repeated for each salt, so it
    should be the distinct, smaller side.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def hot_looked_up(rows: DataFrame, found: DataFrame, keys: list[str], weight: str, total: Column, spread: str, weighed: DataFrame | None = None, how: str = "inner", salts: int = 64) -> DataFrame:
    """``looked_up`` for a ``found`` about as large as ``rows``: only hot values are spread, and only their rows are repeated.

    ``weight`` is a column of ``found`` with the number of rows that a value has, ``total`` the number of all rows. A value
    is hot from one in ``HOT`` of them on, so there are at most ``HOT`` hot values, which are broadcast. ``weighed`` has keys
    and weights where ``found`` is too costly to be made twice.
    """
    is_hot = F.col(weight) * HOT > total
    hot = (found if weighed is None else weighed).where(is_hot).select(*keys, F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    left = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_hot")
    right = found.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt", weight)


def spread(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` over all cores by a hash of ``columns``: few small rows that are costly to work on would else share a task.

    The hash is an expression of its own, as a partitioning by the columns themselves may be that of a step before, whose
    partitions are gathered by their size.
    """
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, F.xxhash64(*columns))
