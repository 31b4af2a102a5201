"""The metadata response as a table: usable records, their latest versions, keys for identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.text import parsed_date, sanitize_key

KEYED = ("docty", "count", "trustfund", "trustfund_key", "projn", "projectid", "display_title", "owner")


def latest_versions(records: DataFrame) -> DataFrame:
    """One row for each id, that of the latest ``modified``; records without id are left out.

    Dates that can't be read come last. Equal dates go to the largest row by its columns, so that the result is the same
    in every run. Only a row for each id and partition is shuffled.
    """
    columns = [c for c in records.columns if c != "id"]
    dated = records.where(F.col("id").isNotNull()).withColumn("modified", parsed_date(F.col("last_modified_date")))
    best = F.max(F.struct("modified", *columns)).alias("r")
    return dated.groupBy("id").agg(best).select("id", *(F.col(f"r.{c}").alias(c) for c in columns), F.col("r.modified").alias("modified"))


def sanitized(records: DataFrame) -> DataFrame:
    """``records`` with the columns that become identifiers as keys."""
    return records.withColumns({c: sanitize_key(F.col(c)) for c in KEYED if c in records.columns})


def version_numbers(records: DataFrame) -> DataFrame:
    """``id, modified, version``: the versions of each id, 1 the oldest; identical records count once."""
    dated = records.where(F.col("id").isNotNull()).withColumn("modified", parsed_date(F.col("last_modified_date"))).select("id", "modified").distinct()
    order = Window.partitionBy("id").orderBy(F.asc_nulls_first("modified"))
    return dated.select("id", "modified", F.row_number().over(order).alias("version"))
