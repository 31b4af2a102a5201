"""Running values along an order, without putting a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRETCH = 512


def running_last(rows: DataFrame, keys: list[str], at: str, values: dict[str, Column], stretch: int = STRETCH) -> DataFrame:
    """``rows`` with a column for each of ``values``: its largest value among the rows of ``keys`` up to and with this one.

    With values that begin with ``at`` (a struct of the position and more) that is the last one that isn't null. Positions
    fall into stretches; a stretch is a task's unit, and only one row of each is carried along the whole order. ``at`` is
    a whole number; rows without it are left out.
    """
    placed = rows.where(F.col(at).isNotNull()).withColumn("_stretch", F.floor(F.col(at) / stretch)).withColumns({f"_{n}": v for n, v in values.items()}).repartition(*keys, "_stretch")
    part = [*keys, "_stretch"]
    marks = placed.groupBy(*part).agg(*(F.max(f"_{n}").alias(f"_{n}") for n in values))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select(*part, *(F.max(f"_{n}").over(earlier).alias(f"_before_{n}") for n in values))
    within = Window.partitionBy(*part).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({n: F.max(f"_{n}").over(within) for n in values})
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"c.{c}")) for c in keys] + [F.col("l._stretch") == F.col("c._stretch")]
    joined = local.alias("l").join(carried.alias("c"), [*same])
    kept = [c for c in rows.columns if c not in values]
    return joined.select(*(F.col(f"l.{c}") for c in kept), *(F.coalesce(F.col(f"l.{n}"), F.col(f"c._before_{n}")).alias(n) for n in values))
