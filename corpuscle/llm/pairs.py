"""Problem 7: items that appear together, by large-basket blocking.

A basket (chunk) is the sorted set of its terms. Baskets of up to ``block`` items yield their pairs where they are
read. Larger ones are split into blocks of ``block`` items; every pair of blocks becomes a task-sized row of its own,
spread over the cluster by a hash of its basket and blocks, whose product holds at most ``block`` squared pairs. So no
task ever holds the square of a huge basket. Both kinds are counted together, with partial counts before the shuffle.

Defined results: repeated deliveries of a chunk count once, rows without chunk_id not at all; null arrays, null
elements and null, empty or blank surfaces hold no item; repeats within a chunk count once; an empty table gives an
empty result. Ratios are against the count expected by chance, n_a * n_b / n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import looked_up, term

BLOCK = 64


def item_set(entities: Column) -> Column:
    """The sorted set of entity terms of an array of entities; empty for null."""
    terms = F.transform(F.coalesce(entities, F.array()), lambda e: term(e["surface"]))
    return F.array_sort(F.array_distinct(F.filter(terms, lambda t: t.isNotNull())))


def baskets(chunk: DataFrame) -> DataFrame:
    """``basket`` and ``items`` of each chunk once; arrays are cut down to their terms before chunks delivered twice are made one."""
    return chunk.where("chunk_id is not null").select(F.col("chunk_id").alias("basket"), item_set(F.col("entities")).alias("items")).dropDuplicates(["basket"])


def _ordered_pairs(items: Column) -> Column:
    """All pairs of a sorted array, smaller first."""
    return F.flatten(F.transform(items, lambda a, i: F.transform(F.slice(items, i + 2, F.size(items)), lambda b: F.struct(a.alias("a"), b.alias("b")))))


def _product(left: Column, right: Column) -> Column:
    """All pairs of an element of ``left`` and one of ``right``, smaller first."""
    return F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")))))


def pair_rows(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a`` and ``b``, once for each basket that holds both."""
    small = sets.where(F.size("items").between(2, block)).select(F.explode(_ordered_pairs(F.col("items"))).alias("p"))
    large = sets.where(F.size("items") > block).withColumn("blocks", F.sequence(F.lit(0), F.floor((F.size("items") - 1) / block).cast("int")))
    tasks = (
        large.select("basket", "items", "blocks", F.explode("blocks").alias("i"))
        .select("basket", "items", "i", F.explode(F.filter("blocks", lambda j: j >= F.col("i"))).alias("j"))
        .select("basket", "i", "j", F.slice("items", F.col("i") * block + 1, F.lit(block)).alias("left"), F.slice("items", F.col("j") * block + 1, F.lit(block)).alias("right"))
        .repartition("basket", "i", "j")
    )
    own = F.when(F.col("i") == F.col("j"), _ordered_pairs(F.col("left"))).otherwise(_product(F.col("left"), F.col("right")))
    return small.unionByName(tasks.select(F.explode(own).alias("p"))).select("p.a", "p.b")


def associations(chunk: DataFrame, block: int = BLOCK, least: int = 1) -> DataFrame:
    """``term_a, term_b, n_ab, n_a, n_b, n, ratio`` of each pair of terms in at least ``least`` common chunks.

    Counts and ratios are those over all chunks; ``least`` only leaves out rows of the result.
    """
    sets = baskets(chunk)
    counts = sets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n_item"))
    found = pair_rows(sets, block).groupBy("a", "b").agg(F.count("*").alias("n_ab"))
    if least > 1:
        found, counts = found.where(F.col("n_ab") >= least), counts.where(F.col("n_item") >= least)
    a = counts.select(F.col("item").alias("a"), F.col("n_item").alias("n_a"))
    b = counts.select(F.col("item").alias("b"), F.col("n_item").alias("n_b"))
    # an item may be in any share of the pairs
    joined = looked_up(looked_up(found, a, ["a"], "b", "inner"), b, ["b"], "a", "inner").withColumn("n", sets.agg(F.count("*")).scalar())
    ratio = F.col("n_ab") * F.col("n") / (F.col("n_a") * F.col("n_b"))
    return joined.select(F.col("a").alias("term_a"), F.col("b").alias("term_b"), "n_ab", "n_a", "n_b", "n", ratio.alias("ratio"))


def associated(chunk: DataFrame, least: int = 6, times: int = 8) -> DataFrame:
    """The pairs in at least ``least`` chunks and at least ``times`` as often as by chance, decided in whole numbers."""
    exact = (F.col("n_ab") * F.col("n")).cast("decimal(38,0)") >= F.lit(times).cast("decimal(10,0)") * (F.col("n_a") * F.col("n_b")).cast("decimal(38,0)")
    return associations(chunk, least=least).where(exact).select("term_a", "term_b")
