"""Problem 9: containers of a fixed capacity filled with items, by non-negative least squares.

Only the histogram of item sizes, of at most ``capacity`` rows whatever the corpus, comes to the driver. Combinations of
one or two lengths that fill a container are enumerated and their repeat counts solved against the histogram by
non-negative least squares. Repeat counts are rounded down, those below one up, the largest first and as far as the
histogram goes; what is left is solved again, until no combination fills a container. The rest is packed greedily, each
choice repeated as often as the histogram allows. The result is a list of runs ("so many containers of this content"), again
bounded by the capacity and not by the corpus. Items find their containers by their rank among the items of their size,
which is made of counts by (size, salt), so that a size of very many items is ranked by many tasks.

Defined results: null and empty texts are no items, blank ones are; an item above the capacity is split into pieces of
the capacity and a rest, any other item stays whole; repeated rows are items of their own (a null key too).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpuscle.llm.tokens import TOKENIZERS, VOCABULARY, token_counts
from corpuscle.session import cut_lineage

CAPACITY, SALTS, MOST_SALTS, COPIES, STEPS = 2_048, 64, 1_024, 8, 400


def combinations(sizes: np.ndarray, capacity: int, copies: int = COPIES) -> np.ndarray:
    """Rows (s, k, t, j) with k*s + j*t = capacity over the sizes that occur; (s, k, 0, 0) where k*s alone fills it."""
    there = np.zeros(capacity + 1, bool)
    there[sizes] = True
    rows = []
    for s in sizes.tolist():
        for k in range(1, capacity // s + 1):
            rest = capacity - k * s
            if rest == 0:
                rows.append((s, k, 0, 0))
                continue
            for j in range(1, copies + 1):
                t, over = divmod(rest, j)
                if t == 0:
                    break
                if not over and t < s and there[t]:
                    rows.append((s, k, t, j))
    return np.array(rows, np.int64).reshape(-1, 4)


def solve(rows: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """The non-negative repeat counts whose use of sizes is closest to ``histogram``, by accelerated projected gradients."""
    x = np.zeros(len(rows))
    if not len(rows):
        return x
    s, k, t, j = rows.T
    norm = np.sqrt(k**2 + j**2)  # columns of one length, so that long combinations don't dictate the step
    use = lambda v: np.bincount(s, v * k / norm, len(histogram)) + np.bincount(t, v * j / norm, len(histogram))
    back = lambda r: (r[s] * k + r[t] * j) / norm
    weights = 1 / np.sqrt(np.maximum(histogram, 1))
    weights[0] = 0
    # a bound of the largest eigenvalue by a few power steps
    v = np.ones(len(rows))
    for _ in range(20):
        v = back(weights**2 * use(v))
        scale = np.linalg.norm(v)
        v /= scale
    step, y, moment = 1 / (scale * 1.05), x.copy(), 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * back(weights**2 * (use(y) - histogram)))
        following = (1 + np.sqrt(1 + 4 * moment**2)) / 2
        y, x, moment = new + (moment - 1) / following * (new - x), new, following
    return x / norm


def fill(left: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs that use up the histogram ``left``: largest item first, then the largest that fits, repeated while it lasts."""
    runs = []
    sizes = np.nonzero(left)[0]
    while len(sizes):
        room, content = capacity, []
        at = len(sizes) - 1
        while at >= 0:
            s = int(sizes[at])
            n = min(room // s, int(left[s]))
            content.append((s, n))
            room -= n * s
            at = min(at, int(np.searchsorted(sizes, room, "right"))) - 1
        times = min(int(left[s]) // n for s, n in content)
        for s, n in content:
            left[s] -= n * times
        runs.append((times, content))
        sizes = sizes[left[sizes] > 0]
    return runs


def solved(left: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs by least squares, which are taken off the histogram ``left``: solved and rounded until no combination fills a container."""
    runs = []
    while True:
        rows = combinations(np.nonzero(left)[0], capacity)
        rows = rows[(rows[:, 1] <= left[rows[:, 0]]) & ((rows[:, 2] == 0) | (rows[:, 3] <= left[rows[:, 2]]))]
        if not len(rows):
            return runs
        repeats = solve(rows, left.astype(float))
        for at in np.argsort(-repeats, kind="stable"):
            s, k, t, j = rows[at].tolist()
            times = min(max(1, int(repeats[at] + 1e-6)), int(left[s]) // k, *([int(left[t]) // j] if t else []))
            if times > 0:
                content = [(s, k)] + ([(t, j)] if t else [])
                for size, n in content:
                    left[size] -= n * times
                runs.append((times, content))


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs (containers, [(size, items of it in each)]) that hold every item of ``histogram`` (counts by size) once."""
    left = histogram.astype(np.int64).copy()
    return solved(left, capacity) + fill(left, capacity)


def slots(runs: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Sorted rows (size, first rank, first container, items in each): where the items of a size go, by their rank."""
    used: dict[int, int] = {}
    rows, container = [], 0
    for times, content in runs:
        for size, n in content:
            rows.append((size, used.get(size, 0), container, n))
            used[size] = used.get(size, 0) + n * times
        container += times
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def items(sizes: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``key, piece, start, n_tokens``: whole items, and the pieces of those above the capacity."""
    pieces = F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / capacity).cast("int"))
    split = sizes.where("n_tokens > 0").select(key, F.col("n_tokens").alias("total"), F.explode(pieces).alias("piece"))
    start = F.col("piece").cast("bigint") * capacity
    return split.select(key, "piece", start.alias("start"), F.least(F.lit(capacity).cast("bigint"), F.col("total") - start).alias("n_tokens"))


def assign(sizes: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, salts: int | None = None) -> DataFrame:
    """``container_id, key, piece, start, n_tokens`` for a table of ``key`` and ``n_tokens``.

    A size is ranked by ``salts`` tasks: ``SALTS``, or as many as the session's shuffle partitions, up to ``MOST_SALTS``.
    """
    salts = salts or min(MOST_SALTS, max(SALTS, int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salted = items(sizes, key, capacity).withColumn("salt", F.pmod(F.xxhash64(key, "piece"), F.lit(salts)).cast("int"))
    counted = salted.groupBy("n_tokens", "salt").agg(F.count("*").alias("n")).toPandas()  # at most capacity * salts rows
    counted = counted.sort_values(["n_tokens", "salt"])
    histogram = np.bincount(counted["n_tokens"].to_numpy(int), counted["n"].to_numpy(), capacity + 1) if len(counted) else np.zeros(capacity + 1)
    table = slots(plan(histogram, capacity)) if len(counted) else np.zeros((0, 4), np.int64)
    before = np.zeros((capacity + 1) * salts, np.int64)
    before[counted["n_tokens"].to_numpy(int) * salts + counted["salt"].to_numpy(int)] = counted.groupby("n_tokens")["n"].cumsum().to_numpy(int) - counted["n"].to_numpy(int)
    shared = salted.sparkSession.sparkContext.broadcast((table, before))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("n_tokens", "salt").orderBy(key, "piece")) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, before = shared.value
        most = np.int64(1) << 40
        at_most = table[:, 0] * most + table[:, 1]
        for batch in batches:
            size, salt, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (3, 4, 5))
            rank = rank + before[size * salts + salt]
            found = table[np.searchsorted(at_most, size * most + rank, "right") - 1]
            container = found[:, 2] + (rank - found[:, 1]) // found[:, 3]
            yield pa.RecordBatch.from_arrays([pa.array(container), *(batch.column(c) for c in range(4))], ["container_id", key, "piece", "start", "n_tokens"])

    kind = sizes.schema[key].dataType.simpleString()
    return ranked.select(key, "piece", "start", "n_tokens", "salt", "rank").mapInArrow(run, f"container_id bigint, `{key}` {kind}, piece int, start bigint, n_tokens bigint")


def containers(documents: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """Every non-empty text in a container; see ``assign``. Token counts are kept in the checkpoint folder, as they are read twice."""
    return assign(cut_lineage(token_counts(documents, key, text, folder, name)), key, capacity)
