"""Conversations: the most recent turns within a budget, questions that stand alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.text import token_count
from corpuscle.operators.windows import within_budget

MEMORY = 6_000


def memory(turns: DataFrame, budget: int = MEMORY) -> DataFrame:
    """``conv_id, turn, role, text, tokens, tokens_so_far``: the latest turns that fit into the budget, counted backwards."""
    counted = turns.withColumn("tokens", token_count(F.col("text")).cast("bigint"))
    return within_budget(counted, "conv_id", [F.desc("turn")], "tokens", budget, strict=False).select("conv_id", "turn", "role", "text", "tokens", "tokens_so_far")


def condensed(kept: DataFrame, questions: DataFrame) -> DataFrame:
    """``conv_id, prompt``: what is left of each conversation, and the new question to be put on its own."""
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(": ", "role", "text").alias("line"))))
    history = kept.groupBy("conv_id").agg(lines.alias("lines")).select("conv_id", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("history"))
    joined = questions.join(history, "conv_id", "left")
    return joined.select("conv_id", F.concat(F.lit("Chat history:\n"), F.coalesce("history", F.lit("")), F.lit("\nFollow-up: "), F.col("question"), F.lit("\nStandalone question:")).alias("prompt"))
