"""Texts split into chunks of a bounded number of tokens, at sentence ends where possible, with an overlap.

A splitter is a function from a text column to a column of arrays of texts, so that a deployment may pass its own. The one
here is made of built-in expressions: a text's units are its sentences, the words of a sentence above the bound, and the
characters of a word above it; units are taken as long as they fit, and the next chunk begins with the last units of the
one before, as far as their tokens stay within the overlap and its first new unit still fits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuscle.functions.text import stripped, token_count

Splitter = Callable[[Column], Column]
SIZE, OVERLAP = 1_024, 20
#: A sentence with the blanks after it, a line, or the rest; a word with the blanks after it.
SENTENCE, WORD = r"[^\n]*?(?:[.!?]+(?:[ \t]+|\z)|\n+|\z)", r"[^ \t\n]+[ \t\n]*|[ \t\n]+"


def units(text: Column, size: int, count: Splitter = token_count) -> Column:
    """The sentences of a text, or what they must be broken into to have at most ``size`` tokens; together they are the text."""

    def parts(value: Column, pattern: str) -> Column:
        return F.filter(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)), lambda x: x != "")

    def runs(word: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.length(word) - 1) / size).cast("int")), lambda k: F.substring(word, k * size + 1, F.lit(size)))

    def broken(value: Column, into: Splitter) -> Column:
        return F.when(count(value) > size, into(value)).otherwise(F.array(value))

    words = lambda s: F.flatten(F.transform(parts(s, WORD), lambda w: broken(w, runs)))
    return F.flatten(F.transform(parts(text, SENTENCE), lambda s: broken(s, words)))


def packed(parts: Column, size: int, overlap: int, count: Splitter = token_count) -> Column:
    """Arrays of units joined into chunks; ``parts`` have at most ``size`` tokens each."""
    # the tokens of all units before each one, and of all
    sums = F.aggregate(F.transform(parts, lambda p: count(p).cast("int")), F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
    kept = F.struct(parts.alias("u"), sums.alias("c"))

    def chunks(x: Column) -> Column:
        u, c = x["u"], x["c"]
        n = F.size(u)
        # two chunks in a row are more than ``size`` tokens ahead, but for the overlap
        rounds = F.sequence(F.lit(1), F.least(n, (2 * F.ceil(F.element_at(c, -1) / (size - overlap)) + 2).cast("int")))
        span = lambda s, e: F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"))

        def step(state: Column, _: Column) -> Column:
            s = state["next"]
            e = F.size(F.filter(c, lambda y: y <= F.element_at(c, s) + size)) - 1
            low = F.greatest(F.element_at(c, e + 1) - overlap, F.element_at(c, F.least(e + 2, n + 1)) - size)
            following = F.when(e >= n, n + 1).otherwise(F.greatest(F.size(F.filter(c, lambda y: y < low)) + 1, s + 1))
            new = F.struct(F.concat(state["spans"], F.array(span(s, e))).alias("spans"), following.cast("int").alias("next"))
            return F.when(s > n, state).otherwise(new)

        start = F.struct(F.expr("cast(array() as array<struct<s:int,e:int>>)").alias("spans"), F.lit(1).alias("next"))
        spans = F.aggregate(rounds, start, step, lambda state: state["spans"])
        return F.transform(spans, lambda p: stripped(F.array_join(F.slice(u, p["s"], p["e"] - p["s"] + 1), "")))

    # a transform over one element, so that units and sums are made once and not wherever they are named
    return F.filter(F.flatten(F.transform(F.array(kept), chunks)), lambda t: t != "")


def sentence_splitter(size: int = SIZE, overlap: int = OVERLAP, count: Splitter = token_count) -> Splitter:
    """Chunks of at most ``size`` tokens by ``count``; a text that fits is one chunk, a blank one none."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be smaller than the size")

    def split(text: Column) -> Column:
        whole = F.filter(F.array(stripped(text)), lambda t: t != "")
        # a word or mark has a character at least, so most texts needn't be counted
        short = F.length(text) <= size if count is token_count else F.lit(False)
        return F.when(short, whole).when(count(text) <= size, whole).otherwise(packed(units(text, size, count), size, overlap, count))

    return split
