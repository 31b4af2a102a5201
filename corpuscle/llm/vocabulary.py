"""Problem 4: free-entered values mapped to a canonical list through BK-trees.

Distinct values are read in a few ways (without marks such as "topic:" or "etc.", parts turned round at a comma, dash,
slash, bracket or "of", abbreviated words spelled out from the list's own words), and each reading is looked up in
BK-trees of the reference entries, one for each length, as entries of another length than within the threshold can't be
meant. The trees' metric is the Levenshtein distance, whose triangle inequality prunes without losing an entry; as an
exchange of neighbours counts 2 there, the radius is twice the threshold, and what it returns is ranked by the Damerau
distance, in which it counts 1. Longer lists are sharded: trees for each ``SHARD`` entries, every value asks all of them,
words are spelled out from the whole list everywhere, and the shard winners merge.

Abbreviations of several words give a value the product of their spellings as readings. Up to ``READINGS`` are looked up
one by one; more are kept as a lattice of words, whose smallest distance to each entry is found without listing them
(edit distances are minima, so alternatives join in one row), and only readings near an entry are spelled out. Both
ways look at every reading, so the result is the same.

Defined results: rows labelled otherwise are left out; identical repeated rows count once, rows without entity_id not at
all; null, empty and blank surfaces are ``unmatched``, as is all within an empty list; ties go to the entry that comes
first by pattern, then id.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from math import prod

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import hot_looked_up, spread

LABEL, UNMATCHED, THRESHOLD, SHARD, READINGS = "UNBIS_TERM", "unmatched", 2, 20_000, 24
#: As many distinct words a sharded list may have, which are broadcast to all shards; a list with more is refused.
WORDS = 2_000_000

#: Common short forms that fit more than one word of such lists.
SHORT_FORMS = {"ins": "insurance", "edu": "education", "intl": "international", "govt": "government", "mgmt": "management", "dev": "development"}
HEAD = re.compile(r"^(?:[#*\s]+|(?:topic|subject|keyword|term)s?\s*:\s*|the\s+)+")
TAIL = re.compile(r"(?:\s*-\s*misc|\s*\((?:general|misc\.?|other)\)|[\s,]+etc)$")
MARKS = " .,;:!?*"
BRACKET = re.compile(r"(.+?)\s*\((.+)\)")
PARTS = re.compile(r"\s*,\s*|\s+-+\s+|\s*/\s*|\s*;\s*|\s*:\s*|\s+of\s+")


def plain(text: str) -> str:
    """Lower case, without accents, white space runs as one space."""
    apart = unicodedata.normalize("NFKD", text)
    return " ".join("".join(c for c in apart if not unicodedata.combining(c)).lower().split())


def without_remarks(text: str) -> str:
    """A plain text without marks before it and remarks such as "etc." after it."""
    text = HEAD.sub("", text)
    while True:
        short = text.rstrip(MARKS)
        short = short[: len(short) - len(m[0])] if (m := TAIL.search(short[-24:])) else short
        if short == text:
            return text
        text = short


def levenshtein(a: str, masks: dict[str, int], length: int) -> int:
    """The Levenshtein distance of ``a`` and a word of ``length`` given as bit masks of its characters (Myers 1999)."""
    if not length:
        return len(a)
    full, last = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    get = masks.get
    for c in a:
        match = get(c, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        right = minus | (~(diagonal | plus) & full)
        left = plus & diagonal
        if right & last:
            score += 1
        elif left & last:
            score -= 1
        right = (right << 1 | 1) & full
        plus = (left << 1 | ~(diagonal | right)) & full
        minus = right & diagonal
    return score


def bit_masks(word: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(word):
        out[c] = out.get(c, 0) | 1 << i
    return out


def damerau(a: str, b: str) -> int:
    """Edits of one character and exchanges of neighbours, unrestricted (a true metric)."""
    most = len(a) + len(b)
    rows = [[most] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        rows[i + 1][1] = i
    for j in range(len(b) + 1):
        rows[1][j + 1] = j
    seen: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        match = 0
        for j, y in enumerate(b, 1):
            k, l = seen.get(y, 0), match
            if x == y:
                match = j
            rows[i + 1][j + 1] = min(rows[i][j] + (x != y), rows[i + 1][j] + 1, rows[i][j + 1] + 1, rows[k][l] + i - k - 1 + 1 + j - l - 1)
        seen[x] = i
    return rows[-1][-1]


class BKTree:
    """Words by their distances; ``within`` returns every one in the radius."""

    def __init__(self, words: Iterator[str]):
        self.root: tuple[str, dict] | None = None
        for word in words:
            self._add(word)

    def _add(self, word: str) -> None:
        if self.root is None:
            self.root = (word, {})
            return
        masks, node = bit_masks(word), self.root
        while True:
            d = levenshtein(node[0], masks, len(word))
            if d == 0:
                return
            if d not in node[1]:
                node[1][d] = (word, {})
                return
            node = node[1][d]

    def within(self, word: str, radius: int) -> list[tuple[int, str]]:
        found, todo, masks = [], [self.root] if self.root else [], bit_masks(word)
        while todo:
            name, children = todo.pop()
            d = levenshtein(name, masks, len(word))
            if d <= radius:
                found.append((d, name))
            todo += [child for at, child in children.items() if d - radius <= at <= d + radius]
        return found


def _within_word(short: str, word: str) -> bool:
    rest = iter(word)
    return all(c in rest for c in short)


def advanced(row: list[int], name: str, word: str) -> list[int]:
    """The Levenshtein row over ``name`` after the letters of ``word``."""
    for c in word:
        new = [row[0] + 1]
        for j, x in enumerate(name, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return row


def near_readings(tokens: list[tuple[str, ...]], name: str, radius: int) -> Iterator[str]:
    """The readings of a lattice of words within ``radius`` of ``name``: a walk that turns back where no end is near enough."""
    backward = [list(range(len(name) + 1))]
    for k in range(len(tokens) - 1, -1, -1):
        rows = [advanced(backward[-1], name[::-1], w[::-1] + (" " if k else "")) for w in tokens[k]]
        backward.append([min(column) for column in zip(*rows, strict=True)])
    rest = [row[::-1] for row in reversed(backward)]  # of the words from k on, to what stands after each place of the name

    def walk(k: int, row: list[int], said: str) -> Iterator[str]:
        if min(map(int.__add__, row, rest[k])) > radius:
            return
        if k == len(tokens):
            yield said
            return
        for w in tokens[k]:
            word = (" " if k else "") + w
            yield from walk(k + 1, advanced(row, name, word), said + word)

    return walk(0, list(range(len(name) + 1)), "")


class Matcher:
    """Finds the entry that a value means, or none, in one shard of the list."""

    def __init__(self, entries: list[tuple[str, str]], threshold: int = THRESHOLD, words: list[str] | None = None):
        self.ids: dict[str, tuple[str, str]] = {}
        for pattern, id_ in sorted(entries):
            self.ids.setdefault(plain(pattern), (pattern, id_))
        lengths: dict[int, list[str]] = {}
        for name in self.ids:
            lengths.setdefault(len(name), []).append(name)
        self.trees = {n: BKTree(iter(names)) for n, names in lengths.items()}
        self.threshold = threshold
        self.longest = max(lengths, default=0)
        self.words = sorted(words if words is not None else words_of(self.ids))
        self.known = set(self.words)
        self.spelled = lru_cache(100_000)(self._spelled)
        self.nearest = lru_cache(100_000)(self._nearest)
        self.table = lru_cache(1)(self._table)

    def _spelled(self, token: str) -> tuple[str, ...]:
        """The words that a token may abbreviate: those it begins, or whose first and last letter and order it keeps."""
        bare = token.strip(".,;:'").replace("-", "").replace(".", "")
        if bare in self.known or not bare:
            return (bare,)
        if bare in SHORT_FORMS and SHORT_FORMS[bare] in self.known:
            return (SHORT_FORMS[bare],)
        begun = [w for w in self.words if w.startswith(bare)] if len(bare) >= 3 else []
        if not begun and 3 <= len(bare) <= 6:
            begun = [w for w in self.words if len(w) > len(bare) + 2 and w[0] == bare[0] and w[-1] == bare[-1] and _within_word(bare, w)]
        return tuple(begun) or (bare,)

    def readings(self, surface: str) -> tuple[list[str], list[list[tuple[str, ...]]]]:
        """The ways in which a value may be read, the plainest first, and lattices of words for those of more than ``READINGS``."""
        text = without_remarks(plain(surface))
        bracket = BRACKET.fullmatch(text)
        orders = [[text]]
        if bracket:
            orders += [[bracket[2], bracket[1]], [bracket[1], bracket[2]]]
        else:
            parts = [p for p in PARTS.split(text) if p]
            if len(parts) > 1:
                orders += [parts[::-1], parts]
        out: dict[str, None] = {}
        lattices = []
        for parts in orders:
            joined = " ".join(parts)
            out[" ".join(re.sub(r"[-_./,;:()]+", " ", joined).split())] = None
            tokens = [w for w in (self.spelled(t) for t in re.split(r"[\s_/]+", joined) if t) if w != ("",)]
            if sum(min(map(len, words)) + 1 for words in tokens) - 1 > self.longest + self.threshold:
                continue
            if prod(map(len, tokens)) > READINGS:
                lattices.append(tokens)
                continue
            for words in product(*tokens):
                out[" ".join(words)] = None
        return [x for x in out if x], lattices

    def _nearest(self, reading: str) -> tuple[int, str] | None:
        """(distance, name) of the nearest entry within the threshold; a smaller radius does where it finds one near enough."""
        for most in sorted({self.threshold // 2, self.threshold}):
            trees = [self.trees[n] for n in range(len(reading) - most, len(reading) + most + 1) if n in self.trees]
            near = [(damerau(reading, name), name) for tree in trees for _, name in tree.within(reading, 2 * most)]
            if best := min((x for x in near if x[0] <= most), default=None):
                return best
        return None

    def _table(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The entries, and their letters as rows of numbers."""
        names = list(self.ids)
        codes = np.full((len(names), self.longest), -1, np.int32)
        for k, name in enumerate(names):
            codes[k, : len(name)] = [ord(c) for c in name]
        return names, codes, np.array([len(n) for n in names])

    def nearest_of(self, tokens: list[tuple[str, ...]]) -> tuple[int, str] | None:
        """(distance, name) of the nearest entry within the threshold to any reading of a lattice of words."""
        names, codes, lengths = self.table()
        place = np.arange(self.longest + 1, dtype=np.int32)
        rows = np.tile(place, (len(names), 1))
        for k, words in enumerate(tokens):
            joined = None
            for word in words:
                row = rows
                for c in (" " if k else "") + word:
                    new = row + 1
                    new[:, 1:] = np.minimum(new[:, 1:], row[:, :-1] + (codes != ord(c)))
                    row = np.minimum.accumulate(new - place, axis=1) + place
                joined = row if joined is None else np.minimum(joined, row)
            rows = joined
        found = None
        for k in np.flatnonzero(rows[np.arange(len(names)), lengths] <= 2 * self.threshold):
            for reading in near_readings(tokens, names[k], 2 * self.threshold):
                one = damerau(reading, names[k]), names[k]
                if one[0] <= self.threshold and (found is None or one < found):
                    found = one
        return found

    def match(self, surface: str | None) -> tuple[int, str, str] | None:
        """(distance, pattern, id) of the nearest entry within the threshold."""
        if surface is None:
            return None
        readings, lattices = self.readings(surface)
        exact = [(0, x) for x in readings if x in self.ids]
        found = exact or [x for x in map(self.nearest, readings) if x]
        found += [x for x in map(self.nearest_of, lattices) if x]
        if not found:
            return None
        distance, name = min(found)
        return distance, *self.ids[name]


def words_of(patterns: Iterator[str]) -> set[str]:
    return {w for p in patterns for w in plain(p).split()}


def list_words(entries: DataFrame) -> list[str]:
    """The distinct words of a list of any length."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"word": sorted(words_of(frame["pattern"]))})

    words = entries.select("pattern").mapInPandas(run, "word string").distinct()
    if words.count() > WORDS:
        raise ValueError(f"a list of more than {WORDS} distinct words is no reference list")
    return [r[0] for r in words.collect()]


def mapped(entities: DataFrame, vocabulary: DataFrame, label: str = LABEL, threshold: int = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """``entity_id, surface, id, pattern, distance`` of every row of ``label``; id ``unmatched`` where none is near enough."""
    rows = entities.where((F.col("label") == label) & F.col("entity_id").isNotNull()).select("entity_id", "surface").dropDuplicates(["entity_id"])
    counted = rows.where("surface is not null").groupBy("surface").agg(F.count("*").alias("n"))
    values = spread(counted, "surface")
    entries = vocabulary.where("id is not null and pattern is not null").select("pattern", "id")
    size = entries.count()
    shards = max(1, -(-size // shard))
    words = values.sparkSession.sparkContext.broadcast(list_words(entries)) if shards > 1 else None
    winners = None
    for k in range(shards):
        # a shard has about ``shard`` entries, whatever the list's size
        own = entries if shards == 1 else entries.where(F.pmod(F.xxhash64("pattern"), F.lit(shards)) == k)
        shared = values.sparkSession.sparkContext.broadcast([tuple(r) for r in own.collect()])

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            matcher = Matcher(shared.value, threshold, words.value if words else None)
            for frame in frames:
                found = [(s, n, *m) for s, n, m in zip(frame["surface"], frame["n"], map(matcher.match, frame["surface"]), strict=True) if m]
                yield pd.DataFrame(found, columns=["surface", "n", "distance", "pattern", "id"])

        part = values.mapInPandas(run, "surface string, n bigint, distance int, pattern string, id string")
        winners = part if winners is None else winners.unionByName(part)
    if shards > 1:
        winners = winners.groupBy("surface", "n").agg(F.min(F.struct("distance", "pattern", "id")).alias("w")).select("surface", "n", "w.*")
    # one value may have any share of the rows
    joined = hot_looked_up(rows, winners, ["surface"], "n", counted.agg(F.sum("n")).scalar(), "entity_id", counted, "left")
    return joined.select("entity_id", "surface", F.coalesce("id", F.lit(UNMATCHED)).alias("id"), "pattern", "distance")


def found(entities: DataFrame, vocabulary: DataFrame) -> DataFrame:
    return mapped(entities, vocabulary).select("entity_id", "id")
