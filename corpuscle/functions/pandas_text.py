"""Text functions that have no counterpart in Spark, as Arrow batches."""

from __future__ import annotations

import html
import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def unescape(values: pd.Series) -> pd.Series:
    """HTML character references as characters, stripped; null stays null."""
    return values.map(lambda v: None if v is None else html.unescape(v).strip())


class _FirstTable(HTMLParser):
    """The cells of the first table, row by row."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[str]] = []
        self.depth, self.closed, self.found = 0, False, False
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if self.closed:
            return
        if tag == "table":
            self.depth, self.found = self.depth + 1, True
        elif self.depth and tag == "tr":
            self._end_cell()
            self.rows.append([])
        elif self.depth and tag in ("td", "th"):
            self._end_cell()
            if not self.rows:
                self.rows.append([])
            self.cell = []
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr"):
            self._end_cell()
        elif tag == "table" and self.depth:
            self._end_cell()
            self.depth -= 1
            self.closed = not self.depth

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def _end_cell(self):
        if self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None


def markdown_table(body: str | None) -> str | None:
    """The first HTML table of ``body`` in Markdown; null without a table."""
    if not body:
        return None
    parser = _FirstTable()
    parser.feed(body)
    parser.close()
    parser._end_cell()
    rows = [r for r in parser.rows if r]
    if not parser.found or not rows:
        return None
    width = max(map(len, rows))
    lines = ["| " + " | ".join(c.replace("|", "\\|") for c in [*r, *[""] * (width - len(r))]) + " |" for r in rows]
    return "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]])


@F.pandas_udf(T.StringType())
def table_to_markdown(bodies: pd.Series) -> pd.Series:
    return bodies.map(markdown_table)


def loose_json(answer: str | None) -> dict[str, str]:
    """The object in a model's answer: as it is, else the outermost braces, else with quotes and commas repaired, else {}."""
    if not answer:
        return {}
    embraced = re.search(r"\{.*\}", answer, re.S)
    tries = [answer, embraced[0] if embraced else None]
    if embraced:
        quoted = re.sub(r"(?<!\w)'|'(?!\w)", '"', embraced[0])
        tries.append(re.sub(r",\s*}", "}", quoted))
    for text in tries:
        try:
            found = json.loads(text) if text else None
        except ValueError:
            continue
        if isinstance(found, dict):
            return {str(k): None if v is None else str(v) for k, v in found.items()}
    return {}


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def parse_answer(answers: pd.Series) -> pd.Series:
    return answers.map(loose_json)


def abbreviations(text: str | None) -> list[tuple[str, str]]:
    """(short, long) pairs as in "long form (SF)" or "SF (the long form)", by the alignment of Schwartz and Hearst (2003)."""
    found: dict[str, str] = {}
    for m in re.finditer(r"\(([^()]{2,})\)", text or ""):
        inside = m[1].strip()
        before = text[: m.start()].rstrip()
        if _short(inside):
            words = before.rsplit(None, min(len(inside) + 5, 2 * len(inside)))
            words = words[1:] if len(words) > min(len(inside) + 5, 2 * len(inside)) else words
            if long := _align(inside, " ".join(words)):
                found.setdefault(inside, long)
        elif before and _short(head := before.rsplit(None, 1)[-1]) and (long := _align(head, inside)):
            found.setdefault(head, long)
    return list(found.items())


def _short(text: str) -> bool:
    return 2 <= len(text) <= 10 and len(text.split()) <= 2 and text[0].isalnum() and any(c.isalpha() for c in text) and sum(c.isupper() for c in text) * 2 >= len(text)


def _align(short: str, words: str) -> str | None:
    """The shortest end of ``words`` whose letters hold those of ``short`` in order, the first at the start of a word."""
    at = len(words) - 1
    for k in range(len(short) - 1, -1, -1):
        c = short[k].lower()
        if not c.isalnum():
            continue
        while at >= 0 and (words[at].lower() != c or (k == 0 and at > 0 and words[at - 1].isalnum())):
            at -= 1
        if at < 0:
            return None
        at -= 1
    start = words.rfind(" ", 0, at + 2) + 1
    long = words[start:]
    return long if len(long) > len(short) and short not in long.split() else None


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("short", T.StringType()), T.StructField("long", T.StringType())])))
def inline_abbreviations(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [{"short": s, "long": v} for s, v in abbreviations(t)])
