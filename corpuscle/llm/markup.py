"""Problem 5: markup residue in tables, by a decision tree over flat text blocks.

A table body is read as a flat list of text blocks, its cells (or one block, where there is no grid). A block is described
by shallow text features, as in boilerplate detection: its word count, its link density in each notation (the share of its
words that stand in links), word count and link density of the blocks before and after it, and how often the other marks of
each notation occur. For each notation a decision tree, trained here on the small labelled tables of ``LABELLED``, whose
blocks stand among their real neighbours, says whether the block holds it. Links are known by their density only. ``clean``
then turns what was found into plain text that keeps rows, cells, headings, lists, code and formulas.

Defined results: repeated deliveries of an element count once, rows without element_id not at all; null and empty bodies
hold nothing; grid tags and character references of single characters are no markup; a body is read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("html", "markdown", "wiki", "latex")
GRID = r"</?(?:table|thead|tbody|tr|th|td)(?:\s[^<>]*)?/?>"
TAG = r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>|<!--.*?(?:-->|$)"

#: What is counted in a block, in the order of the features.
MARKS = {
    "tag": re.compile(TAG, re.S),
    "wiki_template": re.compile(r"\{\{[^{}\n]+\}\}"),
    "wiki_quotes": re.compile(r"(?<!')('{2,3}|'{5})(?=[^\s'])[^'\n]*[^\s']\1(?!')"),
    "wiki_heading": re.compile(r"^[ \t]*(={2,6})[^=\n]+\1[ \t]*$", re.M),
    "wiki_list": re.compile(r"^(?:\*|#|\*\*|\*#)[ \t]+\S[^\n]*\n[ \t]*(?:\*\*|##|\*#|#\*|:)\s*\S", re.M),
    "wiki_table": re.compile(r"^[ \t]*\{\|[^\n]*\n", re.M),
    "md_emphasis": re.compile(r"(?<![\w*])(\*{2,3})(?=[^\s*])[^*\n]*[^\s*]\1(?![\w*])|(?<![\w_])__(?=[^\s_])[^\n]*?[^\s_]__(?![\w_])|~~(?=[^\s~])[^~\n]+~~"),
    "md_heading": re.compile(r"^(?:#{2,6}\s+\S|#\s+[A-Z])", re.M),
    "md_code": re.compile(r"```[^`]*```|(?<![`\w])`[^`\n]+`(?!`)"),
    "md_quote": re.compile(r"^>[ \t]+\S[^\n]*\n>[ \t]*\S", re.M),
    "md_list": re.compile(r"^[ \t]*(?:[-+*][ \t]+\S[^\n]*\n[ \t]*[-+*][ \t]+\S|\d+[.)][ \t]+\S[^\n]*\n[ \t]*\d+[.)][ \t]+\S)", re.M),
    "md_table": re.compile(r"^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$", re.M),
    "tex_command": re.compile(r"\\(?:[a-zA-Z]{2,}\*?)(?:\[[^\]\n]*\])?\{"),
    "tex_environment": re.compile(r"\\(?:begin|end)\{[a-zA-Z*]+\}"),
    "tex_math": re.compile(r"\$(?=[^$\n]*(?:\\[a-zA-Z]+|[\^_]\{?\w))[^$\n]+\$|\\\(.+?\\\)|\\\[.+?\\\]"),
    "tex_escape": re.compile(r"(?<!\\)\\[%&#_$](?!\w)"),
    "tex_row": re.compile(r"\\\\\s*(?:\\hline|\n|$)"),
}
PATHS = re.compile(r"\b[A-Za-z]:\\|\\\\\w+\\")
#: Links of each notation; a bare address counts as one of its neighbourhood only.
LINKS = {
    "html": re.compile(r"<a\s[^>]*>(?:.*?</a>)?", re.S | re.I),
    "markdown": re.compile(r"!?\[[^\[\]\n]*\]\([^()\s]+(?:\s+\"[^\"]*\")?\)(?!\w)"),
    "wiki": re.compile(r"\[\[[^\[\]\n]+\]\]|(?<![\]!\w])\[(?:https?|ftp)://[^\s\]]+ [^\]\n]+\](?!\()"),
}
#: The density of a block with a link is this at least, so that a link in a long block is seen.
LEAST_LINK = 0.05
ADDRESS = re.compile(r"https?://\S+")
PLAIN = re.compile(r"[\w\s.,%:;/+-]*")
WORD = re.compile(r"\w+")
NEAR = ("words_before", "links_before", "words_after", "links_after")
FEATURES = (*MARKS, "path", "words", *(f"links_{kind}" for kind in LINKS), *NEAR)

#: The labelled tables, apart by a blank line: of each block its notation, or "none", and its text ("¶" is a line end).
LABELLED = r"""
none|District
none|# of units
none|Share
none|Remarks
html|<b>total</b>
none|12.5
none|0.31**
html|value<br/>see below
none|North
none|#12
html|<i>5</i>
none|n.a.
html|<em>unfinished
none|(# of units)
markdown|~~31~~
none|words of a plain cell

none|Area (ha)
none|12.5*
none|'as reported'
latex|wages\%
none|Lakes
none|> 15 km
html|<span style="color:red">7</span>
html|<a href="http://example.invalid/a">more about the survey</a>
none|Coast
none|< 5 %
markdown|**12** and more
markdown|[text](http://example.invalid/b)
wiki|[[Page]]
none|3 < 4 km
wiki|''7''
wiki|[[page|shown words]]

none|Project
none|$2-$12 per day
none|[12]
wiki|{{flag|X}} north
none|$ 3.4 million
none|[see note](a)b
wiki|[http://example.invalid/c shown]
none|$5 to $7
none|http://example.invalid/x
html|<p class=Normal>costs of the second year
none|US$ 3 & 4
none|50% of $10

html|<ul><li>one</li><li>two</li></ul>
markdown|- one¶- two¶- three
wiki|* item¶** below it
none|* estimate
markdown|+ one¶+ two
wiki|# item¶## below it
none|1. Introduction
markdown|1. first¶2. second
none|one line¶and another
markdown|1) first¶2) second
none|(a) yes; (b) no
latex|\begin{itemize} \item one \end{itemize}

none|a < b and c > d
html|<!-- hidden --> 12
none|A_1 / B_2
html|<!-- never closed
none|IND_12_B
html|<code>run()</code>
none|a_b_c
html|<pre>load a¶  b</pre>
none|x = 1, y = 2
markdown|`code`
none|a == b
markdown|see `run` first
none|{n = 25}
markdown|```¶sum(x)¶```
none|`
html|<h2>Results</h2>
wiki|== Section ==
wiki|=== Deeper ===
markdown|## Heading¶
markdown|# Title
latex|\section*{Part}

none|12'' pipe
wiki|''slanted''
none|4' 6'' high
wiki|'''bold'''
none|D:\annex\t1.xls
wiki|'''''both'''''
none|\\server\share\file
latex|\emph{9}
none|C:\data\new table.csv
latex|\textbf{words}
none|10^6 m3
latex|$x^{2} + 1$ of the area
none|~ 20
latex|$\sum_i y_i$
none|-3.1
latex|\( \alpha = 0.5 \)
none|- none
latex|\[ a = b \]
none|a | b
latex|$a_1$

none|2010-2014
none|R&D staff
latex|staff \& equipment
none|0.02***
markdown|***both***
none|2 * 3
markdown|__strong__
none|~5 and ~6
markdown|~~gone~~
none|<5
markdown|**bold words**
none|x<y
markdown|> quoted words¶> go on
none|a > b¶c > d
latex|12\%
latex|\frac{a}{100}
none|-
latex|$\mathrm{CO_{2}}$
latex|\multicolumn{2}{c}{sum}
latex|\textit{total} \\ \hline

none|Source
none|The figures of the first year are those of the survey of households, which asked for the cost of water, the way to the next well, the number of cattle and the schooling of children, and left out the islands and the towns of the coast, where no list of households was at hand, and the camps.
wiki|The figures of the second year are those of the [[census]], which asked for the cost of water, the way to the next well, the number of cattle and the schooling of children, and left out the islands and the towns of the coast, where no list of households was at hand, and the camps.
markdown|The figures of the third year are those of the [register](r.htm), which holds the cost of water, the way to the next well, the number of cattle and the schooling of children, and leaves out the islands and the towns of the coast, where no list of households was at hand, and the camps.
html|The figures of the last year are those of the <a href="r.htm">register</a>, which holds the cost of water, the way to the next well, the number of cattle and the schooling of children, and leaves out the islands and the towns of the coast, where no list of households was at hand, and the camps.
none|Notes [1] and (2) hold.
html|<strong>rural</strong> roads and bridges
markdown|**2,100** households in the delta
none|see http://example.invalid/long/path for more

html|<img src="a.png"/>
markdown|![figure](fig1.png)
wiki|[[File:a.png|thumb|caption of it]]
none|Figure 1
html|x<sup>2</sup>
wiki|{{cite|title=x}}
latex|\cite[p. 2]{key}
wiki|{{Increase|12}}
wiki|'''12'''
html|<FONT size=3>old</FONT>

html|<html><body>

html|</body></html>

html|<div>

markdown|| a | b |¶|---|---|¶| 1 | 2 |

markdown|| a | b | c |¶|:--|:--|--:|¶| 1 | 2 | 3 |

markdown|a | b¶--- | ---¶1 | 2

wiki|{| class="x"¶! A !! B¶|-¶| 1 || 2¶|}

wiki|{|¶! A¶|-¶| words of a row¶|}

latex|\begin{tabular}{lr}¶a & b \\ \hline¶1 & 2 \\¶\end{tabular}

none|a plain body without a grid

none|12 | 14 | 15
"""


def describe(blocks: list[str]) -> list[tuple]:
    """The features of each block; blocks of plain words share what is counted."""
    base = []
    for block in blocks:
        words = len(WORD.findall(block))
        if PLAIN.fullmatch(block) and "\n" not in block and "__" not in block and "://" not in block:
            base.append(((0,) * (len(MARKS) + 1), min(words, 99), (0.0,) * len(LINKS), 0.0))
            continue
        path = bool(PATHS.search(block))
        counts = tuple(min(3, sum(1 for _ in pattern.finditer(block))) for pattern in MARKS.values())
        linked = [sum(len(WORD.findall(m[0])) or 1 for m in pattern.finditer(block)) for pattern in LINKS.values()]
        bare = 0 if any(linked) else sum(len(WORD.findall(m[0])) for m in ADDRESS.finditer(block))
        share = lambda n: n and max(LEAST_LINK, min(1.0, n / max(words, 1)))
        base.append(((*counts, int(path)), min(words, 99), tuple(map(share, linked)), share(sum(linked) + bare)))
    nothing = ((), 0, (), 0.0)
    around = [nothing, *base, nothing]
    near = lambda row: (row[1], round(row[3], 1))
    return [(*marks, words, *links, *near(around[i]), *near(around[i + 2])) for i, (marks, words, links, _) in enumerate(base)]


@dataclass(frozen=True)
class Node:
    """A decision: the feature and the value above which ``more`` decides, or the answer of a leaf."""

    feature: int = -1
    value: float = 0.0
    less: Node | None = None
    more: Node | None = None
    answer: bool = False

    def __call__(self, row: tuple) -> bool:
        node = self
        while node.feature >= 0:
            node = node.more if row[node.feature] > node.value else node.less
        return node.answer


def grow(rows: list[tuple], labels: list[bool], depth: int = 12) -> Node:
    """A tree by the Gini impurity; of equal splits the first feature, so that training is repeatable."""
    yes = sum(labels)
    if not depth or yes in (0, len(rows)):
        return Node(answer=2 * yes > len(rows))
    best = None
    for f in range(len(rows[0])):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:], strict=False):
            at = (low + high) / 2
            above = [y for r, y in zip(rows, labels, strict=True) if r[f] > at]
            n, k = len(above), sum(above)
            impurity = k * (n - k) / n + (yes - k) * (len(rows) - n - yes + k) / (len(rows) - n)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, at)
    if best is None:
        return Node(answer=2 * yes > len(rows))
    _, f, at = best
    parts = [[(r, y) for r, y in zip(rows, labels, strict=True) if (r[f] > at) == side] for side in (False, True)]
    less, more = (grow([r for r, _ in p], [y for _, y in p], depth - 1) for p in parts)
    return Node(f, at, less, more)


@lru_cache(1)
def trees() -> dict[str, Node]:
    """A tree for each notation, trained on the labelled tables."""
    rows, labels = [], []
    for table in LABELLED.strip("\n").split("\n\n"):
        blocks = [line.split("|", 1) for line in table.split("\n")]
        rows += describe([text.replace("¶", "\n") for _, text in blocks])
        labels += [kind for kind, _ in blocks]
    return {kind: grow(rows, [label == kind for label in labels]) for kind in KINDS}


def drawn(node: Node, depth: int = 0) -> str:
    """A tree as lines of text."""
    if node.feature < 0:
        return "  " * depth + ("yes" if node.answer else "no") + "\n"
    head = "  " * depth + f"{FEATURES[node.feature]} > {node.value:.3g}\n"
    return head + drawn(node.more, depth + 1) + drawn(node.less, depth + 1)


def used(node: Node) -> set[str]:
    """The features that a tree asks for."""
    return set() if node.feature < 0 else {FEATURES[node.feature]} | used(node.less) | used(node.more)


CELL = re.compile(r"<(?:td|th)(?:\s[^<>]*)?>(.*?)(?=</?(?:td|th|tr|thead|tbody|table)(?:\s[^<>]*)?>|$)", re.S | re.I)


def blocks_of(body: str) -> list[str]:
    """The cells of a grid, and what stands around them as a block of its own; without a grid, the body as one block.

    Character references are read as their characters, so that a tag written with them is a tag like any other.
    """
    if re.search(r"<(?:table|tr|td|th)[\s>]", body, re.I):
        cells = [m[1] for m in CELL.finditer(body)]
        around = re.sub(GRID, " ", CELL.sub(" ", body), flags=re.I)
        found = [*cells, *([around.strip()] if around.strip() else [])]
    else:
        found = [body]
    return [html.unescape(b) if "&" in b else b for b in found]


class Classifier:
    """The notations of a body, by the trees; blocks that are described alike are decided once."""

    def __init__(self, grown: dict[str, Node] | None = None):
        self.grown = grown or trees()
        self.decided = lru_cache(200_000)(self._decide)

    def _decide(self, row: tuple) -> tuple[str, ...]:
        return tuple(kind for kind in KINDS if self.grown[kind](row))

    def kinds(self, body: str | None) -> list[str]:
        if not body:
            return []
        found: set[str] = set()
        for row in describe(blocks_of(body)):
            found.update(self.decided(row))
        return [k for k in KINDS if k in found]


def _tables(content: DataFrame) -> DataFrame:
    usable = (F.col("type") == "table") & F.col("element_id").isNotNull() & F.col("table_body").isNotNull()
    return content.where(usable).select("element_id", "table_body")


def residue(content: DataFrame) -> DataFrame:
    """``element_id, markup``: a row for each notation that a table's body holds."""
    grown = trees()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Classifier(grown).kinds
        for batch in batches:
            found = [kinds(b) for b in batch.column(1).to_pylist()]
            rows = pa.array([i for i, ks in enumerate(found) for _ in ks], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array([k for ks in found for k in ks], pa.string())], ["element_id", "markup"])

    return _tables(content).mapInArrow(run, "element_id bigint, markup string").distinct()


# ---- plain text -----------------------------------------------------------------------------------------------------


def _html_to_text(text: str) -> str:
    text = re.sub(r"<!--.*?(?:-->|$)", "", text, flags=re.S)
    text = re.sub(r"<pre(?:\s[^<>]*)?>(.*?)(?:</pre>|$)", lambda m: "\n" + m[1].strip("\n") + "\n", text, flags=re.S | re.I)
    text = re.sub(r"<br\s*/?>", "\n", text, flags=re.I)
    text = re.sub(r"<li(?:\s[^<>]*)?>", "\n- ", text, flags=re.I)
    text = re.sub(r"</?(?:p|div|ul|ol|h[1-6])(?:\s[^<>]*)?>", "\n", text, flags=re.I)
    text = re.sub(r"<sup>(.*?)</sup>", r"^\1", text, flags=re.S | re.I)
    text = re.sub(r"<sub>(.*?)</sub>", r"_\1", text, flags=re.S | re.I)
    return re.sub(TAG, "", text, flags=re.S)


def _markdown_to_text(text: str) -> str:
    text = re.sub(r"```\w*\n?([^`]*?)\n?```", r"\n\1\n", text)
    text = re.sub(r"(?<!`)`([^`\n]+)`(?!`)", r"\1", text)
    text = re.sub(r"!?\[([^\[\]\n]*)\]\([^()\s]+(?:\s+\"[^\"]*\")?\)", r"\1", text)
    text = re.sub(r"(?<![\w*])(\*{2,3})(?=[^\s*])([^*\n]*[^\s*])\1(?![\w*])", r"\2", text)
    text = re.sub(r"(?<![\w_])__(?=[^\s_])([^\n]*?[^\s_])__(?![\w_])", r"\1", text)
    text = re.sub(r"~~([^~\n]+)~~", r"\1", text)
    text = re.sub(r"^#{1,6}\s+", "", text, flags=re.M)
    text = re.sub(r"^>\s?", "", text, flags=re.M)
    return re.sub(r"^\s*[+*]\s+", "- ", text, flags=re.M)


def _wiki_to_text(text: str) -> str:
    text = re.sub(r"\[\[(?:File|Image):[^\[\]]*\|([^\[\]|]*)\]\]", r"\1", text)
    text = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", text)
    text = re.sub(r"\{\{[^{}|]*\|(?:[^{}|=]*=)?([^{}|]*)[^{}]*\}\}", r"\1", text)
    text = re.sub(r"\{\{([^{}|]*)\}\}", r"\1", text)
    text = re.sub(r"\[(?:https?|ftp)://[^\s\]]+ ([^\]\n]+)\]", r"\1", text)
    text = re.sub(r"(?<!')('{5}|'{2,3})(?=[^\s'])([^'\n]*[^\s'])\1(?!')", r"\2", text)
    text = re.sub(r"^\s*(={2,6})\s*([^=\n]+?)\s*\1\s*$", r"\2", text, flags=re.M)
    return re.sub(r"^[*#]+\s*", "- ", text, flags=re.M)


def _latex_to_text(text: str) -> str:
    kept: list[str] = []

    def keep(m: re.Match) -> str:
        kept.append(m[0])
        return f"\x00{len(kept) - 1}\x00"

    text = MARKS["tex_math"].sub(keep, text)
    text = re.sub(r"\\frac\{([^{}]*)\}\{([^{}]*)\}", r"\1/\2", text)
    text = re.sub(r"\\multicolumn\{[^{}]*\}\{[^{}]*\}\{([^{}]*)\}", r"\1", text)
    text = re.sub(r"\\(?:begin|end)\{[a-zA-Z*]+\}(?:\{[^{}]*\})?", "\n", text)
    text = re.sub(r"\\item\s*", "\n- ", text)
    text = re.sub(r"\\hline|\\[ct]oprule|\\midrule|\\bottomrule", "", text)
    for _ in range(4):
        text = re.sub(r"\\[a-zA-Z]{2,}\*?(?:\[[^\]\n]*\])?\{([^{}]*)\}", r"\1", text)
    text = re.sub(r"\\([%&#_$])", r"\1", text)
    text = re.sub(r"\\\\\s*$", "", text, flags=re.M)
    return re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m[1])], text)


TO_TEXT = {"html": _html_to_text, "markdown": _markdown_to_text, "wiki": _wiki_to_text, "latex": _latex_to_text}


def _rows_without_grid(body: str, kinds: list[str]) -> list[list[str]] | None:
    """The cells of a table wholly in another notation."""
    if "wiki" in kinds and MARKS["wiki_table"].search(body):
        inner = re.sub(r"^\s*\{\|[^\n]*\n|\n?\|\}\s*$", "", body)
        rows = []
        for part in re.split(r"^\|-[^\n]*\n?", inner, flags=re.M):
            cells = [c.strip() for line in part.split("\n") if line.strip() for c in re.split(r"\|\||!!", re.sub(r"^\s*[|!]\s?", "", line))]
            if cells:
                rows.append(cells)
        return rows
    if "latex" in kinds and MARKS["tex_environment"].search(body):
        inner = re.sub(r"\\(?:begin|end)\{[a-zA-Z*]+\}(?:\{[^{}]*\})?", "", body)
        return [[c.strip() for c in re.split(r"(?<!\\)&", re.sub(r"\\hline", "", row))] for row in re.split(r"\\\\", inner) if row.replace("\\hline", "").strip()]
    if "markdown" in kinds and MARKS["md_table"].search(body):
        lines = [line for line in body.split("\n") if line.strip() and not MARKS["md_table"].fullmatch(line)]
        return [[c.strip() for c in line.strip().strip("|").split("|")] for line in lines]
    return None


def clean(body: str | None, classifier: Classifier) -> str:
    """``body`` as text: a line a row and a tab between cells; line ends within a cell become " / "."""
    if not body:
        return ""
    kinds = classifier.kinds(body)

    def text_of(cell: str) -> str:
        own = classifier.decided(describe([cell])[0])
        for kind in KINDS:
            if kind in own:
                cell = TO_TEXT[kind](cell)
        return " / ".join(" ".join(line.split()) for line in cell.split("\n") if line.strip())

    if not re.search(r"<(?:table|tr|td|th)[\s>]", body, re.I):
        rows = _rows_without_grid(html.unescape(body), kinds)
        if rows is None:
            text = html.unescape(body)
            for kind in kinds:
                text = TO_TEXT[kind](text)
            return "\n".join(" ".join(line.split()) for line in text.split("\n") if line.strip())
        return "\n".join("\t".join(text_of(c) for c in row) for row in rows)
    lines = []
    for row in re.split(r"<tr(?:\s[^<>]*)?>", body, flags=re.I):
        cells = [text_of(html.unescape(m[1])) for m in CELL.finditer(row)]
        if cells:
            lines.append("\t".join(cells))
    return "\n".join(lines)


def cleaned(content: DataFrame) -> DataFrame:
    """``element_id, text``: every table's body as clean text, once."""
    grown = trees()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(grown)
        for batch in batches:
            texts = pa.array([clean(b, classifier) for b in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["element_id", "text"])

    return _tables(content).mapInArrow(run, "element_id bigint, text string").dropDuplicates(["element_id"])
