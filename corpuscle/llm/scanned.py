"""Problem 1: noise in text from scanned pages, by a hidden Markov model over lines and a lexicon of the corpus.

Each text element is a sequence of lines. A hidden Markov model, whose probabilities are counted from the small labelled
table ``LABELLED``, labels each line as header (running title, page number), body or break (the last line of a paragraph,
or a blank one) from layout features: capitals, final marks, its length against its neighbours', a number that fits the
page, the document's title, its place. Header lines that are a page number or the document's title leave the text, any
other line stays; lines are joined up to the next break, words hyphenated at line ends are closed and misread characters
put back, which gives continuous paragraphs. An element's paragraphs end with it, as page elements are whole paragraphs.

Words are judged by the corpus: words above a share ``SHARE`` of all its words, at most 1 / SHARE of them, are the lexicon.
A word outside it is misread if its *outline*, in which characters that are taken for one another are one, is that of a far
more frequent word; a hyphenated word was broken if its halves are a word of the lexicon when closed.

Defined results: repeated deliveries of an element count once, rows without element_id not at all; null and empty texts
have no damage; headers (with a level) are no running lines; elements whose document or title is unknown have none either.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import distinct_elements, looked_up
from corpuscle.session import cut_lineage

#: Words below this share of all words (or below ``LEAST`` occurrences) are no lexicon; a misread form is ``TIMES`` as rare.
SHARE, LEAST, TIMES = 1e-6, 3, 8

#: Characters that scanning takes for one another, and groups of them.
ALIKE = str.maketrans({"1": "i", "l": "i", "!": "i", "ı": "i", "|": "i", "0": "o", "5": "s", "$": "s", "6": "b", "h": "b", "8": "b", "q": "g", "9": "g", "e": "c", "ҽ": "c", "¢": "c", "α": "a", "@": "a", "†": "t", "ﬁ": "fi", "ﬂ": "fl"})
GROUPS = (("ii", "u"), ("ri", "n"), ("rn", "m"), ("ci", "d"), ("vv", "w"))
#: Characters that never stand within a word but by misreading; digits and what is read for them.
NEVER = re.compile(r"[a-z][†¢|][a-z]|[a-z]![a-z]|(?<=[a-zA-Z])[ҽαı]|[ҽα](?=[a-zA-Z])|[a-z]{2}[0-9][a-z]{2}")
DIGITS = str.maketrans("oOlIi|!ıSsB", "00111111558")
NUMBER = re.compile(r"(?<![\w|!])[0-9oOlIi|!ıSsB]+(?:[.,][0-9oOlIi|!ıSsB]+)*(?![\w|])")

WORD = re.compile(r"[^\W_一-鿿぀-ヿ가-힯＀-￯]+(?:[†¢|!][^\W_一-鿿]+)*[†¢|]?|[†¢|!][^\W_一-鿿]+")
LETTERS = re.compile(r"[^\W\d_]+")
HYPHENS = "-‐‑­¬"
BROKEN = re.compile(rf"(?<![\w†¢|!])([^\W\d_](?:[\w†¢|!])*)([{HYPHENS}][ \t]*\r?\n\s*|[{HYPHENS}] +|[­¬])([\w†¢|!]*[^\W_])")


def outlines(word: str) -> set[str]:
    """The outlines of a word in lower case: groups read in several orders, as one misreading may make another group."""
    plain = word.translate(ALIKE)
    found = set()
    for first in (0, 1, 3):
        outline = plain
        for a, b in (GROUPS[first], *GROUPS[:first], *GROUPS[first + 1 :]):
            outline = outline.replace(a, b)
        found.add(outline)
    return found


class Lexicon:
    """The frequent words of the corpus, and what rarer ones were meant to be."""

    def __init__(self, counts: dict[str, int], least: int):
        self.counts, self.least = counts, least
        best: dict[str, str] = {}
        for word, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
            for outline in sorted(outlines(word)):
                best.setdefault(outline, word)
        self.best = best
        self.known = {w for w in counts if self._far(w) is None}
        self.meant = lru_cache(200_000)(self._meant)

    def _far(self, word: str) -> str | None:
        n = self.counts.get(word, self.least - 1)
        found = [b for o in outlines(word) if (b := self.best.get(o)) and b != word and self.counts[b] >= TIMES * max(n, 1)]
        return max(found, key=lambda b: self.counts[b], default=None)

    def _meant(self, word: str) -> str | None:
        """The word of the lexicon that ``word``, in lower case, misreads; None if it is right or unknown."""
        if word in self.known or len(word) < 2 or word.isdigit():
            return None
        if len(word) < 4 and word.isalpha() and word.isascii():
            return None
        return self._far(word)

    def closed(self, left: str, right: str) -> str | None:
        """The word that two halves are when closed, if the lexicon has it."""
        joined = (left + right).lower()
        if joined in self.known:
            return joined
        return self.meant(joined) if len(joined) > 3 else None


def misread(text: str, lexicon: Lexicon) -> list[tuple[str, str]]:
    """(as written, as meant) of the misread words and numbers of a text, words broken at a line end apart."""
    found = []
    for written in set(WORD.findall(text)):
        word = written.lower()
        if word in lexicon.known or word.isdigit():
            continue
        meant = lexicon.meant(word)
        if meant:
            found.append((written, meant))
        elif NEVER.search(written) or (("ﬁ" in word or "ﬂ" in word) and unicodedata.normalize("NFKC", word) in lexicon.known):
            found.append((written, unicodedata.normalize("NFKC", word)))
    for m in NUMBER.finditer(text):
        digits = sum(c.isdigit() for c in m[0])
        if digits < len(m[0].replace(".", "").replace(",", "")) and (digits >= 2 or (digits and re.search(r"[.,]", m[0][1:-1]) and len(m[0]) > 2)):
            found.append((m[0], m[0].translate(DIGITS)))
    return found


def broken(text: str, lexicon: Lexicon) -> list[tuple[re.Match, str]]:
    """The words of a text that a hyphen and a line end broke, with what they are."""
    if not any(h in text for h in HYPHENS):
        return []
    out, at = [], 0
    while m := BROKEN.search(text, at):
        if word := lexicon.closed(m[1], m[3]):
            out.append((m, word))
        at = m.start(3)
    return out


# ---- lines ----------------------------------------------------------------------------------------------------------

STATES = ("header", "body", "break")
PAGE = re.compile(r"(?:page|p\.|pg\.?|seite|pagina|página|стр\.?)\s*(\d{1,4})|(\d{1,4})\s+(?:of|de|sur|/)\s+\d{1,4}|[-–—]\s*(\d{1,4})\s*[-–—]|\[(\d{1,4})\]|[A-Z]-(\d{1,4})|(\d{1,4})|([ivxl]{1,7})", re.I)
ROMAN = re.compile(r"x{0,4}(?:ix|iv|v?i{0,3})", re.I)
LEADING = re.compile(r"^(\d{1,4}|[ivxl]{1,7})(?:\s*[|·•]\s*|\s{2,}|\s+[-–—]\s+)(?=\S)", re.I)
TRAILING = re.compile(r"(?:\s*[|·•]\s*|\s{2,}|\s+[-–—]\s+|\s*\.{2,}\s*)(?:page|p\.)?\s*(\d{1,4}|[ivxl]{1,7})$", re.I)
#: A printed number may be ahead of the page's place by so many pages, as where volumes were put together.
FRONT_PAGES = 20
ENDS = re.compile(r"[.!?。؟:;][\"')\]»”]*$")
#: An item of a list begins so.
ITEM = re.compile(r"(?:[-–—•*·▪]|\(?[a-z0-9]{1,2}[.)])\s+\S")
#: A line that ends so goes on.
OPEN = re.compile(rf"[{HYPHENS},،、(\[]$")


def page_number(line: str, page: int | None) -> bool:
    """Whether a line is a printed page number: of a usual form, and near its page (counted from 0, perhaps without a title page) where that is known."""
    m = PAGE.fullmatch(line.strip())
    if not m:
        return False
    roman = m[7]
    if roman:
        return bool(ROMAN.fullmatch(roman)) and roman == roman.lower()
    return page is None or 0 <= int(next(g for g in m.groups() if g)) - page <= FRONT_PAGES


def shape(line: str, page: int | None, titles: frozenset[str] | None = None) -> str:
    """What a line looks like; with the keys of the document's ``titles`` a title is one of them, and other lines like it are capitals."""
    text = line.strip()
    if not text:
        return "blank"
    if page_number(text, page):
        return "number"
    if titles and is_title(text, page, titles):
        return "title"
    words = [w for w in LETTERS.findall(text) if len(w) > 3 or w[0].isupper()]
    capitals = sum(w[0].isupper() for w in words)
    like_title = bool(words) and not ENDS.search(text) and capitals >= 0.55 * len(words) and (len(words) > 1 or text.isupper())
    if like_title and titles is None:
        return "title"
    return "item" if ITEM.match(text) else "capitals" if like_title else "words"


def is_title(line: str, page: int | None, titles: frozenset[str]) -> bool:
    return any(key in titles for key, _ in title_candidates(line, page))


def layout(lines: list[str], page: int | None, titles: frozenset[str] | None = None) -> list[tuple]:
    """The layout features of each line: shape, final mark or one that leaves it open, small start, place, and whether it is short for its element."""
    widest = max((len(line.strip()) for line in lines), default=0)
    out = []
    for i, line in enumerate(lines):
        text = line.strip()
        first = next((c for c in text if c.isalpha()), "")
        place = "only" if len(lines) == 1 else "first" if i == 0 else "last" if i == len(lines) - 1 else "within"
        out.append((shape(line, page, titles), "ended" if ENDS.search(text) else "open" if OPEN.search(text) else "none", first.islower(), place, len(text) < 0.75 * widest))
    return out


#: The titles of the labelled table's documents.
TITLES = ("The River Basin Programme: Annual Report", "Lake Province - Rural Roads Project", "Change in Water Use, North Coast 2009")
#: The labelled table: elements of lines, h header, b body, k break (the last of a paragraph, or blank); after an element ";" and its page, from 0.
LABELLED = """
h The River Basin Programme: Annual Report
; 4
h 3
; 2
h - 4 -
; 3
h Page 2
; 1
h [6]
; 5
h A-7
; 6
h vii
; 6
h 8 of 40
; 7
h 5 | Lake Province - Rural Roads Project
; 4
h LAKE PROVINCE - RURAL ROADS PROJECT ... page 9
; 8
k Copies were sent to all offices.
; 2
k (in thousands)
; 2
k Source: field records
; 9
k Table 3. Visits by month
; 3
k Table 7. Wells by Province
; 0
k Annex 2: Fish Markets
; 11
k Minister of Works
k Mary Porter
; 0
k Total Cost of Works 45
; 3
k 450
; 3
k 2,017
; 6
b The committee met twice in the spring and agreed on a plan for the
b northern wells, which the districts were to carry out by the end of
k the year.
; 2
b Prices rose faster than was foreseen at the time when the loan was
b made, so that fewer schools were built, and those that were built
h The River Basin Programme: Annual Report
b had smaller rooms. Later surveys showed that this had little effect
k on attendance.
; 5
h 12  The River Basin Programme: Annual Report
b Staff were trained in the use of the new pumps. Most of them stayed
k in the service for at least three years.
; 11
b Seven of the ten targets were met. The others were dropped after the
b second review, as the funds were needed elsewhere, mainly for the
k Eastern Ports Authority and its offices.
h Page 3
; 2
b Works on the canal began in May and went on until the first rains of
h p. 4
b the autumn. The contractor then left the site, and the works were
b taken over by the Ministry of Water and the
k Lake Province.
; 3
b Repairs to the dam and the northern gate were put off until
b October 2009. Moreover, Provincial Councils and the
b State Bank of the Lakes had not agreed on who was to pay for the
k new pumps.
; 7
h LAKE PROVINCE - RURAL ROADS PROJECT
b The rate of return was found to be lower than at the start, as costs
b had risen by a third and
k traffic had not.
; 1
k One paragraph ends here.
k
b Another begins after a blank line and goes on for a while, as most
k paragraphs do.
; 4
b Most of the wells were dug by hand and lined with local bricks.
b Two of them ran dry in the third year, and the council had them
h Lake Province - Rural Roads Project
b closed. No more were dug after that, as pumps had become cheap.
b The money saved was spent on pipes and on the training of staff
k in the districts.
; 7
b The second loan was smaller than the first. It was to pay for
b roads and bridges only; the rest was left to the provinces.
b They had asked for more, as they had many schools to repair.
k None was given.
; 2
b The review was held in June. It found that costs had been low.
h 14
b Most members were in favour of a further phase in the north.
k One was not.
; 13
b Water was scarce until the dam was built in the hills above it.
b Since then there has been enough for both towns all year round.
b The farmers still draw theirs from the old canals in the plain.
k It is not clean.
k
b The dam is now thirty years old and in need of costly repairs.
h Change in Water Use, North Coast 2009
b These were begun in March and are to last for at least a year.
k They are on time.
; 4
b The northern roads were built by a company that had won the ten-
b der against three others. It left the country before they were fin-
k ished.
; 6
b Of the twelve towns, five have a market hall,
b six a clinic and all of them a school, a post office and a bank.
k One has a port.
; 1
b The pro-
k vinces agreed.
; 2
k - Visits to clinics 45 percent
k - Wells 12
k - Cost of roads 7.5 percent
k - Pumps 9 %
; 3
b - Roads and bridges of the northern provinces, which were to be
k built by a company from the coast.
k - Two harbours
k - A road to the mines that lie beyond the lakes
; 5
k Wells by district
k (a) North 7
k (b) Lakes 112
; 8
k • Low 12
k • High 41 percent
; 9
k Ministry of Finance
k Office of the Auditor
k Port Street 12
; 0
k Director: Paul Winter
k Department of Mines
; 0
b The survey covered four provinces and all of their towns, large and
k small. Its results are given below
h Change in Water Use, North Coast 2009   14
; 13
"""


@lru_cache(1)
def model() -> tuple[dict, dict, list[dict]]:
    """Logarithms of start, transition and emission probabilities, counted with one added."""
    elements, current = [], []
    for line in LABELLED.strip("\n").split("\n"):
        if line[0] == ";":
            elements.append((current, int(line[1:])))
            current = []
        else:
            current.append(({"h": "header", "b": "body", "k": "break"}[line[0]], line[2:]))
    titles = frozenset(map(title_key, TITLES))
    starts, steps, seen = Counter(), Counter(), [Counter() for _ in range(5)]
    values = [set() for _ in range(5)]
    totals = Counter()
    for element, page in elements:
        states = [s for s, _ in element]
        starts[states[0]] += 1
        steps.update(zip(states, states[1:], strict=False))
        for state, row in zip(states, layout([t for _, t in element], page, titles), strict=True):
            totals[state] += 1
            for k, value in enumerate(row):
                seen[k][state, value] += 1
                values[k].add(value)
    start = {s: log((starts[s] + 1) / (len(elements) + 3)) for s in STATES}
    out_of = Counter(a for a, _ in steps.elements())
    step = {(a, b): log((steps[a, b] + 1) / (out_of[a] + 3)) for a in STATES for b in STATES}
    shapes = {"blank", "number", "title", "item", "capitals", "words"}
    emit = [{(s, v): log((seen[k][s, v] + 0.2) / (totals[s] + 0.2 * len(values[k] | (shapes if k == 0 else set())))) for s in STATES for v in values[k] | (shapes if k == 0 else set())} for k in range(5)]
    return start, step, emit


def _viterbi(rows: tuple[tuple, ...]) -> tuple[str, ...]:
    start, step, emit = model()
    score = lambda s, row: sum(table.get((s, v), -8.0) for table, v in zip(emit, row, strict=True))
    best = {s: start[s] + score(s, rows[0]) for s in STATES}
    back = []
    for row in rows[1:]:
        came = {s: max(STATES, key=lambda p: best[p] + step[p, s]) for s in STATES}
        best = {s: best[came[s]] + step[came[s], s] + score(s, row) for s in STATES}
        back.append(came)
    state = max(STATES, key=best.get)
    path = [state]
    for came in reversed(back):
        state = came[state]
        path.append(state)
    return tuple(reversed(path))


_short = lru_cache(100_000)(_viterbi)


def labels(lines: list[str], page: int | None, titles: frozenset[str] | None = None) -> tuple[str, ...]:
    """The state of each line by the Viterbi path of the model."""
    return (_short if len(lines) <= 32 else _viterbi)(tuple(layout(lines, page, titles))) if lines else ()


def title_key(text: str) -> str:
    """What two spellings of a title have in common, misread characters and capitals aside."""
    words = re.findall(r"[\w†¢|!$@]+", unicodedata.normalize("NFC", text).lower())
    return " ".join(max(outlines(w)) for w in words)


def title_candidates(line: str, page: int | None) -> list[tuple[str, bool]]:
    """(key, whether a page number stands beside it) of the titles that a header line may show."""
    text = line.strip()
    out = [(title_key(text), False)]
    for pattern in (LEADING, TRAILING):
        if (m := pattern.search(text)) and page_number(m[1], page):
            out.append((title_key(pattern.sub("", text)), True))
    return [(k, p) for k, p in out if k]


def damage(text: str, page: int | None, header: bool, lexicon: Lexicon) -> tuple[list[str], list[tuple[str, bool]]]:
    """The kinds of damage in an element's text, and the titles its header lines may show."""
    kinds, titles = [], []
    lines = text.replace("\r\n", "\n").split("\n")
    states = ("body",) * len(lines) if header else labels(lines, page)
    body = "\n".join(line for line, state in zip(lines, states, strict=True) if state != "header")
    # a line taken for a header may be part of the text, so that is read with it and without
    for read in dict.fromkeys((body, "\n".join(lines))):
        split = broken(read, lexicon)
        for m, word in reversed(split):
            if (m[1] + m[3]).lower() != word:
                kinds.append("wrong_char")
            read = read[: m.start()] + word + read[m.end() :]
        if split:
            kinds.append("broken_word")
        if misread(read, lexicon):
            kinds.append("wrong_char")
    for line, state in zip(lines, states, strict=True):
        if state == "header":
            if page_number(line, page):
                kinds.append("page_number")
            else:
                titles += title_candidates(line, page)
    return list(dict.fromkeys(kinds)), list(dict.fromkeys(titles))


def repaired(text: str, page: int | None, header: bool, lexicon: Lexicon, titles: frozenset[str] = frozenset()) -> list[str]:
    """The paragraphs of an element without the page's number and running title, broken words closed and misread characters put back.

    ``titles`` are the keys of its document's titles. Every other line stays, whatever the model takes it for.
    """
    lines = text.replace("\r\n", "\n").split("\n")
    states = ("body",) * len(lines) if header else labels(lines, page, titles)
    paragraphs: list[list[str]] = [[]]
    for line, state in zip(lines, states, strict=True):
        if state == "header" and (page_number(line, page) or is_title(line, page, titles)):
            continue
        if line.strip():
            paragraphs[-1].append(line.strip())
        if state != "body" or not line.strip():
            paragraphs.append([])
    out = []
    for paragraph in paragraphs:
        if paragraph:
            joined = "\n".join(paragraph)
            for m, word in reversed(broken(joined, lexicon)):
                joined = joined[: m.start()] + _cased(m[1] + m[3], word) + joined[m.end() :]
            joined = re.sub(r"\s+", " ", joined)
            wrong = {w: _cased(w, meant) for w, meant in misread(joined, lexicon)}
            if wrong:
                joined = re.sub("|".join(rf"(?<!\w){re.escape(w)}(?!\w)" for w in sorted(wrong, key=len, reverse=True)), lambda m: wrong[m[0]], joined)
            out.append(joined)
    return out


def _cased(like: str, word: str) -> str:
    letters = [c for c in like if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return word.upper()
    return word[:1].upper() + word[1:] if letters and like[:1].isupper() else word


# ---- queries --------------------------------------------------------------------------------------------------------


def text_elements(content: DataFrame) -> DataFrame:
    usable = (F.col("type") == "text") & F.col("text").isNotNull() & (F.col("text") != "")
    return content.where(usable).select("element_id", "doc_id", "pos", "page_idx", F.col("text_level").isNotNull().alias("header"), "text")


def lexicon_of(elements: DataFrame, share: float = SHARE) -> Lexicon:
    """The lexicon of all texts. Words are counted in part where they are read; at most 1 / share come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        total = 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                text = text.lower()
                if any(h in text for h in HYPHENS):
                    text = BROKEN.sub(" ", text)
                found = LETTERS.findall(text)
                total += len(found)
                counts.update(found)
            if len(counts) > 1_000_000:
                yield rows()
                counts.clear()
        counts[""] += total  # the number of all words, under the empty one
        yield rows()

    counted = cut_lineage(elements.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    total = counted.where("word = ''").select("n").collect()
    least = max(LEAST, int(share * total[0][0]) if total else 0)
    frequent = counted.where((F.col("n") >= least) & (F.col("word") != ""))
    return Lexicon({r["word"]: r["n"] for r in frequent.toLocalIterator()}, least)


def damaged(content: DataFrame, documents: DataFrame) -> DataFrame:
    """``element_id, kind`` of every damaged element."""
    elements = text_elements(content)
    lexicon = lexicon_of(elements)
    shared, least = elements.sparkSession.sparkContext.broadcast(lexicon.counts), lexicon.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(shared, least)
        for batch in batches:
            ids, docs, kinds, keys, numbered = [], [], [], [], []
            columns = [batch.column(c).to_pylist() for c in range(5)]
            for element, doc, page, header, text in zip(*columns, strict=True):
                own, titles = damage(text, page, header, lexicon)
                for kind, key, number in [*((k, None, None) for k in own), *((None, *t) for t in titles)]:
                    ids.append(element)
                    docs.append(doc)
                    kinds.append(kind)
                    keys.append(key)
                    numbered.append(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(docs, pa.int64()), pa.array(kinds, pa.string()), pa.array(keys, pa.string()), pa.array(numbered, pa.bool_())],
                ["element_id", "doc_id", "kind", "key", "numbered"],
            )

    seen = cut_lineage(elements.select("element_id", "doc_id", "page_idx", "header", "text").mapInArrow(run, "element_id bigint, doc_id bigint, kind string, key string, numbered boolean").where("element_id is not null"))

    titles = title_keys(documents)
    hashed = lambda df, *more: df.select("doc_id", F.xxhash64("key").alias("key"), *more)
    shown = hashed(seen.where("key is not null and doc_id is not null"), "element_id", "numbered")
    known = hashed(titles.where("key <> ''")).distinct().withColumn("known", F.lit(True))
    running = looked_up(shown, known, ["doc_id", "key"], "element_id", "inner", salts=4)
    kinds = F.when(F.col("numbered"), F.array(F.lit("running_line"), F.lit("page_number"))).otherwise(F.array(F.lit("running_line")))
    return seen.where("kind is not null").select("element_id", "kind").unionByName(running.select("element_id", F.explode(kinds).alias("kind"))).distinct()


def title_keys(documents: DataFrame) -> DataFrame:
    """``doc_id, key`` of the documents' titles."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([title_key(t) for t in batch.column(1).to_pylist()], pa.string())], ["doc_id", "key"])

    return documents.where("doc_id is not null and display_title is not null").select("doc_id", "display_title").mapInArrow(keyed, "doc_id bigint, key string")


_made: dict[int, Lexicon] = {}


def _lexicon(shared, least: int) -> Lexicon:
    """The lexicon of a broadcast, made once in each worker."""
    key = id(shared.value)
    if key not in _made:
        _made.clear()
        _made[key] = Lexicon(shared.value, least)
    return _made[key]


def paragraphs(content: DataFrame, documents: DataFrame) -> DataFrame:
    """``element_id, doc_id, pos, paragraph, text``: the repaired text of every element, once.

    Besides what is put back, an element loses nothing but lines that are its page's number or its document's title.
    """
    elements = text_elements(content)
    lexicon = lexicon_of(elements)
    shared, least = elements.sparkSession.sparkContext.broadcast(lexicon.counts), lexicon.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(shared, least)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(3, 7)]
            texts = [repaired(text, page, header, lexicon, frozenset(keys or ())) for page, header, text, keys in zip(*columns, strict=True)]
            rows = pa.array([i for i, found in enumerate(texts) for _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(rows) for c in range(3)), pa.array([k for found in texts for k in range(len(found))], pa.int32()), pa.array([t for found in texts for t in found], pa.string())],
                ["element_id", "doc_id", "pos", "paragraph", "text"],
            )

    once = distinct_elements(elements, "doc_id", "pos", "page_idx", "header", "text")
    titles = title_keys(documents).where("key <> ''").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    # one document may have any share of the elements
    told = looked_up(once, titles, ["doc_id"], "element_id", salts=4).select(*once.columns, "keys")
    return told.mapInArrow(run, "element_id bigint, doc_id bigint, pos int, paragraph int, text string")


def letters(content: DataFrame, documents: DataFrame) -> DataFrame:
    """``doc_id, n_in, n_out``: the letters and digits of each document's text elements, and those of its repaired paragraphs."""
    counted = F.length(F.regexp_replace("text", r"[^\p{L}\p{N}]", ""))
    before = distinct_elements(text_elements(content), "doc_id", "text").groupBy("doc_id").agg(F.sum(counted).alias("n_in"))
    after = paragraphs(content, documents).groupBy("doc_id").agg(F.sum(counted).alias("n_out"))
    return before.join(after.select(F.col("doc_id").alias("out_id"), "n_out"), F.col("doc_id").eqNullSafe(F.col("out_id")), "left").select("doc_id", "n_in", F.coalesce("n_out", F.lit(0)).alias("n_out"))
