"""Problem 10: texts cut off by a field limit or a broken transfer, by self-joins on prefixes.

Values are sorted; a value that is a strict prefix of any other is one of its successor, so one comparison each replaces
the join of all pairs. This is done twice. For whole texts it finds those of which a longer copy goes on within the line.
For sentences it finds the ends of texts that go on elsewhere: of a text without a final mark, what follows its last
sentence end is cut if it is a strict prefix of another sentence of the corpus (numbers alike) and stands nowhere itself as
a sentence or line, as headings, captions, list items and the like do. Pieces without a letter are no sentences.

An ending that no sentence of the corpus continues is held against the lines that begin alike (by the prefix of their first
words): where such lines end with a mark it is an unfinished sentence, where they end without one it is whole.

Defined results: null, empty and blank texts aren't cut; stray control and replacement characters at the end are passed
over; copies of a text share its verdict and count once in the statistics; rows without doc_id count in no result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpuscle.llm.common import looked_up
from corpuscle.session import cut_lineage

#: What may stand after the end of a text, marks that end a sentence, and what may close after them.
STRAY = "".join(map(chr, (*range(33), *range(0x7F, 0xA1), 0xAD, 0x1680, *range(0x2000, 0x2010), *range(0x2028, 0x2030), 0x205F, 0x2060, 0x3000, 0xFEFF, 0xFFFD)))
MARK = ".!?。！？؟۔।"
CLOSERS = "[\"')\\]»”’」』*_]*"
ENDED = re.compile(rf"[{MARK}]{CLOSERS}$")
#: A remark in brackets after the last sentence; an amount of money broken off at its point; dots in place of the rest.
REMARK = re.compile(rf"[{MARK}]{CLOSERS}\s*\([^()\n]*\)$")
BROKEN_AMOUNT = re.compile(r"(?:US\$|\$|EUR|USD|€|£) ?\d{1,3}\.$")
DOTS = ("...", "…")
#: A tag or character reference that was begun and not ended.
DANGLING = re.compile(r"(?:<[A-Za-z/]{0,8}|&(?:#\d*|am?p?|apo?s?|lt?|gt?|nb?s?p?|quo?t?)?)$")
#: Marks that end a line of running text or a sentence in a list, and what may close after them.
LINE_MARKS, CLOSING = MARK + ";:,…", "[\"')]»”’」』*_"
SENTENCES = re.compile(r"(?<=[.!?؟۔।])\s+|(?<=[。！？])\s*")
EARLIER = re.compile(rf"[{MARK}]{CLOSERS}\s+\S")
BULLET = re.compile(r"(?:\d+[.)]|[-*•])\s")
#: As many lines must begin alike for their endings to count; a line of more words than ``LINE`` after the end of a sentence
#: is running text.
SEEN, LINE = 4, 15


class Successors:
    """Takes sorted values one by one and tells which of those with a key begin their successors; equal ones count once."""

    def __init__(self) -> None:
        self.held: tuple[str | None, str] | None = None
        self.first: str | None = None

    def take(self, key: str | None, value: str) -> tuple[str, str] | None:
        """(key, character that follows) of the value before, if it is a strict prefix of ``value``."""
        found = None
        if self.held is None:
            self.first = value
        elif value == self.held[1]:
            return None
        elif self.held[0] is not None and value.startswith(self.held[1]):
            found = self.held[0], value[len(self.held[1])]
        self.held = key, value
        return found

    def edges(self) -> list[tuple[str | None, str, int]]:
        """(key, value, place) of the first and the last value of the partition; the first has no key."""
        place = TaskContext.get().partitionId()
        return [] if self.held is None else [(None, self.first, 2 * place), (*self.held, 2 * place + 1)]


def across(edges: DataFrame, key: str) -> DataFrame:
    """The prefixes among the last values of partitions, which have their successors in the next.

    ``edges`` has two rows a partition, whatever the data's size.
    """
    followed = edges.withColumn("next", F.lead("value").over(Window.orderBy("place"))).where(f"{key} is not null and next is not null")
    longer = followed.where(F.expr("startswith(next, value) and length(next) > length(value)"))
    return longer.select(key, "next", F.expr("substring(next, length(value) + 1, 1)").alias("after"))


def strict_prefixes(counted: DataFrame, value: str, n: str, most: int = 0) -> DataFrame:
    """``value`` of each value that begins a longer one and whose ``n`` add up to ``most`` or less.

    Values are sorted over the cluster, so that equal ones meet without a shuffle of their own; only the first and last of
    each partition are compared across it.
    """
    parts = counted.where(F.col(value).isNotNull()).select(value, n).repartitionByRange(F.col(value)).sortWithinPartitions(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        successors = Successors()
        held, total = None, 0
        for batch in batches:
            out = []
            for v, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if v == held:
                    total += k
                    continue
                if held is not None and (f := successors.take(held if total <= most else None, held)):
                    out.append((f[0], None, None))
                held, total = v, k
            yield _batch(out, "ssl", ["key", "value", "place"])
        last = successors.take(held if total <= most else None, held) if held is not None else None
        yield _batch(([(last[0], None, None)] if last else []) + [(k, v, p) for k, v, p in successors.edges()], "ssl", ["key", "value", "place"])

    swept = cut_lineage(parts.mapInArrow(run, "key string, value string, place bigint"))
    found = swept.where("place is null").select("key").unionByName(across(swept.where("place is not null"), "key").select("key"))
    return found.withColumnRenamed("key", value)


def _batch(rows: list[tuple], kinds: str, names: list[str]) -> pa.RecordBatch:
    types = {"s": pa.string(), "b": pa.bool_(), "l": pa.int64()}
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds, strict=True)], names)


def usual_form(line: str) -> str:
    """A line with its numbers alike."""
    return re.sub(r"\d+", "0", line)


def line_ended(line: str) -> bool:
    """Whether a line ends with a mark, or with a remark in brackets after one; read from its end, however long it is."""
    bare = line.rstrip(CLOSING)
    if bare and bare[-1] in LINE_MARKS:
        return True
    at = line.rfind("(")
    if at <= 0 or not line.endswith(")") or ")" in line[at + 1 : -1]:
        return False
    head = line[:at].rstrip().rstrip(CLOSING)
    return bool(head) and head[-1] in MARK


def sentences(line: str) -> list[str]:
    """The sentences of a line, or the line itself, as forms with their numbers alike."""
    return [usual_form(" ".join(part.split())) for part in SENTENCES.split(line) if part.strip()]


def beginnings(form: str) -> tuple[str, str]:
    """The first two words and the first word of a line, without marks after them; in scripts without blanks its first characters."""
    words = form.split(None, 2)
    if len(words[0]) > 24:
        return form[:4], form[:2]
    bare = [w.rstrip(":;,.") or w for w in words[:2]]
    return " ".join(bare), bare[0]


def ending(text: str) -> tuple[str, str, bool, bool, int] | None:
    """(form of the last line, of its last sentence, certainly cut, a sentence ended earlier, words of the line) of a text without a final mark."""
    whole = text.rstrip(STRAY)
    certain = whole.endswith(DOTS) or bool(BROKEN_AMOUNT.search(whole, max(0, len(whole) - 16)) or DANGLING.search(whole, max(0, len(whole) - 16)))
    line = " ".join(whole[whole.rfind("\n") + 1 :].strip(STRAY).split())
    if not line or not certain and (ENDED.search(line) or REMARK.search(line)):
        return None
    last = sentences(line)[-1]
    return usual_form(line), last.rstrip(".… ") or last, certain, bool(EARLIER.search(BULLET.sub("", line, count=1))), len(line.split())


def once_a_partition(documents: DataFrame, text: str) -> DataFrame:
    """``text_id, text`` of texts with a character, each once for each partition that it is read in.

    Copies that a third of all rows may be are so as many as there are partitions before they are sorted together.
    """
    usable = documents.where(F.col(text).isNotNull() & (F.rtrim(text, F.lit(STRAY)) != "")).select(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            new = []
            for value in batch.column(0).to_pylist():
                code = hashlib.md5(value.encode())
                if code.digest() not in seen:
                    seen.add(code.digest())
                    new.append((code.hexdigest(), value))
            yield _batch(new, "ss", ["text_id", "text"])

    return usable.mapInArrow(run, "text_id string, text string")


def swept(texts: DataFrame) -> DataFrame:
    """One pass over sorted ``text_id, text``, each text once: all that is known of endings, lines and prefixes.

    Rows are endings without a mark (with a form and ``piece``, what follows the last sentence end), prefixes (with
    ``after``), first and last texts of partitions (with a place), and, without text_id, counts of lines by how they begin
    and of sentences (``piece``, with a count of 0 where it is only such an ending), for each partition.
    """
    parts = texts.repartitionByRange(F.col("text")).sortWithinPartitions("text")
    names = ["text_id", "form", "piece", "two", "one", "certain", "earlier", "n_words", "n", "n_marked", "after", "value", "place"]
    kinds = "sssssbblllssl"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun: Counter[tuple[str, str]] = Counter()
        marked: Counter[tuple[str, str]] = Counter()
        said: Counter[str] = Counter()
        successors = Successors()

        def counts() -> list[tuple]:
            rows = [(None, None, None, *key, None, None, None, n, marked[key], None, None, None) for key, n in begun.items()]
            rows += [(None, None, piece, None, None, None, None, None, n, 0, None, None, None) for piece, n in said.items()]
            begun.clear(), marked.clear(), said.clear()
            return rows

        before = None
        for batch in batches:
            out = []
            for text_id, text in zip(*(batch.column(c).to_pylist() for c in range(2)), strict=True):
                if text == before:
                    continue
                before = text
                if prefix := successors.take(text_id, text):
                    out.append((prefix[0], *[None] * 9, prefix[1], None, None))
                if end := ending(text):
                    out.append((text_id, *end[:2], *beginnings(end[0]), *end[2:], *[None] * 5))
                own: list[str] = []
                for line in text.split("\n"):
                    line = line.strip(STRAY)
                    if line:
                        key = beginnings(usual_form(line))
                        begun[key] += 1
                        marked[key] += line_ended(line)
                        own += sentences(line)
                if end and own:
                    said[end[1]] += 0
                    own.pop()
                said.update(own)
            yield _batch(out, kinds, names)
            if len(begun) + len(said) > 500_000:
                yield _batch(counts(), kinds, names)
        yield _batch(counts() + [(k, *[None] * 10, v, p) for k, v, p in successors.edges()], kinds, names)

    kind = {"s": "string", "b": "boolean", "l": "bigint"}
    return parts.mapInArrow(run, ", ".join(f"{n} {kind[k]}" for n, k in zip(names, kinds, strict=True)))


def judged(documents: DataFrame, text: str = "text") -> DataFrame:
    """``text_id`` and ``evidence`` of every distinct text that was cut.

    Evidence is ``copy`` (a longer copy goes on within the line), ``prefix`` (its last sentence is a strict prefix of another
    one), ``dots`` (dots, a tag or an amount broken off) or ``sentence`` (lines that begin alike end with a mark).
    """
    seen = cut_lineage(swept(once_a_partition(documents, text)))
    open_ = seen.where("text_id is not null and form is not null").select("text_id", "piece", "two", "one", "certain", "earlier", "n_words")
    begins = seen.where("text_id is not null and after is not null").select("text_id", "after").unionByName(across(seen.where("place is not null"), "text_id").select("text_id", "after"))
    copies = begins.where(~F.col("after").isin("\n", "\r", " ")).select("text_id", F.lit(True).alias("copied"))

    begun = seen.where("two is not null and text_id is null")
    by_two = begun.groupBy("two").agg(F.sum("n").alias("n_two"), F.sum("n_marked").alias("marked_two"))
    by_one = begun.groupBy("one").agg(F.sum("n").alias("n_one"), F.sum("n_marked").alias("marked_one"))
    # what stands nowhere but at the end of texts and goes on elsewhere
    goes_on = strict_prefixes(seen.where(F.col("text_id").isNull() & F.col("piece").rlike(r"\p{L}")), "piece", "n").select("piece", F.lit(True).alias("goes_on"))

    keyed = looked_up(looked_up(open_, by_two, ["two"], "text_id"), by_one, ["one"], "text_id")
    # the line itself is among those that begin like it
    share = F.when(F.col("n_two") > SEEN, F.col("marked_two") / (F.col("n_two") - 1)).when(F.col("n_one") > SEEN, F.col("marked_one") / (F.col("n_one") - 1))
    sentence = F.coalesce(share >= 0.5, F.col("earlier") | (F.col("n_words") > 3)) | (F.col("earlier") & (F.col("n_words") > LINE))
    verdicts = looked_up(keyed, goes_on, ["piece"], "text_id").join(copies, "text_id", "left")
    evidence = F.when(F.col("copied"), "copy").when(F.col("goes_on"), "prefix").when(F.col("certain"), "dots").when(sentence, "sentence")
    return verdicts.select("text_id", evidence.alias("evidence")).where("evidence is not null")


def cut_documents(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``evidence`` of every document whose text was cut."""
    rows = documents.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, F.md5(text).alias("text_id"))
    return looked_up(rows, judged(documents, text), ["text_id"], key, "inner").select(key, "evidence").dropDuplicates([key])


def shares(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``source, n_documents, n_cut, share_cut``; a null source is a group of its own."""
    found = cut_documents(documents, key, text).select(key, F.lit(1).alias("cut"))
    rows = documents.where(F.col(key).isNotNull()).select(key, source)
    counted = rows.join(found, key, "left").groupBy(source).agg(F.count("*").alias("n_documents"), F.coalesce(F.sum("cut"), F.lit(0)).alias("n_cut"))
    return counted.withColumn("share_cut", F.col("n_cut") / F.col("n_documents"))
