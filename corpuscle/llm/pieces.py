"""Problem 2: oversized sections cut into ordered pieces at natural boundaries, by agglomerative merging.

A section's text is first broken into atomic segments: at line ends, sentence ends, clause ends and blanks, and within
a word only where a word alone is over the limit. Adjacent segments are then merged, the weakest boundary first (held
in a heap), while the merged size with the overlap fits; what is left are pieces cut at the strongest boundaries. Each
piece but the first repeats about ``overlap`` characters of the one before, from the start of a word where there is one.

Sections are found on narrow rows (document, position, length) without sorting a document in one task: positions fall
into stretches of ``STRETCH``, each stretch finds the last section start within it, and only these summaries are carried
along the document. Texts are moved once, to join them with the positions of oversized sections. A section is cut whole,
unless it spans more than ``BLOCK`` positions: then it is cut in blocks of so many, counted from its own start and ending
between elements, so that one section may hold any share of all rows.

Defined results: repeated deliveries of an element count once; elements without doc_id or pos belong to no section;
a null text has no characters; a section of blanks only is cut like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.session import written_table

SIZE_ABOVE, PIECE, OVERLAP, STRETCH, BLOCK = 4_000, 1_000, 100, 512, 512
#: Boundaries from the strongest down: the text before the cut must end so.
BOUNDARIES = ((6, re.compile(r"\n\s*\n\s*")), (5, re.compile(r"\n\s*")), (4, re.compile(r"[.!?…][\"')\]]*\s+|[。！？]\s*")), (3, re.compile(r"[;:]\s+|[；：]")), (2, re.compile(r",\s+|[，、]")), (1, re.compile(r"\s+")))


def atoms(text: str, most: int) -> tuple[list[int], list[int]]:
    """The ends of the atomic segments of ``text``, none above ``most`` characters, and the strength of each end."""
    strength: dict[int, int] = {}
    for level, pattern in reversed(BOUNDARIES):
        for found in pattern.finditer(text):
            strength[found.end()] = max(level, strength.get(found.end(), 0))
    strength[len(text)] = 7
    ends: list[int] = []
    for end in sorted(strength):
        at = ends[-1] if ends else 0
        while end - at > most:
            at += most
            ends.append(at)
        ends.append(end)
    return ends, [strength.get(end, 0) for end in ends]


def cut(text: str, most: int = PIECE, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces of ``text`` without their overlaps; each with an overlap fits into ``most``."""
    room = most - overlap
    if not text:
        return []
    ends, levels = atoms(text, room)
    count = len(ends)
    start = [0, *ends[:-1]]
    stop, after, before = list(ends), list(range(1, count + 1)), list(range(-1, count - 1))
    alive = [True] * count
    heap = [(levels[i], stop[i + 1] - start[i], i, i + 1) for i in range(count - 1)]
    heapq.heapify(heap)
    size = [stop[i] - start[i] for i in range(count)]
    while heap:
        level, merged, i, j = heapq.heappop(heap)
        if not alive[i] or j >= count or not alive[j] or after[i] != j or merged != size[i] + size[j] or merged > room:
            continue
        alive[j] = False
        stop[i], size[i], after[i], levels[i] = stop[j], merged, after[j], levels[j]
        if after[i] < count:
            before[after[i]] = i
            heapq.heappush(heap, (levels[i], size[i] + size[after[i]], i, after[i]))
        if before[i] >= 0:
            b = before[i]
            heapq.heappush(heap, (levels[b], size[b] + size[i], b, i))
    return [(start[i], stop[i]) for i in range(count) if alive[i]]


def tail(text: str, overlap: int = OVERLAP) -> str:
    """The last characters of ``text`` that the next piece repeats: up to ``overlap``, from the start of a word if any."""
    if len(text) <= overlap or not overlap:
        return text[-overlap:] if overlap else ""
    last = text[-overlap:]
    if text[-overlap - 1].isspace():
        return last
    found = re.search(r"\s+", last)
    return last[found.end() :] if found and found.end() < len(last) else last


def section_elements(content: DataFrame) -> DataFrame:
    """``doc_id, stretch, pos, section, length`` of every element once; ``section`` is the position of its section's first element.

    A section starts at a document's first element and at each element of type text with a level. ``length`` is that of
    the text of an element of type text, and null for other types.
    """
    text = F.col("type") == "text"
    length = F.when(text, F.coalesce(F.length("text"), F.lit(0)))
    start = F.when(text & F.col("text_level").isNotNull(), F.col("pos"))
    rows = content.where(F.col("doc_id").isNotNull() & F.col("pos").isNotNull()).select("doc_id", "pos", F.floor(F.col("pos") / STRETCH).alias("stretch"), start.alias("start"), length.alias("length"))
    # one partitioning serves every step on stretches
    once = rows.repartition("doc_id", "stretch").groupBy("doc_id", "stretch", "pos").agg(F.max("start").alias("start"), F.max("length").alias("length"))
    marks = once.groupBy("doc_id", "stretch").agg(F.max("start").alias("last_start"), F.min("pos").alias("first_pos"))
    earlier = Window.partitionBy("doc_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select("doc_id", "stretch", F.coalesce(F.max("last_start").over(earlier), F.min("first_pos").over(earlier), F.col("first_pos")).alias("carried"))
    within = Window.partitionBy("doc_id", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = once.withColumn("start_within", F.max("start").over(within)).join(carried, ["doc_id", "stretch"])
    return placed.select("doc_id", "stretch", "pos", F.coalesce("start_within", "carried").alias("section"), "length")


def sections(content: DataFrame) -> DataFrame:
    """``doc_id, section, size`` of every section; counted in part before the shuffle."""
    return section_elements(content).groupBy("doc_id", "section").agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size"))


def _sized(content: DataFrame, above: int) -> DataFrame:
    """``doc_id, pos, section, size`` of the text elements of sections of more than ``above`` characters."""
    # narrow rows, which three steps read
    elements = written_table(section_elements(content).where("length is not null"))
    # lengths are summed in each stretch first, so that a section of very many elements is no hot key
    lengths = elements.groupBy("doc_id", "stretch", "section").agg(F.sum("length").alias("length"))
    sizes = lengths.groupBy("doc_id", "section").agg(F.sum("length").alias("size")).where(F.col("size") > above)
    large = lengths.join(sizes, ["doc_id", "section"]).select("doc_id", "stretch", F.col("section").alias("large"), "size")
    # the last condition is written so as to be no key of the join: the elements stay where they are, by document and stretch
    own = (F.col("e.doc_id") == F.col("m.doc_id")) & (F.col("e.stretch") == F.col("m.stretch")) & (F.col("e.section") - F.col("m.large") == 0)
    return elements.alias("e").join(large.alias("m"), own).select("e.doc_id", "e.pos", "e.section", "m.size")


def cut_blocks(content: DataFrame, above: int = SIZE_ABOVE, most: int = PIECE, overlap: int = OVERLAP, block: int = BLOCK) -> DataFrame:
    """``doc_id, pos, size, block, offset, piece, start, text``: the pieces of each block of an oversized section.

    ``pos`` is the section's first element, ``offset`` the number of characters of the blocks before, ``piece`` counts within
    the block, ``start`` is where the piece's own text starts in it.
    """
    texts = content.where((F.col("type") == "text") & F.col("doc_id").isNotNull() & F.col("pos").isNotNull() & (F.col("text") != "")).select("doc_id", "pos", "text")
    kept = texts.join(_sized(content, above), ["doc_id", "pos"]).dropDuplicates(["doc_id", "pos"])
    blocked = kept.withColumn("block", F.floor((F.col("pos") - F.col("section")) / block))
    grouped = blocked.groupBy("doc_id", "section", "block").agg(F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("parts"))
    joined = written_table(grouped.select("doc_id", "section", "block", "size", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text")))
    order = Window.partitionBy("doc_id", "section").orderBy("block")
    # one row a block is carried along the section: the end of its text, and its length with the line end after it
    ends = joined.select("doc_id", "section", "block", F.right("text", F.lit(overlap + 1)).alias("tail"), (F.length("text") + 1).alias("length"))
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # most sections are one block, which nothing comes before
    before = ends.select("doc_id", "section", "block", F.lag("tail").over(order).alias("before"), offset.alias("offset")).where("before is not null")
    told = joined.join(before, ["doc_id", "section", "block"], "left")
    ready = told.select("doc_id", "section", "size", "block", F.coalesce("offset", F.lit(0)).alias("offset"), "text", F.coalesce("before", F.lit("")).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text, last = batch.column(5)[k].as_py(), batch.column(6)[k].as_py()
                out: list[tuple[int, int, str]] = []
                for n, (a, b) in enumerate(cut(text, most, overlap)):
                    out.append((n, a, tail(last, overlap) + text[a:b]))
                    last = text[max(0, a - overlap - 1) : b] if b - a <= overlap else text[a:b]
                rows = pa.array([k] * len(out), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(rows) for c in range(5)] + [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.string())],
                    ["doc_id", "pos", "size", "block", "offset", "piece", "start", "text"],
                )

    return ready.mapInArrow(run, f"doc_id {content.schema['doc_id'].dataType.simpleString()}, pos int, size bigint, block bigint, offset bigint, piece int, start int, text string")


def pieces(content: DataFrame, above: int = SIZE_ABOVE, most: int = PIECE, overlap: int = OVERLAP, block: int = BLOCK) -> DataFrame:
    """``doc_id, pos, size, piece, start, text`` of the sections of more than ``above`` characters.

    ``pos`` is the section's first element, ``piece`` counts over the section from 0, ``start`` is where the piece's own text
    starts in the section's text, whose elements are joined by line ends.
    """
    made = written_table(cut_blocks(content, above, most, overlap, block))
    counts = made.groupBy("doc_id", "pos", "block").agg(F.count("*").alias("n_pieces"))
    order = Window.partitionBy("doc_id", "pos").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("doc_id", "pos", "block", F.coalesce(F.sum("n_pieces").over(order), F.lit(0)).alias("earlier")).where("earlier > 0")
    numbered = made.join(earlier, ["doc_id", "pos", "block"], "left")
    return numbered.select("doc_id", "pos", "size", (F.coalesce("earlier", F.lit(0)) + F.col("piece")).alias("piece"), (F.col("offset") + F.col("start")).alias("start"), "text")


def oversized(content: DataFrame) -> DataFrame:
    """``doc_id, pos`` of each section that was cut: those of its pieces."""
    return cut_blocks(content).select("doc_id", "pos").distinct()
