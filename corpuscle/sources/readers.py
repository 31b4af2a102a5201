"""Sources: metadata pages, graph files, cached knowledge, page elements, converted documents."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpuscle.session import exists

Converter = Callable[[list[tuple[str, bytes, str]]], list[str]]
FIELDS = "id display_title last_modified_date docty count trustfund trustfund_key projn projectid owner pdfurl year".split()
RECORD = "struct<" + ",".join(f"{f}:string" for f in FIELDS) + ">"
TRIPLE = "s string, p string, o string, o_kind string, lang string"
ELEMENT = "array<struct<type:string,text:string,text_level:int,table_body:string,page_idx:int>>"
#: Names of languages that a converter is told by their codes; any other is taken for English.
LANGUAGES = {"English": "en"}


def metadata_pages(spark: SparkSession, path: str) -> DataFrame:
    """The records of landed response pages (a JSON object a file, ``documents`` by key); entries without id are skipped."""
    pages = spark.read.text(path, wholetext=True)
    # entries that are no objects (facets) read as null
    entries = F.from_json("value", f"documents map<string,string>")
    each = pages.select(F.explode(F.map_values(entries["documents"])).alias("entry"))
    records = each.select(F.from_json("entry", RECORD).alias("r")).select("r.*")
    return records.where("id is not null")


class _Page(InputPartition):
    def __init__(self, page: int, step: int = 0):
        self.page, self.step = page, step


class PagedMetadata(DataSource):
    """``spark.read.format("paged_metadata")``: pages of the API in partitions.

    Options: ``module`` and ``function``, which name an importable function from a page number to the text of its response;
    ``start`` (1), ``pages``: how many, a partition each (1), or ``all``: then ``tasks`` (8) partitions take every so many pages,
    each until an empty one, as an API has no page after its first empty one.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_metadata"

    def schema(self) -> str:
        return ", ".join(f"{f} string" for f in FIELDS)

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.module, self.function = options["module"], options["function"]
        self.start, self.pages, self.tasks = int(options.get("start", 1)), options.get("pages", "1"), int(options.get("tasks", 8))

    def partitions(self) -> list[InputPartition]:
        if self.pages == "all":
            return [_Page(self.start + k, self.tasks) for k in range(self.tasks)]
        return [_Page(self.start + k) for k in range(int(self.pages))]

    def read(self, partition: _Page) -> Iterator[tuple]:
        import importlib

        fetch: Callable[[int], str] = getattr(importlib.import_module(self.module), self.function)
        page = partition.page
        while documents := json.loads(fetch(page)).get("documents"):
            for entry in documents.values():
                if isinstance(entry, dict) and "id" in entry:
                    yield tuple(None if entry.get(f) is None else str(entry[f]) for f in FIELDS)
            if not partition.step:
                return
            page += partition.step


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """The triples of N-Triples files; lines of another form are skipped."""
    line = r'^<([^>]*)> <([^>]*)> (?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z-]+)|\^\^<[^>]*>)?) \.$'
    lines = spark.read.text(path).where(F.col("value").rlike(line))
    part = lambda k: F.regexp_extract("value", line, k)
    text = F.replace(part(4), F.lit("\\\\"), F.lit("\u0000"))
    for a, b in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\u0000", "\\")):
        text = F.replace(text, F.lit(a), F.lit(b))
    is_uri = F.col("value").rlike(r"^<[^>]*> <[^>]*> <[^>]*> \.$")
    read = lines.select(part(1).alias("s"), part(2).alias("p"), F.when(is_uri, part(3)).otherwise(text).alias("o"), F.when(is_uri, "uri").otherwise("literal").alias("o_kind"), F.nullif(part(5), F.lit("")).alias("lang"))
    return read.distinct()


_TURTLE = re.compile(r'''\s+|\#[^\n]*|(?P<iri><[^<>\s]*>)|(?P<long>"""(?:[^"\\]|\\.|"(?!""))*""")|(?P<text>"(?:[^"\\\n]|\\.)*")|@(?P<lang>[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<mark>\^\^|[.;,](?!\w))|(?P<name>[^\s<>"';,()\[\]]*[^\s<>"';,()\[\].])|(?P<odd>.)''', re.S)
_ESCAPED = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f"}


def parsed_turtle(text: str) -> Iterator[tuple]:
    """The triples of a Turtle text without blank nodes: prefixes, lists after ``;`` and ``,``, ``a``, literals with a language or a type.

    What can't be read ends its statement.
    """
    prefixes: dict[str, str] = {}
    statement: list[tuple[str, str]] = []

    def thing(kind: str, value: str) -> str | None:
        if kind == "iri":
            return value[1:-1]
        if kind == "name" and value == "a":
            return "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
        head, colon, rest = value.partition(":")
        return prefixes[head] + rest.replace("\\", "") if kind == "name" and colon and head in prefixes else None

    def unescaped(value: str) -> str:
        read = lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _ESCAPED.get(m[3], m[3])
        return re.sub(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", read, value, flags=re.S)

    def told() -> Iterator[tuple]:
        words = list(statement)
        if [v.lower() for _, v in words[:1]] in (["@prefix"], ["prefix"]) and len(words) > 2:
            prefixes[words[1][1].rstrip(":")] = words[2][1][1:-1]
            return
        subject = thing(*words.pop(0)) if words else None
        predicate, at = None, 0
        while subject is not None and at < len(words):
            kind, value = words[at]
            at += 1
            if kind == "mark":
                predicate = None if value == ";" else predicate
            elif predicate is None:
                predicate = thing(kind, value)
                if predicate is None:
                    return
            elif kind in ("text", "long"):
                lang = None
                if at < len(words) and words[at][0] == "lang":
                    lang, at = words[at][1], at + 1
                elif at < len(words) and words[at][1] == "^^":
                    at += 2
                yield subject, predicate, unescaped(value[3:-3] if kind == "long" else value[1:-1]), "literal", lang
            else:
                o = thing(kind, value)
                if o is not None:
                    yield subject, predicate, o, "uri", None
                elif kind == "name":  # a number or a truth value
                    yield subject, predicate, value, "literal", None

    for m in _TURTLE.finditer(text):
        kind = m.lastgroup
        if kind == "mark" and m[0] == "." or kind == "iri" and statement and statement[0][1].lower() == "prefix" and len(statement) == 2:
            if m[0] != ".":
                statement.append((kind, m[0]))
            yield from told()
            statement.clear()
        elif kind == "lang" and m[0].lower() in ("@prefix", "@base"):
            statement.append(("name", m[0].lower()))
        elif kind:
            statement.append((kind, m[kind]))


def turtle(spark: SparkSession, path: str) -> DataFrame:
    """The triples of Turtle files, a file a task; see ``parsed_turtle``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["value"]:
                yield pd.DataFrame(list(parsed_turtle(text)), columns=["s", "p", "o", "o_kind", "lang"])

    return spark.read.text(path, wholetext=True).mapInPandas(run, TRIPLE).distinct()


def knowledge_cache(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``entity links`` (key, url) and ``country facts`` (qid, predicate, object, o_kind) of a JSON cache; empty where it can't be read."""
    schema = "entities map<string,string>, countries map<string,array<struct<predicate:string,object:string,type:string>>>"
    cache = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("c"))
    links = cache.select(F.explode("c.entities").alias("key", "url"))
    facts = cache.select(F.explode("c.countries").alias("qid", "facts")).select("qid", F.explode("facts").alias("f"))
    return links, facts.select("qid", "f.predicate", "f.object", F.col("f.type").alias("o_kind"))


def content_lists(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, pos`` and the fields of page elements, from a JSON array a document; ill-formed files give nothing.

    The document's name is the file's, without what follows its first underscore or point. A level that is no whole number
    is no level.
    """
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/_.]+)[^/]*$", 1).alias("doc_id"), F.from_json("value", ELEMENT).alias("elements"))
    return files.select("doc_id", F.posexplode("elements").alias("pos", "e")).select("doc_id", "pos", "e.*")


def artifacts(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """``name, text`` of converted documents."""
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return files.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.[^./]+$", 1).alias("name"), F.col("value").alias("text"))


def source_files(spark: SparkSession, path: str, glob: str = "*.{pdf,png,jpg,jpeg}") -> DataFrame:
    """``path, modificationTime, length, content`` of landed files, for a converter to work on."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def language(name: Column) -> Column:
    """The code of a language by its name, English for any other."""
    known = F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair))
    return F.coalesce(F.element_at(known, F.coalesce(name, F.lit(""))), F.lit("en"))


def converted(files: DataFrame, converter: Converter, lang: str = "en", first: int = 0, last: int | None = None) -> DataFrame:
    """``doc_id, pos`` and the fields of page elements that ``converter`` finds in ``files``, of pages ``first`` to ``last`` (from 0).

    A converter is a function from lists of (name, bytes, language) to content lists as JSON. A file at which it fails gives
    nothing, like one whose result can't be read; ``doc_id`` is the file's name without its ending.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = [re.sub(r"\.[^.]*$", "", path.rsplit("/", 1)[-1]) for path in frame["path"]]
            texts = []
            for name, content in zip(names, frame["content"], strict=True):
                try:
                    texts += converter([(name, bytes(content), lang)])
                except Exception:  # one bad file must not end the batch
                    texts.append(None)
            yield pd.DataFrame({"doc_id": names, "text": texts})

    made = files.select("path", "content").mapInPandas(run, "doc_id string, text string").select("doc_id", F.posexplode(F.from_json("text", ELEMENT)).alias("pos", "e")).select("doc_id", "pos", "e.*")
    page = F.coalesce("page_idx", F.lit(0))
    return made.where((page >= first) & (page <= last) if last is not None else page >= first)


def vocabulary_file(spark: SparkSession, path: str) -> DataFrame:
    """``pattern, id, label`` of a JSON object from terms to links."""
    read = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("term", "id"))
    return read.select(F.lower("term").alias("pattern"), "id", F.lit("UNBIS_TERM").alias("label"))


def stored_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``, or an empty one of ``schema`` where there is none."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
