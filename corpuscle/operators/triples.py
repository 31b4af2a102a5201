"""The knowledge graph as a table of triples ``s, p, o, o_kind, lang``, and what is read from it.

A graph is a set: producers return distinct rows, and ``union`` makes several of them one set. ``o_kind`` is ``uri`` or
``literal``; ``lang`` is the tag of a literal or null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions.text import comma_list

#: Namespaces and the predicates that the graph uses.
SCHEMA, EX, WD = "http://schema.org/", "http://worldbank.example.org/", "http://www.wikidata.org/entity/"
RDF, RDFS = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2000/01/rdf-schema#"
TYPE, LABEL, SUBCLASS, DOMAIN, CLASS = RDF + "type", RDFS + "label", RDFS + "subClassOf", RDFS + "domain", RDFS + "Class"
IDENTIFIER, NAME, MENTIONS, PART_OF = SCHEMA + "identifier", SCHEMA + "name", SCHEMA + "mentions", SCHEMA + "isPartOf"
#: Metadata columns and the properties they become.
PROPERTIES = {"last_modified_date": "dateModified", "pdfurl": "url", "year": "datePublished", "docty": "genre", "owner": "creator"}
#: The links of a document to listed entities: column of ids, class, predicate.
LINKS = {"count": ("country", "countryOfOrigin"), "projectid": ("project", "isPartOf"), "trustfund_key": ("trustfund", "funder")}

PREFIXES = {"schema": SCHEMA, "ex": EX, "wd": WD, "rdf": RDF, "rdfs": RDFS}

COLUMNS = ("s", "p", "o", "o_kind", "lang")


def _fact(p: str, o: Column, kind: str = "literal", lang: str | None = None) -> Column:
    return F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), F.lit(lang).cast("string").alias("lang"))


def facts(rows: DataFrame, subject: Column, made: list[Column], once: bool = True) -> DataFrame:
    """A triple for each of ``made`` whose object isn't null: one pass over ``rows``, whatever the number of facts.

    Triples are distinct, unless ``once`` is false, as for those that go on into ``union``.
    """
    exploded = rows.select(subject.alias("s"), F.explode(F.array(*made)).alias("f")).select("s", "f.*").where("s is not null and o is not null")
    return exploded.distinct() if once else exploded


def union(*graphs: DataFrame) -> DataFrame:
    """The triples of all ``graphs``, each once."""
    return reduce(DataFrame.unionByName, [g.select(*COLUMNS) for g in graphs]).distinct()


def uri(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"{EX}{kind}/"), key)


def identifier_property(spark: SparkSession) -> DataFrame:
    """The property by which everything is identified, which every graph begins with."""
    return spark.createDataFrame([(IDENTIFIER, TYPE, RDF + "Property", "uri", None), (IDENTIFIER, LABEL, "Identifier", "literal", None)], "s string, p string, o string, o_kind string, lang string")


def class_triples(rows: DataFrame, kind: str, label: str, properties: tuple[str, ...] = ()) -> DataFrame:
    """The class itself, once: type, parent, label, and the properties that have it as domain. ``rows`` gives the session."""
    spark = rows.sparkSession
    name = EX + kind
    made = [(name, TYPE, CLASS, "uri", None), (name, SUBCLASS, SCHEMA + "Thing", "uri", None), (name, LABEL, label, "literal", "en"), (IDENTIFIER, DOMAIN, name, "uri", None)]
    made += [(SCHEMA + p, DOMAIN, name, "uri", None) for p in properties]
    return spark.createDataFrame(made, "s string, p string, o string, o_kind string, lang string")


def instance_triples(rows: DataFrame, kind: str, key: str, label: str, extra: dict[str, str] | None = None, once: bool = True) -> DataFrame:
    """Instances of a class: type, name, identifier and one fact for each of ``extra`` (column to property)."""
    named = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    made = [_fact(TYPE, F.lit(EX + kind), "uri"), _fact(NAME, F.nullif(F.col(label), F.lit("")), lang="en"), _fact(IDENTIFIER, F.col(key))]
    made += [_fact(SCHEMA + p, F.col(c)) for c, p in (extra or {}).items()]
    return facts(named, uri(kind, F.col(key)), made, once)


def document_triples(latest: DataFrame, once: bool = True) -> DataFrame:
    return instance_triples(latest, "document", "id", "display_title", PROPERTIES, once)


def subclass_triples(rows: DataFrame, kind: str, value: str) -> DataFrame:
    """A subclass of ``kind`` for each value: type, parent, label."""
    key = F.translate(F.col(value), " -", "__")
    return facts(rows.select(value).distinct(), uri(kind, key), [_fact(TYPE, F.lit(CLASS), "uri"), _fact(SUBCLASS, F.lit(EX + kind), "uri"), _fact(LABEL, F.col(value), lang="en")])


def zipped(rows: DataFrame, ids: str, names: str) -> DataFrame:
    """``id, name`` of two comma lists side by side, as far as the shorter goes; of an id's names the largest is kept."""
    n = F.least(F.size(comma_list(F.col(ids))), F.size(comma_list(F.col(names))))
    pairs = F.arrays_zip(F.slice(comma_list(F.col(ids)), F.lit(1), n).alias("id"), F.slice(comma_list(F.col(names)), F.lit(1), n).alias("name"))
    each = rows.select(F.explode(pairs).alias("x")).select(F.col("x.id").alias("id"), F.col("x.name").alias("name"))
    return each.groupBy("id").agg(F.max("name").alias("name"))


def country_triples(latest: DataFrame, kb: DataFrame | None = None) -> DataFrame:
    """Countries by their key: type, name, and the same entity in the knowledge base where ``kb`` (``key, qid``) has it."""
    countries = latest.where("`count` is not null").select(F.col("count").alias("key")).distinct()
    if kb is not None:
        countries = countries.join(kb.select("key", "qid"), "key", "left")
    else:
        countries = countries.withColumn("qid", F.lit(None).cast("string"))
    label = F.replace(F.col("key"), F.lit("_"), F.lit(" "))
    return facts(countries, uri("country", F.col("key")), [_fact(TYPE, F.lit(SCHEMA + "Country"), "uri"), _fact(NAME, label, lang="en"), _fact(SCHEMA + "sameAs", F.concat(F.lit(WD), F.col("qid")), "uri")])


def listed(latest: DataFrame, column: str, many: bool, once: bool = True) -> DataFrame:
    """``id, entity``: a row for each part of a list column, or for the whole value; underscores left at parts' ends go."""
    parts = comma_list(F.col(column)) if many else F.array(F.nullif(F.trim(F.col(column)), F.lit("")))
    each = latest.where("id is not null").select("id", F.explode(parts).alias("entity"))
    parted = each.select("id", F.regexp_replace("entity", "^_+|_+$", "").alias("entity")).where("entity <> ''")
    return parted.distinct() if once else parted


def link_triples(latest: DataFrame, column: str, once: bool = True) -> DataFrame:
    """Documents linked with the entities that ``column`` lists (see LINKS)."""
    kind, predicate = LINKS[column]
    links = listed(latest, column, many=column != "count", once=False)
    return facts(links, uri("document", F.col("id")), [_fact(SCHEMA + predicate, uri(kind, F.col("entity")), "uri")], once)


def fallback_triples(latest: DataFrame, column: str, graph: DataFrame) -> DataFrame:
    """Entities that are linked but have no triple of their own in ``graph``: type and identifier."""
    kind, _ = LINKS[column]
    linked = listed(latest, column, many=column != "count").select("entity").distinct().withColumn("s", uri(kind, F.col("entity")))
    missing = linked.join(graph.select("s").distinct(), "s", "left_anti")
    return facts(missing, F.col("s"), [_fact(TYPE, F.lit(EX + kind), "uri"), _fact(IDENTIFIER, F.col("entity"))])


def entity_uri(qid: Column, safe: Column) -> Column:
    return F.when(qid.isNotNull() & (qid != ""), F.concat(F.lit(WD), qid)).otherwise(F.concat(F.lit(f"{EX}entity/"), safe))


def entity_triples(mentions: DataFrame, once: bool = True) -> DataFrame:
    """Entities of documents (``doc_id, surface, label, qid, safe``): type, name, label, and the document's mention."""
    usable = mentions.where("surface is not null and surface <> '' and safe is not null and doc_id is not null").withColumn("e", entity_uri(F.col("qid"), F.col("safe")))
    made = [_fact(TYPE, F.lit(SCHEMA + "Thing"), "uri"), _fact(NAME, F.col("surface")), _fact(SCHEMA + "additionalType", F.col("label")), _fact(MENTIONS, F.col("e"), "uri")]
    # the last fact is the document's, all others the entity's: one pass gives both
    subject = F.when(F.col("f.p") == MENTIONS, uri("document", F.col("doc_id").cast("string"))).otherwise(F.col("e"))
    exploded = usable.select("doc_id", "e", F.explode(F.array(*made)).alias("f")).select(subject.alias("s"), "f.*").where("o is not null")
    return exploded.distinct() if once else exploded


def chunk_triples(chunks: DataFrame, graph: DataFrame) -> DataFrame:
    """Chunks (``chunk_id, doc_id, text, entities``): type, text, document, and mentions of entities that ``graph`` has typed."""
    usable = chunks.where("chunk_id is not null")
    subject = uri("chunk", F.col("chunk_id").cast("string"))
    own = facts(usable, subject, [_fact(TYPE, F.lit(SCHEMA + "TextObject"), "uri"), _fact(SCHEMA + "text", F.col("text")), _fact(PART_OF, uri("document", F.col("doc_id").cast("string")), "uri")])
    return own.unionByName(chunk_mentions(usable, graph).select(*COLUMNS))


def chunk_mentions(chunks: DataFrame, graph: DataFrame) -> DataFrame:
    """The mentions of chunks whose entity has a type in ``graph``."""
    each = chunks.select("chunk_id", F.explode("entities").alias("x")).where("x is not null")
    said = facts(each, uri("chunk", F.col("chunk_id").cast("string")), [_fact(MENTIONS, entity_uri(F.col("x.qid"), F.col("x.rdf_safe")), "uri")])
    typed = graph.where(F.col("p") == TYPE).select(F.col("s").alias("o")).distinct()
    return said.join(typed, "o", "left_semi")


# ---- reading --------------------------------------------------------------------------------------------------------


def with_predicate(graph: DataFrame, predicate: str) -> DataFrame:
    return graph.where(F.col("p") == predicate)


def by_subject(graph: DataFrame) -> DataFrame:
    """``s, n_triples, n_predicates``."""
    return graph.groupBy("s").agg(F.count("*").alias("n_triples"), F.count_distinct("p").alias("n_predicates"))


def identifiers(graph: DataFrame, kind: str | None = None) -> DataFrame:
    """``identifier`` of every subject, or of the instances of class ``kind`` only."""
    found = graph.where(F.col("p") == IDENTIFIER).select("s", F.col("o").alias("identifier"))
    if kind:
        typed = graph.where((F.col("p") == TYPE) & (F.col("o") == EX + kind)).select("s")
        found = found.join(typed, "s", "left_semi")
    return found.select("identifier").distinct()


def urls(graph: DataFrame) -> DataFrame:
    """``identifier, url``; of several the smallest."""
    ids = graph.where(F.col("p") == IDENTIFIER).select("s", F.col("o").alias("identifier"))
    found = graph.where(F.col("p") == SCHEMA + "url").select("s", F.col("o").alias("url"))
    return ids.join(found, "s").groupBy("identifier").agg(F.min("url").alias("url"))


def _literal() -> Column:
    escaped = F.col("o")
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), escaped, F.lit('"'), F.coalesce(F.concat(F.lit("@"), F.col("lang")), F.lit("")))


def ntriples(graph: DataFrame) -> DataFrame:
    """``line`` of N-Triples for each triple."""
    thing = F.when(F.col("o_kind") == "uri", F.concat(F.lit("<"), F.col("o"), F.lit(">"))).otherwise(_literal())
    return graph.select(F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), thing, F.lit(" .")).alias("line"))


def turtle(graph: DataFrame, prefixes: dict[str, str] = PREFIXES) -> DataFrame:
    """``line`` of Turtle for each triple, with names of ``prefixes`` where their rest is of letters, digits and underscores."""

    rest = lambda value, base: F.substring(value, len(base) + 1, 2**31 - 1)

    def named(value: Column) -> Column:
        short = [F.when(value.startswith(base) & rest(value, base).rlike("^[A-Za-z0-9_]+$"), F.concat(F.lit(f"{name}:"), rest(value, base))) for name, base in prefixes.items()]
        return F.coalesce(*short, F.concat(F.lit("<"), value, F.lit(">")))

    thing = F.when(F.col("o_kind") == "uri", named(F.col("o"))).otherwise(_literal())
    return graph.select(F.concat(named(F.col("s")), F.lit(" "), named(F.col("p")), F.lit(" "), thing, F.lit(" .")).alias("line"))


def pivoted(graph: DataFrame, predicates: dict[str, str]) -> DataFrame:
    """``s`` and a column for each of ``predicates`` (name to predicate): the smallest object, or null."""
    wanted = graph.where(F.col("p").isin(*predicates.values()))
    return wanted.groupBy("s").agg(*(F.min(F.when(F.col("p") == p, F.col("o"))).alias(n) for n, p in predicates.items()))
