"""The queries of this subpackage and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.llm import containers, cut_off, distinctive, markup, names, pairs, pieces, scanned, tokens, vocabulary
from corpuscle.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return scanned.damaged(table(spark, folder, "content_list"), table(spark, folder, "documents"))


def p1_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return scanned.paragraphs(table(spark, folder, "content_list"), table(spark, folder, "documents"))


def p1_letters(spark: SparkSession, folder: str) -> DataFrame:
    return scanned.letters(table(spark, folder, "content_list"), table(spark, folder, "documents"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.oversized(table(spark, folder, "content_list"))


def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.pieces(table(spark, folder, "content_list"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.linked(table(spark, folder, "entities"))


def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    return names.classes(table(spark, folder, "entities"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary.found(table(spark, folder, "entities"), table(spark, folder, "unbis_vocab"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return markup.residue(table(spark, folder, "content_list"))


def p5_text(spark: SparkSession, folder: str) -> DataFrame:
    return markup.cleaned(table(spark, folder, "content_list"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return distinctive.characteristic(table(spark, folder, "chunk"))


def p6_scores(spark: SparkSession, folder: str) -> DataFrame:
    return distinctive.scores(table(spark, folder, "chunk"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.associated(table(spark, folder, "chunk"))


def p7_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.associations(table(spark, folder, "chunk")).withColumn("ratio", F.round("ratio", 6))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_ids(table(spark, folder, "documents"))


def p8_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.round_trip(table(spark, folder, "documents"))


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    return containers.containers(table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return cut_off.cut_documents(table(spark, folder, "documents")).select("doc_id")


def p10_sources(spark: SparkSession, folder: str) -> DataFrame:
    return cut_off.shares(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {name: value for name, value in globals().items() if name[0] == "p" and name[1:2].isdigit()}


#: A term, as in corpuscle.llm.common.term.
BLANK = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _term(column: str) -> str:
    return f"nullif(lower(trim(regexp_replace({column}, '{BLANK}', ' ', 'g'))), '')"


CHUNKS = "chunks AS (SELECT DISTINCT * FROM chunk WHERE chunk_id IS NOT NULL)"
ENTITY_TERMS = f"""entity_rows AS (SELECT doc_id, chunk_id, unnest(entities) AS e FROM chunks),
entity_terms AS (SELECT DISTINCT doc_id, chunk_id, {_term('e.surface')} AS term FROM entity_rows WHERE e.surface IS NOT NULL)"""
ACRONYM_TERMS = f"""acronym_rows AS (SELECT doc_id, chunk_id, unnest(acronyms) AS e FROM chunks),
acronym_terms AS (SELECT DISTINCT doc_id, chunk_id, {_term('e.short')} AS term FROM acronym_rows WHERE e.short IS NOT NULL)"""
PAIRS = f"""WITH {CHUNKS}, {ENTITY_TERMS}, items AS (SELECT chunk_id, term FROM entity_terms WHERE term IS NOT NULL),
counts AS (SELECT term, count(*) AS n_item FROM items GROUP BY term),
found AS (SELECT x.term AS a, y.term AS b, count(*) AS n_ab FROM items x JOIN items y ON x.chunk_id = y.chunk_id AND x.term < y.term GROUP BY ALL),
measured AS (SELECT a AS term_a, b AS term_b, n_ab, ca.n_item AS n_a, cb.n_item AS n_b, (SELECT count(*) FROM chunks) AS n
  FROM found JOIN counts ca ON ca.term = a JOIN counts cb ON cb.term = b)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": """WITH elements AS (SELECT DISTINCT doc_id, pos, type, text, text_level FROM content_list WHERE doc_id IS NOT NULL AND pos IS NOT NULL),
            marked AS (SELECT *, CASE WHEN type = 'text' AND text_level IS NOT NULL THEN pos END AS mark FROM elements),
            placed AS (SELECT *, coalesce(max(mark) OVER (PARTITION BY doc_id ORDER BY pos), min(pos) OVER (PARTITION BY doc_id)) AS section FROM marked)
            SELECT doc_id, section AS pos FROM placed WHERE type = 'text' GROUP BY ALL HAVING sum(length(text)) > 4000""",
        "p6_found": f"""WITH {CHUNKS}, {ENTITY_TERMS}, {ACRONYM_TERMS},
            terms AS (SELECT doc_id, chunk_id, 'entity' AS kind, term FROM entity_terms WHERE term IS NOT NULL
              UNION ALL SELECT doc_id, chunk_id, 'acronym', term FROM acronym_terms WHERE term IS NOT NULL),
            by_doc AS (SELECT doc_id, kind, term, count(*) AS n_doc FROM terms GROUP BY ALL),
            overall AS (SELECT kind, term, sum(n_doc) AS n_all FROM by_doc GROUP BY ALL)
            SELECT doc_id, kind, term FROM by_doc JOIN overall USING (kind, term) WHERE doc_id IS NOT NULL AND n_doc >= 3 AND 5 * n_doc >= 4 * n_all""",
        "p7_found": f"""{PAIRS} SELECT term_a, term_b FROM measured WHERE n_ab >= 6 AND n_ab * n >= 8 * n_a * n_b""",
        "p7_pairs": f"""{PAIRS} SELECT term_a, term_b, n_ab, n_a, n_b, n, round(n_ab::DOUBLE * n / (n_a * n_b), 6) AS ratio FROM measured""",
    }
