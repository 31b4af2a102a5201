"""SQL that states the queries of the catalogue over the same tables, for a second engine (DuckDB)."""

from __future__ import annotations

from corpuscle.operators.gazetteer import EXCLUDED
from corpuscle.operators.triples import CLASS, DOMAIN, EX, IDENTIFIER, LABEL, MENTIONS, NAME, PART_OF, PROPERTIES, SCHEMA, SUBCLASS, TYPE, WD

#: White space as Java's and as Python's strip take it.
WS = r"[\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BLANK = WS[:-1] + r"\x{1c}-\x{1f}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def key(c: str) -> str:
    flat = f"replace(regexp_replace(strip_accents(replace({c}, 'ß', 'ss')), '{WS}+', '_', 'g'), '-', '_')"
    return f"nullif(regexp_replace({flat}, '^_+|_+$', '', 'g'), 'nan')"


def tokens(c: str) -> str:
    return rf"len(regexp_extract_all(coalesce({c}, ''), '[\p{{L}}\p{{N}}\p{{M}}\p{{Pc}}]+|[^\p{{L}}\p{{N}}\p{{M}}\p{{Pc}}\s\x0b\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]'))"


def sanitized(c: str) -> str:
    plain = strip(f"regexp_replace(regexp_replace({strip(c)}, '[{{}}\\\\]', '', 'g'), '{BLANK}+', ' ', 'g')")
    word = r"[\p{L}\p{N}\p{M}\p{Pc}]"
    return rf"""(SELECT CASE WHEN NOT regexp_matches(z, '</?{word}+>') AND regexp_matches(z, '[\p{{L}}\p{{M}}\p{{Nl}}\p{{Pc}}]')
        AND len(regexp_replace(z, '[^A-Za-z0-9]', '', 'g')) >= 2 AND regexp_matches(z, '\p{{L}}') AND len(z) BETWEEN 2 AND 200
        THEN replace(z, '"', '\"') END FROM (SELECT {plain} AS z))"""


def safe(c: str) -> str:
    return f"nullif(substring(replace(url_encode(replace({c}, ' ', '_')), '%2F', '/'), 1, 100), '')"


def reference(c: str) -> str:
    """The character references that occur in the tables, as their characters."""
    for name, char in (("nbsp", "chr(160)"), ("lt", "'<'"), ("gt", "'>'"), ("quot", "'\"'"), ("#39", "chr(39)"), ("amp", "'&'")):
        c = f"replace({c}, '&{name};', {char})"
    return c


def date(c: str) -> str:
    return f"coalesce(try_strptime({c}, '%Y-%m-%dT%H:%M:%SZ'), try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%d/%m/%Y'))"


COLUMNS = "display_title last_modified_date docty count trustfund trustfund_key projn projectid owner pdfurl year fetched_at".split()
ORDER = ", ".join(f'"{c}" DESC NULLS LAST' for c in COLUMNS)
VERSIONS = f"""dated AS (SELECT *, {date('last_modified_date')} AS modified FROM doc_metadata WHERE id IS NOT NULL),
newest AS (SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY modified DESC NULLS LAST, {ORDER}) AS nth FROM dated) WHERE nth = 1)"""
KEYED = "docty count trustfund trustfund_key projn projectid display_title owner".split()
LATEST = VERSIONS + ",\nlatest AS (SELECT * REPLACE (" + ", ".join(f'{key(chr(34) + c + chr(34))} AS "{c}"' for c in KEYED) + ") FROM newest)"

ENTITIES = f"""kept AS (SELECT DISTINCT entity_id, doc_id, surface, label, qid FROM entities WHERE entity_id IS NOT NULL AND surface IS NOT NULL AND trim(surface) <> '' AND label IS NOT NULL
  AND label NOT IN ({', '.join(f"'{e}'" for e in EXCLUDED)}))"""
CHUNKS = "chunks AS (SELECT DISTINCT * FROM chunk WHERE chunk_id IS NOT NULL)"


def uri(kind: str, c: str) -> str:
    return f"'{EX}{kind}/' || {c}"


def fact(rows: str, s: str, p: str, o: str, kind: str = "literal", lang: str | None = None) -> str:
    tag = f"'{lang}'" if lang else "NULL::VARCHAR"
    return f"SELECT {s} AS s, '{p}' AS p, ({o})::VARCHAR AS o, '{kind}' AS o_kind, {tag} AS lang FROM {rows} WHERE ({s}) IS NOT NULL AND ({o}) IS NOT NULL"


def graph(*parts: str) -> str:
    return " UNION ".join(parts)


def instance(rows: str, kind: str, k: str, label: str, extra: dict[str, str] | None = None) -> list[str]:
    s, rows = uri(kind, k), f"(SELECT * FROM {rows} WHERE {k} IS NOT NULL AND {label} IS NOT NULL)"
    made = [fact(rows, s, TYPE, f"'{EX}{kind}'", "uri"), fact(rows, s, NAME, f"nullif({label}, '')", lang="en"), fact(rows, s, IDENTIFIER, k)]
    return made + [fact(rows, s, SCHEMA + p, c) for c, p in (extra or {}).items()]


def comma(c: str) -> str:
    return f"list_filter(list_transform(string_split(coalesce({c}, ''), ','), lambda y: trim(y)), lambda y: y <> '')"


def zipped(name: str, ids: str, names: str) -> str:
    return f"""{name} AS (SELECT id, max(name) AS name FROM (SELECT unnest({comma(ids)}[1:least(len({comma(ids)}), len({comma(names)}))]) AS id,
  unnest({comma(names)}[1:least(len({comma(ids)}), len({comma(names)}))]) AS name FROM latest) GROUP BY id)"""


def listed(name: str, c: str, many: bool) -> str:
    parts = comma(c) if many else f"[nullif(trim({c}), '')]"
    return rf"{name} AS (SELECT DISTINCT id, entity FROM (SELECT id, regexp_replace(unnest({parts}), '^_+|_+$', '', 'g') AS entity FROM latest) WHERE entity <> '')"


FUNDS = LATEST + ",\n" + zipped("funds", "trustfund_key", "trustfund") + ",\n" + zipped("projects", "projectid", "projn")
LISTED = FUNDS + ",\n" + listed("in_country", '"count"', False) + ",\n" + listed("in_project", "projectid", True) + ",\n" + listed("by_fund", "trustfund_key", True)
DOCUMENTS = instance("latest", "document", "id", "display_title", PROPERTIES)
INSTANCES = instance("funds", "trustfund", "id", "name") + instance("projects", "project", "id", "name")
LINKS = [
    fact("in_country", uri("document", "id"), SCHEMA + "countryOfOrigin", uri("country", "entity"), "uri"),
    fact("in_project", uri("document", "id"), SCHEMA + "isPartOf", uri("project", "entity"), "uri"),
    fact("by_fund", uri("document", "id"), SCHEMA + "funder", uri("trustfund", "entity"), "uri"),
]
TYPED = f"""{ENTITIES}, named AS (SELECT *, coalesce(nullif(qid, ''), {safe('surface')}) AS safe FROM kept),
usable AS (SELECT *, CASE WHEN qid IS NOT NULL AND qid <> '' THEN '{WD}' || qid ELSE '{EX}entity/' || safe END AS e FROM named WHERE surface <> '' AND safe IS NOT NULL AND doc_id IS NOT NULL)"""
ENTITY_FACTS = [
    fact("usable", "e", TYPE, f"'{SCHEMA}Thing'", "uri"), fact("usable", "e", NAME, "surface"), fact("usable", "e", SCHEMA + "additionalType", "label"),
    fact("usable", uri("document", "doc_id"), MENTIONS, "e", "uri"),
]
WHOLE = f"{LISTED},\n{TYPED},\ngraph AS ({graph(*DOCUMENTS, *INSTANCES, *LINKS, *ENTITY_FACTS)})"
TYPED_GRAPH = f"{TYPED},\ngraph AS ({graph(*ENTITY_FACTS)})"

SAID = f"""{CHUNKS}, said AS (SELECT chunk_id, CASE WHEN nullif(e.qid, '') IS NOT NULL THEN '{WD}' || e.qid ELSE '{EX}entity/' || e.rdf_safe END AS o
  FROM (SELECT chunk_id, unnest(entities) AS e FROM chunks) WHERE e IS NOT NULL),
typed AS (SELECT DISTINCT s FROM graph WHERE p = '{TYPE}')"""
MENTIONED = fact("(SELECT * FROM said WHERE o IN (SELECT s FROM typed))", uri("chunk", "chunk_id"), MENTIONS, "o", "uri")

LEVELS = range(1, 7)
_last = ", ".join(f"max(CASE WHEN named AND text_level = {k} THEN pos END) OVER w AS p{k}, max_by(title, pos) FILTER (WHERE named AND text_level = {k}) OVER w AS h{k}" for k in LEVELS)
_held = ", ".join(f"CASE WHEN p{k} > greatest(-1{''.join(f', coalesce(p{j}, -1)' for j in range(1, k))}) THEN h{k} END" for k in LEVELS)
PATHS = f"""elements AS (SELECT DISTINCT doc_id, pos, type, text, text_level, table_body FROM content_list WHERE doc_id IS NOT NULL AND pos IS NOT NULL),
marked AS (SELECT *, type = 'text' AND text_level IS NOT NULL AS header, {strip("coalesce(text, '')")} AS title FROM elements),
titled AS (SELECT *, header AND title <> '' AS named FROM marked),
carried AS (SELECT *, max(CASE WHEN header THEN pos END) OVER w AS mark, {_last} FROM titled WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
joined AS (SELECT *, concat_ws('/', {_held}) AS path FROM carried),
placed AS (SELECT doc_id, pos, type, text, text_level, table_body, header, title, coalesce(mark, -1) AS section, CASE WHEN path = '' THEN '/' ELSE '/' || path || '/' END AS header_path FROM joined)"""
SECTIONS = f"""{PATHS},
lines AS (SELECT *, CASE WHEN header THEN CASE WHEN title <> '' THEN repeat('#', text_level) || ' ' || title END ELSE coalesce(text, '') END AS line FROM placed WHERE type = 'text'),
texts AS (SELECT doc_id, section, header_path, {strip("string_agg(line, chr(10) ORDER BY pos)")} AS text FROM lines WHERE line IS NOT NULL GROUP BY ALL)"""

#: Units and greedy chunks, as corpuscle.operators.splitting has them, by a recursion over the chunks of each text.
WORD_UNITS = rf"""flatten(list_transform(list_filter(regexp_extract_all(y, '[^ \t\n]+[ \t\n]*|[ \t\n]+'), lambda w: w <> ''),
  lambda w: CASE WHEN {tokens('w')} > SIZE THEN list_transform(range(0, (len(w) - 1) // SIZE + 1), lambda k: substring(w, k * SIZE + 1, SIZE)) ELSE [w] END))"""
SPLITS = (rf"""{SECTIONS},
units AS (SELECT doc_id, section, header_path, flatten(list_transform(list_filter(regexp_extract_all(text, '[^\n]*?(?:[.!?]+(?:[ \t]+|\z)|\n+|\z)'), lambda y: y <> ''),
  lambda y: CASE WHEN {tokens('y')} > SIZE THEN {WORD_UNITS} ELSE [y] END)) AS u FROM texts WHERE text <> ''),
counts AS (SELECT *, list_transform(u, lambda y: {tokens('y')}) AS t FROM units),
sums AS (SELECT *, list_transform(range(0, len(u) + 1), lambda k: coalesce(list_sum(t[1:k]), 0)::BIGINT) AS c FROM counts),
spans AS (SELECT doc_id, section, 0 AS k, 1::BIGINT AS s, len(list_filter(c, lambda y: y <= SIZE))::BIGINT - 1 AS e FROM sums
  UNION ALL SELECT doc_id, section, k + 1, following, len(list_filter(c, lambda y: y <= c[following] + SIZE))::BIGINT - 1 FROM (
    SELECT p.doc_id, p.section, p.k, x.c, greatest(p.s + 1, len(list_filter(x.c, lambda y: y < greatest(x.c[p.e + 1] - OVERLAP, x.c[p.e + 2] - SIZE)))::BIGINT + 1) AS following
    FROM spans p JOIN sums x USING (doc_id, section) WHERE p.e < len(x.u))),
split AS (SELECT doc_id, section, header_path, (row_number() OVER (PARTITION BY doc_id, section ORDER BY k))::INT - 1 AS split, text FROM (
  SELECT doc_id, section, header_path, k, {strip("array_to_string(u[s:e], '')")} AS text FROM spans JOIN sums USING (doc_id, section)) WHERE text <> '')""")
SPLIT = lambda size, overlap: "WITH RECURSIVE " + SPLITS.replace("SIZE", str(size)).replace("OVERLAP", str(overlap))

WORDS = f"words AS (SELECT doc_id, list_filter(string_split_regex(text, '{WS}+'), lambda y: y <> '') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)"
PIECES = f"""{WORDS}, cut AS (SELECT doc_id, w, unnest(range(0, greatest(0, ceil((len(w) - 100) / 80.0)::BIGINT * 80) + 1, 80)) AS start FROM words WHERE len(w) > 0),
pieces AS (SELECT doc_id, (start // 80)::INT AS ordinal, array_to_string(w[start + 1:start + 100], ' ') AS text FROM cut)"""
GROUPS = r"""lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda y: trim(y) <> '') AS l FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
cut AS (SELECT doc_id, l, unnest(range(0, len(l), 2)) AS start FROM lines WHERE len(l) > 0),
groups AS (SELECT doc_id, (start // 2)::INT AS ordinal, array_to_string(l[start + 1:start + 3], chr(10) || chr(10)) AS text FROM cut)"""

ACRONYMS = f"""{CHUNKS}, explained AS (SELECT doc_id, unnest(acronyms) AS a FROM chunks WHERE doc_id IS NOT NULL),
of_chunks AS (SELECT doc_id, a.short AS short, min(a.long) AS long FROM explained WHERE a.short IS NOT NULL AND a.short <> '' AND a.long IS NOT NULL GROUP BY ALL)"""
INITIALS = rf"""{ENTITIES}, capital AS (SELECT doc_id, surface, array_to_string(list_transform(list_filter(string_split_regex(surface, '\s+'), lambda y: regexp_matches(y, '^[A-Z]')), lambda y: substring(y, 1, 1)), '') AS short
  FROM kept WHERE label = 'ORG' AND doc_id IS NOT NULL),
initials AS (SELECT doc_id, short, min(surface) AS long FROM capital WHERE len(short) >= 2 GROUP BY ALL)"""

LOOKUPS = f"""{ENTITIES}, fit AS (SELECT surface, label, {sanitized('surface')} AS name FROM (SELECT DISTINCT surface, label FROM kept) WHERE surface <> '' AND label <> ''),
wanted AS (SELECT lower(name) AS name_lc, lower(label) AS type_lc, min(name) AS name, min(label) AS label FROM fit WHERE name IS NOT NULL GROUP BY 1, 2)"""
CACHE = f"""cache AS (SELECT lower(surface) AS name_lc, lower(label) AS type_lc, min(CASE WHEN qid IS NOT NULL THEN '{WD}' || qid END) AS url
  FROM entities WHERE surface IS NOT NULL AND label IS NOT NULL GROUP BY 1, 2)"""
#: Letters with accents and no-break spaces as single bytes, as the engine's levenshtein counts bytes.
FLAT = lambda c: f"translate({c}, 'áíóéñúàâãçêôõü' || chr(160), chr(1) || chr(2) || chr(3) || chr(4) || chr(5) || chr(6) || chr(7) || chr(14) || chr(15) || chr(16) || chr(17) || chr(18) || chr(19) || chr(20) || chr(21))"
NEAR = f"""{LOOKUPS.replace("wanted AS (", "looked AS (")},
wanted AS (SELECT name_lc, type_lc, CASE WHEN label = 'UNBIS_TERM' THEN strip_accents(name) ELSE name END AS name, label FROM looked),
labels AS (SELECT DISTINCT qid, surface AS label FROM entities WHERE qid IS NOT NULL AND surface IS NOT NULL UNION SELECT id, pattern FROM unbis_vocab WHERE pattern IS NOT NULL),
asked AS (SELECT DISTINCT name, {FLAT('name')} AS flat FROM wanted), told AS (SELECT qid, label, {FLAT('label')} AS flat FROM labels),
near AS (SELECT DISTINCT a.name, t.qid, t.label, levenshtein(a.flat, t.flat) AS distance FROM asked a JOIN told t ON abs(len(a.flat) - len(t.flat)) <= 3 AND levenshtein(a.flat, t.flat) <= 3)"""
KNOWN = "known AS (SELECT surface AS name, min(qid) AS qid FROM entities WHERE qid IS NOT NULL AND surface IS NOT NULL GROUP BY 1)"
TREE = """tree AS (SELECT n_name AS child, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'WORLD' FROM region),
closure AS (SELECT child AS node, child AS ancestor FROM tree UNION SELECT parent, parent FROM tree UNION SELECT child, parent FROM tree UNION SELECT a.child, b.parent FROM tree a JOIN tree b ON a.parent = b.child)"""

VECTORS = """v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), q AS (SELECT * FROM v WHERE vec_id % 50 = 0)"""


def nearest(k: int, same: str = "") -> str:
    return f"""{VECTORS}, scored AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id, round(list_dot_product(v.e, q.e) / (sqrt(list_dot_product(v.e, v.e)) * sqrt(list_dot_product(q.e, q.e))), 6) AS score
  FROM v JOIN q ON v.vec_id <> q.vec_id {same}),
top AS (SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored) WHERE rank <= {k}),
said AS (SELECT doc_id - 10000000 AS vec_id, coalesce(text, '') AS text FROM documents)"""


MEMBERS = """members AS (SELECT doc_id AS node, substring(projectid, 2, 20)::BIGINT AS community FROM documents WHERE projectid IS NOT NULL AND doc_id IS NOT NULL)"""
WITHIN = f"""{MEMBERS}, budgeted AS (SELECT m.community, d.doc_id AS chunk_id, d.text, {tokens('d.text')} AS tokens FROM members m JOIN documents d ON d.doc_id = m.node WHERE d.text IS NOT NULL),
so_far AS (SELECT *, (sum(tokens) OVER (PARTITION BY community ORDER BY chunk_id ROWS UNBOUNDED PRECEDING))::BIGINT AS tokens_so_far FROM budgeted),
within AS (SELECT * FROM so_far WHERE tokens_so_far < 2000)"""
COMMUNITY_FACTS = [
    fact("members", uri("chunk", "node"), PART_OF, uri("community", "community"), "uri"),
    fact("members", uri("community", "community"), TYPE, f"'{SCHEMA}Community'", "uri"),
    fact("members", uri("community", "community"), IDENTIFIER, "community"),
    fact("members", uri("community", "community"), NAME, "'Community ' || community"),
]
TURNS = f"""turns AS (SELECT DISTINCT doc_id AS conv_id, pos AS turn, type AS role, text FROM content_list WHERE doc_id IS NOT NULL AND pos IS NOT NULL AND text IS NOT NULL),
counted AS (SELECT *, {tokens('text')} AS tokens FROM turns),
remembered AS (SELECT * FROM (SELECT *, (sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING))::BIGINT AS tokens_so_far FROM counted) WHERE tokens_so_far <= 200)"""
TRIPLE = "s, p, o, o_kind, lang"


def shared_edges(members: str, node: str) -> str:
    return f"SELECT x.{node} AS u, y.{node} AS v, count(*) AS weight FROM {members} x JOIN {members} y ON x.entity = y.entity AND x.{node} < y.{node} GROUP BY 1, 2"


def oracle_sql() -> dict[str, str]:
    classes = []
    for k, n, properties in (("document", "Document", tuple(PROPERTIES.values())), ("project", "Project", ()), ("trustfund", "Trust Fund", ())):
        classes += [(EX + k, TYPE, CLASS, "uri", None), (EX + k, SUBCLASS, SCHEMA + "Thing", "uri", None), (EX + k, LABEL, n, "literal", "en"), (IDENTIFIER, DOMAIN, EX + k, "uri", None)]
        classes += [(SCHEMA + p, DOMAIN, EX + k, "uri", None) for p in properties]
    rows = ", ".join("(" + ", ".join("NULL" if c is None else f"'{c}'" for c in r) + ")" for r in classes)
    batch = f"""WITH RECURSIVE {ENTITIES}, items AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY entity_id) AS position, surface AS item, {tokens('surface')} AS tokens FROM kept WHERE doc_id IS NOT NULL),
        walk AS (SELECT doc_id, position, item, tokens, 0::BIGINT AS batch, tokens AS used FROM items WHERE position = 1
          UNION ALL SELECT i.doc_id, i.position, i.item, i.tokens, CASE WHEN w.used > 0 AND w.used + i.tokens > 20 THEN w.batch + 1 ELSE w.batch END,
            CASE WHEN w.used > 0 AND w.used + i.tokens > 20 THEN i.tokens ELSE w.used + i.tokens END FROM walk w JOIN items i ON i.doc_id = w.doc_id AND i.position = w.position + 1)
        SELECT doc_id, batch, position, item, tokens FROM walk"""
    token = r"[\p{L}\p{N}]+(?:[-''’][\p{L}\p{N}]+)*"
    doc_facts = f"WITH {LATEST}, graph AS ({graph(*DOCUMENTS)})"
    escaped = "replace(replace(replace(replace(replace(o, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    reached = """links AS (SELECT DISTINCT a.entity AS x, b.entity AS y FROM pairs a JOIN pairs b USING (doc_id)),
        reach AS (SELECT x AS e, x AS r FROM links UNION SELECT reach.e, y FROM reach JOIN links ON x = r),
        least AS (SELECT e, min(doc_id) AS component, count(DISTINCT doc_id) AS n FROM reach JOIN pairs ON pairs.entity = r GROUP BY e),
        found AS (SELECT DISTINCT doc_id AS node, component FROM pairs JOIN least ON entity = e WHERE n > 1)"""
    explained = f"{ACRONYMS}, pairs AS (SELECT DISTINCT doc_id, short || '=' || long AS entity FROM of_chunks)"
    return {
        "metadata_latest_version": f"WITH {VERSIONS} SELECT * EXCLUDE (fetched_at) FROM newest",
        "metadata_versions": f"WITH {VERSIONS} SELECT id, modified, row_number() OVER (PARTITION BY id ORDER BY modified NULLS FIRST) AS version FROM (SELECT DISTINCT id, modified FROM dated)",
        "sanitize_keys": f"WITH {LATEST} SELECT id, {', '.join(chr(34) + c + chr(34) for c in KEYED)} FROM latest",
        "clean_text": f"SELECT doc_id, trim(regexp_replace(strip_accents(replace(text, 'ß', 'ss')), '{WS}+', ' ', 'g')) AS cleaned FROM documents",
        "sanitize_entities": f"SELECT surface, {sanitized('surface')} AS sanitized FROM (SELECT DISTINCT surface FROM entities WHERE surface IS NOT NULL)",
        "rdf_safe_ids": f"SELECT surface, qid, coalesce(nullif(qid, ''), {safe('surface')}) AS safe FROM (SELECT DISTINCT surface, qid FROM entities WHERE surface IS NOT NULL)",
        "token_counts": f"SELECT surface, {tokens('surface')} AS n_tokens FROM (SELECT DISTINCT surface FROM entities WHERE surface IS NOT NULL)",
        "kb_id_and_cache_keys": f"""WITH keyed AS (SELECT lower(surface) || '|' || lower(label) AS key, '{WD}' || qid AS url FROM entities WHERE surface IS NOT NULL AND label IS NOT NULL)
            SELECT DISTINCT substring(key, 1, strpos(key, '|') - 1) AS name_lc, substring(key, strpos(key, '|') + 1) AS type_lc, url, string_split(url, '/')[-1] AS qid FROM keyed""",
        "document_triples": f"WITH {LATEST} {graph(*DOCUMENTS)}",
        "class_triples": f"SELECT DISTINCT * FROM (VALUES {rows}) AS t({TRIPLE})",
        "subclass_triples": f"""WITH {LATEST}, kinds AS (SELECT DISTINCT docty FROM latest WHERE docty IS NOT NULL AND docty <> '')
            {graph(*(fact('kinds', uri('document', "translate(docty, ' -', '__')"), p, o, k, lang) for p, o, k, lang in ((TYPE, f"'{CLASS}'", 'uri', None), (SUBCLASS, f"'{EX}document'", 'uri', None), (LABEL, 'docty', 'literal', 'en'))))}""",
        "split_zip_ids": f"WITH {FUNDS} SELECT id, name FROM funds",
        "fund_and_project_triples": f"WITH {FUNDS} {graph(*INSTANCES)}",
        "country_triples": f"""WITH {LATEST}, named AS (SELECT upper(n_name[1]) || lower(n_name[2:]) AS raw, array_to_string(list_transform(string_split(n_name, ' '), lambda y: upper(y[1]) || lower(y[2:])), ' ') AS n, n_nationkey FROM nation),
            kb AS (SELECT {key('n')} AS key, 'Q' || n_nationkey AS qid FROM named),
            found AS (SELECT DISTINCT key, qid FROM (SELECT "count" AS key FROM latest WHERE "count" IS NOT NULL UNION SELECT key FROM kb) LEFT JOIN kb USING (key))
            {graph(fact('found', uri('country', 'key'), TYPE, f"'{SCHEMA}Country'", 'uri'), fact('found', uri('country', 'key'), NAME, "replace(key, '_', ' ')", lang='en'), fact('found', uri('country', 'key'), SCHEMA + 'sameAs', f"'{WD}' || qid", 'uri'))}""",
        "link_doc_country": f"WITH {LISTED} {graph(LINKS[0])}",
        "link_doc_project": f"WITH {LISTED} {graph(LINKS[1])}",
        "link_doc_trustfund": f"WITH {LISTED} {graph(LINKS[2])}",
        "fallback_entities": f"""WITH {LISTED}, graph AS ({graph(*INSTANCES)}), missing AS (SELECT DISTINCT entity FROM by_fund WHERE {uri('trustfund', 'entity')} NOT IN (SELECT s FROM graph))
            {graph(fact('missing', uri('trustfund', 'entity'), TYPE, f"'{EX}trustfund'", 'uri'), fact('missing', uri('trustfund', 'entity'), IDENTIFIER, 'entity'))}""",
        "typed_entity_triples": f"WITH {TYPED_GRAPH} SELECT {TRIPLE} FROM graph",
        "kg_union_distinct": f"WITH {WHOLE} SELECT {TRIPLE} FROM graph",
        "triples_by_predicate": f"WITH {WHOLE} SELECT p, count(*) AS n_triples FROM graph GROUP BY p",
        "triples_by_subject": f"WITH {WHOLE} SELECT s, count(*) AS n_triples, count(DISTINCT p) AS n_predicates FROM graph GROUP BY s",
        "mentions_of_documents": f"WITH {WHOLE} SELECT s, o FROM graph WHERE p = '{MENTIONS}'",
        "graph_identifiers": f"WITH {WHOLE} SELECT DISTINCT o AS identifier FROM graph WHERE p = '{IDENTIFIER}'",
        "document_ids": f"WITH {WHOLE} SELECT DISTINCT o AS identifier FROM graph WHERE p = '{IDENTIFIER}' AND s IN (SELECT s FROM graph WHERE p = '{TYPE}' AND o = '{EX}document')",
        "url_by_id": f"{doc_facts} SELECT a.o AS identifier, min(b.o) AS url FROM graph a JOIN graph b ON a.s = b.s AND b.p = '{SCHEMA}url' WHERE a.p = '{IDENTIFIER}' GROUP BY 1",
        "graph_ntriples": f"""{doc_facts} SELECT '<' || s || '> <' || p || '> ' || CASE WHEN o_kind = 'uri' THEN '<' || o || '>' ELSE '"' || {escaped} || '"' || coalesce('@' || lang, '') END || ' .' AS line FROM graph""",
        "chunk_triples": f"""WITH {TYPED_GRAPH}, {SAID} {graph(fact('chunks', uri('chunk', 'chunk_id'), TYPE, f"'{SCHEMA}TextObject'", 'uri'), fact('chunks', uri('chunk', 'chunk_id'), SCHEMA + 'text', 'text'), fact('chunks', uri('chunk', 'chunk_id'), PART_OF, uri('document', 'doc_id'), 'uri'), MENTIONED)}""",
        "mention_existing_only": f"WITH {TYPED_GRAPH}, {SAID} SELECT DISTINCT s, o FROM ({MENTIONED})",
        "header_path": f"WITH {PATHS} SELECT doc_id, pos, section, header_path FROM placed",
        "sections_text": f"{SPLIT(1024, 20)} SELECT doc_id, section, header_path, split, text FROM split",
        "sections_split": f"{SPLIT(100, 20)} SELECT doc_id, section, header_path, split, text FROM split",
        "section_tables": f"WITH {PATHS} SELECT doc_id, section, pos, header_path, table_body FROM placed WHERE type = 'table' AND table_body IS NOT NULL",
        "chunk_windows": f"WITH {PIECES} SELECT * FROM pieces",
        "chunk_prev_next": f"""WITH {PIECES}, named AS (SELECT doc_id, ordinal, doc_id || '#' || ordinal AS piece_id FROM pieces)
            SELECT *, lag(piece_id) OVER w AS prev_id, lead(piece_id) OVER w AS next_id FROM named WINDOW w AS (PARTITION BY doc_id ORDER BY ordinal)""",
        "group_into_windows": f"WITH {GROUPS} SELECT * FROM groups",
        "chunk_markdown": f"WITH {GROUPS} SELECT doc_id, ordinal, '## Chunk ' || (ordinal + 1) || chr(10) || chr(10) || text || chr(10) || chr(10) || '---' || chr(10) || chr(10) AS text FROM groups",
        "token_batches": batch,
        "clean_acronyms": rf"""WITH {ACRONYMS} SELECT doc_id, short, {strip(reference('long'))} AS long FROM of_chunks
            WHERE len(short) >= 2 AND len(regexp_replace(short, '[^\p{{Lu}}]', '', 'g'))::DOUBLE / len(short) >= 0.5""",
        "merge_acronyms": f"""WITH {ACRONYMS}, {INITIALS} SELECT doc_id, short, coalesce(a.long, b.long) AS long, coalesce(a.long <> b.long, false) AS conflict FROM of_chunks a FULL JOIN initials b USING (doc_id, short)""",
        "invert_acronyms": f"""WITH {ACRONYMS}, {INITIALS}, both_ AS (SELECT doc_id, long, short, 0 AS rank FROM of_chunks UNION ALL SELECT doc_id, long, short, 1 FROM initials)
            SELECT doc_id, long, short FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, long ORDER BY rank, short) AS nth FROM both_ WHERE long IS NOT NULL) WHERE nth = 1""",
        "acronym_patterns": f"""WITH {ACRONYMS} SELECT DISTINCT * FROM (SELECT 'ACRONYM' AS label, lower(short) AS tokens, short AS id FROM of_chunks
            UNION ALL SELECT 'ACRONYM_EXPANDED', array_to_string(list_filter(string_split_regex(lower(long), '{WS}+'), lambda y: y <> ''), ' '), long FROM of_chunks WHERE long <> '')""",
        "vocab_scrape": "SELECT pattern AS term, id AS href FROM unbis_vocab",
        "vocabulary_patterns": f"SELECT label, array_to_string(list_filter(string_split_regex(lower(pattern), '{WS}+'), lambda y: y <> ''), ' ') AS tokens, id FROM unbis_vocab WHERE pattern <> ''",
        "gazetteer_mentions": f"""WITH said AS (SELECT doc_id, regexp_extract_all(lower(text), '{token}') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
            runs AS (SELECT doc_id, n, unnest(range(0, len(w) - n + 1)) AS start, w FROM said, (VALUES (1), (2), (3)) AS l(n))
            SELECT doc_id, start::INT AS start, n AS length, v.label, v.id FROM runs JOIN unbis_vocab v ON array_to_string(w[start + 1:start + n], ' ') = lower(v.pattern) AND len(string_split(v.pattern, ' ')) = n""",
        "entity_label_filter": f"WITH {ENTITIES} SELECT entity_id, doc_id, surface, label FROM kept",
        "dedupe_mentions": """WITH once AS (SELECT DISTINCT entity_id, doc_id, surface, label FROM entities WHERE doc_id IS NOT NULL AND surface <> '' AND label <> '')
            SELECT doc_id, lower(surface) AS name_lc, lower(label) AS type_lc, min_by(surface, entity_id) AS surface, min_by(label, entity_id) AS label, count(DISTINCT entity_id) AS n FROM once GROUP BY 1, 2, 3""",
        "link_exact": f"WITH {LOOKUPS}, {KNOWN} SELECT name_lc, type_lc, name, label, qid FROM wanted LEFT JOIN known USING (name)",
        "link_cascade": f"""WITH {NEAR}, best AS (SELECT name, qid FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY distance, label, qid) AS nth FROM near WHERE distance <= 2) WHERE nth = 1),
            hit AS (SELECT w.*, v.qid AS hit FROM wanted w LEFT JOIN (SELECT label, min(qid) AS qid FROM labels GROUP BY 1) v ON v.label = w.name)
            SELECT name_lc, type_lc, h.name, label, coalesce(hit, qid) AS qid, CASE WHEN hit IS NOT NULL THEN 'exact' WHEN qid IS NOT NULL THEN 'fuzzy' END AS how FROM hit h LEFT JOIN best b ON b.name = h.name""",
        "fuzzy_candidates": f"""WITH {NEAR} SELECT name, rank, qid, distance FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY distance, label, qid) AS rank FROM near) WHERE rank <= 10""",
        "class_closure": f"WITH {TREE} SELECT node, ancestor FROM closure",
        "link_typed_closure": f"""WITH {TREE}, valid AS (SELECT DISTINCT c_name AS qid FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN closure ON node = n_name WHERE ancestor = 'EUROPE'),
            ranked AS (SELECT c_mktsegment AS name, 'ORG' AS label, c_name AS qid, c_name IN (SELECT qid FROM valid) AS valid, c_custkey FROM customer)
            SELECT name, label, qid, valid FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY valid DESC, c_custkey, qid) AS nth FROM ranked) WHERE nth = 1""",
        "link_cache_literal": f"WITH {LOOKUPS}, {CACHE} SELECT * FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM cache c WHERE c.name_lc = w.name_lc AND c.type_lc = w.type_lc)",
        "link_cache_intended": f"""WITH {LOOKUPS}, {CACHE} SELECT w.*, string_split(url, '/')[-1] AS qid, c.name_lc IS NOT NULL AS known FROM wanted w LEFT JOIN cache c ON c.name_lc = w.name_lc AND c.type_lc = w.type_lc""",
        "cache_upsert": f"""WITH {LOOKUPS}, {KNOWN}, {CACHE}, new AS (SELECT name_lc, type_lc, CASE WHEN qid IS NOT NULL THEN '{WD}' || qid END AS url FROM wanted LEFT JOIN known USING (name))
            SELECT name_lc, type_lc, url FROM cache c WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.name_lc = c.name_lc AND n.type_lc = c.type_lc) UNION ALL SELECT * FROM new""",
        "country_facts": """WITH named AS (SELECT array_to_string(list_transform(string_split(n_name, ' '), lambda y: upper(y[1]) || lower(y[2:])), ' ') AS key, n_nationkey, n_regionkey FROM nation),
            facts AS (SELECT key, 'P30' AS predicate, r_name AS object FROM named JOIN region ON n_regionkey = r_regionkey
              UNION SELECT key, 'P1082', count(*)::VARCHAR FROM named JOIN customer ON c_nationkey = n_nationkey GROUP BY key)
            SELECT key, predicate, object, row_number() OVER (PARTITION BY object ORDER BY key, predicate) = 1 AS named FROM facts""",
        "annotate_entities": f"WITH {CHUNKS}, {ENTITIES} SELECT DISTINCT chunk_id, surface FROM chunks c JOIN (SELECT DISTINCT doc_id, surface FROM kept) e ON e.doc_id = c.doc_id WHERE contains(lower(c.text), lower(surface))",
        "annotate_acronyms": f"WITH {ACRONYMS} SELECT DISTINCT chunk_id, short, long FROM chunks c JOIN of_chunks a ON a.doc_id = c.doc_id WHERE contains(text, short) OR (long <> '' AND contains(text, long))",
        "annotated_chunks": f"""WITH {ACRONYMS}, {ENTITIES}
            SELECT DISTINCT chunk_id, 'acronym' AS kind, short AS said, long AS meant FROM chunks c JOIN of_chunks a ON a.doc_id = c.doc_id WHERE contains(text, short) OR (long <> '' AND contains(text, long))
            UNION ALL SELECT DISTINCT chunk_id, 'entity', surface, NULL FROM chunks c JOIN (SELECT DISTINCT doc_id, surface FROM kept) e ON e.doc_id = c.doc_id WHERE contains(lower(c.text), lower(surface))""",
        "llm_json_repair": f"WITH {ACRONYMS} SELECT doc_id, short, replace(long, chr(39), ' ') AS long FROM of_chunks",
        "llm_json_sizes": f"WITH {ACRONYMS} SELECT doc_id, 1::INT AS n_parsed FROM of_chunks",
        "pages_read": "SELECT id, display_title, last_modified_date, docty, \"count\", trustfund, trustfund_key, projn, projectid, owner, pdfurl, year FROM doc_metadata WHERE id IS NOT NULL",
        "graph_saved": f"WITH {LATEST} {graph(*DOCUMENTS)}",
        "graph_turtle": f"WITH {LATEST} {graph(*DOCUMENTS)}",
        "vocabulary_saved": "SELECT lower(pattern) AS pattern, min(id) AS id, 'UNBIS_TERM' AS label FROM unbis_vocab WHERE pattern IS NOT NULL GROUP BY 1",
        "table_saved": f"WITH {ENTITIES} SELECT entity_id, label, nullif(qid, '') AS qid FROM kept",
        "records_saved": f"WITH {ACRONYMS} SELECT doc_id, short, long FROM of_chunks",
        "markdown_saved": f"WITH {GROUPS} SELECT '## Chunk ' || (ordinal + 1) AS value, count(*) AS n FROM groups GROUP BY 1",
        "store_documents": """WITH chunks AS (SELECT DISTINCT chunk_id, doc_id FROM chunk WHERE chunk_id IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL)
            SELECT doc_id, CASE WHEN count(*) > 3 THEN 1 ELSE count(*) END AS n_chunks FROM chunks GROUP BY 1""",
        "store_new_documents": "SELECT doc_id FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM chunk WHERE chunk_id IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL)",
        "metadata_languages": "SELECT doc_id, CASE lang WHEN 'English' THEN 'en' ELSE 'en' END AS code FROM documents",
        "same_as_links": """WITH named AS (SELECT array_to_string(list_transform(string_split(n_name, ' '), lambda y: upper(y[1]) || lower(y[2:])), ' ') AS n, n_nationkey FROM nation)
            SELECT 'EXcountry/' || KEYED AS s, 'Q' || n_nationkey AS qid FROM named""".replace("EX", EX).replace("KEYED", key("n")),
        "tree_summaries": f"""WITH {nearest(3)}, texts AS (SELECT query_id, max(CASE WHEN rank = 1 THEN text END) AS a, max(CASE WHEN rank = 2 THEN text END) AS b, max(CASE WHEN rank = 3 THEN text END) AS c, count(*) AS n FROM top JOIN said USING (vec_id) GROUP BY 1)
            SELECT query_id, CASE n WHEN 3 THEN substring(substring(a || chr(10) || chr(10) || b, 1, 60) || chr(10) || chr(10) || substring(c, 1, 60), 1, 60) WHEN 2 THEN substring(concat_ws(chr(10) || chr(10), a, b, c), 1, 60) ELSE substring(coalesce(a, b, c), 1, 60) END AS answer FROM texts""",
        "replace_doc_chunks": f"""{SPLIT(1024, 20)}, {CHUNKS}, new AS (SELECT doc_id, header_path, text FROM split)
            SELECT doc_id, header_path, text FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.doc_id = c.doc_id) UNION ALL SELECT * FROM new""",
        "chunk_graph_edges": f"""WITH {CHUNKS}, members AS (SELECT DISTINCT chunk_id, coalesce(nullif(e.qid, ''), nullif(e.rdf_safe, '')) AS entity FROM (SELECT chunk_id, unnest(entities) AS e FROM chunks))
            {shared_edges('members', 'chunk_id')}""",
        "acronym_graph_edges": f"WITH {explained} {shared_edges('pairs', 'doc_id')}",
        "graph_components": f"WITH RECURSIVE {explained}, {reached} SELECT node, component FROM found",
        "community_sizes": f"WITH RECURSIVE {explained}, {reached} SELECT component, count(*) AS n FROM found GROUP BY 1 ORDER BY n DESC, component LIMIT 10",
        "community_context": f"WITH {WITHIN} SELECT community, chunk_id, tokens, tokens_so_far FROM within",
        "community_texts": f"WITH {WITHIN} SELECT community, count(*) AS n_texts, string_agg(text, chr(10) || chr(10) ORDER BY chunk_id) AS context FROM within GROUP BY 1",
        "community_triples": f"WITH {MEMBERS} {graph(*COMMUNITY_FACTS)}",
        "community_docs_new": f"""WITH {MEMBERS}, stored AS (SELECT substring(projectid, 2, 20)::BIGINT AS community FROM documents WHERE docty IS NULL AND projectid IS NOT NULL)
            SELECT 'community-' || community AS id, {uri('community', 'community')} AS uri, 'community_summary' AS kind, 'Documents: ' || count(*) AS text, community::VARCHAR AS identifier, 'Community ' || community AS name
            FROM members WHERE community NOT IN (SELECT community FROM stored) GROUP BY community""",
        "vector_topk": f"WITH {nearest(3)} SELECT query_id, rank, vec_id, score FROM top",
        "vector_topk_filtered": f"WITH {nearest(5, 'AND v.label = q.label')} SELECT query_id, rank, vec_id, score FROM top",
        "acronym_section": f"WITH {nearest(5, 'AND v.label = q.label')} SELECT query_id, string_agg(text, '---' || chr(10) || chr(10) ORDER BY rank) AS context FROM top JOIN said USING (vec_id) GROUP BY 1",
        "rag_prompt": f"""WITH {nearest(3)} SELECT query_id, 'Context:' || chr(10) || string_agg(text, chr(10) || chr(10) ORDER BY rank) || chr(10) || chr(10) || 'Question: What is said of ' || query_id || '?' || chr(10) || 'Answer:' AS prompt
            FROM top JOIN said USING (vec_id) GROUP BY query_id""",
        "source_snippets": f"WITH {nearest(3)} SELECT query_id, rank, vec_id, '[chunk] ' || replace(substring(text, 1, 140), chr(10), ' ') || '...' AS snippet FROM top JOIN said USING (vec_id)",
        "chat_memory": f"WITH {TURNS} SELECT conv_id, turn, role, tokens, tokens_so_far FROM remembered",
        "condensed_question": f"""WITH {TURNS}, history AS (SELECT conv_id, string_agg(concat_ws(': ', role, text), chr(10) ORDER BY turn) AS history FROM remembered GROUP BY 1)
            SELECT c.conv_id, 'Chat history:' || chr(10) || coalesce(history, '') || chr(10) || 'Follow-up: What changed?' || chr(10) || 'Standalone question:' AS prompt FROM (SELECT DISTINCT conv_id FROM turns) c LEFT JOIN history h ON h.conv_id = c.conv_id""",
        "result_records": f"""WITH {ACRONYMS}, {ENTITIES} SELECT doc_id, coalesce(a.n, 0) AS n_acronyms, coalesce(e.n, 0) AS n_entities FROM (SELECT doc_id, count(*) AS n FROM of_chunks GROUP BY 1) a
            FULL JOIN (SELECT doc_id, count(*) AS n FROM kept WHERE doc_id IS NOT NULL GROUP BY 1) e USING (doc_id)""",
    }
