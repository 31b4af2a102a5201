"""Scalar text functions as columns (identifiers, keys, cleaning, rendering)."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ends of a string that Python calls white space, no-break spaces too.
EDGES = r"(?U)^[\s\u001c-\u001f]+|[\s\u001c-\u001f]+$"


@lru_cache(1)
def _accents() -> tuple[str, str]:
    """Accented letters of the alphabets below U+2000 and their bases, by Unicode's own decompositions."""
    pairs = {}
    for code in range(0xC0, 0x2000):
        letter = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.combining(c))
        if base != letter and len(base) == 1:
            pairs[letter] = base
    return "".join(pairs), "".join(pairs.values())


def unaccent(value: Column) -> Column:
    """Letters without their accents, whether composed or followed by marks; letters themselves stay in their script."""
    with_marks, without = _accents()
    return F.regexp_replace(F.translate(F.replace(value, F.lit("ß"), F.lit("ss")), with_marks, without), r"\p{M}+", "")


def stripped(value: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(value, EDGES, "")


def sanitize_key(value: Column) -> Column:
    """A key for identifiers: no accents, blanks and hyphens as underscores, none at the ends; null for null and 'nan'."""
    key = F.regexp_replace(unaccent(value), r"(?U)\s+", "_")
    key = F.regexp_replace(F.replace(key, F.lit("-"), F.lit("_")), "^_+|_+$", "")
    return F.nullif(key, F.lit("nan"))


def clean_text(value: Column) -> Column:
    """Running text: no accents, white space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(unaccent(value), r"(?U)\s+", " "))


def sanitize_entity(surface: Column) -> Column:
    """A name fit for a lookup, or null.

    Braces and backslashes go, white space runs become one space. Null for a bare tag, for digits and marks only, for
    fewer than two ASCII letters or digits, for no letter at all, for a length outside 2 to 200. Double quotes get a
    backslash.
    """
    text = F.regexp_replace(stripped(surface), r"[{}\\]", "")
    text = stripped(F.regexp_replace(text, r"(?U)[\s\u001c-\u001f]+", " "))
    good = (
        ~text.rlike(r"(?U)</?\w+>")
        & ~text.rlike(r"(?U)^[\d\W]+$")
        & (F.length(F.regexp_replace(text, "[^A-Za-z0-9]", "")) >= 2)
        & text.rlike(r"\p{IsAlphabetic}")
        & F.length(text).between(2, 200)
    )
    return F.when(good, F.replace(text, F.lit('"'), F.lit('\\"')))


def rdf_safe(surface: Column) -> Column:
    """A name as the last part of an identifier: blanks as underscores, percent-encoded, cut at 100 characters; null if empty."""
    code = F.url_encode(F.replace(surface, F.lit(" "), F.lit("_")))
    for a, b in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        code = F.replace(code, F.lit(a), F.lit(b))
    return F.nullif(F.substring(code, 1, 100), F.lit(""))


def comma_list(value: Column) -> Column:
    """The non-empty parts of a comma-separated list, trimmed; empty for null."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def without_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def cache_key(name: Column, kind: Column) -> Column:
    return F.concat_ws("|", F.lower(name), F.lower(kind))


def header_line(level: Column, text: Column) -> Column:
    return F.concat(F.repeat(F.lit("#"), level), F.lit(" "), text)


def token_count(text: Column) -> Column:
    """The number of words and marks; the default counter where no tokenizer is given."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)(\w+|[^\w\s])"), F.lit(1)))


def parsed_date(value: Column) -> Column:
    """A timestamp from ISO date-times, ISO dates or day/month/year; null for anything else."""
    forms = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd", "dd/MM/yyyy")
    return F.coalesce(*(F.try_to_timestamp(value, F.lit(f)) for f in forms))
