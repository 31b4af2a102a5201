import re
import tracemalloc
import urllib.parse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuscle.functions import pandas_text as p
from corpuscle.functions import text as x
from corpuscle.models import leading_sentences
from corpuscle.plans import catalog


def apply(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in rows.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


def test_sanitize_entity(spark):
    cases = {
        "Global Bank": "Global Bank", "": None, "<div>hi</div>": None, "12345": None, "a": None, "A" * 300: None, 'World "Bank"': 'World \\"Bank\\"',
        "{x} y": "x y", "!!!": None, "A-1": "A-1", "ñ12": "ñ12", " UN ": "UN", None: None, "a \n b": "a b",
    }
    assert apply(spark, x.sanitize_entity, list(cases)) == list(cases.values())


def test_rdf_safe_is_percent_encoding(spark):
    values = ["Global Bank", "", "a/b~c*d", "México", "x" * 150, None, "50% & more", "日本"]
    want = [None if not v else urllib.parse.quote(v.replace(" ", "_"))[:100] for v in values]
    assert apply(spark, x.rdf_safe, values) == want


def test_sanitize_key(spark):
    values = ["México DF", "South-Africa", None, "nan", "_a b_", "Straße", "étude", "  x  "]
    assert apply(spark, x.sanitize_key, values) == ["Mexico_DF", "South_Africa", None, None, "a_b", "Strasse", "etude", "x"]


def test_clean_text_and_lists(spark):
    assert apply(spark, x.clean_text, ["é\n b\t c ", None, ""]) == ["e b c", None, ""]
    assert apply(spark, x.comma_list, ["TF50160, TF2,,", None, ""]) == [["TF50160", "TF2"], [], []]
    assert apply(spark, x.token_count, ["Hello, world!", None, "a_b c"]) == [4, 0, 2]


def test_every_document_is_cleaned(spark, tmp_path):
    rows = [(1, "é  a", "en"), (2, "ё\n中 文", "zh"), (3, "b ", None), (4, None, "und"), (5, "Ä", "EN"), (6, "كَتَبَ", "ar"), (7, "ỗ", "en-GB")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.cleaned for r in catalog.clean_text(spark, str(tmp_path)).collect()}
    assert got == {1: "e a", 2: "е 中 文", 3: "b", 4: None, 5: "A", 6: "كتب", 7: "o"}


def test_dates(spark):
    got = apply(spark, x.parsed_date, ["2017-03-04T08:08:36Z", "2016-12-06", "01/07/2017", "", None, "soon"])
    assert [g and g.isoformat() for g in got] == ["2017-03-04T08:08:36", "2016-12-06T00:00:00", "2017-07-01T00:00:00", None, None, None]


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>1</td></tr></table>", "| a | b |\n| --- | --- |\n| 1 |  |"),
        ("no table", None), (None, None), ("", None), ("<table></table>", None),
        ("<table><tr><th>x|y<td>z</table><table><tr><td>second</td></tr></table>", "| x\\|y | z |\n| --- | --- |"),
    ],
)
def test_markdown_table(body, want):
    assert p.markdown_table(body) == want


@pytest.mark.parametrize(
    ("answer", "want"),
    [
        ('{"A": "b"}', {"A": "b"}), ('Sure: {"A": "b"} done', {"A": "b"}), ("{'A': 'b',}", {"A": "b"}), ("nothing", {}), ("", {}), (None, {}), ("[1]", {}), ("{'it's': broken", {}), ('{"A": null}', {"A": None}),
    ],
)
def test_loose_json(answer, want):
    assert p.loose_json(answer) == want


def test_abbreviations():
    assert p.abbreviations("The World Health Organization (WHO) met.") == [("WHO", "World Health Organization")]
    assert p.abbreviations("Under the LSR (Loan Supervision Report) they") == [("LSR", "Loan Supervision Report")]
    assert p.abbreviations("nothing (see page 4) here") == []
    assert p.abbreviations(None) == []


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.text(max_size=200))
def test_abbreviations_never_fail(text):
    for short, long in p.abbreviations(text + " (AB) x"):
        assert len(long) > len(short)


@given(st.text("ab.!? \n", max_size=80), st.integers(-1, 40))
def test_leading_sentences_are_those_of_the_whole_text(text, most):
    kept = ""
    for sentence in re.split(r"(?<=[.!?])\s+", text.strip()):
        if kept and len(kept) + len(sentence) > most:
            break
        kept = f"{kept} {sentence}".strip()
    assert leading_sentences([text], most) == [kept[: max(most, 0)]]


def test_leading_sentences_read_no_more_than_they_keep():
    text = "Some words. " * 20_000
    tracemalloc.start()
    leading_sentences([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * len(text)
