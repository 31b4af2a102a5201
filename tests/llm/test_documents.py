import pytest

from corpuscle.llm import cut_off, markup, scanned

DOCUMENTS = "doc_id bigint, text string, source string, n_chars bigint, display_title string, form string"
SENTENCES = ["The committee met twice in the spring.", "Prices rose faster than was foreseen.", "Most of the targets were met in the end.", "Staff were trained in the use of pumps.", "Works on the canal began in May."]


def body(k):
    return " ".join(SENTENCES[(k + i) % 5] for i in range(4))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "s" if (i or 0) % 2 else None, 0, f"title {i}", "f") for i, t in rows], DOCUMENTS)


def test_cut_texts(spark):
    whole = [f"Title {k}\n\n{body(k)}\n\n{body(k + 1)}" for k in range(30)]
    whole += [f"{body(k)}\n\nAnnex {k}" for k in range(6)] + [f"{body(k)}\n\nKeywords: water; roads {k}" for k in range(6)] + [f"{body(2)}\n\n| Total | {k}.0 |" for k in range(6)] + [f"{body(k)} (see Annex 2)" for k in range(3)] + [f"{body(1)} \x00\ufffd"]
    cut = [f"Title\n\n{body(0)} The committee met twi", f"{body(1)}\n\nPrices rose", f"{body(2)} Works on the canal beg...", f"{body(3)} Most of the targets were\ufffd", f"{body(1)}\n\nStaff were trained in the use of"]
    longer = f"Unlike others.\n\n{body(3)} And then there was a very strange affair that nobody saw."
    cut.append(longer[:-25])
    rows = list(enumerate([*whole, longer, *cut, cut[0], None, "", "  \n ", "x" * 50_000 + "."]))
    frame = documents(spark, [*rows, rows[0], (None, cut[0])])
    found = {r.doc_id: r.evidence for r in cut_off.cut_documents(frame).collect()}
    first = len(whole) + 1
    assert set(found) == set(range(first, first + len(cut) + 1))
    assert found[first + 5] == "copy" and found[first + 2] in ("dots", "prefix")
    shares = {r.source: (r.n_documents, r.n_cut) for r in cut_off.shares(frame).collect()}
    assert sum(n for _, n in shares.values()) == len(cut) + 1
    assert cut_off.cut_documents(frame.limit(0)).count() == 0
    assert cut_off.cut_documents(frame.where("text is null")).count() == 0


def test_strict_prefixes_against_brute_force(spark):
    from random import Random

    random = Random(1)
    words = sorted({"".join(random.choice("ab") for _ in range(random.randint(1, 9))) for _ in range(200)})
    said = {w: random.randint(0, 1) for w in words}
    frame = spark.createDataFrame([(w, n) for w, n in said.items() for _ in range(2)], "w string, n bigint").repartition(7)
    got = {r.w for r in cut_off.strict_prefixes(frame, "w", "n").collect()}
    assert got == {w for w in words if not said[w] and any(v != w and v.startswith(w) for v in words)}
    assert cut_off.strict_prefixes(frame.limit(0), "w", "n").count() == 0


def test_ends_that_go_on_elsewhere(spark):
    """The self-join of sentences finds cut ends, also of copies; headings and captions that stand elsewhere too are whole."""
    told = "Works on the canal began in May and the contractor left in June."
    texts = [told, f"{told}\nLake maps", "Lake maps\nThey are kept.", "Lake maps and the river were made.", "They met. Works on the canal began in M", "Then it rained. Works on the canal began in M", "Dry. Works on the can..."]
    found = {r.doc_id: r.evidence for r in cut_off.cut_documents(documents(spark, list(enumerate(texts)))).collect()}
    assert found == {4: "prefix", 5: "prefix", 6: "prefix"}


@pytest.mark.parametrize(("line", "ended"), [("It rose.", True), ("It rose." + "x" * 900 + ")", False), ("It rose. (" + "x" * 900 + ")", True), ("(a) roads", False), ('He said "yes."', True), ("as follows:", True), ("", False), ("(x)", False)])
def test_line_ended(line, ended):
    assert cut_off.line_ended(line) == ended


CONTENT = "element_id bigint, doc_id bigint, pos int, type string, text string, text_level int, table_body string, page_idx int, kind string, key string"


def content(spark, rows):
    return spark.createDataFrame([(e, d, e, t, x, lv, tb, p, "k", "k") for e, d, t, x, lv, tb, p in rows], CONTENT)


def grid(*cells):
    return "<table><tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr></table>"


MARKUP = {
    grid("plain", "12.5*", "[3]", "#4", "&gt; 5 km", "a | b", "x = 1, y = 2", "{n = 3}", "A_1 / B_2", "D:\\annex\\t.xls", "$2-$12 per day", "'as said'", "12'' pipe"): [],
    grid("<b>x</b>"): ["html"], grid("&lt;i&gt;x&lt;/i&gt;"): ["html"], grid("a<br/>b", "<!-- c -->"): ["html"], "<html><body>" + grid("x") + "</body></html>": ["html"],
    grid("**bold**"): ["markdown"], grid("`code`"): ["markdown"], grid("## crop yields\n"): ["markdown"], grid("- a\n- b\n- c"): ["markdown"], grid("[t](http://x.invalid/1)"): ["markdown"],
    grid("[[a|b]]"): ["wiki"], grid("'''b'''"): ["wiki"], grid("== h =="): ["wiki"], grid("* a\n** b"): ["wiki"], grid("{{cite|t=x}}"): ["wiki"],
    grid("\\textbf{x}"): ["latex"], grid("12\\%"): ["latex"], grid("$x^{2} + 1$ ha"): ["latex"], grid("\\( a = b \\)"): ["latex"],
    "| a | b |\n|---|---|\n| 1 | 2 |": ["markdown"], '{| class="t"\n! A !! B\n|-\n| 1 || 2\n|}': ["wiki"], "\\begin{tabular}{lr}\na & b \\\\ \\hline\n1 & 2 \\\\\n\\end{tabular}": ["latex"],
    grid("<em>a", "[[b]]", "\\emph{c}", "~~d~~"): ["html", "markdown", "wiki", "latex"], "": [], grid(): [], None: [],
}


def test_markup(spark):
    bodies = list(MARKUP)
    frame = content(spark, [(i, 1, "table", None, None, b, 0) for i, b in enumerate(bodies)] + [(1, 1, "table", None, None, bodies[1], 0), (None, 1, "table", None, None, bodies[1], 0), (99, 1, "text", "t", None, bodies[1], 0)])
    got = {}
    for r in markup.residue(frame).collect():
        got.setdefault(r.element_id, []).append(r.markup)
    assert {i: sorted(k) for i, k in got.items()} == {i: sorted(k) for i, k in enumerate(MARKUP.values()) if k}
    assert markup.residue(frame.limit(0)).count() == 0
    assert markup.cleaned(frame).count() == len(bodies) - 1


@pytest.mark.parametrize("body", ["<" * 20_000, "'" * 20_000, "\n" * 20_000, "[" * 20_000, "* \n" * 5_000, "$" * 20_000, "\\" * 20_000, "|-" * 9_000, "`" * 9_999, "{{" * 9_000])
def test_markup_of_long_odd_bodies(body):
    classifier = markup.Classifier()
    classifier.kinds(body), classifier.kinds(grid(body))
    markup.clean(body, classifier)


def test_clean_text():
    c = markup.Classifier()
    assert markup.clean("<table><tr><td><b>a</b></td><td>x<br/>y</td></tr><tr><td>[[p|q]]</td><td>\\frac{a}{100}</td></tr></table>", c) == "a\tx / y\nq\ta/100"
    assert markup.clean("| a | b |\n|---|---|\n| **1** | `f(x)` |", c) == "a\tb\n1\tf(x)"
    assert markup.clean('{| class="t"\n! A !! B\n|-\n| 1 || [[2]]\n|}', c) == "A\tB\n1\t2"
    assert markup.clean("\\begin{tabular}{lr}\na & b \\\\ \\hline\n1 & 50\\% \\\\\n\\end{tabular}", c) == "a\tb\n1\t50%"
    assert markup.clean(grid("<ul><li>one</li><li>two</li></ul>", "$x^{2}$"), c) == "- one / - two\t$x^{2}$"
    assert markup.clean(None, c) == "" == markup.clean("", c)


def scans(spark):
    rows = [(100 + k, 9, "text", " ".join(SENTENCES) + " The percent of spending on records was small. The ministry agreed in 2009 and 2012.", None, None, 0) for k in range(60)]
    rows += [(200 + k, 9, "text", "The river basin programme has seen climate-resilient and labour-intensive works.", None, None, 0) for k in range(30)]
    title = "River Basin Programme: Annual Report"
    damaged = [
        (1, "The com-\nmittee met twice.", 0, None, {"broken_word"}), (2, "The cornmittee met.", 0, None, {"wrong_char"}), (3, "It rose in 2O09.", 0, None, {"wrong_char"}), (4, title, 3, None, {"running_line"}), (5, title.upper() + " ... page 3", 3, None, {"running_line", "page_number"}),
        (6, "— 4 —", 3, None, {"page_number"}), (7, title, 0, 1, set()), (8, "The climate-\nresilient works.", 0, None, set()), (9, "Levels of CO2 and 4WD and B2B.", 0, None, set()), (10, "Page 4 of the report lists them.", 3, None, set()),
        (11, "Works on the canal be-\n" + title + "\ngan in May, and the ministry\nagreed.", 0, None, {"broken_word", "running_line"}), (12, "S†aff were trained.", 0, None, {"wrong_char"}), (13, "", 0, None, set()), (14, None, 0, None, set()), (15, "viii", 0, None, {"page_number"}), (16, "The rninistry agreed.", 0, 2, {"wrong_char"}),
        (17, "x" * 30_000 + " " + "," * 20_000, 0, None, set()), (18, "The river basin\nRiver 8asin Programme: Annual Report\nprogramme.", 0, None, {"running_line", "wrong_char"}),
    ]
    rows += [(e, 1, "text", x, lv, None, p) for e, x, p, lv, _ in damaged]
    documents_ = spark.createDataFrame([(1, title), (9, None), (None, "x")], "doc_id bigint, display_title string")
    return content(spark, [*rows, rows[-1], (None, 1, "text", "Page 1", None, None, 0)]), documents_, {(e, k) for e, *_, kinds in damaged for k in kinds}


def test_scanned(spark):
    frame, titles, want = scans(spark)
    got = {(r.element_id, r.kind) for r in scanned.damaged(frame, titles).collect()}
    assert got == want
    assert scanned.damaged(frame.limit(0), titles).count() == 0
    assert {k for _, k in {(r.element_id, r.kind) for r in scanned.damaged(frame, titles.limit(0)).collect()}} == {"broken_word", "wrong_char", "page_number"}


def test_paragraphs(spark):
    frame, titles, _ = scans(spark)
    got = {}
    for r in scanned.paragraphs(frame, titles).orderBy("element_id", "paragraph").collect():
        got.setdefault(r.element_id, []).append(r.text)
    assert got[1] == ["The committee met twice."] and got[2] == ["The committee met."] and got[3] == ["It rose in 2009."]
    assert 4 not in got and 6 not in got and got[7] and got[8] == ["The climate- resilient works."]
    assert got[12] == ["Staff were trained."]


def test_paragraphs_lose_nothing_but_numbers_and_titles(spark):
    """Headings, captions and capitals within a text stay; letters and digits in are those out, but for what is confirmed."""
    title = "River Basin Programme: Annual Report"
    kept = ["Annex 1: Bus corridors", "Table 6. Ridership by district", "Minister of Finance\nJohn Carter", "Total Project Cost 45", "Lake Province", "The loan was to be closed in the fourth year, but in\nAugust 2023. Moreover, Participating Banks and the\nministry of works agreed that it should go on for two\nmore.", "A" * 900, "Rural Roads Project " * 20]
    gone = [title, "3 | " + title, "4", f"Works on the canal and its banks went on until\n{title}\nthe autumn came and the last of them left."]
    rows = [(k, 1, "text", x, None, None, 3) for k, x in enumerate(kept + gone)]
    documents_ = spark.createDataFrame([(1, title)], "doc_id bigint, display_title string")
    got = {}
    for r in scanned.paragraphs(content(spark, rows), documents_).orderBy("element_id", "paragraph").collect():
        got.setdefault(r.element_id, []).append(r.text)
    letters = lambda text: [c for c in text if c.isalnum()]
    for k, x in enumerate(kept):
        assert letters("".join(got[k])) == letters(x)
    assert set(got) == set(range(len(kept))) | {len(rows) - 1} and got[len(rows) - 1] == ["Works on the canal and its banks went on until the autumn came and the last of them left."]
    assert got[2] == ["Minister of Finance", "John Carter"] and len(got[5]) == 1


def test_labelled_lines_are_learnt():
    """The model gives its own labelled table back, with pages and titles as features."""
    elements, own = [], []
    for line in scanned.LABELLED.strip("\n").split("\n"):
        if line[0] == ";":
            elements.append((own, int(line[1:])))
            own = []
        else:
            own.append((line[0], line[2:]))
    titles = frozenset(map(scanned.title_key, scanned.TITLES))
    same = [a == {"header": "h", "body": "b", "break": "k"}[b] for rows, page in elements for (a, _), b in zip(rows, scanned.labels([t for _, t in rows], page, titles), strict=True)]
    assert sum(same) >= 0.9 * len(same)
    assert scanned.labels(["45"], 44) == ("header",) and scanned.labels(["45"], 3, titles) == ("break",)


def test_model_keeps_paragraphs_apart():
    lines = ["One paragraph ends here.", "", "Another begins and goes on for a while, as most of", "them do.", "Page 7"]
    assert scanned.labels(lines, 6)[1:] == ("break", "body", "break", "header")
    assert scanned.labels([], 0) == ()


def test_trees_ask_for_words_and_links_of_real_sequences():
    """Links are known by their density only, labelled blocks stand among their neighbours, and the trees give their table back."""
    asked = {kind: markup.used(tree) for kind, tree in markup.trees().items()}
    assert "links_markdown" in asked["markdown"] and "links_wiki" in asked["wiki"]
    assert not any("link" in mark or "url" in mark for mark in markup.MARKS)
    kinds = markup.Classifier()
    for table in markup.LABELLED.strip("\n").split("\n\n"):
        blocks = [line.split("|", 1) for line in table.split("\n")]
        for (kind, _), row in zip(blocks, markup.describe([text.replace("¶", "\n") for _, text in blocks]), strict=True):
            assert kinds.decided(row) == ((kind,) if kind != "none" else ())
    for kind, link in (("wiki", "[[link]]"), ("markdown", "[a](b)"), ("html", '<a href="x">y</a>')):
        assert kinds.kinds("word " * 4_000 + link + " word" * 4_000) == [kind]
