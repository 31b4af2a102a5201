from random import Random

import pytest

from corpuscle.llm import pieces

SCHEMA = "element_id bigint, doc_id bigint, pos int, type string, text string, text_level int, table_body string, section string, size int"


def rows(spark, elements):
    return spark.createDataFrame([(i, d, p, t, x, lv, None, "s", 0) for i, (d, p, t, x, lv) in enumerate(elements)], SCHEMA)


@pytest.mark.parametrize("seed", range(8))
def test_cut_covers_the_text_within_the_limit(seed):
    random = Random(seed)
    text = "".join(random.choice(["word ", "long" * 30, ". ", "\n", "\n\n", "; ", "中文。", "x" * 300, ", "]) for _ in range(80))
    found = pieces.cut(text, 200, 20)
    assert found[0][0] == 0 and found[-1][1] == len(text)
    assert all(a[1] == b[0] for a, b in zip(found, found[1:], strict=False))
    assert all(0 < b - a <= 180 for a, b in found)
    assert all(sum(b - a for a, b in pair) > 180 for pair in zip(found, found[1:], strict=False))


def test_cuts_at_natural_boundaries():
    text = " ".join(f"Sentence number {i} is here." for i in range(100))
    assert all(text[:b].rstrip().endswith(".") for _, b in pieces.cut(text, 300, 30))
    assert pieces.cut("") == [] and pieces.cut("a") == [(0, 1)]


def brute(elements):
    out, sizes = {}, {}
    for d in {e[0] for e in elements if e[0] is not None and e[1] is not None}:
        section = None
        for _, p, t, x, lv in sorted({e for e in elements if e[0] == d and e[1] is not None}, key=lambda e: e[1]):
            if section is None or (t == "text" and lv is not None):
                section = p
            if t == "text":
                sizes[d, section] = sizes.get((d, section), 0) + len(x or "")
    return {k for k, n in sizes.items() if n > 4000}


@pytest.mark.parametrize("stretch", [1, 3, 512])
def test_sections_against_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(pieces, "STRETCH", stretch)
    random = Random(9)
    elements = []
    for d in range(6):
        for p in range(40):
            kind = random.choice(["text"] * 6 + ["table", "image"])
            elements.append((d, p + (5 if d == 2 else 0), kind, random.choice([None, "", "é" * 700, "word. " * 200, "x" * 5000 if random.random() < 0.1 else "y"]), random.choice([None, None, None, 1, 2]) if kind == "text" else None))
    elements += elements[:20] + [(None, 1, "text", "x" * 9000, None), (1, None, "text", "x" * 9000, None)]
    content = rows(spark, elements)
    assert {(r.doc_id, r.pos) for r in pieces.oversized(content).collect()} == brute(elements)
    made = pieces.pieces(content, block=7).collect()
    assert max(len(r.text) for r in made) <= 1000
    texts = section_texts(elements)
    by = {}
    for r in sorted(made, key=lambda r: (r.doc_id, r.pos, r.piece)):
        by.setdefault((r.doc_id, r.pos), []).append(r)
    for key, own in by.items():
        assert [r.piece for r in own] == list(range(len(own)))
        ends = [r.start for r in own[1:]] + [len(texts[key])]
        for r, end in zip(own, ends, strict=True):
            # a block's last piece leaves out the line end after it
            assert r.text.endswith(texts[key][r.start : end].removesuffix("\n")) or r.text.endswith(texts[key][r.start : end])
        for r, s in zip(own, own[1:], strict=False):
            if len(r.text) >= 100:
                assert next(k for k in range(101, -1, -1) if s.text.startswith(r.text[len(r.text) - k :] if k else "")) >= 1


def section_texts(elements):
    out = {}
    for d, p, t, x, lv in sorted({e for e in elements if e[0] is not None and e[1] is not None}, key=lambda e: e[:2]):
        if (d, "at") not in out or (t == "text" and lv is not None):
            out[d, "at"] = p
        if t == "text" and x:
            key = d, out[d, "at"]
            out[key] = f"{out[key]}\n{x}" if key in out else x
    return out


def test_a_section_is_cut_where_its_boundaries_are(spark):
    """A section across positions 500 to 530 is cut as one of the same elements at the start, and one of very many elements is whole too."""
    parts = [f"Sentence {i} of this section is here, and it goes on." * 6 for i in range(30)]
    made = pieces.pieces(rows(spark, [(d, at + i, "text", x, 1 if i == 0 else None) for d, at in ((1, 0), (2, 500)) for i, x in enumerate(parts)])).collect()
    by = {d: [(r.piece, r.start, r.text) for r in sorted(made, key=lambda r: r.piece) if r.doc_id == d] for d in (1, 2)}
    assert by[1] == by[2] and len(by[1]) > 3
    long = pieces.pieces(rows(spark, [(1, i, "text", f"Words of element {i}.", None) for i in range(3_000)])).collect()
    assert sorted(r.piece for r in long) == list(range(len(long))) and {r.pos for r in long} == {0}


def test_a_limit_is_no_case(spark):
    assert pieces.oversized(rows(spark, [(1, 0, "text", "x" * 4000, None)])).count() == 0
    assert pieces.oversized(rows(spark, [(1, 0, "text", "x" * 4000, None), (1, 1, "text", "y", None)])).count() == 1
    assert pieces.oversized(rows(spark, [])).count() == 0
