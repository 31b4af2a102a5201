from random import Random

import pytest

from corpuscle.llm import names, vocabulary

ENTITY = "entity_id bigint, doc_id bigint, surface string, label string, id string, qid string, n bigint, salt int"


def entities(spark, rows):
    return spark.createDataFrame([(i, 1, s, label, None, None, 1, 0) for i, (s, label) in rows], ENTITY)


def plain_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def test_metric_and_tree():
    random = Random(8)
    word = lambda: "".join(random.choice("abcd") for _ in range(random.randrange(9)))
    words = [word() for _ in range(150)]
    tree = vocabulary.BKTree(iter(words))
    for _ in range(60):
        asked, radius = word(), random.randrange(5)
        want = sorted({(plain_levenshtein(asked, w), w) for w in words if plain_levenshtein(asked, w) <= radius})
        assert sorted(tree.within(asked, radius)) == want
    for _ in range(500):
        a, b, c = word(), word(), word()
        d = vocabulary.damerau
        assert d(a, b) <= plain_levenshtein(a, b) <= 2 * d(a, b) and d(a, c) <= d(a, b) + d(b, c) and d(a, b) == d(b, a)
    assert vocabulary.BKTree(iter([])).within("a", 3) == []


def test_lattices_find_what_all_readings_do(monkeypatch):
    """A value of very many readings has none dropped: the lattice gives what listing all of them gives."""
    random = Random(5)
    words = ["".join(random.choice("abc") for _ in range(random.randint(3, 7))) for _ in range(110)]
    entries = [(" ".join(random.sample(words, random.randint(1, 4))), f"id{k}") for k in range(80)]
    values = []
    for _ in range(60):
        said = [w[: random.randint(3, len(w))] if random.random() < 0.7 else w for w in random.choice(entries)[0].split()]
        text = list(" ".join(said))
        if random.random() < 0.5:
            text[random.randrange(len(text))] = random.choice("abc ")
        values.append("".join(text))
    found = {}
    for readings in (0, 3, 10**9):
        monkeypatch.setattr(vocabulary, "READINGS", readings)
        matcher = vocabulary.Matcher(entries)
        found[readings] = [matcher.match(v) for v in values]
        assert readings != 3 or any(matcher.readings(v)[1] for v in values)
    assert found[0] == found[3] == found[10**9] and sum(x is not None for x in found[0]) > 30


def test_a_shard_spells_words_of_the_whole_list():
    """A short form means a word of the list, in whichever shard it is."""
    one, other = [("museum inspection", "a")], [("museum insurance", "b")]
    words = sorted(vocabulary.words_of(p for p, _ in one + other))
    whole = vocabulary.Matcher(one + other)
    for value in ("museum ins.", "museum insur.", "museum insp", "musuem inspection", "mus. inspect."):
        parts = [m for m in (vocabulary.Matcher(x, words=words).match(value) for x in (one, other)) if m]
        assert min(parts, default=None) == whole.match(value)


LIST = ["air pollution", "public debt", "water standards", "teacher training", "rule of law", "insurance", "museum insurance", "museum inspection"]
MEANT = {
    "Air  Pollution": 0, "air polution": 0, "ari pollution": 0, "pollution, air": 0, "pollution (air)": 0, "pollution of air": 0, "pollution - air": 0, "air / pollution": 0, "topic: air pollution": 0, "#air pollution": 0, "air pollution etc.": 0, "air pollution - misc.": 0,
    "airpollution": 0, "air-pollution": 0, "the public debt.": 1, "PUBLIC DEBT": 1, "púb\u00a0debt": 1, "water stds": 2, "teach. training": 3, "teacher trng": 3, "rule of law": 4, "law, rule of": 4, "museum ins.": 6, "publik debd": 1,
    "air transport": None, "perfume portraits": None, "": None, " ": None, None: None, "." * 5000 + "x": None, "air pollution " * 500: None,
}


@pytest.mark.parametrize("shard", [3, 1000])
def test_mapping(spark, shard):
    listed = spark.createDataFrame([(f"id{i}", "T", p) for i, p in enumerate(LIST)], "id string, label string, pattern string")
    rows = [(i, (s, "UNBIS_TERM")) for i, s in enumerate(MEANT)]
    frame = entities(spark, [*rows, *rows[:4], (900, ("air pollution", "ORG")), (None, ("air pollution", "UNBIS_TERM"))])
    got = {r.entity_id: r.id for r in vocabulary.mapped(frame, listed, shard=shard).collect()}
    assert got == {i: "unmatched" if v is None else f"id{v}" for i, v in enumerate(MEANT.values())}
    assert {r.id for r in vocabulary.found(frame, listed.limit(0)).collect()} == {"unmatched"}
    assert vocabulary.found(frame.limit(0), listed).count() == 0


GROUPS = [
    ("PERSON", [("Kirsten Darovanav", 18), ("Kirsten Daroavnav", 2), ("Kirsten J. Draovanav", 6), ("DAROVANAV Kirsten", 3), ("Darovanav, K.J.", 2), ("Kirsty Darovanav", 2), ("Dr. Kirsten Darovanav", 2), ("Kirsten Darovánav (TTL)", 1), ("K J Darovanav", 2)]),
    ("PERSON", [("Leonard Darovanav", 15), ("Lenny Darovanav", 2), ("Darovanav L.", 2), ("Leonard  Darovanav", 3)]),
    ("PERSON", [("Olivia Mabatarad", 9), ("Liv Mabatarad", 2)]),
    ("PERSON", [("Oliver Mabatarad", 9), ("Ollie Mabatarad", 2)][:1]),
    ("ORG", [("Vatamital Water and Sanitation Authority", 30), ("Vatamital Wtr & San. Auth.", 5), ("Vatamital WSA", 3), ("Vatamital-WSA", 1), ("WSA (Vatamital)", 2), ("Vatamital Authority for Water and Sanitation", 2), ("The Vatamital Water and Sanitation Authority", 1), ("VATAMITAL WATER AND SANITATION AUTHORITY", 4), ("Vatamitl Water and Sanitaton Authority", 2)]),
    ("ORG", [("Vatamital Forestry Department", 20), ("Forestry Dept. of Vatamital", 2), ("Vatamital FD", 2)]),
    ("ORG", [("Kidisefek Forestry Department", 20), ("Kidisefek, Forestry Department", 2)]),
]


def test_variants(spark):
    rows = [(s, label) for label, group in GROUPS for s, n in group for _ in range(n)]
    # given names that many bear are no typing errors of each other
    rows += [(f"{g} {s}", "PERSON") for g in ("Olivia", "Oliver", "Kirsten", "Leonard") for s in ("Gobamorom", "Tuvelirak", "Sanidopet", "Kelzumira", "Wandofish", "Pirrelton") for _ in range(5)]
    rows += [(None, "ORG"), ("", "PERSON"), (" ", "ORG"), ("!!!", "PERSON"), ("x" * 5000, "PERSON"), ("Kirsten Darovanav", "GPE"), ("A", "PERSON")]
    frame = entities(spark, list(enumerate(rows)))
    got = {(r.label, r.surface_a, r.surface_b) for r in names.linked(frame).collect()}
    want = {(label, *sorted((a, b))) for label, group in GROUPS for a, _ in group for b, _ in group if a < b}
    assert got == want
    assert names.linked(frame.limit(0)).count() == 0
    assert names.linked(frame.where("label = 'GPE'")).count() == 0


def mistyped(random, word, n):
    for _ in range(n):
        k = random.randrange(len(word))
        word = random.choice([word[:k] + word[k + 1 :], word[:k] + word[k + 1 : k + 2] + word[k : k + 1] + word[k + 2 :], word[:k] + word[k] + word[k:], word[:k] + random.choice(names.NEAR.get(word[k], "x") or "x") + word[k + 1 :]])
    return word


@pytest.mark.parametrize("size", [3, 4, 5, 6, 12, 22, 23, 24, 25, 26, 28, 64, 70, 200])
def test_keys_miss_no_error(size):
    """Words of any length within the errors that ``errors`` accepts share a key."""
    random = Random(size)
    for _ in range(300):
        word = "".join(random.choice("abcdefgh") for _ in range(size))
        written = mistyped(random, word, random.randint(0, 2))
        for loose in (False, True):
            if names.errors(written, word, loose) is not None:
                assert names.asks(written) & names.holds(word)
                assert names.asks(word) & names.holds(written)
    one, other = "internationalisierungsgesell", "intrnationalisierungsgesel"
    assert names.errors(other, one) is not None and names.asks(other) & names.holds(one)


def test_crowd_keys_miss_no_candidate():
    random = Random(3)
    stock = ["water", "forestry", "rural", "roads", "mining", "of", "transport", "bank", "zoo", "internationalisierungsgesell"]
    given = ["robert", "bob", "al", "elizabeth", "beth", "oliver", "ann"]
    checked = 0
    for _ in range(20_000):
        full = sorted(random.sample(stock, random.randint(0, 4)))
        words = sorted(mistyped(random, w, random.choice([0, 0, 0, 1, 2])) or "x" for w in full)
        words = [w[: random.randint(1, 4)] + "." if random.random() < 0.15 else w for w in words]
        if len(full) > 1 and random.random() < 0.1:
            words = ["".join(w[0] for w in full)]
        if names.cost_of_words(words, full) is not None:
            checked += 1
            assert names.crowd_keys("ORG", "", "", tuple(words), False) & names.crowd_keys("ORG", "", "", tuple(full), True)
        name, letters = random.choice(given), random.choice(["", "r", "b", "ra"])
        written = random.choice(["", mistyped(random, random.choice(given), random.randint(0, 2)), random.choice(given)])
        if names.cost_of_given(written, letters, 1, name, "", 100) is not None:
            checked += 1
            assert names.crowd_keys("PERSON", written, letters, (), False) & names.crowd_keys("PERSON", name, "", (), True)
    assert checked > 10_000


def test_a_crowded_anchor_is_split_without_loss(spark, data, monkeypatch):
    """Keys for crowds and blocks of a class change no result."""
    frame = spark.read.parquet(f"{data}/entities.parquet")
    want = {tuple(r) for r in names.linked(frame).collect()}
    monkeypatch.setattr(names, "CROWD", 0)
    assert {tuple(r) for r in names.linked(frame, 2).collect()} == want and len(want) > 20


def test_ties_go_to_the_first_form(spark):
    scored = spark.createDataFrame([("f", "b", 1.5), ("f", "a", 1.5), ("f", "c", 1.0), ("g", "z", -2.0)], "form string, to string, posterior double")
    assert {tuple(r) for r in names.best(scored).collect()} == {("f", "a"), ("g", "z")}


@pytest.mark.parametrize(
    ("surface", "want"),
    [
        ("Kirsten J. Darovanav", ("darovanav", "kirsten", "j")), ("Darovanav, K.J.", ("darovanav", "", "kj")), ("DAROVANAV Kirsten", ("darovanav", "kirsten", "")), ("KIRSTEN DAROVANAV", ("darovanav", "kirsten", "")), ("Darovanav K.", ("darovanav", "", "k")),
        ("Ms H. Verotamal", ("verotamal", "", "h")), ("Isabella Ramotosex (TTL)", ("ramotosex", "isabella", "")), ("L E Losesasak", ("losesasak", "", "le")), ("", None), ("!!", None), ("A. B.", None),
    ],
)
def test_read_person(surface, want):
    assert names.read_person(surface) == want
