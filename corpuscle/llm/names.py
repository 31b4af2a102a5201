"""Problem 3: variant spellings of persons and organisations, by noisy-channel attribution.

Every distinct spelling is read into a *form*: an anchor (a surname, or the rarest proper word of an organisation) and the
rest (given name and initials, or the other words). Frequent complete forms are the candidate canonical ones. A form is
attributed to the candidate of highest posterior: the logarithm of the candidate's frequency less the cost of the channel,
that is of typing errors in the anchor and in the other words, of nicknames, initials, abbreviations and acronyms. A form
that no better candidate explains stands for itself; following the attributions to their ends gives the classes.

Candidates come from equal keys only: anchors within two errors share a string with up to two characters left out, or,
where they are long, one of five pieces at nearly the same place. Keys are made of distinct anchors, not of rows, so that
a name of very many rows has one; no bucket is capped. Where an anchor has more than ``CROWD`` candidates, as a common
surname has, forms meet only those of them that agree in a key of the other words too: a given name with characters left
out, its nicknames, its initial, the initials of an organisation's words. These keys miss no candidate that the channel
allows, so the result is the same with them and without.

Defined results: other labels are left out; identical repeated rows don't matter, as spellings are counted; null, empty
and blank surfaces name nobody; ties in the posterior go to the first form by code point.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpuscle.llm.common import spread
from corpuscle.session import cut_lineage

LABELS, EDITS = ("PERSON", "ORG"), 2
#: How many times as many anchors a given name must have, for a rarer one to be a typing error of it.
TYPO_RATIO = 6
#: Costs of the channel in nats: an error, a nickname, an initial, a word cut short, an acronym.
ERROR, NICKNAME, INITIAL, SHORT, ACRONYM = 4.0, 1.0, 1.5, 0.7, 1.5
#: The cost, in nats, of a further name beside the known ones, which a complete form pays to stand for itself.
BIRTH = 9.0
#: Anchors of more candidates than this are split by keys of the other words; classes of more spellings by blocks.
CROWD, BLOCK = 256, 256
#: Words of so many letters have a piece as key in place of what is left of them.
LONG, PIECES = 25, 5
#: An anchor of more than two spellings is no mistyped one, unless the other has so many times as many.
OFTENER = 4

#: Honorifics and remarks that are no part of a name, and words that an acronym leaves out.
TITLES = frozenset("mr mrs ms miss dr prof professor sir dame mme mlle herr frau sr sra ing eng hon rev ttl jr phd".split())
SMALL = frozenset("of and for the a an in on de la le du des et & y".split())
#: Words for kinds of organisations, which are no anchors.
KINDS = frozenset(
    "academy administration affairs agency agricultural association authority aviation bank board bureau center centre civil college commission committee "
    "company consortium consumer cooperative corporation council court credit department development directorate disaster distribution division education "
    "energy environmental exploration export facility federation finance forestry foundation fund geological group health housing institute institution "
    "insurance international irrigation judicial laboratory land maintenance management microfinance mineral ministry municipal national office organization "
    "panel partnership power programme protection public regional registry regulatory road rural sanitation school secretariat service services social "
    "society statistics survey technology telecommunications training transport tribunal trust union unit university veterinary water".split()
)
#: Nicknames of English given names.
NICKNAMES = """abby abigail; abbie abigail; gail abigail; al albert alan alexander; alex alexander alexandra; sandy alexander alexandra; sasha alexander alexandra; xander alexander; tony anthony
barb barbara; barbie barbara; babs barbara; ben benjamin; benny benjamin; benji benjamin; bernie bernard; bern bernard; cathy catherine; cate catherine; kate catherine; katie catherine; kitty catherine
charlie charles; chuck charles; chas charles; chris christopher christine; kit christopher; topher christopher; dan daniel; danny daniel; deb deborah; debbie deborah; debby deborah; doug douglas; ed edward; eddie edward; ned edward; ted edward theodore; teddy theodore edward
nell eleanor; nellie eleanor; ellie eleanor; nora eleanor; ella eleanor; lenore eleanor; liz elizabeth; beth elizabeth; betty elizabeth; eliza elizabeth; lizzie elizabeth; bess elizabeth; libby elizabeth; flo florence; florrie florence; flossie florence; fran frances; fanny frances; frankie frances; fred frederick; freddie frederick; freddy frederick; rick frederick richard
gabby gabrielle; gaby gabrielle; gabi gabrielle; elle gabrielle; geoff geoffrey; jeff geoffrey; greg gregory; hal harold henry; harry harold henry; hattie harriet; hank henry; immy imogen; immie imogen; ike isaac; zac isaac; izzy isabella; bella isabella; isa isabella; belle isabella; jen jennifer; jenny jennifer; jenn jennifer; jon jonathan; jonny jonathan; nathan jonathan nathaniel; johnny jonathan; joe joseph; joey joseph; jo joseph
ken kenneth; kenny kenneth; kim kimberly; kimmy kimberly; kirsty kirsten; kirstie kirsten; larry lawrence; lars lawrence; laurie lawrence; len leonard; lenny leonard; leo leonard; lily lillian; lil lillian; lilly lillian; meg margaret; maggie margaret; peggy margaret; peg margaret; madge margaret; rita margaret; matt matthew; matty matthew; mike michael; mick michael; mickey michael; nat nathaniel natalie; nate nathaniel; nick nicholas; nicky nicholas; nico nicholas
ollie oliver olivia; olly oliver olivia; liv olivia; livvy olivia; livia olivia; oz oswald; ozzie oswald; ozzy oswald; pat patricia patrick; patty patricia; tricia patricia; trish patricia; pete peter; phil philip; pip philip; becky rebecca; becca rebecca; rich richard; dick richard; richie richard; ricky richard; rob robert; bob robert; bobby robert; robbie robert; bert robert albert; sam samuel samantha; sammy samuel; steph stephanie; stevie stephanie; steffi stephanie; sue susan; susie susan; suzy susan
theo theodore; tom thomas; tommy thomas; tim timothy; timmy timothy; val valerie; vicky victoria; vicki victoria; tori victoria; vince vincent; vin vincent; vinny vincent; walt walter; wally walter; will william; bill william; billy william; willie william; liam william; winnie winifred; win winifred; freda winifred; fredi winifred"""
FULL_NAMES = {line.split()[0]: frozenset(line.split()[1:]) for line in re.split(r"[;\n]\s*", NICKNAMES)}


def folded(text: str) -> str:
    apart = unicodedata.normalize("NFKD", text)
    return "".join(c for c in apart if not unicodedata.combining(c))


def read_person(surface: str) -> tuple[str, str, str] | None:
    """(surname, given name or "", initials of the given names that stand for themselves)."""
    text = re.sub(r"\([^)]*\)", " ", folded(surface))
    text = " ".join(text.replace("'", "").split())
    comma = text.split(",", 1) if "," in text else None
    words = re.findall(r"[^\W_]+(?:-[^\W_]+)*\.?", text)
    words = [w for w in words if w.strip(".").lower() not in TITLES or (len(words) <= 2 and comma)]
    if not words:
        return None
    initial = lambda w: len(w.strip(".")) == 1
    long = [w for w in words if not initial(w)]
    if not long:
        return None
    if comma and (head := re.findall(r"[^\W_]+(?:-[^\W_]+)*", comma[0])):
        last = [w for w in head if len(w) > 1 and w.lower() not in TITLES] or head
        surname, rest = " ".join(last), words[len(head) :] if words[: len(head)] == head else [w for w in words if w not in head]
    elif len(words) > 1 and words[0].isupper() and len(words[0]) > 2 and any(not w.isupper() for w in words[1:] if not initial(w)):
        surname, rest = words[0], words[1:]
    elif len(words) > 1 and initial(words[-1]) and not initial(words[0]):
        surname, rest = (long[-1] if len(long) > 1 else words[0]), [w for w in words if w != (long[-1] if len(long) > 1 else words[0])]
    else:
        surname, rest = long[-1], list(words)
        del rest[len(rest) - 1 - rest[::-1].index(long[-1])]
    given = [w.strip(".").lower() for w in rest if not initial(w)]
    letters = "".join(w.strip(".").lower() for w in rest if initial(w))
    return surname.lower(), given[0] if given else "", letters


def read_organisation(surface: str) -> list[str]:
    """The words of a name in lower case, without small ones; a dot stays on words that were cut short."""
    text = folded(surface).replace("’", "'").replace("'", "")
    words = [w.lower() for w in re.findall(r"[^\W_]+\.?|&", text)]
    kept = [w for w in words if w.strip(".") not in SMALL]
    while kept and kept[-1].endswith(".") and len(kept[-1].strip(".")) > 8:
        kept[-1] = kept[-1].strip(".")
    return kept


@lru_cache(100_000)
def may_anchor(word: str) -> bool:
    """Whether a word looks like a proper word in full: no kind (mistyped or cut short either), no abbreviation, no acronym."""
    if word.endswith(".") or word in KINDS:
        return False
    if not word.isascii():
        return True
    if len(word) < 5 or sum(c in "aeiou" for c in word) < 2:
        return False
    return not any(kind.startswith(word) or (len(kind) > 5 and errors(word, kind)) for kind in KINDS)


def shortened(word: str, edits: int = EDITS) -> set[str]:
    """``word`` with up to ``edits`` characters left out; words of less than five letters lose one, of less than three none."""
    most = min(edits, 2 if len(word) >= 5 else 1 if len(word) >= 3 else 0)
    return {"".join(c for i, c in enumerate(word) if i not in left) for n in range(most + 1) for left in map(set, combinations(range(len(word)), n))}


def _pieces(length: int) -> list[tuple[int, int]]:
    return [(k * length // PIECES, (k + 1) * length // PIECES) for k in range(PIECES)]


def asks(word: str, edits: int = EDITS) -> set[str]:
    """Keys of a word as it is written: it shares one with ``holds`` of every word within ``edits`` errors, of two at most.

    Of a long word's pieces, two errors, either of which may be an exchange across a seam, leave one whole, and move it by
    two places at most.
    """
    out = shortened(word, edits) if len(word) < LONG else set()
    for length in range(max(len(word) - edits, LONG - EDITS), len(word) + edits + 1):
        for k, (a, b) in enumerate(_pieces(length)):
            out |= {f"{length}.{k}.{word[a + by : b + by]}" for by in range(-edits, edits + 1) if a + by >= 0}
    return out


def holds(word: str, edits: int = EDITS) -> set[str]:
    """Keys of a word as it is meant."""
    out = shortened(word, edits) if len(word) < LONG else set()
    if len(word) >= LONG - EDITS:
        out |= {f"{len(word)}.{k}.{word[a:b]}" for k, (a, b) in enumerate(_pieces(len(word)))}
    return out


#: The rows of a keyboard.
KEYBOARD = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
EXTRA, OTHER = 1.5, 2.5


def neighbours() -> dict[str, str]:
    """The keys beside each key, from the rows of a keyboard, each half a key to the right of the one above."""
    near: dict[str, str] = {}
    for k, row in enumerate(KEYBOARD):
        for i, c in enumerate(row):
            above = KEYBOARD[k - 1][i : i + 2] if k else ""
            below = KEYBOARD[k + 1][max(0, i - 1) : i + 1] if k + 1 < len(KEYBOARD) else ""
            near[c] = row[max(0, i - 1) : i] + row[i + 1 : i + 2] + above + below
    return near


NEAR = neighbours()


def slips(written: str, meant: str) -> float:
    """The cost, in errors, of typing ``meant`` as ``written``.

    Leaving a letter out, doubling one, exchanging two and hitting the key beside cost one error each; another letter too
    many costs ``EXTRA`` and another key ``OTHER``.
    """
    n, m = len(written), len(meant)
    rows = [[0.0] * (m + 1) for _ in range(n + 1)]
    for j in range(1, m + 1):
        rows[0][j] = j
    for i in range(1, n + 1):
        a, before = written[i - 1], written[i - 2] if i > 1 else ""
        rows[i][0] = rows[i - 1][0] + EXTRA
        for j in range(1, m + 1):
            b = meant[j - 1]
            best = rows[i - 1][j - 1] + (0 if a == b else 1 if b in NEAR.get(a, "") else OTHER)
            best = min(best, rows[i][j - 1] + 1, rows[i - 1][j] + (1 if a == before else EXTRA))
            if i > 1 and j > 1 and a == meant[j - 2] and before == b and a != b:
                best = min(best, rows[i - 2][j - 2] + 1)
            rows[i][j] = best
    return rows[n][m]


def errors(written: str, meant: str, loose: bool = False) -> float | None:
    """The typing errors between two words, if plausible for their length; ``loose`` where the words around agree."""
    if written == meant:
        return 0.0
    if abs(len(written) - len(meant)) > EDITS or min(len(written), len(meant)) < 3:
        return None
    short = min(len(written), len(meant))
    most = EDITS + 0.5 if short >= (5 if loose else 6) else 1
    found = slips(written, meant)
    return found if found <= most else None


def cost_of_given(given: str, letters: str, n_given: int, full: str, full_letters: str, n_full: int) -> float | None:
    """The cost of writing a person's given names as ``given`` and ``letters``; None if it can't be."""
    if given:
        if given == full:
            cost = 0.0
        elif full in FULL_NAMES.get(given, ()) or given in FULL_NAMES.get(full, ()):
            cost = NICKNAME
        elif (d := errors(given, full)) and n_given * TYPO_RATIO <= n_full:
            cost = ERROR * d
        else:
            near = [d for nick, names in FULL_NAMES.items() if full in names and (d := errors(given, nick)) and n_given * TYPO_RATIO <= n_full]
            if not near:
                return None
            cost = NICKNAME + ERROR * min(near)
        middle = letters
    elif letters:
        if letters[0] != full[:1]:
            return None
        cost, middle = INITIAL, letters[1:]
    else:
        return None
    if middle and full_letters:
        return cost if middle[0] in full_letters else cost + 2 * ERROR
    return cost


def cost_of_words(words: list[str], full: list[str]) -> float | None:
    """The cost of writing the words of an organisation other than its anchor as ``words``."""
    if sorted(words) == sorted(full):
        return 0.0
    if len(words) == 1 and len(full) > 1 and len(words[0].strip(".")) == len(full):
        return ACRONYM if sorted(words[0].strip(".")) == sorted(w[0] for w in full) else None
    if len(words) != len(full):
        return None
    left, cost, edits = list(full), 0.0, 0.0
    for word in sorted(words, key=lambda w: (w not in full, -len(w))):
        if word in left:
            left.remove(word)
            continue
        bare = word.strip(".")
        fits = [w for w in left if len(bare) < len(w) and bare[:1] == w[0] and _in_order(bare, w) and (word.endswith(".") or len(bare) <= len(w) - 2)]
        if fits:
            left.remove(min(fits, key=lambda w: (not w.startswith(bare), len(w))))
            cost += SHORT
            continue
        near = [(d, w) for w in left if (d := errors(bare, w, loose=True))]
        if not near:
            return None
        d, w = min(near)
        left.remove(w)
        edits += d
    return cost + ERROR * edits if edits <= EDITS + 0.5 else None


def _stems(word: str, meant: bool) -> set[str]:
    """What an error at the beginning of a word leaves of it, as keys that allow one more error."""
    return {key for at in range(3) for key in (holds if meant else asks)(word[at:], 1)}


@lru_cache(50_000)
def crowd_keys(label: str, given: str, letters: str, words: tuple[str, ...], meant: bool) -> frozenset[str]:
    """Keys of the parts of a form beside its anchor, as written or as meant: wherever the channel allows a candidate, one is shared."""
    if label == "PERSON":
        if meant:
            nicks = [nick for nick, names in FULL_NAMES.items() if given in names]
            return frozenset({"=" + given, "i" + given[:1], *("~" + k for w in (given, *nicks) for k in holds(w))})
        if given:
            known = {given, *FULL_NAMES.get(given, ()), *(nick for nick, names in FULL_NAMES.items() if given in names)}
            return frozenset({*("=" + w for w in known), *("~" + k for k in asks(given))})
        return frozenset({"i" + letters[:1]} if letters else ())
    bare = [w.strip(".") or w for w in words]
    initials = lambda *left: "".join(sorted(w[0] for i, w in enumerate(bare) if i not in left))
    out = {f"{len(bare)}p{initials()}"}
    # one or two words with an error in their first letter; the others keep theirs
    out |= {f"{len(bare)}q{initials(i)}|{k}" for i, w in enumerate(bare) for k in _stems(w, meant)}
    out |= {f"{len(bare)}r{initials(i, j)}|{k}" for i, j in permutations(range(len(bare)), 2) for k in _stems(bare[i], meant)}
    if meant and len(bare) > 1:
        out.add("a" + initials())
    if not meant and len(bare) == 1:
        out.add("a" + "".join(sorted(bare[0])))
    return frozenset(out)


def _in_order(short: str, word: str) -> bool:
    rest = iter(word)
    return all(c in rest for c in short)


def _mapped(function, kind: str):
    """A function of a word as a function of columns, in Arrow batches."""

    def run(words: pd.Series) -> pd.Series:
        return words.map(function)

    return F.pandas_udf(run, kind)


def spellings(entities: DataFrame) -> DataFrame:
    """``label, surface, n``: distinct spellings, counted in part before the shuffle."""
    usable = F.col("label").isin(*LABELS) & F.col("surface").isNotNull() & (F.trim("surface") != "")
    return entities.where(usable).groupBy("label", "surface").agg(F.count("*").alias("n"))


def forms(spelled: DataFrame) -> DataFrame:
    """``label, surface, n, anchor, given, letters, words`` of each spelling; those that can't be read are left out."""
    org = spelled.where("label = 'ORG'")

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(words=[read_organisation(s) for s in frame["surface"]])

    def people(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            read = [read_person(s) for s in frame["surface"]]
            frame = frame[[r is not None for r in read]]
            read = [r for r in read if r]
            yield frame.assign(anchor=[r[0] for r in read], given=[r[1] for r in read], letters=[r[2] for r in read], words=[[] for _ in read])

    kind = "label string, surface string, n bigint"
    persons = spelled.where("label = 'PERSON'").mapInPandas(people, f"{kind}, anchor string, given string, letters string, words array<string>")
    read = org.mapInPandas(words, f"{kind}, words array<string>")
    each = read.select("label", "surface", "n", "words", F.posexplode("words").alias("at", "word"))
    # how many spellings hold a word, one error aside: a mistyped frequent word isn't rare
    asked, held = _mapped(lambda w: sorted(asks(w, 1)), "array<string>"), _mapped(lambda w: sorted(holds(w, 1)), "array<string>")
    counted = each.select("word").groupBy("word").agg(F.count("*").alias("n_word"))
    most = counted.select("n_word", F.explode(held("word")).alias("key")).groupBy("key").agg(F.max("n_word").alias("most"))
    frequent = counted.select("word", F.explode(asked("word")).alias("key")).join(most, "key").groupBy("word").agg(F.max("most").alias("spread"))
    able = _mapped(may_anchor, "boolean")
    order = Window.partitionBy("surface").orderBy(F.desc("able"), "spread", F.desc(F.length("word")), "at")
    ranked = each.join(frequent, "word").withColumn("able", able("word")).withColumn("nth", F.row_number().over(order)).where("nth = 1")
    others = F.filter("words", lambda w, i: i != F.col("at"))
    return persons.unionByName(ranked.select("label", "surface", "n", F.col("word").alias("anchor"), F.lit("").alias("given"), F.lit("").alias("letters"), others.alias("words")))


def attributed(read: DataFrame) -> DataFrame:
    """``form, to`` for each form that a candidate explains, with a row for each form otherwise (``to`` null).

    ``read`` is a table of spellings as forms with the column ``form``.
    """
    own = ["label", "anchor", "given", "letters", "words"]
    form = read.groupBy("form", *own).agg(F.sum("n").alias("n"))
    # complete forms, counted whatever the order, case, title or initials they are written with
    complete = F.when(F.col("label") == "PERSON", F.length("given") > 2).otherwise(
        ((F.size("words") > 1) | (F.length(F.get("words", F.lit(0))) > 3)) & ~F.exists("words", lambda w: w.endswith("."))
    )
    base = form.where(complete).groupBy("label", "anchor", "given", F.array_sort("words").alias("words")).agg(
        F.sum("n").alias("n"), F.array_sort(F.collect_set(F.nullif("letters", F.lit("")))).alias("middle"), F.min_by("form", F.struct(F.length("letters"), -F.col("n"), F.col("form"))).alias("to")
    )
    n_given = form.where("label = 'PERSON' AND given <> ''").groupBy("given").agg(F.count_distinct("anchor").alias("n_given"))
    # a name of its own is spelled in several ways; a mistyped one rarely twice
    spelled = read.groupBy("label", "anchor").agg(F.count("*").alias("n_spelled"))
    anchors = spelled.select("label", "anchor")
    asked, held = _mapped(lambda w: sorted(asks(w)), "array<string>"), _mapped(lambda w: sorted(holds(w)), "array<string>")
    by_key = anchors.select("label", F.col("anchor").alias("to_anchor"), F.explode(held("anchor")).alias("key"))
    near = anchors.select("label", "anchor", F.explode(asked("anchor")).alias("key")).join(by_key, ["label", "key"]).select("label", "anchor", "to_anchor").distinct()
    crowded = base.groupBy("label", F.col("anchor").alias("to_anchor")).agg((F.count("*") > CROWD).alias("crowded"))
    near = near.join(crowded, ["label", "to_anchor"])  # anchors without a candidate explain nothing
    rank = base.select("label", "anchor", "given", "words", F.col("n").alias("own_n"), F.col("to").alias("own"))
    form, base = form.join(spelled, ["label", "anchor"]), base.join(spelled, ["label", "anchor"])
    left = (
        form.join(n_given, "given", "left").join(rank, ["label", "anchor", "given", "words"], "left")
        .select("form", *own, "n_spelled", F.coalesce("n_given", F.lit(0)).alias("n_given"), F.coalesce("own_n", F.lit(0)).alias("own_n"), F.coalesce("own", F.lit("")).alias("own"))
    )
    right = base.join(n_given, "given", "left").join(crowded.withColumnRenamed("to_anchor", "anchor"), ["label", "anchor"]).select(
        "label", F.col("anchor").alias("to_anchor"), F.col("given").alias("to_given"), F.col("words").alias("to_words"), F.col("n").alias("to_n"), F.concat_ws("", "middle").alias("to_letters"), "to", F.col("n_spelled").alias("to_n_spelled"), F.coalesce("n_given", F.lit(0)).alias("to_n_given"), "crowded"
    )
    left = left.join(near, ["label", "anchor"]).withColumn("key", F.explode(_crowd_keys(False)("label", "given", "letters", "words", "crowded"))).drop("crowded")
    right = right.withColumn("key", F.explode(_crowd_keys(True)("label", "to_given", F.lit(""), "to_words", "crowded"))).drop("crowded")
    pairs = spread(left.join(right, ["label", "to_anchor", "key"]), "form")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                if r.key:
                    # a pair may share several keys and is looked at under the first
                    written, meant = crowd_keys(r.label, r.given, r.letters, tuple(r.words), False), crowd_keys(r.label, r.to_given, "", tuple(r.to_words), True)
                    if r.key != min(written & meant):
                        continue
                if r.own == r.to:
                    out.append((r.form, r.to, log(r.to_n) - BIRTH))
                    continue
                # towards the more frequent name only, so that attributions never go round
                mistyped = errors(r.anchor, r.to_anchor) if (r.to_n, r.to) > (r.own_n, r.own) else None
                if mistyped is None or (mistyped and r.n_spelled > 2 and r.n_spelled * OFTENER > r.to_n_spelled):
                    continue
                if r.label == "PERSON":
                    cost = cost_of_given(r.given, r.letters, r.n_given, r.to_given, r.to_letters, r.to_n_given)
                else:
                    cost = cost_of_words(list(r.words), list(r.to_words))
                if cost is not None:
                    out.append((r.form, r.to, log(r.to_n) - cost - ERROR * mistyped))
            yield pd.DataFrame(out, columns=["form", "to", "posterior"])

    return best(pairs.mapInPandas(run, "form string, to string, posterior double"))


def best(scored: DataFrame) -> DataFrame:
    """``form, to``: of each form's candidates that of the greatest posterior; of equal ones the first by code point."""
    return scored.groupBy("form").agg(F.min_by("to", F.struct(-F.col("posterior"), F.col("to"))).alias("to"))


def _crowd_keys(meant: bool):
    """``crowd_keys`` as a function of columns; where there is no crowd the one key is empty."""

    def run(label: pd.Series, given: pd.Series, letters: pd.Series, words: pd.Series, crowded: pd.Series) -> pd.Series:
        rows = zip(label, given, letters, words, crowded, strict=True)
        return pd.Series([sorted(crowd_keys(x, g, i, tuple(w), meant)) if c else [""] for x, g, i, w, c in rows])

    return F.pandas_udf(run, "array<string>")


def classes(entities: DataFrame) -> DataFrame:
    """``label, surface, n, class_id`` of every spelling that can be read."""
    spelled = forms(cut_lineage(spread(spellings(entities), "surface")))
    form = F.concat_ws("\u0001", "label", "anchor", "given", "letters", F.array_join(F.array_sort("words"), " "))
    read = cut_lineage(spelled.withColumn("form", form).withColumn("words", F.array_sort("words")))
    to = cut_lineage(attributed(read).where("form <> to"))
    # an attribution may lead to a form that is itself attributed: follow, twice as far in each round, until none does
    while True:
        further = to.select(F.col("form").alias("to"), F.col("to").alias("further"))
        followed = cut_lineage(to.join(further, "to", "left"))
        if followed.where("further is not null").isEmpty():
            break
        to = followed.select("form", F.coalesce("further", "to").alias("to"))
    return read.join(to, "form", "left").select("label", "surface", "n", F.coalesce("to", "form").alias("class_id"))


def linked(entities: DataFrame, block: int = BLOCK) -> DataFrame:
    """``label, surface_a, surface_b``: pairs of different spellings of one class.

    A class of more than ``block`` spellings is split into blocks by hash, and each pair of blocks is a key of its own.
    """
    members = cut_lineage(classes(entities).select("label", "class_id", "surface"))
    sizes = members.groupBy("label", "class_id").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1").drop("n")
    placed = members.join(sizes, ["label", "class_id"]).withColumn("i", F.pmod(F.xxhash64("surface"), F.col("blocks")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    a = placed.select("label", "class_id", F.col("surface").alias("surface_a"), "i", each.alias("j"))
    b = placed.select("label", "class_id", F.col("surface").alias("surface_b"), F.col("i").alias("j"), each.alias("i"))
    return a.join(b, ["label", "class_id", "i", "j"]).where("surface_a < surface_b").select("label", "surface_a", "surface_b")
