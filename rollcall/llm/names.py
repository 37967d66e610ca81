"""Variant spellings of people's names by a noisy channel: frequency prior, typo and abbreviation likelihoods."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from rollcall.session import cut

# fixed values: words around names, and short forms of given names
TITLES = frozenset(
    "the hon honorable honourable sen senator rep representative del delegate asm assemblymember assemblyman assemblywoman assemblyperson member mr mrs ms miss mx dr prof "
    "speaker president leader chair chairman chairwoman chairperson cochair vice majority minority councilmember councilman councilwoman commissioner gov governor".split())
SUFFIXES = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "ii", "2nd": "ii", "iii": "iii", "3rd": "iii", "iv": "iv", "esq": "", "md": "", "phd": ""}
PARTICLES = frozenset("de del della der den di da dos du la le las los van von ter ten st saint bin al el mac y e".split())
NICKNAMES = {
    "abigail": "abby gail", "alexander": "alex al sandy xander lex alec", "andrew": "andy drew", "anthony": "tony ant", "barbara": "barb babs barbie bobbie", "benjamin": "ben benny benji benjy",
    "charles": "charlie chuck chas chip charley", "christine": "chris tina chrissy christy", "christopher": "chris kit topher", "daniel": "dan danny", "deborah": "deb debbie debby debra", "dmitri": "dima mitya",
    "dorothy": "dot dottie dolly dory", "edward": "ed eddie ted ned teddy", "eleanor": "ellie nell nora nellie ella lenny", "elizabeth": "liz beth betty eliza libby lizzie bess betsy ellie lisa", "francisco": "paco frank pancho cisco",
    "frederick": "fred freddie fritz rick freddy", "gerald": "gerry jerry", "grace": "gracie", "gregory": "greg gregg", "guadalupe": "lupe lupita", "harold": "hal harry", "imogen": "immy", "irene": "rene renie", "jacqueline": "jackie jacqui",
    "james": "jim jimmy jamie jem", "jennifer": "jen jenny jenn", "john": "jack johnny jon", "jose": "pepe", "joseph": "joe joey jo", "joshua": "josh", "katherine": "kate kathy katie kay kathryn kat kitty", "kenneth": "ken kenny",
    "lawrence": "larry lars laurie", "leonard": "leo len lenny", "margaret": "maggie meg peggy marge margie greta rita daisy", "matthew": "matt matty", "michael": "mike mick mickey mikey", "nathaniel": "nate nat nathan", "noelle": "noel",
    "odette": "detta", "oscar": "ozzie", "pamela": "pam pammy", "patricia": "pat patty tricia trish patti", "quentin": "quint", "rebecca": "becky becca", "richard": "rick dick rich richie ricky", "robert": "bob rob bobby robbie bert",
    "ronald": "ron ronnie", "samuel": "sam sammy", "stephen": "steve", "steven": "steve stevie", "susan": "sue susie suzy", "tamsin": "tammy tam", "theodora": "thea dora teddy theo", "theodore": "ted teddy theo", "thomas": "tom tommy",
    "timothy": "tim timmy", "vera": "vee", "victoria": "vicky tori vicki vic", "vincent": "vince vinny vin", "walter": "walt wally", "william": "bill will billy willie liam", "xavier": "xavi", "yolanda": "yoli", "zachary": "zach zack zac",
    "ulysses": "uly",
}
# fixed values end
_SHORT: dict[str, frozenset[str]] = {k: frozenset(v.split()) for k, v in NICKNAMES.items()}
#: What typing does to a name. Costs are negative log-likelihoods: these are where estimation begins (see ``channel_costs``).
OPERATIONS = {"edit": 2.6, "abbreviated": 1.8, "initial": 1.2, "nick": 0.8, "no_given": 2.0, "untitled": 1.0, "middle_unknown": 1.6, "middle_other": 4.5, "middle_left_out": 0.3,
              "suffix_left_out": 0.8, "suffix_added": 3.0, "suffix_other": 14.0, "family_initial": 5.0, "half": 1.2, "by_middle": 2.5}
MISMATCH = 30.0
#: Above this cost, by the costs estimation begins with, a name is likelier to be somebody or something else.
NOBODY = 9.5
#: A spelling that holds a person's family name as it is and costs less needs no candidates by similar words: those cost an edit or an abbreviation more.
SETTLED = 1.7
#: A person's frequency counts by its logarithm to this power: how often somebody is written about says less than how.
PRIOR_WEIGHT = 0.3
_BITS = 4
_AT = {name: _BITS * i for i, name in enumerate(OPERATIONS)}
#: bits that tell whether the person has a suffix or middle names, and what can happen only to those who do (True) or don't
_FLAGS = {"suffix": 1 << 60, "middle": 1 << 61}
_NEEDS = {"suffix_left_out": ("suffix", True), "suffix_other": ("suffix", True), "suffix_added": ("suffix", False), "middle_left_out": ("middle", True), "middle_other": ("middle", True), "middle_unknown": ("middle", False)}


@lru_cache(None)
def _op(name: str, n: int = 1) -> tuple[float, int]:
    """(cost, operations): how often each operation took place, packed into four bits each."""
    return OPERATIONS[name] * n, n << _AT[name]


def _both(*parts: tuple[float, int]) -> tuple[float, int]:
    c, o = 0.0, 0
    for x, y in parts:
        c += x
        o += y
    return c, o


_NONE, _FAILS = (0.0, 0), (MISMATCH, 0)
_LOOKALIKE = str.maketrans("013457@$", "oleastas")


_APOSTROPHES = str.maketrans("", "", "'’ʼ`´‘")


def fold(text: str) -> str:
    """Lower case without accents; apostrophes of all kinds are left out."""
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text.translate(_APOSTROPHES)) if not unicodedata.combining(c))
    return text.lower().translate(_APOSTROPHES)


@lru_cache(400_000)
def distance(a: str, b: str, most: int) -> int:
    """Edits incl. swaps of neighbours between two words, or ``most`` + 1 if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before2, before, row = [], list(range(len(b) + 1)), []
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before2[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before2, before = before, row
    return min(row[-1], most + 1)


@dataclass(frozen=True)
class Typed:
    """A typed name without what stands around it: words (folded), whether each ends in a point, where the comma was."""
    words: tuple[str, ...]
    pointed: tuple[bool, ...]
    comma: int | None
    suffix: str
    nick: str
    titled: bool


    def form(self) -> str:
        return "\x1f".join((" ".join(self.words), "".join("01"[p] for p in self.pointed), "" if self.comma is None else str(self.comma), self.suffix, self.nick, "1" * self.titled))

    @staticmethod
    def of(form: str) -> Typed:
        words, pointed, comma, suffix, nick, titled = form.split("\x1f")
        return Typed(tuple(words.split(" ")) if words else (), tuple(x == "1" for x in pointed), int(comma) if comma else None, suffix, nick, bool(titled))


_NICK = re.compile(r"[\"“”]\s*([^\"“”]+?)\s*[\"“”]|\(([a-z]{2,})\)")
_NO_NICK = re.compile(r"r|d|i|rep|dem|ind|republican|democratic|democrat|independent|vacancy")
_BRACKETS = re.compile(r"[\(\[][^()\[\]]*[\)\]]?")
_DIGIT = re.compile(r"\d")
_DISTRICT = re.compile(r",?\s+(?:[a-z]{1,4}-)?\d+(?:st|nd|rd|th)?(?: district)?\s*$")
_PLACE = re.compile(r"\s+of\s+[a-z][a-z .-]*$")
_WORDS = re.compile(r"[^\s.]+\.?")


def parse(name: str) -> Typed:
    t = " ".join(fold(name).split())
    nick = ""
    if not t.isascii() or '"' in t or "(" in t or "[" in t:
        m = _NICK.search(t)
        if m and not _NO_NICK.fullmatch((m[1] or m[2]).strip()):
            nick = (m[1] or m[2]).strip()
            t = t[:m.start()] + " " + t[m.end():]
        t = _BRACKETS.sub(" ", t)  # party and place
    if _DIGIT.search(t):
        t = _DISTRICT.sub(" ", t)  # party and district
    if " of " in t:
        t = _PLACE.sub(" ", t)
    if " - " in t:
        t = t[:t.index(" - ")]
    head, _, tail = t.partition(",")
    parts: list[tuple[str, bool]] = []
    comma, suffix, titled = None, "", False
    for side, text in enumerate((head, tail.replace(",", " "))):
        for raw in _WORDS.findall(text):
            word, point = raw.rstrip("."), raw.endswith(".")
            if not word or word == "-":
                continue
            if word in SUFFIXES and (parts or side):
                suffix = SUFFIXES[word] or suffix
            elif word in TITLES and not parts and not (word == "the" and point):
                titled = True
            else:
                parts.append((word.translate(_LOOKALIKE), point))
        if side == 0 and tail.strip() and parts:
            comma = len(parts)
    if comma == len(parts):
        comma = None
    return Typed(tuple(w for w, _ in parts), tuple(p for _, p in parts), comma, suffix, nick, titled)


@dataclass(frozen=True)
class Person:
    given: str
    middles: tuple[str, ...]
    family: str
    suffix: str
    family_words: tuple[str, ...] = field(default=())

    def form(self) -> str:
        return "\x1f".join((self.given, " ".join(self.middles), self.suffix, " ".join(self.family_words)))


@lru_cache(50_000)
def _person_of(form: str) -> Person:
    given, middles, suffix, family = form.split("\x1f")
    words = tuple(family.split(" "))
    return Person(given, tuple(middles.split(" ")) if middles else (), "".join(words), suffix, words)


def person(name: str, given: str, middle: str, family: str, suffix: str) -> Person | None:
    p = parse(name)
    words = list(p.words)
    if not words:
        return None
    known = [w.translate(_LOOKALIKE) for w in fold(family).split()] if family else []
    if known and len(known) < len(words) + 1 and words[-len(known):] == known:
        cut = len(words) - len(known)
    elif p.comma:
        words = words[p.comma:] + words[:p.comma]
        cut = len(words) - p.comma
    else:
        cut = len(words) - 1
        while cut > 1 and words[cut - 1] in PARTICLES:
            cut -= 1
    cut = max(cut, 1) if len(words) > 1 else 0
    middles = tuple(words[1:cut]) or tuple(fold(middle).split() if middle else ())
    return Person(words[0] if cut else fold(given or ""), middles, "".join(words[cut:]), p.suffix or SUFFIXES.get(fold(suffix or "").strip("."), ""), tuple(words[cut:]))


@lru_cache(400_000)
def _word_cost(typed: str, pointed: bool, full: str) -> tuple[float, int]:
    """How a given or middle name was typed."""
    short = _SHORT.get(full, frozenset())
    if typed == full:
        return _NONE
    if len(typed) == 1:
        return _op("initial") if full[:1] == typed else _FAILS
    if typed in short:
        return _op("nick")
    if full.startswith(typed) and (pointed or len(typed) >= 3):
        return _op("abbreviated")
    most = 2 if len(full) > 4 else 1
    d = distance(typed, full, most)
    if d <= most:
        return _op("edit", d)
    best = _FAILS
    if pointed and len(typed) >= 3 and distance(typed, full[:len(typed)], 1) <= 1:
        best = _both(_op("abbreviated"), _op("edit"))
    for s in short:
        if len(s) > 3 and distance(typed, s, 1) <= 1:
            best = min(best, _both(_op("nick"), _op("edit")))
    return best


@lru_cache(400_000)
def _family_cost(typed: str, pointed: bool, full: str) -> tuple[float, int]:
    if typed == full:
        return _NONE
    if len(typed) == 1:
        return _op("family_initial") if full[:1] == typed else _FAILS
    most = 1 if len(full) < 5 else 2 if len(full) < 10 else 3
    d = distance(typed, full, most)
    found = _op("edit", d) if d <= most else _FAILS
    if pointed and len(typed) >= 3:
        near = distance(typed, full[:len(typed)], 2)
        if near <= 1 or (near == 2 and len(typed) > 6):
            found = min(found, _both(_op("abbreviated"), _op("edit", near)))
    return found


def cost(t: Typed, p: Person) -> tuple[float, int]:
    """Negative log-likelihood that ``p`` was typed as ``t``, over the ways to read the words, and the operations of the likeliest."""
    n = len(t.words)
    if not n or not p.family:
        return _FAILS
    short = _SHORT.get(p.given, frozenset())
    base = (0.0, _has(p))
    if p.suffix != t.suffix:
        base = _both(base, _op("suffix_left_out" if not t.suffix else "suffix_other" if p.suffix else "suffix_added"))
    best = _FAILS
    width = len(p.family_words)
    for i, j in _spans(t, width):
        family = "".join(t.words[i:j])
        f = _family_cost(family, t.pointed[j - 1], p.family)
        if "-" in p.family or width > 1:
            f = min(f, _both(_op("half"), _half(family, p)))
        if f[0] >= MISMATCH:
            continue
        rest = _rest(t, i, j)
        if not rest:
            alone = _op("no_given") if t.titled or not p.given else _both(_op("no_given"), _op("untitled"))
            best = min(best, _both(f, base, min(alone, _op("nick") if t.nick and t.nick in short else _FAILS)))
            continue
        g = _word_cost(*rest[0], p.given) if p.given else _op("no_given")
        if t.nick:
            g = min(g, _both(_op("nick"), _op("untitled")) if t.nick in short else _FAILS)
        others = rest[1:]
        if g[0] >= MISMATCH and p.middles and len(rest) == 1:  # goes by the middle name
            m = min(_word_cost(*rest[0], x) for x in p.middles)
            if m[0] < MISMATCH:
                g, others = _both(_op("by_middle"), m), []
        if g[0] >= MISMATCH:
            continue
        if not others:
            middle = _op("middle_left_out") if p.middles else _NONE
        elif not p.middles:
            middle = _op("middle_unknown")
        else:
            near = _both(*(min(_word_cost(w, q, x) for x in p.middles) for w, q in others))
            middle = min((near[0] * 0.7, near[1]), _op("middle_other"))
        best = min(best, _both(f, base, g, middle))
    return best


def _has(p: Person) -> int:
    return (_FLAGS["suffix"] if p.suffix else 0) | (_FLAGS["middle"] if p.middles else 0)


def _spans(t: Typed, width: int) -> set[tuple[int, int]]:
    """Where the family name may stand: first or last, or on one side of the comma."""
    n = len(t.words)
    if t.comma is not None:
        return {(0, t.comma)} | ({(t.comma, n)} if n > t.comma else set())
    return {span for w in {1, width, width + 1} if w <= n for span in ((0, w), (n - w, n))}


def _rest(t: Typed, i: int, j: int) -> list[tuple[str, bool]]:
    before = [*zip(t.words[:i], t.pointed[:i], strict=True)]
    return before if t.comma is not None and i else [*before, *zip(t.words[j:], t.pointed[j:], strict=True)]


def unknown_given(t: Typed, p: Person) -> tuple[tuple[float, int], str] | None:
    """If but for the given name ``p`` may have been typed as ``t``: (cost, operations) as if it were a nickname, and the given name as typed."""
    found = []
    for i, j in _spans(t, len(p.family_words)):
        f, rest = _family_cost("".join(t.words[i:j]), t.pointed[j - 1], p.family), _rest(t, i, j)
        if f[0] <= OPERATIONS["edit"] and rest and len(rest[0][0]) > 1:
            found.append((_both(f, _op("nick"), (0.0, _has(p))), rest[0][0]))
    return min(found) if found and p.given and p.suffix == (t.suffix or p.suffix) else None


def _half(typed: str, p: Person) -> tuple[float, int]:
    """Only one part of a double or particled family name was typed."""
    parts = [x for x in re.split(r"-", p.family) if x] if "-" in p.family else list(p.family_words[-1:])
    return min((_family_cost(typed, False, x) for x in parts if len(x) > 3), default=_FAILS)


def typed_words(t: Typed) -> set[str]:
    """What may be the family name: words at the beginning or the end, or one side of the comma."""
    w = t.words
    if t.comma is not None:
        return {"".join(w[:t.comma]), "".join(w[t.comma:])} - {""}
    return {"".join(w[:k]) for k in (1, 2, 3)} | {"".join(w[-k:]) for k in (1, 2, 3)} - {""}


def family_words(p: Person | None) -> set[str]:
    return set() if p is None else {p.family, *p.family_words, *p.family.split("-")} - {""}


def typed_keys(t: Typed) -> set[str]:
    keys = set().union(*map(_near, typed_words(t)))
    return keys | {"<" + w[:3] for w, point in zip(t.words, t.pointed, strict=True) if point and 3 <= len(w) <= 6} | {"." + a + w for a, w in _with_initial(t)}


def _with_initial(t: Typed) -> list[tuple[str, str]]:
    """(initial, given name) of names whose family is one letter: ``John S.``"""
    return [(w, g) for w in t.words if len(w) == 1 for g in t.words if len(g) > 1] if len(t.words) <= 3 else []


def person_keys(p: Person | None) -> set[str]:
    if p is None:
        return set()
    words = family_words(p)
    return set().union(*map(_near, words)) | {"<" + w[:3] for w in words} | {"." + p.family[:1] + p.given}


def _near(w: str) -> set[str]:
    """Keys by which similar words meet: the word, all words with one letter less, its beginning, its end, and what is between.

    Two words with one edit, or two edits that leave one of beginning, middle and end as it is, share a key.
    """
    if len(w) < 3:
        return {"=" + w} if w else set()
    keys = {"=" + w, "^" + w[:4], "$" + w[-5:]}
    if len(w) > 3:
        keys |= {"=" + w[:i] + w[i + 1:] for i in range(len(w))}
    if len(w) > 7:
        keys |= {"~" + w[i:i + 4] for i in range(2, len(w) - 5)}
    return keys


def attribute_names(typed: DataFrame, people: DataFrame, scope: list[str], name: str, number: str, nobody: float = NOBODY, prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """(scope, ``name``, ``number``, ``posterior``, ``cost``): each distinct typed name with the person it stands for.

    ``typed`` has the scope, ``name``, and may have ``district`` (as typed). ``people`` has the scope, ``number``,
    ``full_name``, ``given``, ``middle``, ``family``, ``suffix`` and ``district``. Names are kept byte for byte. Names
    that fit nobody (cost above ``nobody``), or two people equally well, are left out, as are null, blank names and null
    scopes. ``number`` may be of any type.

    Method. Typed rows are counted per distinct spelling before anything else, so a spelling with a third of all rows
    is one row. Spellings meet people of the scope by a word that is a family name as it is; those not settled so meet
    them by keys of similar words. No pairs of a whole scope are made, and keys that would be hot (a common family name
    in a large scope) are joined with their hot side split. A person's prior is the share of the scope's names that spell
    their full name; the likelihood adds up what was done to the name (edits, initials, abbreviations, nicknames, parts
    left out or added), and what the district says. What each operation costs is estimated from the spellings that
    only one person can stand for (``channel_costs``). Each spelling goes to the greatest posterior.
    """
    spark, has = typed.sparkSession, set(typed.columns)
    district = F.regexp_replace(F.trim(F.col("district")), "^0+", "") if "district" in has else F.lit(None).cast("string")
    rows = typed.filter(F.col(name).isNotNull() & (F.trim(name) != "")).select(*scope, F.col(name).alias("name"), F.when(district != "", district).alias("district"))
    # spelling and district are counted first, then spellings: bounded by distinct values, whatever the rows
    per = rows.groupBy(*scope, "name", "district").agg(F.count("*").alias("n"))
    spelt = per.groupBy(*scope, "name").agg(F.sum("n").alias("n"), F.max_by("district", F.when(F.col("district").isNotNull(), F.struct("n", "district"))).alias("district"))
    spelt = cut(spelt.dropna(subset=scope).withColumn("sh", F.xxhash64(*scope)).withColumn("sid", F.xxhash64(*scope, "name")))
    full = people.select(*scope, F.col(number).alias("number"), "full_name", "given", "middle", "family", "suffix", F.regexp_replace(F.trim("district"), "^0+", "").alias("home")).dropna(subset=scope).withColumn("pid", F.xxhash64(*scope, "number"))
    totals = spelt.groupBy(*scope).agg((F.sum("n") + F.count("*")).alias("total"))
    exact = spelt.select(*scope, F.col("name").alias("full_name"), F.col("n").alias("exactly"))
    full = (full.join(exact, [*scope, "full_name"], "left").join(totals, scope, "left")
               .withColumn("prior", F.log((F.coalesce("exactly", F.lit(0)) + 1) / (F.coalesce("total", F.lit(0)) + 1))).drop("exactly", "total"))
    kinds = {c: people.schema[c].dataType.simpleString() for c in scope} | {"number": people.schema[number].dataType.simpleString()}

    typed_kinds = ", ".join([*(f"`{c}` {k}" for c, k in kinds.items() if c != "number"), "name string, district string, sh long, sid long, form string, words array<long>"])
    own_kinds = ", ".join([*(f"`__{c}` {k}" for c, k in kinds.items() if c != "number"), f"number {kinds['number']}, full_name string, home string, prior double, pid long, form string, words array<long>, keys array<long>"])
    spelt = cut(spelt.select(*scope, "name", "district", "sh", "sid").mapInArrow(_typed_forms(len(scope)), typed_kinds))
    own = cut(full.select(*[F.col(c).alias(f"__{c}") for c in scope], "number", "full_name", "home", "prior", "pid", F.xxhash64(*scope).alias("sh"), "given", "middle", "family", "suffix")
              .mapInArrow(_person_forms(len(scope)), own_kinds)).withColumnRenamed("form", "person_form")

    # a candidate is a few bytes but costs much: as many tasks as there are, not as the size of the pairs makes them
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def scored(pairs: DataFrame) -> DataFrame:
        """Candidates by shared keys; keys travel as hashes, a collision only adds a candidate that is scored in its own scope."""
        same = F.lit(True)
        for c in scope:
            same = same & (F.col(c) == F.col(f"__{c}"))
        rich = pairs.join(spelt.drop("words"), "sid").join(own.drop("words", "keys"), "pid").filter(same)
        head = ", ".join(f"`{c}` {k}" for c, k in kinds.items())
        return rich.select(*scope, "number", "sid", "pid", "prior", "name", (F.col("district") == F.col("home")).alias("near"), "full_name", "form", "person_form").repartition(tasks, "sid", "pid").mapInArrow(
            _score(len(scope) + 5, nobody), f"{head}, sid long, pid long, prior double, name string, near boolean, first double, operations long, given string, as_typed string")

    of = lambda df, key, keys: df.select(key, F.explode(keys).alias("key"))
    word_pairs = cut(of(spelt, "sid", "words").join(of(own, "pid", "words"), "key").select("sid", "pid").distinct())
    by_word = cut(scored(word_pairs))
    settled = by_word.filter((F.col("first") < SETTLED) & F.col("given").isNull()).select("sid").distinct()
    unsettled = spelt.join(settled, "sid", "left_anti").select("sh", "sid", "form").mapInArrow(_similar_keys, "key long, sid long")
    by_key = cut(scored(unsettled.join(of(own, "pid", "keys"), "key").select("sid", "pid").distinct().join(word_pairs, ["sid", "pid"], "left_anti")))
    both = by_word.unionByName(by_key)
    fitting = both.filter("given is null")
    unknown = both.filter("given is not null")
    found = fitting.unionByName(unknown.join(learnt_nicknames(unknown.join(fitting.select("sid"), "sid", "left_anti")), ["given", "as_typed"]).select(both.columns)).drop("given", "as_typed")
    costs = channel_costs(found)
    counted = {name: F.shiftrightunsigned("operations", at).bitwiseAND((1 << _BITS) - 1) for name, at in _AT.items()}
    likelihood = reduce(lambda a, b: a + b, [F.lit(costs[name]) * n for name, n in counted.items()])
    # the district as typed speaks for or against
    score = prior_weight * F.col("prior") - likelihood + F.when(F.col("near"), 1.0).when(~F.col("near"), -1.5).otherwise(0.0)
    # a spelling has few candidates: those that share a key with it
    by_score = Window.partitionBy("sid").orderBy(F.desc("score"), "pid")
    best = (found.withColumn("score", score).withColumn("rank", F.row_number().over(by_score)).withColumn("next", F.lead("score").over(by_score))
            .withColumn("all", F.sum(F.exp(F.col("score") - F.max("score").over(Window.partitionBy("sid")))).over(Window.partitionBy("sid"))).filter("rank = 1"))
    return (best.filter(F.col("next").isNull() | (F.col("score") - F.col("next") > 0.05))
            .select(*scope, F.col("name").alias(name), F.col("number").alias(number), (1 / F.col("all")).alias("posterior"), likelihood.alias("cost")))


def learnt_nicknames(unknown: DataFrame, least: int = 3, lift: float = 0.1) -> DataFrame:
    """(``given``, ``as_typed``): short forms no list knows, from spellings that would stand for one person but for the given name.

    A pair counts once a person; it is learnt if ``least`` people are so called and it is no coincidence of namesakes: its
    squared count is at least ``lift`` of the product of all counts of either name.
    """
    alone = unknown.groupBy("sid").agg(F.count("*").alias("n"), F.first("pid").alias("pid"), F.first("given").alias("given"), F.first("as_typed").alias("as_typed")).filter("n = 1")
    pairs = alone.select("pid", "given", "as_typed").distinct().groupBy("given", "as_typed").agg(F.count("*").alias("n"))
    of = lambda c: pairs.groupBy(c).agg(F.sum("n").alias(f"of_{c}"))
    return pairs.filter(F.col("n") >= least).join(of("given"), "given").join(of("as_typed"), "as_typed").filter(F.col("n") * F.col("n") >= lift * F.col("of_given") * F.col("of_as_typed")).select("given", "as_typed")


def channel_costs(found: DataFrame) -> dict[str, float]:
    """The cost of each operation, estimated: minus the logarithm of how often it is met where it can be told.

    Counted are all spellings with one candidate, or whose second costs an edit more by the costs to begin with; one row
    of sums comes to the driver. What can only happen to people with a suffix or middle names is counted among those.
    A hundred spellings at the first costs are added, so without data these hold; no cost is below 0.05.
    """
    by_cost = Window.partitionBy("sid").orderBy("first", "pid")
    clear = (found.withColumn("rank", F.row_number().over(by_cost)).withColumn("next", F.lead("first").over(by_cost))
             .filter((F.col("rank") == 1) & (F.col("next").isNull() | (F.col("next") - F.col("first") >= OPERATIONS["edit"]))))
    flag = lambda k, has: F.col("operations").bitwiseAND(_FLAGS[k]) != 0 if has else F.col("operations").bitwiseAND(_FLAGS[k]) == 0
    sums = clear.agg(F.count("*").alias("n"), *[F.count_if(flag(k, has)).alias(f"{k}_{has}") for k in _FLAGS for has in (True, False)],
                     *[F.coalesce(F.sum(F.shiftrightunsigned("operations", at).bitwiseAND((1 << _BITS) - 1)), F.lit(0)).alias(name) for name, at in _AT.items()]).first()
    weight = 100.0
    out = {}
    for name, first in OPERATIONS.items():
        of = sums["{}_{}".format(*_NEEDS[name])] if name in _NEEDS else sums["n"]
        out[name] = max(0.05, -math.log((sums[name] + weight * math.exp(-first)) / (of + weight)))
    return out


def _hashes(scope: int, keys: set[str]) -> list[int]:
    """64-bit hashes of scope and key, as signed numbers."""
    seed = scope & (1 << 64) - 1
    return [h - (1 << 64) if h >> 63 else h for h in (xxhash.xxh3_64_intdigest(k, seed) for k in keys)]


def _with(batch: pa.RecordBatch, kept: int, **more: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns[:kept], *more.values()], names=[*batch.schema.names[:kept], *more])


def _typed_forms(scope: int):
    """Adds how each name was read, and hashes of its words; columns: scope, name, district, sh, sid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [parse(x) for x in batch.column(scope).to_pylist()]
            words = [_hashes(h, {"=" + w for w in typed_words(t)}) for h, t in zip(batch.column(scope + 2).to_pylist(), read, strict=True)]
            yield _with(batch, scope + 4, form=pa.array([t.form() for t in read], pa.string()), words=pa.array(words, pa.list_(pa.int64())))
    return run


def _person_forms(scope: int):
    """Likewise for people, and keys of similar words; columns: scope, number, full_name, home, prior, pid, sh, given, middle, family, suffix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [c.to_pylist() for c in batch.columns[scope:]]
            read = [person(full or "", *(y or "" for y in rest)) for full, *rest in zip(parts[1], *parts[6:], strict=True)]
            kinds = pa.list_(pa.int64())
            words = [_hashes(h, {"=" + w for w in family_words(p)}) for h, p in zip(parts[5], read, strict=True)]
            keys = [_hashes(h, person_keys(p)) for h, p in zip(parts[5], read, strict=True)]
            yield _with(batch, scope + 5, form=pa.array([p.form() if p else None for p in read], pa.string()), words=pa.array(words, kinds), keys=pa.array(keys, kinds))
    return run


def _similar_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sh, sid, form) to a row for each key of similar words."""
    for batch in batches:
        found = [_hashes(h, typed_keys(Typed.of(f))) for h, f in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        at = np.repeat(np.arange(len(found)), [len(x) for x in found])
        yield pa.RecordBatch.from_arrays([pa.array([k for x in found for k in x], pa.int64()), batch.column(1).take(pa.array(at, pa.int64()))], names=["key", "sid"])


def _score(kept: int, nobody: float):
    """Rows of the first ``kept`` columns (the last is the name), near, full_name and both forms: those likely enough, with cost and operations.

    Where only the given name doesn't fit, it and what was typed for it are told: such a row counts if the two are learnt to be one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, costs, operations, givens, as_typed = [], [], [], [], []
            for i, (name, near, full, form, of) in enumerate(zip(*(c.to_pylist() for c in batch.columns[kept - 1:]), strict=True)):
                given = typed = None
                if name == full:
                    c, o = 0.0, _has(_person_of(of)) if of else 0
                elif of:
                    t, p = Typed.of(form), _person_of(of)
                    c, o = cost(t, p)
                    if c >= MISMATCH and (known := unknown_given(t, p)):
                        (c, o), given, typed = known[0], p.given, known[1]
                else:
                    c, o = _FAILS
                if c - (1.0 if near else 0.0) <= nobody:
                    keep.append(i)
                    costs.append(c)
                    operations.append(o)
                    givens.append(given)
                    as_typed.append(typed)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns[:kept + 1]), pa.array(costs, pa.float64()), pa.array(operations, pa.int64()), pa.array(givens, pa.string()), pa.array(as_typed, pa.string())],
                                             names=[*batch.schema.names[:kept + 1], "first", "operations", "given", "as_typed"])
    return run
