"""Porter and Snowball (English) stemmers as column expressions.

Both algorithms are chains of suffix rules, so each step is one ``CASE`` over
the current word and runs inside the JVM.  The steps can be applied

* to a DataFrame column (``stem_column``): one projection per step, and
* to an ``ARRAY<STRING>`` column (``stem_array``): one ``transform`` per step.

Neither needs a shuffle, so stemming a corpus stays a map-only job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: Porter suffix rules (suffix, replacement), in rule order --
PORTER_1A = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
PORTER_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
]
PORTER_3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
            ("ical", "ic"), ("ful", ""), ("ness", "")]
PORTER_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
            "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]
PORTER_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# --- fixed values: Snowball suffix rules -------------------------------------
SNOWBALL_SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes", "inning": "inning",
    "innings": "inning", "outing": "outing", "outings": "outing", "canning": "canning",
    "cannings": "canning", "herring": "herring", "herrings": "herring",
    "earring": "earring", "earrings": "earring", "proceed": "proceed",
    "proceeds": "proceed", "proceeded": "proceed", "proceeding": "proceed",
    "exceed": "exceed", "exceeds": "exceed", "exceeded": "exceed",
    "exceeding": "exceed", "succeed": "succeed", "succeeds": "succeed",
    "succeeded": "succeed", "succeeding": "succeed",
}
SNOWBALL_DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
SNOWBALL_2 = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"),
    ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"),
    ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"),
    ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
]
SNOWBALL_3 = [("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"),
              ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", "")]
SNOWBALL_4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism",
              "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic"]

State = dict[str, Column]
Step = Callable[[State], State]


def _len(col: Column) -> Column:
    return F.char_length(col)


def _cut(col: Column, n: int) -> Column:
    return F.left(col, _len(col) - n)


def _last(col: Column, n: int = 1) -> Column:
    """The single character at position ``n`` from the end."""
    return F.substring(col, -n, 1)


def _first_match(word: Column, cases: list[tuple[str, Column]]) -> Column:
    """The result of the first suffix that matches, else the word itself."""
    branch = None
    for suffix, result in cases:
        hit = word.endswith(suffix)
        branch = F.when(hit, result) if branch is None else branch.when(hit, result)
    return branch.otherwise(word)


# --- Porter ------------------------------------------------------------------

def letter_classes(word: Column) -> Column:
    """The word with each letter replaced by ``v`` (vowel) or ``c``.

    ``y`` counts as a vowel after a consonant only.
    """
    marked = F.translate(F.regexp_replace(word, "[^aeiouy]", "c"), "aeiou", "vvvvv")
    single = F.regexp_replace(F.regexp_replace(F.regexp_replace(marked, "^y", "c"), "cy", "cv"), "vy", "vc")
    # in a run of y each one depends on the one before it, so runs take one pass over the letters
    run = F.aggregate(F.split(marked, ""), F.lit(""), lambda done, x: F.concat(
        done, F.when(x != "y", x).when(done.endswith("c"), "v").otherwise("c")))
    return F.when(marked.contains("yy"), run).when(marked.contains("y"), single).otherwise(marked)


def _m_positive(classes: Column) -> Column:
    return classes.rlike("^c*v+c")


def _m_above_one(classes: Column) -> Column:
    return classes.rlike("^c*v+c+v+c")


def _ends_cvc(stem: Column, classes: Column) -> Column:
    return (classes.rlike("cvc$") & ~stem.rlike("[wxy]$")) | (classes == "vc")


def _porter_1a(s: State) -> State:
    w = s["w"]
    rules = _first_match(w, [(a, F.concat(_cut(w, len(a)), F.lit(b))) for a, b in PORTER_1A])
    short = w.endswith("ies") & (_len(w) == 4)
    return {"w": F.when(short, F.concat(_cut(w, 3), F.lit("ie"))).otherwise(rules)}


def _porter_1b(s: State) -> State:
    w, cv = s["w"], s["cv"]

    def repaired(n: int) -> Column:
        stem, classes = _cut(w, n), F.left(cv, _len(w) - n)
        double = (_last(stem) == _last(stem, 2)) & classes.endswith("c") & (_len(stem) >= 2)
        fixed = (
            F.when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
            .when(double, F.when(stem.rlike("[lsz]$"), stem).otherwise(_cut(w, n + 1)))
            .when(_m_positive(classes) & ~_m_above_one(classes) & _ends_cvc(stem, classes),
                  F.concat(stem, F.lit("e")))
            .otherwise(stem)
        )
        return F.when(classes.contains("v"), fixed).otherwise(w)

    return {"w": F.when(w.endswith("ied"), F.when(_len(w) == 4, _cut(w, 1)).otherwise(_cut(w, 2)))
            .when(w.endswith("eed"),
                  F.when(_m_positive(F.left(cv, _len(w) - 3)), _cut(w, 1)).otherwise(w))
            .when(w.endswith("ed"), repaired(2))
            .when(w.endswith("ing"), repaired(3))
            .otherwise(w)}


def _porter_1c(s: State) -> State:
    w, cv = s["w"], s["cv"]
    turn = w.endswith("y") & (_len(w) > 2) & (_last(cv, 2) == "c")
    return {"w": F.when(turn, F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)}


def _porter_2_alli(s: State) -> State:
    w, cv = s["w"], s["cv"]
    turn = w.endswith("alli") & _m_positive(F.left(cv, _len(w) - 4))
    return {"w": F.when(turn, _cut(w, 2)).otherwise(w)}


def _porter_rules(rules: list[tuple[str, str]]) -> Step:
    def step(s: State) -> State:
        w, cv = s["w"], s["cv"]
        cases = []
        for suffix, repl in rules:
            measured = len(suffix) - 1 if suffix == "logi" else len(suffix)
            ok = _m_positive(F.left(cv, _len(w) - measured))
            cases.append((suffix, F.when(ok, F.concat(_cut(w, len(suffix)), F.lit(repl))).otherwise(w)))
        return {"w": _first_match(w, cases)}
    return step


def _porter_4(s: State) -> State:
    w, cv = s["w"], s["cv"]
    cases = []
    for suffix in PORTER_4:
        stem = _cut(w, len(suffix))
        ok = _m_above_one(F.left(cv, _len(w) - len(suffix)))
        if suffix == "ion":
            ok = ok & stem.rlike("[st]$")
        cases.append((suffix, F.when(ok, stem).otherwise(w)))
    return {"w": _first_match(w, cases)}


def _porter_5a(s: State) -> State:
    w, cv = s["w"], s["cv"]
    stem, classes = _cut(w, 1), F.left(cv, _len(w) - 1)
    drop = w.endswith("e") & (
        _m_above_one(classes) | (_m_positive(classes) & ~_ends_cvc(stem, classes)))
    return {"w": F.when(drop, stem).otherwise(w)}


def _porter_5b(s: State) -> State:
    w, cv = s["w"], s["cv"]
    drop = w.endswith("ll") & _m_above_one(F.left(cv, _len(w) - 1))
    return {"w": F.when(drop, _cut(w, 1)).otherwise(w)}


def _with_classes(step: Step) -> list[Step]:
    return [lambda s: {"w": s["w"], "cv": letter_classes(s["w"])}, step]


PORTER_STEPS: list[Step] = [_porter_1a]
for _step in (_porter_1b, _porter_1c, _porter_2_alli, _porter_rules(PORTER_2),
              _porter_rules(PORTER_3), _porter_4, _porter_5a, _porter_5b):
    PORTER_STEPS += _with_classes(_step)


# --- Snowball ----------------------------------------------------------------

_REGION = "^.*?[aeiouy][^aeiouy]"


def _snowball_start(s: State) -> State:
    w = F.regexp_replace(s["w"], "^'", "")
    w = F.regexp_replace(w, "^y", "Y")
    return {"w": F.regexp_replace(w, "([aeiouy])y", "$1Y")}


def _region_after(text: Column, start: Column) -> Column:
    found = _len(F.regexp_extract(F.substr(text, start + 1), _REGION, 0))
    return F.when(found == 0, _len(text)).otherwise(start + found)


def _snowball_r1(s: State) -> State:
    w = s["w"]
    return {"w": w, "p1": F.when(w.rlike("^(?:gener|arsen)"), F.lit(5))
            .when(w.startswith("commun"), F.lit(6))
            .otherwise(_region_after(w, F.lit(0)))}


def _snowball_r2(s: State) -> State:
    return {**s, "p2": _region_after(s["w"], s["p1"])}


def _in_region(w: Column, n: int, start: Column) -> Column:
    return (_len(w) - n) >= start


def _snowball_0(s: State) -> State:
    w = s["w"]
    return {**s, "w": F.regexp_replace(w, "(?:'s'|'s|')$", "")}


def _snowball_1a(s: State) -> State:
    w = s["w"]
    ie = F.when(_len(w) - 3 > 1, _cut(w, 2)).otherwise(_cut(w, 1))
    return {**s, "w": _first_match(w, [
        ("sses", _cut(w, 2)), ("ied", ie), ("ies", ie), ("us", w), ("ss", w),
        ("s", F.when(_cut(w, 2).rlike("[aeiouy]"), _cut(w, 1)).otherwise(w))])}


def _snowball_1b(s: State) -> State:
    w, p1 = s["w"], s["p1"]

    def stripped(n: int) -> Column:
        stem = _cut(w, n)
        empty_r1 = _len(w) - n <= p1
        short = empty_r1 & (stem.rlike("[^aeiouy][aeiouy][^aeiouywxY]$")
                            | ((_len(stem) == 2) & stem.rlike("^[aeiouy][^aeiouy]$")))
        fixed = (
            F.when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
            .when(stem.rlike(f"(?:{'|'.join(SNOWBALL_DOUBLES)})$"), _cut(w, n + 1))
            .when(short, F.concat(stem, F.lit("e")))
            .otherwise(stem))
        return F.when(stem.rlike("[aeiouy]"), fixed).otherwise(w)

    def eed(n: int) -> Column:
        return F.when(_in_region(w, n, p1), F.concat(_cut(w, n), F.lit("ee"))).otherwise(w)

    return {**s, "w": _first_match(w, [
        ("eedly", eed(5)), ("ingly", stripped(5)), ("edly", stripped(4)),
        ("eed", eed(3)), ("ing", stripped(3)), ("ed", stripped(2))])}


def _snowball_1c(s: State) -> State:
    w = s["w"]
    turn = (_len(w) > 2) & w.rlike("[^aeiouy][yY]$")
    return {**s, "w": F.when(turn, F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)}


def _snowball_2(s: State) -> State:
    w, p1 = s["w"], s["p1"]
    cases = []
    for suffix, repl in SNOWBALL_2:
        ok = _in_region(w, len(suffix), p1)
        if suffix == "ogi":
            ok = ok & (_last(w, 4) == "l")
        if suffix == "li":
            ok = ok & w.rlike("[cdeghkmnrt]li$")
        cases.append((suffix, F.when(ok, F.concat(_cut(w, len(suffix)), F.lit(repl))).otherwise(w)))
    return {**s, "w": _first_match(w, cases)}


def _snowball_3(s: State) -> State:
    w, p1, p2 = s["w"], s["p1"], s["p2"]
    cases = []
    for suffix, repl in SNOWBALL_3:
        ok = _in_region(w, len(suffix), p2 if suffix == "ative" else p1)
        cases.append((suffix, F.when(ok, F.concat(_cut(w, len(suffix)), F.lit(repl))).otherwise(w)))
    return {**s, "w": _first_match(w, cases)}


def _snowball_4(s: State) -> State:
    w, p2 = s["w"], s["p2"]
    cases = []
    for suffix in SNOWBALL_4:
        ok = _in_region(w, len(suffix), p2)
        if suffix == "ion":
            ok = ok & w.rlike("[st]ion$")
        cases.append((suffix, F.when(ok, _cut(w, len(suffix))).otherwise(w)))
    return {**s, "w": _first_match(w, cases)}


def _snowball_5(s: State) -> State:
    w, p1, p2 = s["w"], s["p1"], s["p2"]
    long_e = (_len(w) >= 4) & w.rlike("(?:[aeiouywxY]e|[^aeiouy].e|[aeiouy]..e)$")
    drop = (w.endswith("ll") & _in_region(w, 1, p2)) | (
        w.endswith("e") & (_in_region(w, 1, p2) | (_in_region(w, 1, p1) & long_e)))
    return {"w": F.translate(F.when(drop, _cut(w, 1)).otherwise(w), "Y", "y")}


SNOWBALL_STEPS: list[Step] = [
    _snowball_start, _snowball_r1, _snowball_r2, _snowball_0, _snowball_1a, _snowball_1b,
    _snowball_1c, _snowball_2, _snowball_3, _snowball_4, _snowball_5]

ALGORITHMS = {
    "porter": (PORTER_STEPS, PORTER_IRREGULAR),
    "snowball": (SNOWBALL_STEPS, SNOWBALL_SPECIAL),
}


def _pairs(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def _result(word: Column, stem: Column, irregular: dict[str, str]) -> Column:
    """Short and irregular words bypass the rules."""
    return F.when(_len(word) <= 2, word).otherwise(F.coalesce(_pairs(irregular)[word], stem))


def stem_column(df: DataFrame, token: str, algorithm: str, out: str) -> DataFrame:
    """Adds ``out``, the stem of the string column ``token``."""
    steps, irregular = ALGORITHMS[algorithm]
    kept = df.columns
    work = df.withColumn("_w", F.lower(token))
    for step in steps:
        state = {c[1:]: F.col(c) for c in work.columns if c in ("_w", "_cv", "_p1", "_p2")}
        new = step(state)
        work = work.select(*kept, *[v.alias(f"_{k}") for k, v in new.items()])
    return work.select(*kept, _result(F.lower(token), F.col("_w"), irregular).alias(out))


def stem_array(tokens: Column, algorithm: str) -> Column:
    """Stems of an ``ARRAY<STRING>``; one ``transform`` per step."""
    steps, irregular = ALGORITHMS[algorithm]
    work = F.transform(tokens, lambda t: F.struct(F.lower(t).alias("o"), F.lower(t).alias("w")))
    names = ["w"]
    for step in steps:
        work, names = _advance(work, step, names)
    return F.transform(work, lambda t: _result(t["o"], t["w"], irregular))


def _advance(work: Column, step: Step, names: list[str]) -> tuple[Column, list[str]]:
    made: list[str] = []

    def advance(t: Column) -> Column:
        new = step({n: t[n] for n in names})
        made[:] = list(new)
        return F.struct(t["o"].alias("o"), *[v.alias(k) for k, v in new.items()])

    return F.transform(work, advance), made
