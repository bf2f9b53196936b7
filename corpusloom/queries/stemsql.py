"""Word normalisers as SQL, for checking.

One CTE per algorithm step.  The suffix tables are the published ones; the
conditions are written out again here as SQL.
"""

from __future__ import annotations

from ..functions import stems as st
from ..operators.audit import NOUN_ENDINGS, NOUN_EXCEPTIONS
from .sql import q


def _has(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {q(pattern)})"


def _cut(n: int, w: str = "w") -> str:
    return f"substr({w}, 1, length({w}) - {n})"


def _case(branches: list[tuple[str, str]], other: str = "w") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {r}" for c, r in branches) + f" ELSE {other} END"


def _ends(suffix: str) -> str:
    return f"suffix(w, {q(suffix)})"


_CV0 = "translate(regexp_replace(w, '[^aeiouy]', 'c', 'g'), 'aeiou', 'vvvvv')"


def _cv() -> str:
    """Letter by letter: a y is a vowel if what stands before it is a consonant."""
    return (f"list_reduce(list_prepend('', string_split({_CV0}, '')), lambda a, x: a || CASE WHEN x <> 'y' THEN x "
            "WHEN right(a, 1) = 'c' THEN 'v' ELSE 'c' END)")


def _stem_cv(n: int) -> str:
    return f"substr(cv, 1, length(w) - {n})"


def _m0(n: int) -> str:
    return _has(_stem_cv(n), "^c*v+c")


def _m1(n: int) -> str:
    return _has(_stem_cv(n), "^c*v+c+v+c")


def _cvc(n: int) -> str:
    return f"(({_has(_stem_cv(n), 'cvc$')} AND NOT {_has(_cut(n), '[wxy]$')}) OR {_stem_cv(n)} = 'vc')"


def _chain(name: str, source: str, steps: list[tuple[str, str]], irregular: dict[str, str], carry: str = "") -> str:
    """CTE chain; each step is (columns computed first, expression for w)."""
    keep = f", {carry}" if carry else ""
    ctes, prev = [], source
    for i, (extra, expr) in enumerate(steps):
        inner = f"SELECT *, {extra} FROM {prev}" if extra else f"SELECT * FROM {prev}"
        ctes.append(f"{name}_{i} AS (SELECT term{keep}, {expr} AS w FROM ({inner}))")
        prev = f"{name}_{i}"
    special = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in irregular.items())
    ctes.append(f"{name} AS (SELECT term, CASE WHEN length(term) <= 2 THEN lower(term) ELSE "
                f"CASE lower(term) {special} ELSE w END END AS stem FROM {prev})")
    return ",\n".join(ctes)


def porter(source: str, name: str) -> str:
    def table(rules: list[tuple[str, str]]) -> str:
        return _case([(_ends(a), f"CASE WHEN {_m0(len(a) - (a == 'logi'))} THEN {_cut(len(a))} || {q(b)} ELSE w END")
                      for a, b in rules])

    def undone(n: int) -> str:
        s = _cut(n)
        double = f"length({s}) >= 2 AND substr({s}, -1, 1) = substr({s}, -2, 1) AND suffix({_stem_cv(n)}, 'c')"
        fix = _case([(_has(s, "(at|bl|iz)$"), f"{s} || 'e'"),
                     (double, f"CASE WHEN {_has(s, '[lsz]$')} THEN {s} ELSE {_cut(n + 1)} END"),
                     (f"{_m0(n)} AND NOT {_m1(n)} AND {_cvc(n)}", f"{s} || 'e'")], s)
        return f"CASE WHEN contains({_stem_cv(n)}, 'v') THEN {fix} ELSE w END"

    cv = f"{_cv()} AS cv"
    four = [(_ends(s), f"CASE WHEN {_m1(len(s))}" + (f" AND {_has(_cut(3), '[st]$')}" if s == "ion" else "")
             + f" THEN {_cut(len(s))} ELSE w END") for s in st.PORTER_4]
    steps = [
        ("", _case([(f"{_ends('ies')} AND length(w) = 4", f"{_cut(3)} || 'ie'")]
                   + [(_ends(a), f"{_cut(len(a))} || {q(b)}") for a, b in st.PORTER_1A])),
        (cv, _case([(_ends("ied"), f"CASE WHEN length(w) = 4 THEN {_cut(1)} ELSE {_cut(2)} END"),
                    (_ends("eed"), f"CASE WHEN {_m0(3)} THEN {_cut(1)} ELSE w END"),
                    (_ends("ed"), undone(2)), (_ends("ing"), undone(3))])),
        (cv, _case([(f"{_ends('y')} AND length(w) > 2 AND substr(cv, -2, 1) = 'c'", f"{_cut(1)} || 'i'")])),
        (cv, _case([(f"{_ends('alli')} AND {_m0(4)}", _cut(2))])),
        (cv, table(st.PORTER_2)), (cv, table(st.PORTER_3)), (cv, _case(four)),
        (cv, _case([(f"{_ends('e')} AND ({_m1(1)} OR ({_m0(1)} AND NOT {_cvc(1)}))", _cut(1))])),
        (cv, _case([(f"{_ends('ll')} AND {_m1(1)}", _cut(1))])),
    ]
    return f"{name}_in AS (SELECT term, lower(term) AS w FROM {source}),\n" + _chain(
        name, f"{name}_in", steps, st.PORTER_IRREGULAR)


def snowball(source: str, name: str) -> str:
    region = "^.*?[aeiouy][^aeiouy]"
    start = "regexp_replace(regexp_replace(regexp_replace(lower(term), '^''', ''), '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g')"

    def after(text: str, base: str) -> str:
        found = f"length(regexp_extract({text}, {q(region)}))"
        return f"CASE WHEN {found} = 0 THEN length(w) ELSE {base} + {found} END"

    r1 = f"CASE WHEN {_has('w', '^(gener|arsen)')} THEN 5 WHEN starts_with(w, 'commun') THEN 6 ELSE {after('w', '0')} END"

    def inside(n: int, p: str) -> str:
        return f"length(w) - {n} >= {p}"

    def undone(n: int) -> str:
        s = _cut(n)
        short = (f"length({s}) <= p1 AND ({_has(s, '[^aeiouy][aeiouy][^aeiouywxY]$')} "
                 f"OR {_has(s, '^[aeiouy][^aeiouy]$')})")
        fix = _case([(_has(s, "(at|bl|iz)$"), f"{s} || 'e'"),
                     (_has(s, f"({'|'.join(st.SNOWBALL_DOUBLES)})$"), _cut(n + 1)), (short, f"{s} || 'e'")], s)
        return f"CASE WHEN {_has(s, '[aeiouy]')} THEN {fix} ELSE w END"

    def rules(items: list[tuple[str, str]], special: dict[str, str], regions: dict[str, str]) -> str:
        out = []
        for a, b in items:
            cond = inside(len(a), regions.get(a, "p1")) + (f" AND {special[a]}" if a in special else "")
            out.append((_ends(a), f"CASE WHEN {cond} THEN {_cut(len(a))} || {q(b)} ELSE w END"))
        return _case(out)

    ie = f"CASE WHEN length(w) - 3 > 1 THEN {_cut(2)} ELSE {_cut(1)} END"
    four = [(_ends(s), f"CASE WHEN {inside(len(s), 'p2')}" + (f" AND {_has('w', '[st]ion$')}" if s == "ion" else "")
             + f" THEN {_cut(len(s))} ELSE w END") for s in st.SNOWBALL_4]
    eed = {n: f"CASE WHEN {inside(n, 'p1')} THEN {_cut(n)} || 'ee' ELSE w END" for n in (3, 5)}
    long_e = f"length(w) >= 4 AND {_has('w', '([aeiouywxY]e|[^aeiouy].e|[aeiouy]..e)$')}"
    last = _case([(f"{_ends('ll')} AND {inside(1, 'p2')}", _cut(1)),
                  (f"{_ends('e')} AND ({inside(1, 'p2')} OR ({inside(1, 'p1')} AND {long_e}))", _cut(1))])
    steps = [
        ("", "regexp_replace(w, '(''s''|''s|'')$', '')"),
        ("", _case([(_ends("sses"), _cut(2)), (_ends("ied"), ie), (_ends("ies"), ie), (_ends("us"), "w"), (_ends("ss"), "w"),
                    (_ends("s"), f"CASE WHEN {_has(_cut(2), '[aeiouy]')} THEN {_cut(1)} ELSE w END")])),
        ("", _case([(_ends("eedly"), eed[5]), (_ends("ingly"), undone(5)), (_ends("edly"), undone(4)),
                    (_ends("eed"), eed[3]), (_ends("ing"), undone(3)), (_ends("ed"), undone(2))])),
        ("", _case([(f"length(w) > 2 AND {_has('w', '[^aeiouy][yY]$')}", f"{_cut(1)} || 'i'")])),
        ("", rules(st.SNOWBALL_2, {"ogi": "substr(w, -4, 1) = 'l'", "li": _has("w", "[cdeghkmnrt]li$")}, {})),
        ("", rules(st.SNOWBALL_3, {}, {"ative": "p2"})),
        ("", _case(four)),
        ("", f"translate({last}, 'Y', 'y')"),
    ]
    return (f"{name}_a AS (SELECT term, {start} AS w FROM {source}),\n"
            f"{name}_b AS (SELECT term, w, {r1} AS p1 FROM {name}_a),\n"
            f"{name}_c AS (SELECT term, w, p1, {after('substr(w, p1 + 1)', 'p1')} AS p2 FROM {name}_b),\n"
            + _chain(name, f"{name}_c", steps, st.SNOWBALL_SPECIAL, "p1, p2"))


def lemmas(source: str, name: str) -> str:
    exceptions = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in NOUN_EXCEPTIONS.items())
    options = [f"SELECT term, term AS c, 1 AS o FROM {source}", f"SELECT term, CASE term {exceptions} END, 0 FROM {source}"] + [
        f"SELECT term, substr(term, 1, length(term) - {len(a)}) || {q(b)}, 1 FROM {source} "
        f"WHERE suffix(term, {q(a)}) AND length(term) > {len(a)}" for a, b in NOUN_ENDINGS]
    return f"""{name}_c AS ({" UNION ALL ".join(options)}),
{name}_b AS (SELECT term, c, row_number() OVER (PARTITION BY term ORDER BY o, length(c), c) AS rn
  FROM {name}_c WHERE c IN (SELECT term FROM {source})),
{name} AS (SELECT v.term, coalesce(b.c, v.term) AS lemma FROM {source} v LEFT JOIN {name}_b b ON b.term = v.term AND b.rn = 1)"""
