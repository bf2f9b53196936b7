"""Personal data by weak supervision.

Strict patterns give the base spans.  Looser patterns and base matches that fail
their check are candidates too.  Six labelers vote on each candidate: shape, check
digits and ranges, a gazetteer, words before it that speak for it, words before it
that speak against it, and what it touches.  Expectation-maximisation over the
counts of vote patterns estimates, by kind, how often each labeler says what of
true and of false candidates.  Its posteriors are soft labels for a final
classifier on features of the span, which decides on the candidates; one whose check
fails needs a word for it as well; base spans stay.  All of it is built-in expressions over two passes of the texts; what passes
between them is a table of vote and feature combinations, bounded by their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sealed, settle

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that no text makes them slow.  A
#: look-behind keeps a failed run of characters from being tried again inside.
BASE = {
    "email": r"(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\\.[0-9]++){3}",
    "card": r"[0-9](?:[\\x20-]?[0-9])++",
    "phone": r"\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
GUARD = {"email": "contains(_t, '@')", "ip": "_digits", "card": "_digits", "phone": "_digits AND contains(_t, '+')"}
#: Looser forms: spelled-out addresses, eight groups of hexadecimals, numbers in groups with or without a country.
LOOSE = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++[\\x20]?[(\\[{]at[)\\]}][\\x20]?[A-Za-z0-9-]++"
              r"(?:[\\x20]?(?:\\.|[(\\[{]dot[)\\]}])[\\x20]?[A-Za-z0-9-]++)++", "_t rlike '[(\\\\[{]at[)\\\\]}]'"),
    "ip": (r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])", "_digits AND contains(_t, ':')"),
    "phone": (r"\\+[0-9]{1,3}[\\x20.-]?(?:\\([0-9]{2,4}\\)|[0-9]{2,4})[\\x20.-]?[0-9]{3}[\\x20.-]?[0-9]{3,4}(?![0-9])|"
              r"(?<![0-9+.A-Za-z])(?:\\([0-9]{3}\\)[\\x20]?|[0-9]{3}[\\x20.-])[0-9]{3}[\\x20.-][0-9]{4}(?![0-9])", "_digits"),
}
#: Gazetteers: top-level domains, country calling codes, first digits of cards.
DOMAINS = "com|org|net|edu|gov|io|info|biz|de|fr|es|uk|eu|us|it|nl|ch|at"
CALLING = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65"
#: Words shortly before a span that speak for its kind, and for none.
FOR = {"email": "mail|contact|write|reach", "ip": "host|server|address|client|ip\\\\b", "card": "card|visa|credit|payment|account",
       "phone": "phone|call|tel|mobile|fax|contact"}
AGAINST = "version|isbn|order|invoice|serial|model|chapter|licen[cs]e|build|release"
WINDOW = 30
BLANK = r"\\x20\\n\\t"
LABELERS = 6
ROUNDS = 25
LIMIT = 0.5

SPAN = "array<struct<kind:string,s:int,e:int,m:string>>"


def _find(kind: str, pattern: str, guard: str) -> str:
    """Matches with their places in code points: gaps and matches alternate, so their lengths add up."""
    return f"""CASE WHEN {guard} THEN transform(array(named_struct('m', regexp_extract_all(_t, '{pattern}', 0),
        'g', split(_t, '{pattern}', -1))), z -> aggregate(z.m,
        named_struct('at', 0, 'k', 0, 'out', cast(array() as {SPAN})),
        (a, x) -> named_struct('at', a.at + length(z.g[a.k]) + length(x), 'k', a.k + 1, 'out', concat(a.out, array(named_struct(
            'kind', '{kind}', 's', a.at + length(z.g[a.k]), 'e', a.at + length(z.g[a.k]) + length(x), 'm', x)))),
        a -> a.out))[0] ELSE cast(array() as {SPAN}) END"""


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _octets(m: str) -> str:
    return (f"forall(split({m}, '[.]'), p -> length(regexp_replace(p, '^0+', '')) <= 3 "
            "AND coalesce(try_cast(regexp_replace(p, '^0+', '') as int), 0) <= 255)")


def _luhn(m: str) -> str:
    return (f"transform(array(reverse({_digits(m)})), d -> length(d) BETWEEN 13 AND 19 AND aggregate(sequence(1, least(length(d), 19)), 0, "
            "(a, i) -> a + transform(array(cast(substring(d, i, 1) as int) * (2 - i % 2)), v -> v - 9 * cast(v > 9 as int))[0]) % 10 = 0)[0]")


#: What a base match must fulfil.
VALID = {"email": "true", "ip": _octets("x.m"), "card": _luhn("x.m"),
         "phone": f"length({_digits('x.m')}) BETWEEN 9 AND 15"}


def _by_kind(values: dict[str, str]) -> str:
    return "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


def _spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Adds ``_t``, ``_base`` and ``_cand`` (candidates with votes and features) to the kept columns."""
    names = [f"`{c}`" for c in keep]
    out = docs.select(*[docs[c] for c in keep], F.coalesce(docs["text"], F.lit("")).alias("_t"))
    out = out.selectExpr(*names, "_t", "_t rlike '[0-9]' AS _digits")
    out = out.selectExpr(*names, "_t", *[f"{_find(k, BASE[k], GUARD[k])} AS _{k}" for k in KINDS],
                         *[f"{_find(k, p, g)} AS _loose_{k}" for k, (p, g) in LOOSE.items()])
    out = out.selectExpr(*names, "_t", *[f"filter(_{k}, x -> {VALID[k]}) AS _ok_{k}" for k in KINDS],
                         f"concat({', '.join('_' + k for k in KINDS)}) AS _all", f"concat({', '.join('_loose_' + k for k in LOOSE)}) AS _loose")
    out = out.selectExpr(*names, "_t", f"concat({', '.join('_ok_' + k for k in KINDS)}) AS _base", "_all", "_loose",
                         *[f"cast(size(_ok_{k}) as long) AS n_{k}" for k in KINDS])
    seen = (f"named_struct('kind', x.kind, 's', x.s, 'e', x.e, 'm', x.m, 'before', lower(substring(_t, greatest(x.s - {WINDOW}, 0) + 1, "
            f"least(x.s, {WINDOW}))), 'after', substring(_t, x.e + 1, 1),")
    out = out.selectExpr(
        *names, "_t", "_base", *[f"n_{k}" for k in KINDS],
        f"concat(transform(_all, x -> {seen} 'base', array_contains(_base, x))),"
        f" transform(filter(_loose, x -> NOT exists(_base, b -> b.s < x.e AND x.s < b.e)), x -> {seen} 'base', false))) AS _seen")
    vote = lambda yes, no: f"CASE WHEN {yes} THEN 2 WHEN {no} THEN 0 ELSE 1 END"
    digits = _digits("x.m")
    shape = _by_kind({
        "email": vote("x.m rlike '^[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9.-]++$' AND x.m rlike '[.][A-Za-z]{2,}$'", "x.m rlike '[.]{2}|^[.]'"),
        "ip": vote("x.m rlike '^(0|[1-9][0-9]{0,2})([.](0|[1-9][0-9]{0,2})){3}$|:.*:'", "x.m rlike '[0-9]{4}'"),
        "card": vote("x.m rlike '^([0-9]{13,16}|[0-9]{4}([ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$'", f"length({digits}) NOT BETWEEN 13 AND 19"),
        "phone": vote("x.m rlike '^([+][0-9]{1,3}[ .-]?)?[(]?[0-9]{2,4}[)]?[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}$'", "x.m rlike '[.]{2}|[ ]{2}|--'")})
    sound = _by_kind({
        "email": vote("x.m rlike '[A-Za-z]{2}$'", "x.m rlike '[.-][0-9]+$'"), "ip": vote(f"x.m rlike ':' OR {_octets('x.m')}", "true"),
        "card": vote(_luhn("x.m"), "true"), "phone": vote(f"length({digits}) BETWEEN 9 AND 15", "true")})
    listed = _by_kind({
        "email": vote(f"lower(x.m) rlike '(?:[.]|[)}}]|[\\\\]])[ ]?({DOMAINS})$'", "x.m rlike '[0-9]$'"),
        "ip": vote("x.m rlike '^(10|127|172|192|[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])[.]|:'", "x.m rlike '^0*[.]?0|^(24|25)[0-9]'"),
        "card": vote(f"{digits} rlike '^({ISSUERS})'", "true"), "phone": vote(f"{digits} rlike '^({CALLING})'", f"{digits} rlike '^0'")})
    context = _by_kind({k: vote(f"x.before rlike '{w}'", "false") for k, w in FOR.items()})
    against = vote("false", f"x.before rlike '({AGAINST})[^a-z]*$'")
    touch = vote("x.before rlike '(^|[^0-9a-z._%+-])$' AND x.after rlike '^$|[^0-9A-Za-z_%+-]'", "x.before rlike '[0-9a-z._-]$' OR x.after rlike '[0-9A-Za-z_]'")
    features = ("array(concat('length:', least(floor(length(x.m) / 4), 8)), concat('digits:', least(floor(length("
                f"{digits}) / 2), 10)), concat('marks:', array_join(array_sort(array_distinct(split(regexp_replace(substring(x.m, 1, 64), '[0-9A-Za-z]', ''), ''))), '')),"
                f" concat('left:', CASE WHEN x.before rlike '[0-9]$' THEN 'digit' WHEN x.before rlike '[a-z]$' THEN 'letter' WHEN x.before rlike '[{BLANK}]$|^$' THEN 'space' ELSE 'mark' END),"
                f" concat('right:', CASE WHEN x.after rlike '[0-9]' THEN 'digit' WHEN x.after rlike '[A-Za-z]' THEN 'letter' WHEN x.after rlike '^$|[{BLANK}]' THEN 'space' ELSE 'mark' END),"
                f" concat('for:', {context}), concat('check:', {sound}))")
    return out.selectExpr(*names, "_t", "_base", *[f"n_{k}" for k in KINDS],
                          f"transform(_seen, x -> named_struct('kind', x.kind, 's', x.s, 'e', x.e, 'base', x.base, 'votes', "
                          f"array({shape}, {sound}, {listed}, {context}, {against}, {touch}), 'features', {features})) AS _cand")


def train(docs: DataFrame) -> DataFrame:
    """One row with ``model``: by ``kind`` the classifier's log odds, by ``kind|feature`` what each feature adds."""
    cells = settle(_spans(docs, []).select(F.explode("_cand").alias("c")).groupBy("c.kind", "c.votes", "c.features").agg(F.count(F.lit(1)).alias("n")), "votes")
    patterns = cells.groupBy("kind", "votes").agg(F.sum("n").alias("n")).groupBy("kind").agg(
        F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("p"))
    # theta: share of true ones, then for true and for false ones each labeler's shares of votes 0, 1 and 2
    one, zero = "1 + l * 3 + {v}", f"{1 + 3 * LABELERS} + l * 3 + {{v}}"
    odds = (f"ln(t[0] / (1 - t[0])) + aggregate(sequence(0, {LABELERS - 1}), 0D, (a, l) -> a + "
            f"ln(t[{one.format(v='x.votes[l]')}] / t[{zero.format(v='x.votes[l]')}]))")
    start = "array(0.5D, " + ", ".join(["0.2D, 0.3D, 0.5D"] * LABELERS + ["0.5D, 0.3D, 0.2D"] * LABELERS) + ")"
    expect = f"transform(p, x -> named_struct('votes', x.votes, 'n', x.n, 'r', 1 / (1 + exp(-greatest(-30D, least(30D, {odds}))))))"
    part = "(CASE WHEN k <= {last} THEN x.r ELSE 1 - x.r END)".format(last=3 * LABELERS)
    share = (f"(0.5D + aggregate(e, 0D, (a, x) -> a + CASE WHEN x.votes[cast(floor((k - 1) % {3 * LABELERS} / 3) as int)] = (k - 1) % 3 "
             f"THEN x.n * {part} ELSE 0D END)) / (1.5D + aggregate(e, 0D, (a, x) -> a + x.n * {part}))")
    total = "(1D + aggregate(e, 0D, (a, x) -> a + x.n * x.r)) / (2D + aggregate(e, 0D, (a, x) -> a + x.n))"
    step = f"transform(array({expect}), e -> transform(sequence(0, {6 * LABELERS}), k -> CASE WHEN k = 0 THEN {total} ELSE {share} END))[0]"
    fitted = patterns.selectExpr("kind", "p", f"aggregate(sequence(1, {ROUNDS}), {start}, (t, i) -> {step}) AS t")
    soft = fitted.selectExpr("kind", f"explode({expect}) AS x").selectExpr("kind", "x.votes AS votes", "x.r AS r")
    held = cells.join(soft, ["kind", "votes"])
    sides = held.select("kind", F.explode("features").alias("f"), (F.col("n") * F.col("r")).alias("yes"), (F.col("n") * (1 - F.col("r"))).alias("no"))
    totals = held.groupBy("kind").agg(F.sum(F.col("n") * F.col("r")).alias("all_yes"), F.sum(F.col("n") * (1 - F.col("r"))).alias("all_no"))
    weights = (sides.groupBy("kind", "f").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).join(totals, "kind")
               .selectExpr("concat(kind, '|', f) AS k", "ln((yes + 0.5D) / (all_yes + 5D)) - ln((no + 0.5D) / (all_no + 5D)) AS w"))
    priors = totals.selectExpr("kind AS k", "ln((all_yes + 1D) / (all_no + 1D)) AS w")
    return (weights.unionByName(priors).agg(F.sort_array(F.collect_list(F.struct("k", "w"))).alias("e"))
            .select(F.map_from_entries("e").alias("model")))


def find(docs: DataFrame, keep: list[str] | None = None, model: DataFrame | None = None) -> DataFrame:
    """Adds ``n_email, n_ip, n_card, n_phone, base, spans, text`` to the kept columns (``doc_id`` by default).

    ``base`` and ``spans`` are arrays of ``kind, s, e`` in code points, end
    exclusive, by kind and start.  ``model`` is :func:`train`'s, by default over
    ``docs``.  Nulls are empty texts and have no spans; repeated rows and rows
    without id are handled each on their own; extra columns are not read; an empty
    table gives no rows and an empty model.
    """
    model = train(docs) if model is None else model
    keep = keep or ["doc_id"]
    names = [f"`{c}`" for c in keep]
    out = _spans(docs, keep).withColumn("_model", model.scalar())
    prob = "1 / (1 + exp(-(coalesce(_model[x.kind], 0D) + aggregate(x.features, 0D, (a, f) -> a + coalesce(_model[concat(x.kind, '|', f)], 0D)))))"
    rank = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    order = lambda a: f"transform(sort_array(transform({a}, x -> named_struct('o', {rank}, 's', x.s, 'e', x.e, 'kind', x.kind))), x -> named_struct('kind', x.kind, 's', x.s, 'e', x.e))"
    return sealed(out, *names, *[f"n_{k}" for k in KINDS], "_t AS text", f"{order('_base')} AS base",
                          f"{order(f'filter(_cand, x -> x.base OR {prob} >= {LIMIT}D AND (x.votes[1] = 2 OR x.votes[3] = 2))')} AS spans")


def listed(spans: str) -> str:
    """Spans as ``kind:start:end``, joined by commas."""
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.s, x.e)), ',')"


def digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, and all spans as text."""
    return found.selectExpr("doc_id", *[f"n_{k}" for k in KINDS], f"sha2({listed('base')}, 256) AS base_sha256", f"{listed('spans')} AS spans")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span, or union of overlapping spans, replaced by its kind in brackets."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"
    carried = plain.select(F.struct(*plain.columns).alias("row"), plain[text].alias("text"))
    found = find(carried, ["row"])
    clean = ("CASE WHEN row." + text + " IS NULL THEN NULL WHEN size(spans) = 0 THEN text ELSE aggregate(sort_array(transform(spans, "
             "x -> named_struct('s', x.s, 'e', x.e, 'kind', x.kind))), named_struct('out', '', 'at', 0), (a, x) -> CASE WHEN x.s >= a.at "
             "THEN named_struct('out', concat(a.out, substring(text, a.at + 1, x.s - a.at), '[', upper(x.kind), ']'), 'at', x.e) "
             "ELSE named_struct('out', a.out, 'at', greatest(a.at, x.e)) END, a -> concat(a.out, substring(text, a.at + 1))) END")
    cols = []
    for i, name in enumerate(docs.columns):
        if f"c{i}" == text:
            cols.append(f"_clean AS c{i}")
        elif name == "n_chars":
            cols.append(f"cast(coalesce(length(_clean), row.c{i}) as {docs.schema[i].dataType.simpleString()}) AS c{i}")
        else:
            cols.append(f"row.c{i} AS c{i}")
    return found.selectExpr("row", f"{clean} AS _clean").selectExpr(*cols).toDF(*docs.columns)
