"""SQL text shared by the checks.  Written for DuckDB; no DataFrame code."""

from __future__ import annotations

from ..functions.fixed import EMOJI_RANGES, ROMAN_URDU


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


W = r"[\p{L}\p{N}_]"
SP = r"\t-\r \x1c-\x1f\x{85}\p{Z}"
WORD = rf"{W}(?:[\p{{L}}\p{{N}}_']*{W})?"
CUSTOM = rf"{WORD}|[\x{{0600}}-\x{{06FF}}]+|[!?.,;:\-]"
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
TAG = r"<[^>]+>"
URL = rf"[hH][tT][tT][pP][sS]?://[^{SP}]+|[wW][wW][wW]\.[^{SP}]+"
EMOJI = "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in EMOJI_RANGES) + "]"


def sub(expr: str, pattern: str, repl: str = " ") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, 'g')"


def find_all(expr: str, pattern: str) -> str:
    return f"regexp_extract_all({expr}, {q(pattern)})"


def unescape(expr: str) -> str:
    named = {"&amp;": "&", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&apos;": "'",
             "&nbsp;": " ", "&copy;": "©", "&middot;": "·"}
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in named.items())
    return (f"array_to_string(list_transform({find_all(expr, ENTITY + '|[^&]+|&')}, "
            f"lambda p: CASE p {whens} ELSE p END), '')")


def markup(expr: str) -> str:
    return sub(sub(sub(sub(expr, TAG), URL), rf"#({W}+)", r"\1"), rf"@{W}+")


def squeeze(expr: str) -> str:
    return sub(expr, "([!?.]){2,}", r"\1")


def dictionary(expr: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in ROMAN_URDU.items())
    return (f"array_to_string(list_transform({find_all(expr, rf'{W}+|[^' + W[1:] + '+')}, "
            f"lambda p: CASE p {whens} ELSE p END), '')")


def clean(expr: str) -> str:
    step = sub(squeeze(markup(unescape(expr))), EMOJI)
    step = dictionary(f"lower({sub(step, '[\\x00-\\x1f\\x7f-\\x9f]')})")
    return f"trim({sub(sub(step, r'[\x{2018}\x{2019}\x{201c}\x{201d}]', chr(39)), f'[{SP}]+')})"


def words(expr: str) -> str:
    return find_all(f"lower({expr})", WORD)


def custom(expr: str) -> str:
    return find_all(expr, CUSTOM)


def word_list(items: list[str]) -> str:
    return "(" + ", ".join(q(w) for w in items) + ")"


LABELLED = f"""
raw AS (
  SELECT d.doc_id, d.text, d.source, CASE WHEN l.quality = 0 THEN 'fake' ELSE 'real' END AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IN (0, 1)),
corpus AS (
  SELECT doc_id, label, source, clean_text FROM (
    SELECT doc_id, label, source, {clean('text')} AS clean_text FROM raw) WHERE clean_text <> '')"""

POSTINGS = f"""{LABELLED},
tok AS (SELECT doc_id, label, unnest({words('clean_text')}) AS term FROM corpus),
post AS (SELECT doc_id, label, term, count(*) AS tf FROM tok GROUP BY ALL)"""

DOCS = f"""
docs AS (SELECT doc_id, source, {clean('text')} AS clean_text FROM documents)"""

DOC_POSTINGS = f"""{DOCS},
post AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest({words('clean_text')}) AS term FROM docs) GROUP BY ALL)"""

SPLIT = """
parts AS (
  SELECT doc_id, label, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS part FROM (
    SELECT doc_id, label, count(*) OVER (PARTITION BY label) AS n,
      row_number() OVER (PARTITION BY label ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id) AS rn
    FROM corpus))"""


def vocab(limit: int, source: str = "post", name: str = "vocab") -> str:
    return f"""{name} AS (SELECT term, sum(tf)::BIGINT AS corpus_tf, count(*) AS df FROM {source}
  GROUP BY term ORDER BY corpus_tf DESC, term LIMIT {limit})"""


def weights(n_docs: str, smooth: bool, sublinear: bool, source: str = "post",
            vocab_name: str = "vocab", name: str = "w", cols: str = "doc_id, label",
            key: str = "doc_id") -> str:
    idf = (f"ln((1.0 + ({n_docs})) / (1.0 + v.df)) + 1.0" if smooth
           else f"ln(({n_docs})::DOUBLE / v.df) + 1.0")
    tf = "(1.0 + ln(p.tf))" if sublinear else "p.tf"
    pc = ", ".join(f"p.{c.strip()}" for c in cols.split(","))
    return f"""{name}_raw AS (
  SELECT {pc}, p.term, p.tf, {tf} * ({idf}) AS raw FROM {source} p JOIN {vocab_name} v ON p.term = v.term),
{name} AS (
  SELECT {cols}, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})) AS weight FROM {name}_raw)"""
