"""Text cleaning as built-in column expressions (no Python in the tasks).

Character classes are spelled out with Unicode properties because ``\\w`` and
``\\s`` are ASCII-only in Java regular expressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import EMOJI_RANGES, ROMAN_URDU

WORD_CHAR = r"[\p{L}\p{N}_]"
NOT_WORD_CHAR = r"[^\p{L}\p{N}_]"
SPACES = r"\t-\r \x1c-\x1f\x{85}\p{Z}"

TAG = r"<[^>]+>"
URL = rf"[hH][tT][tT][pP][sS]?://[^{SPACES}]+|[wW][wW][wW]\.[^{SPACES}]+"
HASHTAG = rf"#({WORD_CHAR}+)"
HANDLE = rf"@{WORD_CHAR}+"
REPEATED_PUNCT = r"([!?.]){2,}"
CONTROL = r"[\x00-\x1f\x7f-\x9f]"
CURLY_QUOTES = r"[\x{2018}\x{2019}\x{201c}\x{201d}]"
EMOJI = "[" + "".join(
    rf"\x{{{lo:x}}}" if lo == hi else rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in EMOJI_RANGES
) + "]"
#: The same class; what stands before its first range is settled by one comparison.
_EMOJI = rf"[[\x{{{EMOJI_RANGES[0][0]:x}}}-\x{{10ffff}}]&&{EMOJI}]"

#: Names that count without their semicolon, longest first: the longest prefix of a run of letters wins.
BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
ENTITY = rf"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;|(?:{'|'.join(BARE_NAMES)}))"


def strip(col: Column) -> Column:
    """Trim every Unicode space, not only blanks."""
    return F.regexp_replace(F.regexp_replace(col, rf"^[{SPACES}]+", ""), rf"[{SPACES}]+$", "")


def is_blank(col: Column) -> Column:
    return ~col.rlike(rf"[^{SPACES}]")


NAMED_ENTITIES = {f"&{name}": value for name, value in html5.items()}
#: What numbers 128 to 159 stand for: the Windows code page, where it has a character.
WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once and named once in the plan.

    A body that mentions its input several times would otherwise copy the
    whole expression beneath it each time.
    """
    return F.transform(F.array(value), body)[0]


def html_unescape(col: Column) -> Column:
    """Decode named and numeric character references in one left-to-right pass.

    The text is cut into references and the runs between them; each reference
    is looked up (named) or computed from its code point (numeric).  Texts
    without a reference skip the work.
    """
    named = F.from_json(F.lit(json.dumps(NAMED_ENTITIES)), "map<string,string>")

    windows = F.create_map(*[F.lit(x) for n, c in WINDOWS.items() for x in (n, c)])

    def from_code_point(code: Column) -> Column:
        valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        dropped = (code.between(1, 8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF)
                   | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
        safe = F.when(F.coalesce(valid, F.lit(False)), code).otherwise(F.lit(0xFFFD))
        return (F.when(code.between(0x80, 0x9F), windows[code.cast("int")]).when(valid & dropped, "")
                .otherwise(F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")))

    def by_name(piece: Column) -> Column:
        bare = F.regexp_extract(piece, rf"^&(?:{'|'.join(BARE_NAMES)})", 0)
        prefix = F.when(bare != "", F.concat(F.element_at(named, bare), F.substring(piece, F.length(bare) + 1, F.length(piece))))
        return F.coalesce(F.element_at(named, piece), prefix, piece)

    def decode(piece: Column) -> Column:
        hexa = F.conv(F.regexp_extract(piece, r"^&#[xX]0*([0-9a-fA-F]*);?$", 1), 16, 10)
        deci = F.regexp_extract(piece, r"^&#([0-9]+);?$", 1)
        return (
            F.when(~piece.rlike(rf"^{ENTITY}$"), piece)
            .when(piece.rlike("^&#[xX]"), from_code_point(F.coalesce(hexa, F.lit("0")).try_cast("bigint")))
            .when(piece.rlike("^&#"), from_code_point(deci.try_cast("bigint")))
            .otherwise(by_name(piece))
        )

    def whole(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(rf"{ENTITY}|[^&]+|&"), F.lit(0))
        return F.when(text.contains("&") & text.rlike(ENTITY), F.array_join(F.transform(pieces, decode), "")).otherwise(text)

    return let(col, whole)


def strip_tags(col: Column) -> Column:
    return F.regexp_replace(col, TAG, " ")


def strip_urls(col: Column) -> Column:
    return F.regexp_replace(col, URL, " ")


def unwrap_hashtags(col: Column) -> Column:
    return F.regexp_replace(col, HASHTAG, "$1")


def strip_handles(col: Column) -> Column:
    return F.regexp_replace(col, HANDLE, " ")


def strip_markup(col: Column) -> Column:
    """Tags, links and handles become a space; a hashtag keeps its word."""
    return strip_handles(unwrap_hashtags(strip_urls(strip_tags(col))))


def squeeze_punctuation(col: Column) -> Column:
    """A run of ``! ? .`` keeps its last character."""
    return F.regexp_replace(col, REPEATED_PUNCT, "$1")


def strip_emoji(col: Column) -> Column:
    return F.regexp_replace(col, _EMOJI, " ")


def collapse_spaces(col: Column) -> Column:
    """A run of spaces becomes one blank; single blanks, nearly all of them, aren't matched."""
    return F.regexp_replace(col, rf"(?: (?=[{SPACES}])|[{SPACES}&&[^ ]])[{SPACES}]*", " ")


def replace_words(col: Column, pairs: dict[str, str] | None = None) -> Column:
    """Replace whole words; ``col`` must be lower-case already.

    One scan decides whether any key is present; only then is the text cut
    into words and what stands between them, and each word looked up.  Keys
    consist of word characters only.
    """
    pairs = ROMAN_URDU if pairs is None else pairs
    if not pairs:
        return col
    values = F.create_map(*[F.lit(x) for p in pairs.items() for x in p])

    def rewrite(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(rf"{WORD_CHAR}++|{NOT_WORD_CHAR}++"), F.lit(0))
        rewritten = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.element_at(values, p), p)), "")
        # the blank in front lets the scan begin with a character instead of a look behind
        found = F.concat(F.lit(" "), text).rlike(rf"{NOT_WORD_CHAR}(?:{'|'.join(pairs)})(?!{WORD_CHAR})")
        return F.when(found, rewritten).otherwise(text)

    return let(col, rewrite)


def clean_text(col: Column) -> Column:
    """The full cleaning chain, in its fixed order."""
    step = squeeze_punctuation(strip_markup(html_unescape(col)))
    step = F.regexp_replace(strip_emoji(step), CONTROL, " ")
    step = replace_words(F.lower(step))
    step = F.regexp_replace(step, CURLY_QUOTES, "'")
    return F.trim(collapse_spaces(step))
