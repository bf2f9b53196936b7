"""Tokenisers, stopword filters and n-grams over array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import stopwords
from .text import SPACES, WORD_CHAR

#: Runs of word characters with apostrophes between them; no way back is kept, as none is ever taken.
WORD = rf"{WORD_CHAR}++(?:'+{WORD_CHAR}++)*+"
CUSTOM = rf"{WORD}|[\x{{0600}}-\x{{06FF}}]+|[!?.,;:\-]"
CONTRACTION = r"(\p{L})(n't|'(?:s|m|d|ll|re|ve))([^\p{L}\p{N}_']|$)"
TREEBANK = rf"n't|'(?:s|m|d|ll|re|ve)|{WORD}|[^{SPACES}\p{{L}}\p{{N}}_]"

#: Like the one above, but hyphenated words and runs of dots stay whole, and numbers with their separators.
WHOLE = rf"n't|'(?:s|m|d|ll|re|ve)|\.{{2,}}|\p{{N}}+(?:[.,]\p{{N}}+)+|{WORD}(?:-{WORD})*|[^{SPACES}\p{{L}}\p{{N}}_]"

#: ``nltk`` keeps hyphenated words, ``spacy`` cuts them; both split contractions.
PROFILES = {"custom": "custom", "word": "word", "treebank": "treebank",
            "nltk": "whole", "spacy": "treebank"}


def tokenize(col: Column, profile: str = "custom") -> Column:
    """Tokens of a cleaned text as ``ARRAY<STRING>``."""
    try:
        kind = PROFILES[profile]
    except KeyError:
        raise ValueError(f"unknown tokenizer: {profile}") from None
    if kind == "word":
        return F.regexp_extract_all(F.lower(col), F.lit(WORD), F.lit(0))
    if kind == "custom":
        return F.regexp_extract_all(col, F.lit(CUSTOM), F.lit(0))
    split = F.regexp_replace(col, CONTRACTION, "$1 $2$3")
    return F.regexp_extract_all(split, F.lit(WHOLE if kind == "whole" else TREEBANK), F.lit(0))


def word_list(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def in_list(token: Column, words: Sequence[str]) -> Column:
    """Membership test; a literal IN list becomes a hash-set lookup."""
    return F.lower(token).isin(*words) if words else F.lit(False)


def remove_stopwords(tokens: Column, list_name: str) -> Column:
    words = stopwords(list_name)
    return F.filter(tokens, lambda t: ~in_list(t, words)) if words else tokens


def removed_stopwords(tokens: Column, list_name: str) -> Column:
    words = stopwords(list_name)
    if not words:
        return F.array().cast("array<string>")
    return F.filter(tokens, lambda t: in_list(t, words))


def keep_long(tokens: Column, min_length: int) -> Column:
    return F.filter(tokens, lambda t: (F.char_length(t) >= min_length) & (F.trim(t) != ""))


def or_fallback(tokens: Column, cleaned: Column) -> Column:
    """An empty list falls back to the cleaned text, else to ``empty``."""
    fallback = F.when(F.trim(cleaned) != "", F.trim(cleaned)).otherwise(F.lit("empty"))
    return F.when(F.size(tokens) == 0, F.array(fallback)).otherwise(tokens)


def padded(tokens: Column, order: int) -> Column:
    """Start marks (order - 1 of them), the tokens, one end mark."""
    return F.concat(F.array_repeat(F.lit("<s>"), order - 1), tokens, F.array(F.lit("</s>")))


def ngrams(tokens: Column, order: int) -> Column:
    """``ARRAY<STRUCT<w1..wn>>`` of the padded sequence.

    Zips shifted slices instead of indexing inside a lambda: linear work.
    """
    whole = padded(tokens, order)
    count = F.size(tokens) + 1
    shifted = [F.slice(whole, F.lit(i + 1), count).alias(f"w{i + 1}") for i in range(order)]
    fields = ", ".join(f"w{i + 1}: string" for i in range(order))
    return F.arrays_zip(*shifted).cast(f"array<struct<{fields}>>")
