"""Spelling variants by permuterm rotations.

A word with a terminator has one rotation for each of its characters and one for the
terminator.  Words that differ in one replaced character have rotations that are
equal but for the last character; a word that lacks a character of another has a
whole rotation that equals the other's without its last character.  So rotations are
sorted by what stands before the last character, together with the whole rotations,
and each run of equal keys, a range of the sorted rotations, holds neighbours only.
A run has at most one word for each character of the alphabet and one more, whatever
the number of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, settle

#: Characters of a word, one run in so many has a slip, fewest code points and occurrences of a word,
#: times a form has to be more frequent than a word.
LETTERS, SLIP, MIN_LENGTH, MIN_COUNT, TIMES = r"[A-Za-zÀ-ÿ]+", 199, 6, 5, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks the end of a word; no letter, and before every letter in order.
END = "$"


def words(docs: DataFrame) -> DataFrame:
    """``word, n``: the distinct words of ``docs`` that are long and frequent enough.

    Words are maximal runs of letters with A-Z lowered.  A run whose ``crc32`` with its
    document's id is a multiple of ``SLIP`` loses one code point.  Null texts have no
    words, and runs of a row without id have no slip.
    """
    runs = id_and_text(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run"))
    run = runs.select(F.translate("run", UPPER, LOWER).alias("word"), "doc_id").withColumn(
        "h", F.coalesce(F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary")), F.lit(1)))
    at = F.expr("cast(h % length(word) as int)")
    slipped = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
    word = F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("word"))
    return (run.select(word.alias("word")).filter(F.length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT))


def _rotation(marked: str, at: str) -> str:
    """The rotation of ``marked`` that begins at ``at`` (from 0), as SQL."""
    return f"concat(substring({marked}, {at} + 1), substring({marked}, 1, {at}))"


def rotations(vocabulary: DataFrame) -> DataFrame:
    """``key, word, n, whole, fresh``: every rotation, once whole and once without its last character.

    ``fresh`` is false where the character left out equals the one before it: leaving
    that one out gives the same word, and counts once.
    """
    marked = vocabulary.select("word", "n", F.concat("word", F.lit(END)).alias("marked"), F.length("word").alias("size"))
    whole = (marked.select("word", "n", "marked", F.explode(F.sequence(F.lit(0), F.col("size"))).alias("at"))
             .select(F.expr(_rotation("marked", "at")).alias("key"), "word", "n", F.lit(True).alias("whole"), F.lit(True).alias("fresh")))
    # the character at ``at`` stands last in the rotation that begins after it
    cut = (marked.select("word", "n", "marked", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("at"))
           .select(F.expr("concat(substring(marked, at + 2), substring(marked, 1, at))").alias("key"), "word", "n", F.lit(False).alias("whole"),
                   F.expr("at = 0 OR substring(word, at, 1) <> substring(word, at + 1, 1)").alias("fresh")))
    return whole.unionByName(cut)


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """``word, near, near_n`` for every ordered pair of words of ``vocabulary (word, n)`` that are one edit apart.

    An edit is one inserted, deleted or replaced code point.  Each pair meets in one run
    of equal keys.  Words are distinct and hold no terminator; an empty table gives no rows.
    """
    runs = (rotations(vocabulary).groupBy("key").agg(F.collect_list(F.struct("word", "n", "whole", "fresh")).alias("run"))
            .filter((F.size("run") > 1)))
    one = runs.select(F.explode("run").alias("one"), "run")

    def meets(two: Column) -> Column:
        replaced = ~F.col("one.whole") & ~two["whole"] & (two["word"] != F.col("one.word"))
        shortened = (F.col("one.whole") != two["whole"]) & F.col("one.fresh") & two["fresh"]
        return replaced | shortened

    return (one.select(F.col("one.word").alias("word"), F.explode(F.filter("run", meets)).alias("two"))
            .select("word", F.col("two.word").alias("near"), F.col("two.n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every row of ``forms (word, form)``: the last word that forms lead to.

    Forms lead to ever more frequent words, ``TIMES`` as many at each step, so chains are
    short; each round halves what is left of them.
    """
    steps = settle(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        ahead = steps.filter("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settle(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return steps


def variants(vocabulary: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``vocabulary (word, n)``.

    ``form`` is the most frequent near word (ties: the smallest in code-point order) if
    it is at least ``TIMES`` as frequent, else null; ``root`` follows forms to the last.
    An empty table gives no rows.
    """
    best = neighbours(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    frequent = -F.col("best.less") >= TIMES * F.col("n")
    named = settle(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n")), "forms")
    return named.join(roots(named), "word").select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of ``docs``.

    Repeated rows count each time; extra columns are not read; an empty table gives no rows.
    """
    return variants(settle(words(docs), "words"))
