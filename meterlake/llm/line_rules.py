"""Quality rules, lines first, with built-in functions alone.

Each line is judged by itself (signs, navigation, boilerplate, shouting, a copy
of an earlier line); failing lines go, and a document that loses too much of its
text, or fails the document rules, is rejected. All of it is one projection over
arrays in the row: no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the rules.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words in 3-word windows found more than once
MOST_SYMBOLS = 10  # percent of a line's characters outside white space
MOST_SHOUTS = 5  # percent of exclamation marks, likewise
MOST_LOST = 40  # percent of a document's characters outside white space
NAVIGATION_MARKS = 3  # vertical bars in a line
BOILERPLATE = (
    "all rights reserved",
    "click here to",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
)


def without(text: Column, chars: str) -> Column:
    """text without the given ASCII characters."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def solid(text: Column) -> Column:
    """Code points outside white space."""
    return F.length(without(text, SPACE_CHARS))


def count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(without(text, chars))


def line_fails(line: Column) -> Column:
    """Does the line break a rule: too many signs, navigation, shouting or a boilerplate phrase?"""
    size = solid(line)
    return (
        (100 * count_of(line, SYMBOLS) > MOST_SYMBOLS * size)
        | (count_of(line, "|") >= NAVIGATION_MARKS)
        | (100 * count_of(line, "!") > MOST_SHOUTS * size)
        | F.lower(line).rlike("|".join(BOILERPLATE))
    )


def judge_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_lost: int = MOST_LOST,
) -> DataFrame:
    """Per row: doc_id, the counts, n_lines, n_kept_lines, clean_text, base_failed, kept.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words describe the
    whole text; ``clean_text`` joins the lines that have a word, break no rule and
    copy no earlier line. ``kept`` is false where the document rules fail or the
    lines left out hold more than ``most_lost`` percent of the characters outside
    white space. A null text counts as empty (it fails for its few words);
    repeated rows and null ids each keep their row.

    Words in repeated windows: windows are hashed, and where all hashes differ
    there is nothing to count. Otherwise (hash, place) pairs are sorted, so that
    equal windows meet, and the places that they cover are counted: n log n.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    df = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    df = df.withColumns(
        {
            "words": words_of(F.col("text")),
            "lines": F.filter(F.split("text", "\n"), lambda line: solid(line) > 0),
        }
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
    )
    df = df.withColumns(
        {
            "windows": F.when(F.size("words") >= 3, windows),
            "kept_lines": F.array_distinct(F.filter("lines", lambda line: ~line_fails(line))),
        }
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
    df = df.withColumn("pairs", F.when(repeats, F.sort_array(pairs)))

    def met(pair: Column, k: Column) -> Column:
        near = [F.get("pairs", k - 1)["hash"], F.get("pairs", k + 1)["hash"]]
        same = near[0].eqNullSafe(pair["hash"]) | near[1].eqNullSafe(pair["hash"])
        return F.when(same, pair["place"])

    df = df.withColumn("places", F.filter(F.transform("pairs", met), lambda p: p.isNotNull()))
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.array(p, p + 1, p + 2))))
    df = df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("places").isNotNull(), F.size(covered)), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("kept_lines").cast("long").alias("n_kept_lines"),
        F.array_join("kept_lines", "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    lost = F.col("word_chars") - solid(F.col("clean_text"))
    return df.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (100 * lost <= most_lost * F.col("word_chars"))
    )
