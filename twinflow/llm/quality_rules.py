"""Quality rules, line first.

Every line is judged by punctuation, navigation and boilerplate rules. Lines
that fail go; a document that loses too much of its text goes as a whole.

Null and empty texts have no lines, are ``base_failed`` and not kept. Repeated
rows are judged one by one. Extra columns of the input pass through
``clean_lines``; ``judge`` returns only its own columns. Empty tables give
empty results. Everything is a native expression per row: no shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow.llm.common import SPACE, WORD, text_of, words_of

SYMBOLS = "#*$%&|<>"
# marks that end a sentence, with what may close it
ENDING = r"[.!?:;…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$"
NAVIGATION = r"(?i)^[\x20\t]*(home|menu|login|log in|sign in|sign up|next|previous|back to top|skip to content|read more|share|search)\b"
BOILERPLATE = r"(?i)(all rights reserved|privacy policy|terms of (use|service)|cookie|enable javascript|lorem ipsum|subscribe to our|click here)"


def line_fails(line: Column, most_symbols: float = 0.1, least_words: int = 4) -> Column:
    """Whether a line goes.

    Punctuation: a line of several words without an ending mark in which more
    than ``most_symbols`` of the characters are symbols. Navigation: a short
    line that opens with a menu word, or consists of parts between bars.
    Boilerplate: one of the known phrases in a line of under 30 words.
    """
    chars = F.length(line)
    symbols = chars - F.length(F.translate(line, SYMBOLS, ""))
    ended = line.rlike(ENDING)
    blanks = chars - F.length(F.translate(line, " \t", ""))
    short = blanks < 2 * least_words
    bars = chars - F.length(F.translate(line, "|»›", ""))
    punctuation = ~ended & (symbols > most_symbols * chars)
    navigation = ~ended & ((short & line.rlike(NAVIGATION)) | (bars * 4 > blanks + 1) & (bars >= 2))
    boilerplate = (blanks < 30) & line.rlike(BOILERPLATE)
    return punctuation | navigation | boilerplate


def repeated_words(words: Column) -> Column:
    """Words inside a three-word window that occurs more than once.

    Windows are sorted with their places; those equal to a neighbour repeat.
    Sorted places then cover three words each, less what they share.
    """
    windows = F.when(
        F.size(words) >= 4,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i")),
        ),
    )
    return windows


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    t = text_of(text)
    out = docs.withColumn("_words", words_of(t))
    w = F.col("_words")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    out = out.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
            "_lines": lines,
            "_win": repeated_words(w),
        }
    )
    out = out.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hash": F.col("_win.h"),
        }
    )
    repeats = F.size(F.array_distinct("_hash")) < F.size("_hash")
    out = out.withColumn("_sorted", F.when(repeats, F.sort_array("_win")))
    s = F.col("_sorted")
    places = F.sort_array(
        F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        )["i"]
    )
    out = out.withColumn("_places", places)
    covered = F.aggregate(
        F.col("_places"),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return out.drop("_words", "_lines", "_win", "_hash", "_sorted", "_places")


def clean_lines(docs: DataFrame, text: str = "text", **rules) -> DataFrame:
    """The input with ``clean_text`` (lines that pass) and ``n_lines_removed``."""
    lines = F.split(text_of(text), "\n", -1)
    kept = F.filter(lines, lambda x: ~line_fails(x, **rules))
    return docs.withColumn("_kept", kept).withColumns(
        {
            "clean_text": F.array_join("_kept", "\n"),
            "n_lines_removed": (F.size(lines) - F.size("_kept")).cast("long"),
        }
    ).drop("_kept")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most_lost: float = 0.5) -> DataFrame:
    """One row per input row: base counts, ``base_failed``, ``kept`` and the lost share.

    A document goes when the base rules fail, or when its failing lines hold
    more than ``most_lost`` of its word characters.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = clean_lines(base_columns(rows))
    left = F.length(F.regexp_replace("clean_text", SPACE, ""))
    lost = F.when(F.col("word_chars") > 0, 1 - left / F.col("word_chars")).otherwise(F.lit(0.0))
    rows = rows.withColumns(
        {
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "lost_share": lost.cast("double"),
        }
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("lost_share") <= most_lost)).alias("kept"),
        "n_lines_removed",
    )
