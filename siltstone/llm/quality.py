"""Line-first quality cleaning.

Every line is judged by itself: does it end like a sentence, is it navigation, mostly links, boilerplate or symbols. Marks
count by their share of the line, so one phrase or a few quotes don't fail a long one.
Lines that fail are removed, and a document that loses too large a share of its text this way is rejected, as is one
that fails the base rules (too few words, or too many words inside repeated three-word windows).

All of it is one narrow projection of built-in functions: no shuffle, no Python. Repeated windows are first looked for
by hash, in linear time; only a document that has any is then sorted by its windows, so results are exact.

Cases: a null text counts as empty: no words, no lines, base_failed. Lines without a word are neither judged nor
removed. Repeated rows are judged each. Very long texts need memory in proportion to their words, in one row. An empty
table gives an empty result. Result columns win over columns of the same name; others are passed through on request.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import SPACE_CHARS, SPACE_CLASS, lower_ascii, words

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

#: A line that reads as text ends so (Latin, Arabic, Devanagari, Ethiopic, Burmese, Khmer, Armenian, CJK), perhaps inside
#: quotes or brackets.
SENTENCE_ENDS, CLOSING = ".!?…:;؟۔।॥።။։។。！？．｡", "\"'”’»)]"
#: Marks of lines that aren't prose. So many of them, and one for every so many characters of words, fail a line; so a
#: long line isn't lost for a few.
SHOUT, SEPARATOR, LINK = "!!", "[|•·]| [›»] ", r"(?i)https?://|www\."
LEAST_SHOUTS, LEAST_SEPARATORS, LEAST_LINKS = 3, 3, 1
CHARS_A_SHOUT, CHARS_A_SEPARATOR, CHARS_A_LINK, CHARS_A_PHRASE = 50, 50, 40, 150
#: Of all characters but white space, in percent.
MOST_SYMBOL_PERCENT = 10
#: Phrases of lines that belong to a site and not to its text.
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "use of cookies",
    "uses cookies",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "licensed under",
    "under the mit license",
    "subscribe to our newsletter",
    "click here to",
    "powered by",
    "skip to content",
)
#: Of the characters of a document's words, lost to removed lines, in percent.
MOST_LOST_PERCENT = 50


#: What a text or line without any of these, or of the phrases, can't fail by besides its end.
MARKS = f"[{SYMBOLS}•·›»]|{SHOUT}|(?i:https?://|www\\.)"


def visible(text: Column) -> Column:
    """Code points that are in words."""
    return F.length(F.translate(text, SPACE_CHARS, ""))


def count_of(text: Column, expression: str) -> Column:
    return F.regexp_count(text, F.lit(expression))


def has_phrase(text: Column) -> Column:
    low = F.lower(text)  # finds all that differ by A-Z, and perhaps more
    return functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(p)) for p in BOILERPLATE])


def line_fails(line: Column, marks: Column, phrases: Column) -> Column:
    """The verdict on one line that has a word, of a text that has marks, or perhaps phrases."""
    seen = visible(line)
    dense = lambda n, least, chars: (n >= least) & (n * chars >= seen)
    marked = (
        dense(count_of(line, SHOUT), LEAST_SHOUTS, CHARS_A_SHOUT)
        | dense(count_of(line, SEPARATOR), LEAST_SEPARATORS, CHARS_A_SEPARATOR)
        | dense(count_of(line, LINK), LEAST_LINKS, CHARS_A_LINK)
        | (count_of(line, f"[{SYMBOLS}]") * 100 > seen * MOST_SYMBOL_PERCENT)
    )
    boilerplate = dense(count_of(line, "(?i)" + "|".join(BOILERPLATE)), 1, CHARS_A_PHRASE)
    end = F.right(F.rtrim(F.rtrim(line, F.lit(SPACE_CHARS)), F.lit(CLOSING)), F.lit(1))
    never = F.lit(False)
    return ~end.isin(*SENTENCE_ENDS) | F.when(marks & line.rlike(MARKS), marked).otherwise(never) | F.when(phrases, boilerplate).otherwise(never)


def has_word(line: Column) -> Column:
    return line.rlike(SPACE_CLASS.replace("[", "[^"))


def repeated_words(df: DataFrame, words_column: str, out: str) -> DataFrame:
    """Adds the number of words in three-word windows that occur twice or more."""
    w, n = F.col(words_column), F.size(words_column)
    zipped = F.arrays_zip(F.slice(w, 1, n - 2).alias("a"), F.slice(w, 2, n - 2).alias("b"), F.slice(w, 3, n - 2).alias("c"))
    hashes = F.when(n > 3, F.transform(zipped, lambda x: F.xxhash64(x))).otherwise(F.array().cast("array<long>"))
    df = df.withColumn("_windows", hashes)
    df = df.withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    at = F.arrays_zip(
        F.slice(w, 1, n - 2).alias("a"),
        F.slice(w, 2, n - 2).alias("b"),
        F.slice(w, 3, n - 2).alias("c"),
        F.sequence(F.lit(0), n - 3).alias("i"),
    )
    df = df.withColumn("_sorted", F.when(F.col("_repeats"), F.sort_array(at)))
    s, m = F.col("_sorted"), F.size("_sorted")
    neighbours = F.arrays_zip(F.slice(s, 1, m - 1).alias("x"), F.slice(s, 2, m - 1).alias("y"))
    same = F.filter(
        neighbours,
        lambda p: (p["x"]["a"] == p["y"]["a"]) & (p["x"]["b"] == p["y"]["b"]) & (p["x"]["c"] == p["y"]["c"]),
    )
    starts = F.sort_array(F.array_distinct(F.flatten(F.transform(same, lambda p: F.array(p["x"]["i"], p["y"]["i"])))))
    df = df.withColumn("_starts", F.when(F.col("_repeats"), starts))
    p, k = F.col("_starts"), F.size("_starts")
    gaps = F.zip_with(F.slice(p, 1, k - 1), F.slice(p, 2, k - 1), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.aggregate(gaps, F.lit(3).cast("long"), lambda total, gap: total + gap)
    return df.withColumn(out, F.when(k > 0, covered).otherwise(F.lit(0).cast("long"))).drop(
        "_windows", "_repeats", "_sorted", "_starts"
    )


def judge(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_text: bool = False) -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, n_failed_lines,
    lost_chars, kept), and with keep_text the cleaned text and all columns of df in `row`."""
    passed = [F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")] if keep_text else []
    own = df.select(df[id_column].alias("doc_id"), F.coalesce(df[text_column].cast("string"), F.lit("")).alias("t"), *passed)
    t = F.col("t")
    own = own.withColumn("w", words(t)).withColumn("lines", F.split(t, "\n", -1))
    own = own.withColumn("n_words", F.size("w").cast("long"))
    # what holds for the text goes into a struct that the outer function names, or it would be worked out for each line
    text = F.struct(F.col("lines").alias("lines"), t.rlike(MARKS).alias("marks"), has_phrase(t).alias("phrases"))
    bad = lambda line, x: has_word(line) & line_fails(line, x["marks"], x["phrases"])
    marked = F.transform(F.array(text), lambda x: F.transform(x["lines"], lambda line: F.struct(line.alias("line"), bad(line, x).alias("bad"))))
    own = own.withColumn("marked", marked[0])
    own = own.withColumn("full", F.filter("lines", has_word))
    own = own.withColumn("failed", F.transform(F.filter("marked", lambda x: x["bad"]), lambda x: x["line"]))
    own = repeated_words(own, "w", "n_repeat_words")
    lost = F.aggregate(F.col("failed"), F.lit(0).cast("long"), lambda total, line: total + visible(line))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)
    columns = [
        "doc_id",
        "n_words",
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count_of(t, f"[{SYMBOLS}]").cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        base_failed.alias("base_failed"),
        F.size("full").cast("long").alias("n_lines"),
        F.size("failed").cast("long").alias("n_failed_lines"),
        lost.alias("lost_chars"),
    ]
    if keep_text:
        clean = F.array_join(F.transform(F.filter("marked", lambda x: ~x["bad"]), lambda x: x["line"]), "\n")
        columns += [F.when(F.size("failed") == 0, t).otherwise(clean).alias("clean_text"), "row"]
    judged = own.select(*columns)
    enough = F.col("lost_chars") * 100 <= F.col("word_chars") * MOST_LOST_PERCENT
    return judged.withColumn("kept", ~F.col("base_failed") & enough)


def clean_documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The kept rows of df with their failed lines removed; all columns stay. A null text never survives."""
    judged = judge(df, id_column, text_column, keep_text=True)
    # a filter on row numbers can't be moved below the projections, where it would work everything out many times over
    kept = judged.withColumn("__at", F.monotonically_increasing_id()).where(F.col("kept") & (F.col("__at") >= 0))
    return kept.select(*[F.col("clean_text").alias(c) if c == text_column else F.col("row")[c].alias(c) for c in df.columns])
