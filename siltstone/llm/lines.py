"""Line dedup by site-relative frequency.

Pages are grouped by host. For every line the number of the host's pages that contain it is divided by the host's page
total, and lines above a ratio are boilerplate of that host and dropped from its pages. A line is known by its text
without white space at the ends; a page counts once however often it repeats the line. Exact copies of a page within a
host are one page in both counts: a document that is copied often isn't boilerplate, and line dedup leaves it to the
removal of duplicates. Lines on fewer than `least_pages` pages stay, so small hosts keep their text.

Counts are exact (pages are told apart by a 64-bit hash of their text) and cover all pages: (host, line digest, page)
and then (host, line digest) are aggregated partially before each shuffle, so the hot line of a hot host is spread over
tasks and then one row a task. A host has at most (mean lines of a page / ratio) boilerplate lines, so they fit one
array a host. Where all these arrays together are small by count they are broadcast and no text moves; else pages join
them on (host, salt), which splits a hot host over `salts` tasks.

Cases: a null text stays null and isn't a page; a null host is a host of its own. Lines without a word are neither
counted nor dropped. A text may end up empty; the row stays. Repeated rows are one page and each loses its lines. Ties
can't arise: a line's ratio is compared with the limit alone, and equal to it stays. An empty table gives an empty
result. All columns stay, whatever their names; columns named like the two results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import SPACE_CHARS, SPACE_CLASS, durable

#: Chosen by the line frequencies of the test tables (README); the same at every size.
MAX_RATIO, LEAST_PAGES = 0.01, 5
#: Boilerplate lines of all hosts together that are still broadcast (32 bytes each and their host), and hosts.
BROADCAST_LINES, BROADCAST_HOSTS = 200_000, 200_000
SALTS = 64


def line_key(line: Column) -> Column:
    return F.md5(F.btrim(line, F.lit(SPACE_CHARS)).cast("binary"))


def has_word(line: Column) -> Column:
    return line.rlike(SPACE_CLASS.replace("[", "[^"))


def host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit("null"))


def page_keys(text: Column) -> Column:
    """The distinct keys of a page's lines that have a word."""
    return F.array_distinct(F.transform(F.filter(F.split(text, "\n", -1), has_word), line_key))


def boilerplate(df: DataFrame, host: str, text: str, max_ratio: float = MAX_RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Rows (host, lines array<string>): the keys of every host's boilerplate lines."""
    t = df[text].cast("string")
    # the null key stands for the page itself, so the same aggregate counts pages
    keys = F.concat(F.array(F.lit(None).cast("binary")), F.transform(page_keys(t), F.unhex))
    pages = df.where(t.isNotNull()).select(host_key(df[host]).alias("host"), F.xxhash64(t).alias("page"), F.explode(keys).alias("k"))
    counts = pages.distinct().groupBy("host", "k").agg(F.count("*").alias("n"))
    often = durable(counts.where(F.col("k").isNull() | (F.col("n") >= least_pages)))
    totals = often.where("k is null").select("host", F.col("n").alias("pages"))
    totals = F.broadcast(totals) if totals.count() <= BROADCAST_HOSTS else totals
    bad = often.where("k is not null").join(totals, "host").where(F.col("n") > F.col("pages") * max_ratio)
    return bad.groupBy("host").agg(F.collect_list(F.lower(F.hex("k"))).alias("lines"))


def drop_boilerplate(
    df: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    least_pages: int = LEAST_PAGES,
    broadcast_lines: int = BROADCAST_LINES,
    salts: int = SALTS,
) -> DataFrame:
    """df with boilerplate lines taken out of its texts, and `__n_lines`, `__n_dropped` (long) added."""
    columns = [c for c in df.columns if c not in ("__n_lines", "__n_dropped")]
    found = durable(boilerplate(df, host, text, max_ratio, least_pages))
    total = found.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0)).alias("n")).first()["n"]
    # the row in one column: no name of its can clash with those of this plan
    row = F.struct(*[df[f"`{c}`"] for c in columns]).alias("row")
    own = df.select(row, host_key(df[host]).alias("host"), df[text].cast("string").alias("t"))
    if total <= broadcast_lines:
        joined = own.join(F.broadcast(found), "host", "left")
    else:
        spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = own.withColumn("salt", F.pmod(F.xxhash64("t"), F.lit(salts)).cast("int")).join(spread, ["host", "salt"], "left")
    lines = F.split("t", "\n", -1)
    judged = joined.withColumn("bad", F.when(F.col("lines").isNotNull(), F.array_intersect(page_keys(F.col("t")), "lines")))
    kept = F.filter(lines, lambda line: ~(has_word(line) & F.array_contains(F.col("bad"), line_key(line))))
    judged = judged.withColumn("kept", F.when(F.size("bad") > 0, kept))
    new = F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col("row")[text])
    dropped = F.when(F.col("kept").isNotNull(), F.size(lines) - F.size("kept")).otherwise(0).cast("long")
    n_lines = F.coalesce(F.size(F.filter(lines, has_word)), F.lit(0)).cast("long")
    out = [(new if c == text else F.col("row")[c]).alias(c) for c in columns]
    return judged.select(*out, n_lines.alias("__n_lines"), dropped.alias("__n_dropped"))
