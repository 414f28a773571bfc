"""Personal data: base patterns, and contextual extraction bootstrapped from what they find.

Base spans are the leftmost matches of one expression a kind, kept if they pass that kind's test. They seed the method,
together with a fifth kind that only context can confirm: secrets, whose seeds are long tokens of mixed letters and
digits. Texts are read as tokens: words with what is inside them, runs of digit groups with blanks or brackets between
them, and the punctuation in between. Every token, whatever it looks like, is a possible instance of the lexical patterns
around it: the two tokens before it; the one before with the one after; the one before with the token's own shape. In
rounds a pattern is scored by the share of its distinct instances that are known to be of one kind, an unknown instance
by the patterns that lead to it, and instances of a high score become known, until a round finds none. The two looser
kinds of pattern need more instances and a smoothed share. Unseen tokens in a pattern of high confidence are added as
spans of its kind. Base spans always stay.

The graph holds only what can matter: patterns with enough known instances are the frontier, and all that follows one of
them anywhere is gathered by a pass over the texts, so that a share counts every word there. New instances widen the
frontier by a second pass. Before a pass over all texts, what follows a pattern in a 4096th and then a 64th of them
rules out those whose share can't be reached any more, which are most of those that have their instances by chance. A
pass finds tokens by whole patterns, never by one word of them, and before any becomes a row, so what it makes are the
instances of the patterns looked for. Everything is built from DataFrame functions. Only distinct (pattern, token)
pairs of the frontier and few columns a document are shuffled, never texts; they are aggregated partially first, so a
pattern that a third of all tokens follow is one row to the rest of the plan. Places are worked out for texts with hits
alone.

The expressions are written so that they take linear time on any text: no run is entered twice and no repeated group
recurses. They match what the plain forms in the comments match.

Cases: a null text counts as empty: no spans. Repeated rows each get their spans. Touching base matches of one kind
follow each other; matches of different kinds may overlap. An added span never overlaps a base span. Ties between kinds
of a pattern go to the kind listed first. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import durable

KINDS = ("email", "ip", "card", "phone")
EXPRESSIONS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Seeds of secrets: this many letters and digits, of both, without a blank.
SECRET = r"^(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])[A-Za-z0-9+/_=-]{24,}+$"
#: All kinds, in the order of spans.
ALL_KINDS = (*KINDS, "secret")
_GROUP = r"\(?[0-9][0-9.()-]*+"
#: Tokens: runs of digit groups; from the first to the last letter or digit of a word; other characters.
TOKEN = (
    rf"\+?{_GROUP}(?:[ ]{_GROUP}){{1,8}}+(?![\p{{L}}\p{{N}}@_])"
    r"|[\p{L}\p{N}@+_](?:[^\s]*[\p{L}\p{N}_)])?+"
    r"|[^\s\p{L}\p{N}@+_]++"
)
#: A pattern of two tokens before: so many known instances of one kind, and this share of all its instances.
LEAST_SUPPORT, LEAST_SCORE = 3, 0.7
#: The looser patterns: so many, and the share with so many unknown ones more.
LOOSE_SUPPORT, LOOSE_MORE = 5, 3
#: Rows of patterns or instances that are still broadcast.
BROADCAST_ROWS = 100_000
#: Hashes of patterns up to which the bits that tokens are checked with grow, and how many bits a hash there are.
BROADCAST_HASHES, BITS = 1_000_000, 64
#: Patterns are first tried on one text in so many, one after the other; that only rules out, it never accepts.
PARTS = (4096, 64)
#: So few words are first looked for in whole texts.
FEW_WORDS = 32
#: So many are looked up before a token's patterns are made.
MANY_WORDS = 5_000
MATCHES = "array<struct<s:long,e:long,v:string>>"
SPAN = "struct<kind:string,start:long,end:long>"


def matches(text: Column, expression: str) -> Column:
    """Array of (s, e, v) of all matches, in code points. The pieces between matches give the positions."""
    found, between = F.regexp_extract_all(text, F.lit(expression), F.lit(0)), F.split(text, expression, -1)
    lengths = F.zip_with(
        F.slice(between, 1, F.size(found)), found, lambda gap, v: F.struct(F.length(gap).cast("long").alias("gap"), v.alias("v"))
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(MATCHES).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + F.length(x["v"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v")))).alias("out"))

    return F.aggregate(lengths, start, step, lambda acc: acc["out"])


def passes(kind: str, v: Column) -> Column:
    """The kind's own test on a match."""
    digits = F.translate(v, "+ ().-", "")
    if kind == "ip":
        part = lambda x: F.ltrim(x, F.lit("0"))
        return F.forall(F.split(v, r"\."), lambda x: (F.length(part(x)) <= 3) & (F.lpad(part(x), 3, "0") <= "255"))
    if kind == "card":
        back = F.reverse(digits)
        digit = lambda i: F.substr(back, i, F.lit(1)).cast("int")
        twice = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        luhn = F.aggregate(
            F.sequence(F.lit(1), F.length(digits)),
            F.lit(0),
            lambda total, i: total + F.when(i % 2 == 0, twice(digit(i))).otherwise(digit(i)),
        )
        return F.when(F.length(digits).between(16, 19), luhn % 10 == 0).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def tested(found: Column, kind: str) -> Column:
    return F.filter(found, lambda m: passes(kind, m["v"]))


def as_spans(found: Column, kind: Column) -> Column:
    return F.transform(found, lambda m: F.struct(kind.alias("kind"), m["s"].alias("start"), m["e"].alias("end")))


def text_key(text: Column) -> Column:
    """What a text is known by."""
    return F.concat_ws(":", F.md5(text.cast("binary")), F.length(text))


def scan(df: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """One pass over the texts: `keep`, the text `t`, `th` (what it is known by), and `base`, an array of SPAN."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    own = df.select(*keep, t.alias("t"))
    none = F.array().cast(f"array<{SPAN}>")
    return own.withColumn("th", text_key(F.col("t"))).withColumn("base", F.coalesce(base_spans(F.col("t")), none))


def seed_kind(v: Column) -> Column:
    """The kind that a token is by itself; null for most."""
    out = F.when(F.length(v) >= 24, F.when(v.rlike(SECRET), F.lit("secret")))
    for kind in reversed(KINDS):
        found = F.regexp_extract(v, EXPRESSIONS[kind], 0)
        out = F.when((found != "") & passes(kind, found), F.lit(kind)).otherwise(out)
    return F.when(v.rlike("[0-9@]"), out)


def tokens_of(texts: DataFrame, *keep: str, only=None) -> DataFrame:
    """Rows (keep, i, l2, l1, v, r1): every token, its place, and its neighbours in lower case. `only` picks some by
    (v, l1); their i is then without meaning."""
    w, n = F.col("w"), F.size("w")
    own = texts.select(*keep, F.regexp_extract_all("t", F.lit(TOKEN), F.lit(0)).alias("w"))
    edge = F.array(F.lit(""))
    own = own.select(*keep, "w", F.concat(edge, edge, "w", edge).alias("c"))
    rows = F.arrays_zip(F.slice("c", 1, n).alias("l2"), F.slice("c", 2, n).alias("l1"), w.alias("v"), F.slice("c", 4, n).alias("r1"))
    rows = rows if only is None else F.filter(rows, lambda x: only(x["v"]))
    flat = own.select(*keep, F.posexplode(rows).alias("i", "x"))
    return flat.select(*keep, "i", *[F.lower(f"x.{c}").alias(c) for c in ("l2", "l1")], "x.v", F.lower("x.r1").alias("r1"))


def with_patterns(rows: DataFrame, may: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row for each pattern `p` that a token stands in, which starts with its sort. `may` picks some of them by their
    hashes; the others never become rows."""
    l2, l1, v, r1 = (F.col(c) for c in ("l2", "l1", "v", "r1"))
    shape = F.regexp_replace(F.regexp_replace(v, "[0-9]", "9"), r"\p{L}", "a")
    found = [
        F.when(l2 != "", F.concat(F.lit("2 "), l2, F.lit(" "), l1)),
        F.when((l1 != "") & (r1 != ""), F.concat(F.lit("r "), l1, F.lit(" "), r1)),
        F.when((l1 != "") & v.rlike("[0-9@]"), F.concat(F.lit("s "), l1, F.lit(" "), shape)),
    ]
    if may is not None:
        # columns first: written out at each use, they make methods too long to be compiled
        rows = rows.select("*", *[p.alias(f"p{i}") for i, p in enumerate(found)])
        rows = rows.select("*", *[F.xxhash64(f"p{i}").alias(f"h{i}") for i in range(len(found))])
        found = [F.when(may(F.col(f"h{i}")), F.col(f"p{i}")) for i in range(len(found))]
    return rows.withColumn("p", F.explode(F.array_compact(F.array(*found))))


def _may_be_among(patterns: DataFrame) -> Callable[[Column], Column]:
    """Whether the hash of a pattern may be that of one of patterns (p): all of theirs pass, and hardly any others. Two
    places in one array of bits are looked up, so it takes no join, and no row for what isn't there."""
    spark, hashes = patterns.sparkSession, durable(patterns.select(F.xxhash64("p").alias("h")).distinct())
    size = 1 << max(12, (BITS * min(hashes.count(), BROADCAST_HASHES)).bit_length())
    places = lambda h: [F.pmod(x, F.lit(size)) for x in (h, F.shiftrightunsigned(h, 32))]
    bit = lambda i: F.pmod(i, F.lit(64)).cast("int")
    word = lambda i: F.shiftright(i, 6)
    at = hashes.select(F.explode(F.array(*places(F.col("h")))).alias("i"))
    at = at.select(word("i").alias("id"), bit(F.col("i")).alias("n")).groupBy("id").agg(F.expr("bit_or(shiftleft(1L, n))").alias("bits"))
    filled = spark.range(size >> 6).join(at, "id", "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    row = filled.agg(F.sort_array(F.collect_list(F.struct("id", "bits"))).alias("x")).select(F.col("x.bits").alias("x"))
    bits = durable(row).scalar()
    return lambda h: functools.reduce(lambda a, b: a & b, [F.getbit(F.get(bits, word(i).cast("int")), bit(i)) == 1 for i in places(h)])


def _small(df: DataFrame) -> DataFrame:
    """df, broadcast where a count allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _standing(texts: DataFrame, patterns: DataFrame, *keep: str) -> DataFrame:
    """Rows (keep, i, v, p) of with_patterns() for all tokens that stand in one of patterns (p, l1). Whole patterns are
    looked up by their hashes before they become rows: a word may be common where a pattern with it is rare, and with
    enough patterns all words are named. A few rows of other patterns are left, for a join by p. Only to save time, texts
    that hold none of few such words aren't taken apart, and tokens after none of many are left out before; so are those
    without a shape after words that only patterns with a shape name."""
    shaped = F.startswith(F.col("p"), F.lit("s "))
    listed = patterns.groupBy("l1").agg(F.min(shaped).alias("shaped")).limit(MANY_WORDS + 1).collect()
    if len(listed) <= FEW_WORDS:
        low = F.lower("t")
        texts = texts.where(functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(r[0])) for r in listed], F.lit(False)))
    tokens = tokens_of(texts, *keep)
    if len(listed) <= MANY_WORDS:
        free, bound = ([r.l1 for r in listed if r.shaped == x] for x in (False, True))
        tokens = tokens.where(F.col("l1").isin(free) | (F.col("l1").isin(bound) & F.col("v").rlike("[0-9@]")))
    return with_patterns(tokens, _may_be_among(patterns)).select(*keep, "i", "v", "p")


def _followers(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """Rows (p, l1, v) of all tokens that stand in one of patterns (p, l1)."""
    return _standing(texts, patterns).select("p", "v").join(_small(patterns), "p").select("p", "l1", "v")


def _loose(p: Column) -> Column:
    return ~F.startswith(p, F.lit("2 "))


def _frontier(pairs: DataFrame) -> DataFrame:
    """Patterns (p, l1, known) with enough distinct known instances of one kind, from pairs (p, l1, v, kind)."""
    counts = pairs.groupBy("p", "l1", "kind").agg(F.count_distinct("v").alias("n"))
    known = counts.groupBy("p", "l1").agg(F.max("n").alias("known"))
    return known.where(F.col("known") >= F.when(_loose(F.col("p")), LOOSE_SUPPORT).otherwise(LEAST_SUPPORT)).where(_possible(F.col("known")))


def _possible(n: Column) -> Column:
    """Whether `known` of n instances or more can make a confident pattern."""
    return F.col("known") >= LEAST_SCORE * (n + F.when(_loose(F.col("p")), LOOSE_MORE).otherwise(0)) - 1e-9


def _scored(graph: DataFrame) -> DataFrame:
    """Confident patterns (p, l1, k, score) of the graph (p, l1, v, kind)."""
    by_kind = F.array_sort(F.array(*[F.struct((-F.count(F.when(F.col("kind") == k, 1))).alias("n"), F.lit(i).alias("i")) for i, k in enumerate(ALL_KINDS)]))
    scored = graph.groupBy("p", "l1").agg(F.count("*").alias("n"), by_kind[0].alias("best"))
    scored = scored.withColumn("known", -F.col("best.n"))
    loose = _loose(F.col("p"))
    scored = scored.withColumn("score", F.col("known") / (F.col("n") + F.when(loose, LOOSE_MORE).otherwise(0)))
    enough = F.col("known") >= F.when(loose, LOOSE_SUPPORT).otherwise(LEAST_SUPPORT)
    kind = F.element_at(F.array(*map(F.lit, ALL_KINDS)), F.col("best.i") + 1)
    return scored.where(enough & (F.col("score") >= LEAST_SCORE)).select("p", "l1", kind.alias("k"), "score")


def _accepted(graph: DataFrame, patterns: DataFrame) -> DataFrame:
    """Unknown tokens (v, k) that confident patterns lead to with a high score."""
    led = graph.where("kind is null").select("p", "v").join(patterns, "p")
    miss = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
    by_kind = led.groupBy("v", "k").agg((1 - miss).alias("score")).where(F.col("score") >= LEAST_SCORE - 1e-9)
    order = F.array_position(F.array(*map(F.lit, ALL_KINDS)), F.col("k"))
    return by_kind.groupBy("v").agg(F.max_by("k", F.struct("score", -order)).alias("k"))


class _Graph:
    """What is gathered of the pattern-instance graph: `pairs`, the patterns of known instances, and `rows`, all that
    follows the patterns that can still become confident (p, l1, v, kind)."""

    def __init__(self, found: DataFrame) -> None:
        self.found = found
        seeds = tokens_of(found, only=lambda v: v.rlike("[0-9@]")).withColumn("kind", seed_kind(F.col("v"))).where("kind is not null")
        self.pairs = durable(with_patterns(seeds).select("p", "l1", "v", "kind").distinct())
        self.tested: dict[int, DataFrame] = {}
        self.looked = self.rows = None

    def widen(self, instances: DataFrame | None) -> None:
        """Gather the followers of patterns that have enough known instances by now."""
        able = durable(_frontier(self.pairs))
        # what follows a pattern in a part of the texts alone may be too much already
        for parts in PARTS:
            tested = self.tested.get(parts)
            untested = durable((able if tested is None else able.join(tested, "p", "left_anti")).select("p", "l1"))
            if not untested.isEmpty():
                part = self.found.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == 0)
                counts = _followers(part, untested).distinct().groupBy("p").agg(F.count("*").alias("n"))
                counts = untested.select("p").join(counts, "p", "left").select("p", F.coalesce("n", F.lit(0)).alias("n"))
                tested = self.tested[parts] = durable(counts if tested is None else tested.union(counts))
            if tested is None:
                return
            able = durable(able.join(tested, "p").where(_possible(F.col("n"))).select("p", "l1", "known"))
        able = able.select("p", "l1")
        able = durable(able if self.looked is None else able.join(self.looked, "p", "left_anti"))
        if able.isEmpty():
            return
        self.looked = durable(able if self.looked is None else self.looked.union(able))
        more = _followers(self.found, able).distinct().withColumn("kind", seed_kind(F.col("v")))
        if instances is not None:
            names = instances.select("v", F.col("k").alias("new"))
            more = more.join(names, "v", "left").select("p", "l1", "v", F.coalesce("kind", "new").alias("kind"))
        self.rows = durable(more if self.rows is None else self.rows.union(more))

    def learn(self, new: DataFrame) -> None:
        """Make instances (v, k) known."""
        named = new.select("v", F.col("k").alias("new"))
        self.rows = durable(self.rows.join(named, "v", "left").select("p", "l1", "v", F.coalesce("kind", "new").alias("kind")))
        seen = with_patterns(tokens_of(self.found).join(_small(named), "v")).select("p", "l1", "v", F.col("new").alias("kind"))
        self.pairs = durable(self.pairs.union(seen.distinct()))


def bootstrap(found: DataFrame, rounds: int | None = None) -> tuple[DataFrame, DataFrame] | None:
    """(patterns, instances) of high confidence from scanned rows: (p, l1, k) and (v, k), unseen tokens only; None if no
    pattern can become confident.

    Rounds end with the first that adds no instance, so the patterns are scored with every instance known; each makes at
    least one known, so there is an end. `rounds` stops earlier, with patterns as the last round scored them."""
    graph, instances = _Graph(found), None
    graph.widen(None)
    if graph.rows is None:
        return None
    patterns = None
    for _ in itertools.count() if rounds is None else range(rounds):
        patterns = durable(_scored(graph.rows))
        new = durable(_accepted(graph.rows, patterns))
        if new.isEmpty():
            break
        instances = new if instances is None else durable(instances.union(new))
        graph.learn(new)
        graph.widen(instances)
    if instances is None:
        instances = graph.rows.limit(0).select("v", F.col("kind").alias("k"))
    return patterns, instances


def discovered(found: DataFrame, rounds: int | None = None) -> DataFrame | None:
    """Rows (th, added array<SPAN>): what the method adds to the texts that have any; None if it adds nothing."""
    learned = bootstrap(found, rounds)
    if learned is None:
        return None
    patterns, instances = learned
    if patterns.isEmpty():
        return None
    texts = found.select("th", "t", "base")
    # of the tokens in confident patterns, those that aren't base spans anyway: instances, and seeds of secrets
    rows = _standing(texts, patterns, "th").join(_small(patterns.select("p", "k")), "p")
    known = instances.select("v", "k", F.lit(True).alias("learned"))
    rows = rows.join(_small(known), ["v", "k"], "left").where(F.col("learned") | ((F.col("k") == "secret") & F.col("v").rlike(SECRET)))
    hits = durable(rows.select("th", "i", "k").distinct())
    # places: a running sum of lengths in the texts that have hits
    hit_texts = texts.join(_small(hits.select("th").distinct()), "th", "left_semi").dropDuplicates(["th"])
    tokens = F.regexp_extract_all("t", F.lit(TOKEN), F.lit(0))
    pieces = F.arrays_zip(tokens.alias("v"), F.slice(F.split("t", TOKEN, -1), 1, F.size(tokens)).alias("gap"))
    laid = hit_texts.select("th", F.posexplode(pieces).alias("i", "x"))
    laid = laid.select("th", "i", F.length("x.gap").alias("gap"), F.length("x.v").alias("n"))
    until = Window.partitionBy("th").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = laid.withColumn("e", F.sum(F.col("gap") + F.col("n")).over(until))
    placed = laid.join(hits, ["th", "i"])
    span = F.struct(F.col("k").alias("kind"), (F.col("e") - F.col("n")).alias("start"), F.col("e").alias("end"))
    spans = placed.groupBy("th").agg(F.collect_set(span).alias("added")).join(hit_texts.select("th", "base"), "th")
    free = F.filter("added", lambda x: ~F.exists("base", lambda y: (y["start"] < x["end"]) & (y["end"] > x["start"])))
    return durable(spans.select("th", free.alias("added")).where(F.size("added") > 0))


def all_spans(found: DataFrame, more: DataFrame | None) -> DataFrame:
    """Scanned rows with `added`, an array of SPAN from discovered()."""
    none = F.array().cast(f"array<{SPAN}>")
    if more is None:
        return found.withColumn("added", none)
    return found.join(_small(more), "th", "left").withColumn("added", F.coalesce("added", none))


def in_order(spans: Column) -> Column:
    """By kind as listed, then start, then end."""
    order = F.array(*map(F.lit, ALL_KINDS))
    keyed = F.transform(spans, lambda x: F.struct(F.array_position(order, x["kind"]).alias("k"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.transform(F.sort_array(F.array_distinct(keyed)), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def find_personal_data(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, base array<SPAN>, added array<SPAN>), one for each row of df."""
    found = scan(df, df[text_column], df[id_column].cast("long").alias("doc_id"))
    more = discovered(found.select("t", "th", "base"))
    return all_spans(found.drop("t"), more).select("doc_id", "base", "added")


def count_kind(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from find_personal_data(): counts and the hash are of base spans, `spans` has all; and
    `n_added`, `n_spans`, how many the method added and how many there are."""
    counts = [count_kind(k).alias(f"n_{k}") for k in KINDS]
    sizes = [F.size("added").cast("long").alias("n_added"), (F.size("base") + F.size("added")).cast("long").alias("n_spans")]
    every = written(F.when(F.size("added") == 0, F.col("base")).otherwise(in_order(F.concat("base", "added"))))
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), every.alias("spans"), *sizes)


def redact(df: DataFrame, text_column: str = "text", broadcast_rows: int = 100_000) -> DataFrame:
    """df with every span in its text replaced by its kind in brackets; overlapping spans become one, of the kind that
    starts first. Rows, order of columns and null texts stay."""
    more = discovered(scan(df, df[text_column]))
    text = df[text_column].cast("string")
    row = F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")
    own = df.select(row, text.alias("t"), base_spans(text).alias("base"))
    if more is not None:
        more = F.broadcast(more) if more.count() <= broadcast_rows else more  # a row has at most a few spans
        own = own.withColumn("th", text_key(F.coalesce("t", F.lit("")))).join(more, "th", "left")
        own = own.withColumn("base", F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>"))))
    new = redacted(F.col("t"), F.coalesce("base", F.array().cast(f"array<{SPAN}>")))
    return own.select(*[(new if c == text_column else F.col("row")[c]).alias(c) for c in df.columns])


def base_spans(text: Column) -> Column:
    """Array of SPAN of the base kinds, in one expression."""
    able = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    parts = []
    for kind in KINDS:
        kept = tested(matches(text, EXPRESSIONS[kind]), kind)
        spans = as_spans(kept, F.lit(kind))
        parts.append(F.when(able.get(kind, text.rlike("[0-9]")), spans).otherwise(F.array().cast(f"array<{SPAN}>")))
    return F.concat(*parts)


def redacted(text: Column, spans: Column) -> Column:
    """The text with its spans replaced; of spans with one start the longest gives the kind."""
    by_start = F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("s"), (-x["end"]).alias("m"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substr(text, (acc["at"] + 1).cast("int"), (x["s"] - acc["at"]).cast("int"))
        out = F.when(x["s"] >= acc["at"], F.concat(acc["out"], gap, F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], -x["m"]).alias("at"), out.alias("out"))

    whole = F.aggregate(by_start, start, step, lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
