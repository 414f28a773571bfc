"""URL filters with redirect equivalence.

A rule names a host and a path. It fits its host and all subdomains where the url's path starts with the rule's; of
those that fit the longest wins, an allow before a block of the same length. A url without a rule gets the decision of
its aliases: pages are linked to the targets of their redirects (`meta` refresh) and of their canonical links, and the
connected components of these links are computed over the whole table, targets that aren't pages included. A component
with a blocked url blocks its members that no rule decides, unless it also has an explicitly allowed url: an explicit
allow takes precedence over propagation. A rule's own verdict is never overturned. What nothing decides is allowed.

Only built-in functions and joins: links are read in one pass over the html, and only urls that have links enter the
iterations. Nodes are whole urls without scheme and fragment, compared as text (host in lower case, an empty path as
`/`), so nothing rests on hashes, and http and https of one address are one node.

Cases: a null url, or one without `://`, has an empty host and path, no rule and no aliases, and is allowed. Null or
empty html has no links. Repeated rows are judged each. Links of a page to itself don't count. Very long pages are one
row of one projection. Relative targets are taken against the page's url, with `&amp;` and the like read as characters
and `.` and `..` resolved; a target that is only a query keeps the page's path. An empty table gives an empty result. All
other columns of the pages are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import lower_ascii
from siltstone.llm.components import connected_components

LINK_TAG, META_TAG = r"(?i)<link\b[^>]*>", r"(?i)<meta\b[^>]*>"
CANONICAL, REFRESH = r"(?i)\srel\s*=\s*[\"']?canonical\b", r"(?i)\shttp-equiv\s*=\s*[\"']?refresh\b"
HREF, TARGET = r"(?i)\shref\s*=\s*[\"']?([^\"'\s>]+)", r"(?i);\s*url\s*=\s*['\"]?([^\"'\s>]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The url as a node `://host/path?query`; null where there is no `://`."""
    rest = F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1)
    rest = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(F.contains(url, F.lit("://")), F.concat(F.lit("://"), host_of(url), rest))


#: Entities that stand in attributes of links.
ENTITIES = (("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&#38;", "&"), ("&amp;", "&"))


def plain(target: Column) -> Column:
    for entity, character in ENTITIES:
        target = F.replace(target, F.lit(entity), F.lit(character))
    return target


def without_dots(path: Column) -> Column:
    """A path that starts with `/`, its segments `.` and `..` resolved."""
    parts = F.split(path, "/", -1)
    none = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    folder = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    resolved = F.concat(F.array_join(F.aggregate(parts, none, step), "/"), folder)
    resolved = F.when(F.startswith(resolved, F.lit("/")), resolved).otherwise(F.concat(F.lit("/"), resolved))
    return F.when(path.rlike(r"/\.\.?(/|$)"), resolved).otherwise(path)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the rule that wins, or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow", r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Edges (a, b) from a page to the targets of its redirects and canonical links."""
    url, html = pages[url_column], pages[html_column]
    tags = lambda kind, mark, value: F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(kind), F.lit(0)), lambda tag: tag.rlike(mark)),
        lambda tag: F.regexp_extract(tag, value, 1),
    )
    found = F.concat(tags(LINK_TAG, CANONICAL, HREF), tags(META_TAG, REFRESH, TARGET))
    linked = html.rlike("(?i)canonical|refresh") & F.contains(url, F.lit("://"))
    rows = pages.where(linked).select(url.alias("url"), F.explode(found).alias("target")).where("target <> ''")
    rows = rows.withColumn("target", plain(F.col("target")))
    root = F.regexp_extract("url", r"^(.*?://[^/?#]*)", 1)
    own_path, target = path_of(F.col("url")), F.regexp_replace("target", "#.*$", "")
    folder = F.concat(F.lit("/"), F.regexp_extract(own_path, "^/(.*/)?", 1))
    rest = F.regexp_extract(target, r"(\?.*)$", 1)
    relative = F.regexp_replace(target, r"\?.*$", "")
    path = F.when(F.startswith(relative, F.lit("/")), relative).when(relative == "", own_path).otherwise(F.concat(folder, relative))
    absolute = (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("x:"), target))
        .otherwise(F.concat(root, without_dots(path), rest))
    )
    return rows.where(target != "").select(node_of(F.col("url")).alias("a"), node_of(absolute).alias("b")).where("a <> b")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict), one for each page."""
    members = connected_components(links(pages, url_column, html_column))
    node = F.col("node")
    decided = members.withColumn("v", rule_for(host_of(node), path_of(node), rules)["verdict"])
    groups = decided.groupBy("component").agg(
        F.max(F.col("v") == "block").alias("blocked"), F.max(F.col("v") == "allow").alias("allowed")
    )
    spread = groups.where("coalesce(blocked, false) and not coalesce(allowed, false)").select("component")
    blocked = members.join(spread, "component", "left_semi").select(F.col("node").alias("_node"), F.lit("block").alias("_by"))
    url = pages[url_column]
    own = pages.select(pages[id_column].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("_n"))
    own = own.withColumn("_r", rule_for(F.col("host"), F.col("path"), rules))
    joined = own.join(blocked, own["_n"] == blocked["_node"], "left")
    verdict = F.coalesce(F.col("_r.verdict"), F.col("_by"), F.lit("allow"))
    return joined.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"))
