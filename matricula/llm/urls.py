"""URL filter: stated rules first, for the rest a path-template tree per host.

A path's segments become a template: digits are generalised at once, and a node whose children are many and mostly
seen once gets one wildcard child.  Sibling branches with the same profile (what lies below them in quarter shares, and
their labelled share) become one branch.  A template is rejected if the labelled share of blocked pages, smoothed
towards one half, is high; labels are the pages that a stated rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matricula.llm.text import ascii_lower
from matricula.session import stored

# Verdict, then host and path of each rule.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)

DEPTH = 6  # segments of a template; what lies deeper is one more segment "**"
MANY = 16  # children from which on a node may get a wildcard child
ONCE = 0.2  # and the least share of different children among its paths
SMOOTH = 5.0  # pages' worth of the even prior
REJECT = 0.8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without "://"."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def stated(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (first in the alphabet of equals) and its verdict, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        rule_host, _, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(f"/{rule_path}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _segments(path: Column) -> list[Column]:
    """The first DEPTH segments and a mark for more; digits and long hex strings generalised; null past the end."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    shape = lambda s: F.regexp_replace(F.regexp_replace(s, r"(?i)\b(?=[a-f]*[0-9])[0-9a-f]{12,}\b", "%"), r"[0-9]+", "#")
    some = F.when(path == "", F.array().cast("array<string>")).otherwise(parts)
    return [F.when(F.size(some) > k, shape(F.try_element_at(some, F.lit(k + 1)))) for k in range(DEPTH)] + [F.when(F.size(some) > DEPTH, F.lit("**"))]


def templates(paths: DataFrame) -> DataFrame:
    """paths (host, path, n, n_block, n_allow; one row per host and path) with the column template.

    One pass down the tree for wildcards and one pass up for merging; both count children per node, never pairs."""
    seg = [f"seg_{k}" for k in range(DEPTH + 1)]
    rows = paths.select("*", *[c.alias(s) for s, c in zip(seg, _segments(F.col("path")), strict=True)])
    deepest = rows.agg(F.max(F.size(F.split(F.col("path"), "/")))).first()[0] or 1
    levels = range(min(DEPTH + 1, max(1, deepest)))
    rows = rows.withColumn("node", F.lit(""))
    for k in levels:
        child = rows.where(F.col(seg[k]).isNotNull()).groupBy("host", "node", seg[k]).agg(F.count("*").alias("times"))
        wide = child.groupBy("host", "node").agg(F.count("*").alias("kinds"), F.sum("times").alias("all")).where((F.col("kinds") >= MANY) & (F.col("kinds") >= F.lit(ONCE) * F.col("all"))).select("host", "node", F.lit(True).alias("wide"))
        rows = rows.join(wide, ["host", "node"], "left")
        rows = rows.withColumn(seg[k], F.when(F.col(seg[k]).isNotNull() & F.coalesce("wide", F.lit(False)), F.lit("*")).otherwise(F.col(seg[k]))).drop("wide")
        rows = rows.withColumn("node", F.concat(F.col("node"), F.coalesce(F.concat(F.lit("/"), F.col(seg[k])), F.lit(""))))
        rows = stored(rows, "templates")
    for k in reversed(levels):
        above, below = seg[:k], seg[k + 1:]
        under = F.concat_ws("/", *below) if below else F.lit("")
        inside = rows.where(F.col(seg[k]).isNotNull()).groupBy("host", *above, seg[k], under.alias("under")).agg(F.sum("n").alias("n"), F.sum("n_block").alias("n_block"), F.sum("n_allow").alias("n_allow"))
        branch = inside.groupBy("host", *above, seg[k]).agg(F.sum("n").alias("all"), F.sum("n_block").alias("all_block"), F.sum("n_allow").alias("all_allow"))
        keys = ["host", *above, seg[k]]
        with_all = inside.alias("i").join(branch.alias("b"), [F.col(f"i.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys]).select("i.*", "all", "all_block", "all_allow")
        profile = with_all.groupBy(*keys).agg(
            F.bit_xor(F.xxhash64("under", F.round(F.col("n") * 4 / F.col("all")))).alias("profile"),
            F.first(F.round(4 * purity(F.col("all_block"), F.col("all_allow")))).alias("rate"),
            F.first(F.col("all_block") + F.col("all_allow") > 0).alias("labelled"))
        same = profile.groupBy("host", *above, "profile", "rate", "labelled").agg(F.min(seg[k]).alias("least"), F.count("*").alias("members"))
        renamed = profile.alias("p").join(same.alias("s"), [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("host", *above, "profile", "rate", "labelled")]).where("members > 1").select(
            *[F.col(f"p.{c}").alias(f"r_{c}") for c in keys], F.concat("least", F.lit("~")).alias("merged"))
        joined = rows.join(renamed, [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in keys], "left")
        rows = stored(joined.withColumn(seg[k], F.coalesce("merged", seg[k])).drop("merged", *[f"r_{c}" for c in keys]), "templates")
    return rows.withColumn("template", F.concat(F.lit("/"), F.concat_ws("/", *seg))).drop("node", *seg)


def purity(n_block: Column, n_allow: Column) -> Column:
    """The share of blocked among labelled pages with SMOOTH pages of an even prior; one half without labels."""
    return (n_block + SMOOTH * 0.5) / (n_block + n_allow + SMOOTH)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, template, purity.

    Null urls and such without "://" have an empty host and path and share one template; repeated urls count as often
    as they come; columns other than page_id and url are not read."""
    host, path = split_url(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = stated(F.col("host"), F.col("path"), rules)
    seen = seen.select("*", rule.alias("rule"), verdict.alias("said"))
    paths = seen.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("said") == "block", 1)).alias("n_block"), F.count(F.when(F.col("said") == "allow", 1)).alias("n_allow"))
    tree = templates(paths)
    rates = tree.groupBy("host", "template").agg(F.sum("n_block").alias("all_block"), F.sum("n_allow").alias("all_allow"))
    rates = rates.select("host", "template", purity(F.col("all_block"), F.col("all_allow")).alias("purity"))
    judged = tree.select("host", "path", "template").join(rates, ["host", "template"])
    return seen.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template", "purity")
