"""URL filter with redirect equivalence.

Rules decide hosts and path prefixes. Pages that redirect to each other or name each other as
canonical are one resource under several addresses: connected components over those links carry a
block decision to every alias, unless one of the aliases is explicitly allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdex.llm.common import ascii_lower, components, stored

#: Up to so many rules are broadcast; more are joined by shuffle.
BROADCAST_RULES = 10_000

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; '' without one."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; '' for null or without `://`."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def resource(url: Column) -> Column:
    """Address without scheme and fragment; an empty path is `/`. Null where there is no host."""
    p = path(url)
    key = F.concat(host(url), F.when(p == "", F.lit("/")).otherwise(p), F.regexp_extract(url, _PARTS, 3))
    return F.when(host(url) != "", key)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict) triples, as a table."""
    rows = F.array(*[
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules
    ])
    if not rules:
        return spark.createDataFrame([], "host string, path string, verdict string")
    return spark.range(1).select(F.inline(rows))


def match_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """Longest fitting rule for each distinct (host, path): columns host, path, rule, decided.

    A rule fits its host and all subdomains if the path starts with the rule's path. The longest
    `host + path` wins; of equally long ones the smallest, and of contradicting copies of one rule
    `allow`. Addresses that no rule fits are left out. Rules with a null are ignored.
    """
    r = rules.where("host is not null and path is not null and verdict is not null").select(
        ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    ).distinct()
    if r.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        r = F.broadcast(r)
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )
    fits = (
        addresses.select("host", "path").distinct()
        .select("host", "path", F.explode(suffixes).alias("r_host"))
        .join(r, "r_host")
        .where(F.startswith("path", F.col("r_path")))
        .withColumn("rule", F.concat("r_host", "r_path"))
    )
    best = F.min(F.struct((-F.length("rule")).alias("n"), "rule", F.col("r_verdict").alias("decided")))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.decided")


def links(pages: DataFrame) -> DataFrame:
    """Redirect (`meta refresh`) and canonical links of `pages` (url, html) as pairs of urls.

    Relative targets are resolved against the page's address; targets of other schemes, empty ones
    and mere fragments are no links.
    """
    tags = F.regexp_extract_all("html", F.lit(r"(?i)(<(?:link|meta)\b[^>]*>)"), F.lit(1))
    tag = F.col("tag")
    value = lambda name: F.regexp_replace(
        F.regexp_extract(tag, rf"""(?i)\b{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1), "^[\"']|[\"']$", ""
    )
    target = F.trim(
        F.when(F.lower(value("rel")).rlike(r"(^|\s)canonical(\s|$)"), value("href")).when(
            F.lower(value("http-equiv")) == "refresh",
            F.regexp_replace(F.regexp_extract(value("content"), r"(?is);\s*url\s*=\s*(.*)$", 1), "^[\"']|[\"']$", ""),
        )
    )
    to, base = F.col("to"), F.concat(F.lit("http://"), host(F.col("url")))
    full = (
        F.when(F.startswith(to, F.lit("//")), F.concat(F.lit("http:"), to))
        .when(F.startswith(to, F.lit("/")), F.concat(base, to))
        .when(to.rlike("(?i)^[a-z][a-z0-9+.-]*://"), to)
        .when(to.rlike("(?i)^[a-z][a-z0-9+.-]*:") | to.startswith("#"), None)
        .when(to.startswith("?"), F.concat(base, "path", to))
        .otherwise(F.concat(base, F.regexp_extract("path", "(?s)^(.*/|)", 1), F.when(F.col("path") == "", "/").otherwise(""), to))
    )
    # `inline` keeps the optimiser from writing each value's expression into all its uses
    found = (
        pages.where(host(F.col("url")) != "")
        .select("url", F.explode(tags).alias("tag"))
        .where(tag.rlike("(?i)canonical|refresh"))
        .select("url", F.inline(F.array(F.struct(target.alias("to"), path(F.col("url")).alias("path")))))
        .where("to != ''")
    )
    return found.select("url", F.inline(F.array(F.struct(full.alias("target"))))).where("target is not null")


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict, alias_of.

    `rule` is the longest fitting rule (null without one) and decides. Elsewhere the component of
    aliases decides: `allow` if any address in it is explicitly allowed, else `block` if any is
    blocked, else `allow`. Linked addresses that are no pages themselves count as aliases too.
    `alias_of` is the smallest address of the component (null for an address without links).

    Null or host-less urls have empty host and path, no rule but one for the empty host, no
    aliases. Null html has no links. Repeated rows and repeated ids are judged each; an empty table
    gives an empty result; other columns are ignored.
    """
    own = pages.select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        resource(F.col("url")).alias("node"),
    )
    found = stored(
        links(pages.select("url", "html")).select(
            resource(F.col("url")).alias("u"), resource(F.col("target")).alias("v"),
            host(F.col("target")).alias("host"), path(F.col("target")).alias("path"),
        ).where("v is not null").distinct(),
        "links",
    )
    matched = stored(match_rules(own.unionByName(found, allowMissingColumns=True), rules), "matched")
    member = components(found)
    nodes = (
        own.where("node is not null").select("node", "host", "path")
        .unionByName(found.select(F.col("v").alias("node"), "host", "path")).distinct()
    )
    group = (
        member.join(nodes, "node").join(matched, ["host", "path"])
        .groupBy("component")
        .agg(F.bool_or(F.col("decided") == "allow").alias("allowed"))
        .withColumn("carried", F.when(F.col("allowed"), "allow").otherwise("block"))
    )
    return (
        own.join(matched, ["host", "path"], "left")
        .join(member, "node", "left")
        .join(group.select("component", "carried"), "component", "left")
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce("decided", "carried", F.lit("allow")).alias("verdict"),
            F.col("component").alias("alias_of"),
        )
    )
