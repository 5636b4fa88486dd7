"""URL filters by host and path, with decisions that spread over redirects and canonical links. Native only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import connected_components, discard, hot_join, materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules of the production query: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*(?:"(?:[^">]*\s)?canonical[\s"]|'(?:[^'>]*\s)?canonical[\s']|canonical(?:[\s/>]|$)))[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct<size, allow, rule> of the longest rule that fits, or null; of two of one length, one that allows."""
    fits = []
    for verdict, rule_host, rule_path in rules:
        inside = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        fits.append(F.when(inside, F.struct(F.lit(len(rule_host) + len(rule_path)).alias("size"), F.lit(verdict == "allow").alias("allow"), F.lit(rule_host + rule_path).alias("rule"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,allow:boolean,rule:string>")


def node_of(url: Column) -> Column:
    """What a URL names: host, path and query; the scheme and the fragment don't count. Null without '://'."""
    rest = F.regexp_replace(F.regexp_replace(url, r"(?s)^.*?://", ""), r"(?s)#.*$", "")
    host = F.translate(F.regexp_extract(rest, r"^[^/?]*", 0), _UPPER, _LOWER)
    tail = F.regexp_extract(rest, r"(?s)^[^/?]*(.*)$", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host, F.when(F.startswith(tail, F.lit("/")), tail).otherwise(F.concat(F.lit("/"), tail))))


def resolved(target: Column, url: Column) -> Column:
    """A link's target as an absolute URL."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.coalesce(F.nullif(F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    clean = F.regexp_replace(target, "&amp;", "&")
    return (
        F.when(clean == "", None)
        .when(F.regexp_like(clean, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), clean)
        .when(F.startswith(clean, F.lit("//")), F.concat(scheme, F.lit(":"), clean))
        .when(F.regexp_like(clean, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), None)
        .when(F.startswith(clean, F.lit("/")), F.concat(site, clean))
        .when(F.startswith(clean, F.lit("?")), F.concat(site, path_of(url), clean))
        .when(F.startswith(clean, F.lit("#")), None)
        .otherwise(F.concat(site, folder, clean))
    )


def alias_links(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(url, target) from all canonical links and refreshing redirects in html, and from a table (url, target) of redirects."""
    found = F.filter(F.concat(*[F.regexp_extract_all("html", F.lit(x), F.lit(1)) for x in (_CANONICAL, _REFRESH)]), lambda x: x != "")
    links = pages.filter(F.regexp_like("html", F.lit("(?i)canonical|refresh")) & F.col("url").isNotNull()).select("url", F.explode(found).alias("target"))
    links = links.select("url", resolved(F.col("target"), F.col("url")).alias("target"))
    return links if redirects is None else links.unionByName(redirects.select("url", "target"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages.

    A page takes its longest rule's verdict. Without a rule it is blocked if any of its aliases (URLs that redirects
    and canonical links join, in either direction and over any number of steps, whether or not they are pages) is
    blocked by a rule and none is allowed by one; else it is allowed. Null URLs and those without '://' have an empty
    host and path and no aliases. Null html has no links, and of long html all links count. Repeated rows are judged
    each, a null page_id stays null, other columns are not read, and an empty table gives an empty result. rules: at most some hundreds, as they become one expression.
    """
    own = pages.select("page_id", "url")
    judged = own.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("_rule.allow"), "allow").when(F.col("_rule").isNotNull(), "block")
    links = materialize(alias_links(pages.select("page_id", "url", "html"), redirects).filter("target is not null").distinct(), "alias-links")
    if links.isEmpty():
        return judged.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(verdict, F.lit("allow")).alias("verdict"))
    edges = links.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"))
    members = connected_components(edges)
    discard(links)
    as_url = F.concat(F.lit("http://"), F.col("id"))
    ruled = members.withColumn("_rule", matching_rule(host_of(as_url), path_of(as_url), rules))
    decided = ruled.groupBy("component").agg(F.max(F.coalesce(F.col("_rule.allow"), F.lit(False))).alias("allowed"), F.max(F.coalesce(~F.col("_rule.allow"), F.lit(False))).alias("blocked"))
    blocked = materialize(hot_join(members, decided.filter("blocked and not allowed"), "component").select(F.col("id").alias("node"), F.lit(True).alias("_alias_blocked")), "blocked")
    rows = materialize(judged.withColumn("node", F.coalesce(node_of(F.col("url")), F.lit(""))), "judged")
    joined = hot_join(rows, blocked, "node", "left")
    return joined.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(verdict, F.when(F.col("_alias_blocked"), "block"), F.lit("allow")).alias("verdict"))
