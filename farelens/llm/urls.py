"""Url filter with redirect equivalence.

A url's own rule decides first.  Urls that redirect to each other or name each other as
canonical are aliases: their connected component passes decisions on to members without a
rule of their own.  If any member is allowed by a rule, the component allows (explicit allow
precedence); else, if any member is blocked by a rule, it blocks; else it allows.

Aliases are compared as scheme-less urls with the host in lower case and without a fragment.
Defined results: a null url, or one without ``://``, has an empty host and path, no rule and
no alias, and is allowed; a null html names no alias; repeated urls get the same verdict; only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from farelens.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_of(url: Column) -> Column:
    """The url's identity among aliases: host, path and query; null without a host."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), rest))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``, or null.

    A rule ``(verdict, host, path)`` fits its host and the host's subdomains where the path
    starts with the rule's.  Of equally long rules the one with the longer host wins, then
    an allowing one.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0]))
    fits = [
        F.when(((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)),
               F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, h, p in ordered
    ]
    return F.coalesce(*fits)


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``source, target`` urls of canonical links and refresh redirects in the pages."""
    tags = F.filter(
        F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0),
        lambda x: x.rlike(r"(?is)\brel\s*=\s*[\"']?canonical\b|http-equiv\s*=\s*[\"']?refresh\b"))
    quoted = F.regexp_extract(
        "tag", r"(?is)(?:\bhref\s*=|\burl\s*=)\s*[\"']?\s*([^\"'>\s]+)", 1)
    target = F.replace(quoted, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    folder = F.regexp_extract(path_of(F.col(url)), r"(?s)^(.*/)", 1)
    return (
        pages.where(F.col(url).contains("://"))
        .select(F.col(url), F.explode(tags).alias("tag"))
        .select(F.col(url).alias("source"), target.alias("t"), scheme.alias("s"),
                host_of(F.col(url)).alias("h"), folder.alias("f"))
        .where("t <> ''")
        .select("source", F.when(F.col("t").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("t"))
                .when(F.startswith("t", F.lit("//")), F.concat("s", F.lit(":"), "t"))
                .when(F.startswith("t", F.lit("/")), F.concat("s", F.lit("://"), "h", "t"))
                .otherwise(F.concat(F.concat("s", F.lit("://"), "h"),
                                    F.when(F.col("f") == "", "/").otherwise(F.col("f")), "t"))
                .alias("target"))
    )


def judge(pages: DataFrame, edges: DataFrame, rules: Sequence[tuple[str, str, str]],
          page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, inherited`` for every row of ``pages``.

    ``edges`` holds ``source, target`` urls; targets need not be pages.  ``inherited`` tells
    verdicts that come from the component.
    """
    ends = edges.select("source", "target").select(
        alias_of(F.col("source")).alias("u"), alias_of(F.col("target")).alias("v"))
    found = components(ends)
    as_url = F.concat(F.lit("://"), "node")
    ruled = found.select(
        "node", "component",
        rule_for(host_of(as_url), path_of(as_url), rules)["verdict"].alias("own"))
    decided = ruled.groupBy("component").agg(
        F.max(F.col("own") == "allow").alias("allowed"),
        F.max(F.col("own") == "block").alias("blocked"))
    passed = (
        decided.where("blocked OR allowed")
        .select("component", F.when(F.col("allowed"), "allow").otherwise("block").alias("passed"))
        .join(found, "component").select(F.col("node").alias("alias"), "passed")
    )
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.select(
        F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"),
        rule_for(host, path, rules).alias("own"), alias_of(F.col(url)).alias("alias"))
    return rows.join(passed, "alias", "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "passed", F.lit("allow")).alias("verdict"),
        (F.col("own").isNull() & F.col("passed").isNotNull()).alias("inherited"))
