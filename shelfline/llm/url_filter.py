"""URL filter whose block decisions reach the aliases of a URL: redirects and canonical links."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components

ALLOW, BLOCK = "allow", "block"
_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)([^#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, below a path. Rules are configuration: a short list."""

    verdict: str
    host: str
    path: str


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, group), F.lit(""))


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def host_of(url: Column) -> Column:
    """What follows the first ``://``, A-Z lower-cased; empty for null and for a url without ``://``."""
    return _ascii_lower(_part(url, 2))


def path_of(url: Column) -> Column:
    return _part(url, 3)


def _without_dots(path: Column) -> Column:
    """The path without ``.`` and ``..`` segments, each of the latter with the segment before it; ``/`` if empty."""
    dots = F.array(F.lit("."), F.lit(".."))
    parts = F.split(F.substring(path, 2, 1 << 30), "/")
    # What a dot segment at the end leaves behind is a folder.
    ended = F.when(F.array_contains(dots, F.element_at(parts, -1)), F.concat(parts, F.array(F.lit("")))).otherwise(parts)

    def step(kept: Column, part: Column) -> Column:
        above = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(part == "..", above).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(ended, F.array().cast("array<string>"), step)
    clean = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(path == "", F.lit("/")).when(path.rlike(r"/\.{1,2}(/|$)"), clean).otherwise(path)


def node_of(url: Column) -> Column:
    """The url as a graph node: scheme and host lower-cased, without dot segments and fragment, an empty path as ``/``;
    null if it has no ``://``."""
    node = F.concat(_ascii_lower(_part(url, 1)), F.lit("://"), host_of(url), _without_dots(path_of(url)), _part(url, 4))
    return F.when(F.contains(url, F.lit("://")), node)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as struct (rule, verdict), or null; of equally long ones the first in code points."""
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(ordered):
        at_host = (host == rule.host) | host.endswith("." + rule.host)
        named = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(at_host & path.startswith(rule.path), named).otherwise(found)
    return found


def _resolved(href: Column, url: Column) -> Column:
    """``href`` as an absolute url, as seen from ``url``; null if it is empty, of a scheme without hosts, or ``url`` has
    no ``://``."""
    origin = F.concat(_part(url, 1), F.lit("://"), host_of(url))
    folder = F.regexp_replace(path_of(url), "[^/]*$", "")
    return (
        F.when(~F.contains(url, F.lit("://")) | (href == ""), F.lit(None).cast("string"))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(href.startswith("#"), url)
        .when(href.startswith("//"), F.concat(_part(url, 1), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(origin, path_of(url), href))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), href))
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct edges (src, dst) from a page to its canonical link and to the target of a refresh redirect.

    Comments and scripts don't count, ``&amp;`` is decoded, relative links are resolved against the page's first
    ``base`` that has a link, and that against the page's url.
    """
    text, here = F.col(html), F.col(url)
    hint = r"(?i)rel\s*=\s*[\"']?[^\"'>]*canonical|http-equiv\s*=\s*[\"']?\s*refresh"
    marked = F.regexp_replace(text, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")
    value = r"(?is)%s\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"

    def attribute(tag: Column, name: str) -> Column:
        return F.concat(*(F.regexp_extract(tag, value % rf"\s{name}", i) for i in (1, 2, 3)))

    def tags(names: str) -> Column:
        return F.regexp_extract_all(marked, F.lit(rf"(?is)(<(?:{names})\b[^>]*>)"), 1)

    bases = F.filter(F.transform(tags("base"), lambda tag: F.trim(attribute(tag, "href"))), lambda link: link != "")
    found = pages.filter(here.isNotNull() & text.rlike(hint)).select(
        here.alias("_url"), F.get(bases, F.lit(0)).alias("_base"), F.explode(tags("link|meta")).alias("_tag")
    )
    tag = F.col("_tag")
    canonical = tag.rlike(r"(?i)^<link") & attribute(tag, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
    refresh = tag.rlike(r"(?i)^<meta") & attribute(tag, "http-equiv").rlike(r"(?i)^\s*refresh\s*$")
    aim = F.regexp_extract(attribute(tag, "content"), r"(?is)url\s*=\s*[\"']?([^\"']*)", 1)
    href = F.trim(F.regexp_replace(F.when(canonical, attribute(tag, "href")).when(refresh, aim), "&amp;", "&"))
    at = F.coalesce(_resolved(F.regexp_replace("_base", "&amp;", "&"), F.col("_url")), F.col("_url"))
    return (
        found.select(node_of(F.col("_url")).alias("src"), node_of(_resolved(href, at)).alias("dst"))
        .filter("src is not null and dst is not null and src != dst")
        .distinct()
    )


def judge_urls(
    urls: DataFrame, rules: Sequence[Rule], edges: DataFrame, url: str = "url", default: str = ALLOW
) -> DataFrame:
    """``urls`` with host, path, rule and verdict; columns of those names are replaced.

    A url that a rule fits has that rule's verdict. Any other one takes the verdict of its aliases, the urls
    connected with it through ``edges`` (src, dst): allow if a rule explicitly allows one of them, else block
    if a rule blocks one, else ``default``. Aliases need not be rows of ``urls``. A null url, and one without
    ``://``, has empty host and path, no rule and the default verdict. Repeated rows are judged each, and
    equally; an empty table gives no rows. Only aliases are shuffled by component; a url that many rows share
    meets its verdict in a join that Spark can split.
    """
    node = F.col("node")
    members = connected_components(edges.select("src", "dst"), "src", "dst").select(
        "node", "component", fitting_rule(host_of(node), path_of(node), rules)["verdict"].alias("own")
    )
    by_component = members.groupBy("component").agg(F.max(F.col("own") == ALLOW).alias("allowed"), F.max(F.col("own") == BLOCK).alias("blocked"))
    aliases = members.join(by_component, "component").select(
        F.col("node").alias("_node"), F.when(F.col("allowed"), ALLOW).when(F.col("blocked"), BLOCK).alias("_alias_verdict")
    )
    kept = [name for name in urls.columns if name not in ("host", "path", "rule", "verdict")]
    rows = urls.select(*kept, node_of(F.col(url)).alias("_node"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules)).join(aliases, "_node", "left")
    return rows.select(
        *kept,
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_alias_verdict", F.lit(default)).alias("verdict"),
    )
