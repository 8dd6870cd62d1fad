"""URL filters: prefix rules, and block decisions carried over redirects and canonical links.

Rules are matched by expressions in the scan. Redirects (``meta refresh`` or a given table)
and canonical links are edges between URLs; their connected components are equivalent
addresses. A component that holds a blocked URL blocks its members that no rule speaks
about; an explicit allow wins over that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabproof.llm.components import connected_components
from tabproof.llm.spool import spool


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_node(url: Column) -> Column:
    """The address as a node of the alias graph: no fragment, scheme and host in lower case."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    scheme = F.translate(F.regexp_extract(bare, r"(?s)^(.*?)://", 1), _UPPER, _LOWER)
    rest = F.regexp_extract(bare, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(F.locate("://", bare) > 0,
                  F.concat(scheme, F.lit("://"), url_host(url), rest)).otherwise(bare)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, else null.

    A rule fits its host and all subdomains where the path starts with the rule's. Of
    equally long rules an allow comes first. ``rules`` is a short policy in code: it
    becomes one expression.
    """
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "allow", r.text))
    chosen = None
    for rule in order:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen if chosen is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, quoted or bare; empty if the tag has none."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)])


def _absolute(base: Column, link: Column) -> Column:
    """``link`` as seen from the page at ``base``."""
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(F.locate("://", link) > 0, link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(folder, link))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``from_url, to_url``: all canonical links and redirects that each page states.

    A link tag counts if ``canonical`` is a word of its ``rel``, a meta tag if its
    ``http-equiv`` is ``refresh``, wherever else these words stand.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    base = F.coalesce(F.col("url"), F.lit(""))
    links = F.filter(
        F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0)),
        lambda tag: F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"\s+"), "canonical"))
    metas = F.filter(
        F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)),
        lambda tag: F.trim(F.lower(_attribute(tag, "http-equiv"))) == "refresh")
    targets = F.concat(
        F.transform(links, lambda tag: _attribute(tag, "href")),
        F.transform(metas, lambda tag: F.regexp_extract(
            _attribute(tag, "content"), r"""(?is)\burl\s*=\s*["']?([^"'>\s]+)""", 1)))
    # Outer, or Spark would test the size of the targets before and work them out twice.
    links = pages.where(html.rlike("(?i)canonical|refresh")).select(
        base.alias("from_url"), F.explode_outer(targets).alias("link"))
    link = F.replace(F.trim("link"), F.lit("&amp;"), F.lit("&"))
    return links.where(link != "").select(
        url_node(F.col("from_url")).alias("from_url"),
        url_node(_absolute(F.col("from_url"), link)).alias("to_url"),
    ).where("from_url != ''").distinct()


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES,
                redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    The verdict is the rule's where one fits. Elsewhere it is ``block`` if an equivalent
    address is blocked by its rule, else ``allow``. ``redirects`` may add rows of two URLs,
    such as those met while fetching. Null and empty URLs have empty host and path, belong
    to no component and are allowed. Repeated pages get a row each; an empty table none;
    other columns are not looked at.
    """
    links = page_links(pages)
    if redirects is not None:
        a, b = redirects.columns
        links = links.unionByName(redirects.select(
            url_node(F.col(a)).alias("from_url"), url_node(F.col(b)).alias("to_url")))
    members = connected_components(links, "url-aliases").withColumn(
        "said", rule_of(url_host(F.col("node")), url_path(F.col("node")), rules))
    blocked = members.where("said.verdict = 'block'").select("component").distinct()
    blocked = spool(
        members.join(blocked, "component").select(F.col("node").alias("_node")).distinct(),
        "url-blocked")
    thin = pages.select("page_id", "url").select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
        url_node(F.col("url")).alias("node")).withColumn(
        "said", rule_of(F.col("host"), F.col("path"), rules))
    return thin.join(blocked, thin["node"] == blocked["_node"], "left").select(
        "page_id", "host", "path", F.col("said.rule").alias("rule"),
        F.coalesce(F.col("said.verdict"), F.when(F.col("_node").isNotNull(), F.lit("block")),
                   F.lit("allow")).alias("verdict"))
