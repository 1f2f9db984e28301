"""URL filters by redirect equivalence (operator 13), in DataFrame functions only.

A rule is (host, path, verdict). It fits a url whose host is the rule's or a subdomain of it and
whose path begins with the rule's; the longest rule text wins (then the longer host, then allow).
Urls without a rule take the verdict of their aliases: redirect edges (meta refresh, and any table
of redirects handed in) and canonical-link edges join urls to classes, by distributed connected
components. A class with an explicitly allowed url is allowed, else one with a blocked url is
blocked; all other urls are allowed. Link targets count whether or not they are pages themselves.

Two spellings are one node where they ask a server for the same thing: the fragment is left out,
scheme and host are lower-cased, the scheme's own port and dot segments go, an empty path is ``/``.

Null urls and urls without ``://`` have empty host and path, fit no rule and are no node. Null html
has no links. Repeated rows each get the same verdict; extra columns pass through; an empty table
gives no rows. Links inside comments, scripts and style sheets do not count. Of the character
references only those that urls need are decoded (``&amp;`` and the quotes).

A class may hold a third of all pages: edges are hung under least nodes by partial aggregates and
joins that AQE can split, class verdicts are partial aggregates, and only nodes with a link enter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .common import LOWER, UPPER, cut
from .groups import components


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("net", "/", "block"),
    UrlRule("example.net", "/en/", "allow"),
    UrlRule("example.com", "/de/", "block"),
    UrlRule("org", "/fr/", "allow"),
)

_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1|\z)"
_LINK = r"(?i)<link\b[^<>]*>"
_META = r"(?i)<meta\b[^<>]*>"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """The winning rule as a struct (rule, verdict); null if none fits."""
    ranked = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "allow", r.text))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ranked):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _plain_path(path: Column) -> Column:
    """Path without dot segments."""
    def step(done, seg):
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(seg == ".", done).when(seg == "..", up).otherwise(F.concat(done, F.array(seg)))

    parts = F.split(path, "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    last = F.element_at(parts, -1).isin(".", "..")
    joined = F.concat(F.array_join(kept, "/"), F.when(last, F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"/\.{1,2}(?:/|\z)"), F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))).otherwise(path)


def node_of(url: Column) -> Column:
    """The name that all spellings of one url share; null if it has no ``://``."""
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    host = host_of(url)
    port = F.when(scheme == "http", F.regexp_replace(host, r":80\z", "")).when(
        scheme == "https", F.regexp_replace(host, r":443\z", "")).otherwise(host)
    path = _plain_path(path_of(url))
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    name = F.concat(scheme, F.lit("://"), port, F.when(path == "", F.lit("/")).otherwise(path), query)
    return F.when(F.instr(url, "://") > 0, name)


def resolve(base: Column, href: Column) -> Column:
    """The absolute url that ``href`` names on a page at ``base``."""
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    path = path_of(base)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
            .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), href))
            .when(href.startswith("/"), F.concat(root, href))
            .when(href.startswith("?"), F.concat(root, path, href))
            .when((href == "") | href.startswith("#"), base)
            .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
            .otherwise(F.concat(root, folder, href)))


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, quotes removed, white space trimmed."""
    raw = F.regexp_extract(tag, rf"""(?is)[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    bare = F.regexp_replace(raw, r"""(?s)^["'](.*)["']\z""", "$1")
    for ref, char in (("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(ref), F.lit(char))
    return F.trim(bare, F.lit(" \t\n\r\f"))


def links(pages: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between nodes: each page's canonical links and refresh targets."""
    some = pages.filter(F.col("url").contains("://") & F.col("html").rlike(r"(?i)canonical|http-equiv"))
    plain = some.select("url", F.regexp_replace("html", _HIDDEN, " ").alias("html"))
    canonical = F.transform(
        F.filter(F.regexp_extract_all("html", F.lit(_LINK), F.lit(0)),
                 lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical")),
        lambda t: _attribute(t, "href"))
    refresh = F.transform(
        F.filter(F.regexp_extract_all("html", F.lit(_META), F.lit(0)), lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh"),
        lambda t: F.regexp_extract(_attribute(t, "content"), r"""(?is)^[\d.\s]*[;,]\s*url\s*=\s*["']?([^"']*)""", 1))
    hrefs = plain.select("url", F.explode(F.concat(canonical, refresh)).alias("href")).filter("href <> ''")
    return hrefs.select(node_of(F.col("url")).alias("a"), node_of(resolve(F.col("url"), F.col("href"))).alias("b"))


def class_verdicts(edges: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """``edges(a, b)`` -> (node, class_verdict) of each node whose class has a rule."""
    comp = components(edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b"))
    own = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)
    named = cut(comp.select("node", "comp", own["verdict"].alias("own")))
    judged = (named.filter("own IS NOT NULL").groupBy("comp")
              .agg(F.max(F.when(F.col("own") == "allow", 1).otherwise(0)).alias("allowed")))
    return named.join(judged, "comp").select("node", F.when(F.col("allowed") == 1, "allow").otherwise("block").alias("class_verdict"))


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """All columns of ``pages(url, html, ...)`` plus host, path, rule and verdict.

    ``redirects(src, dst)``: further redirects, as absolute urls.
    """
    edges = links(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")))
    verdicts = class_verdicts(edges, rules)
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    found = let(F.struct(host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p")),
                lambda x: F.struct(x["h"].alias("host"), x["p"].alias("path"), rule_of(x["h"], x["p"], rules).alias("r")))
    rows = pages.select(*own, found.alias("__f"), node_of(F.col("url")).alias("__node"))
    named = verdicts.select(F.col("node").alias("__node"), F.col("class_verdict").alias("__class"))
    return rows.join(named, "__node", "left").select(
        *own, F.col("__f.host").alias("host"), F.col("__f.path").alias("path"), F.col("__f.r.rule").alias("rule"),
        F.coalesce("__f.r.verdict", "__class", F.lit("allow")).alias("verdict"))
