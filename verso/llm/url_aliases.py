"""URL filters with redirect equivalence.

URLs that redirect or point with a canonical link to each other are aliases. Their connected
components, found over the edges in distributed steps, pass block decisions on to the members
that no rule judges; an explicit allow in a component takes precedence over its blocks.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import components, cut

#: Parts over which one component's members are dealt.
SALT = 16


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; '' without ://, and for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), ascii_uppercase, ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_: Column, path_: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does. A rule fits its host and subdomains."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host_ == r.host) | host_.endswith("." + r.host)) & path_.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def plain(url: Column) -> Column:
    """A URL with https for http, its host in lower case and no fragment."""
    whole = F.regexp_replace(url, r"(?s)#.*$", "")
    before, after = F.regexp_extract(whole, r"(?s)^(.*?://)", 1), F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.when(whole.contains("://"), F.concat(F.regexp_replace(before, r"^[Hh][Tt][Tt][Pp][Ss]?://", "https://"), host(whole), after)).otherwise(whole)


def _without_dots(path_: Column) -> Column:
    """A path that begins with /, its . and .. segments applied."""
    parts = F.split(path_, "/")
    kept = lambda a, s: F.when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).when(s == ".", a).otherwise(F.array_append(a, s))
    left = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"), kept)
    folder = F.element_at(parts, -1).isin(".", "..") & (F.size(left) > 0)
    return F.concat(F.lit("/"), F.array_join(left, "/"), F.when(folder, "/").otherwise(""))


def _target(page: Column, link: Column) -> Column:
    """A link's absolute URL, found from the page's; null if it is empty or of a scheme without //."""
    link = F.trim(F.regexp_replace(link, "&amp;", "&"))
    scheme = F.regexp_extract(page, r"(?s)^(.*?)://", 1)
    top = F.concat(scheme, F.lit("://"), host(page))
    own = F.when(path(page) == "", "/").otherwise(path(page))
    to, rest = F.regexp_extract(link, r"(?s)^[^?#]*", 0), F.regexp_extract(link, r"(?s)[?#].*$", 0)
    folder = F.regexp_extract(own, r"(?s)^.*/", 0)
    return (
        F.when(link == "", None)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(top, _without_dots(to), rest))
        .when(link.startswith("?"), F.concat(top, own, link))
        .when(link.startswith("#"), F.concat(F.regexp_replace(page, r"(?s)#.*$", ""), link))
        .otherwise(F.concat(top, _without_dots(F.concat(folder, to)), rest))
    )


_CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*(?:"[^"]*\bcanonical\b[^"]*"|'[^']*\bcanonical\b[^']*'|canonical\b)[^>]*>"""
_REFRESH = r"""(?i)<meta\b[^>]*http-equiv\s*=\s*["']?refresh\b[^>]*>"""
_OG_URL = r"""(?i)<meta\b[^>]*\bproperty\s*=\s*["']?og:url\b[^>]*>"""
_BASE = r"""(?i)<base\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_HREF, _URL, _CONTENT = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", r"""(?i)\burl\s*=\s*["']?([^"'>]+)""", r"""(?i)\bcontent\s*=\s*["']?([^"'\s>]+)"""


def links(pages: DataFrame) -> DataFrame:
    """Edges (src, dst): each page's canonical links, refresh redirects and og:url, absolute.

    pages needs url and html; other columns are ignored. Relative links are resolved against <base>, else
    the page's URL; what stands in comments is none. Pages without html, or whose url has no ://, have
    no edges, nor have empty links and those of other schemes (mailto:). Repeated rows repeat their edges.
    """
    telling = pages.where(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|refresh|og:url"))
    html = F.regexp_replace("html", r"(?s)<!--.*?-->", " ")
    found = telling.select(F.col("url").alias("src"), html.alias("html"))

    def of(tag: str, attribute: str) -> Column:
        return F.transform(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda x: F.regexp_extract(x, attribute, 1))

    each = [of(_CANONICAL, _HREF), of(_REFRESH, _URL), of(_OG_URL, _CONTENT)]
    found = found.select("src", F.regexp_extract("html", _BASE, 1).alias("base"), F.explode(F.concat(*each)).alias("link"))
    found = found.withColumn("base", F.coalesce(_target(F.col("src"), F.col("base")), F.col("src")))
    return found.select("src", _target(F.col("base"), F.col("link")).alias("dst")).where("dst is not null")


def _named(urls: DataFrame) -> DataFrame:
    """(url) to (url, node, check): two hashes, node one of its own for each url; where the first is shared it is mixed with the second."""
    named = cut(urls.distinct().select("url", F.xxhash64("url").alias("node"), F.xxhash64(F.lit("check"), "url").alias("check")))
    clash = cut(named.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node", F.lit(True).alias("clash")))
    if clash.isEmpty():
        return named
    return named.join(clash, "node", "left").select("url", F.when(F.col("clash"), F.col("node").bitwiseXOR(F.col("check"))).otherwise(F.col("node")).alias("node"), "check")


def verdicts(pages: DataFrame, edges: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    pages needs page_id and url, edges src and dst (URLs, as links finds them or a crawl's redirects
    have them); other columns are ignored. URLs that differ in http or https, in the host's case or
    in the fragment are one. A page's rule decides; without one, an allow by a rule anywhere in the
    component of its URL, else a block, else default. A null url, or one without ://, has an empty
    host and path, no rule and the default. Edges with a null end are dropped; an empty table of
    edges leaves the rules alone, an empty table of pages gives no rows. Repeated pages get a row each.
    """
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    own = cut(edges.where("src is not null and dst is not null").select(plain(F.col("src")).alias("src"), plain(F.col("dst")).alias("dst")).where("src <> dst").distinct())
    shown = ["page_id", "host", "path", F.col("r.rule").alias("rule")]
    if own.isEmpty():
        return rows.select(*shown, F.coalesce("r.verdict", F.lit(default)).alias("verdict"))
    ends = cut(_named(own.select(F.explode(F.array("src", "dst")).alias("url"))))
    by = ends.select("url", "node")
    joined = components(own.join(by.toDF("src", "u"), "src").join(by.toDF("dst", "v"), "dst").select("u", "v"))
    # a hub's members are dealt over SALT tasks
    members = joined.join(ends, "node").select("node", "url", "root", F.pmod(F.xxhash64("node"), F.lit(SALT)).alias("salt"))
    judged = members.select("root", rule_of(host(F.col("url")), path(F.col("url")), rules)["verdict"].alias("v")).where("v is not null")
    passed = judged.groupBy("root").agg(F.max(F.col("v") == "allow").alias("allowed")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    by_alias = members.join(passed, ["root", "salt"]).select(F.col("url").alias("__plain"), F.when(F.col("allowed"), "allow").otherwise("block").alias("alias_verdict"))
    decided = rows.where("r is not null").select(*shown, F.col("r.verdict").alias("verdict"))
    rest = rows.where("r is null").withColumn("__plain", plain(F.col("url"))).join(by_alias, "__plain", "left")
    return decided.unionAll(rest.select(*shown, F.coalesce("alias_verdict", F.lit(default)).alias("verdict")))
