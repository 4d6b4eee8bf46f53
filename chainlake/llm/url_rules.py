"""URL filters by redirect equivalence.

URLs are nodes; a redirect or a page's canonical link is an edge. URLs that such edges join are aliases of one page, so what blocks one of
them blocks all that no rule of their own allows: a rule that fits a URL itself always decides for it. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import saved
from chainlake.llm.components import components
from chainlake.session import configured

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rules are broadcast where they name up to this many hosts; more are joined by shuffle. Results are the same.
FEW_HOSTS = 10_000
# Query parameters that say where a visitor came from, and host labels of a site's other faces.
TRACKING = r"(?i)utm_[a-z]+|gclid|fbclid|ref"
FACES = ("www", "m")
# A tag's attribute value: quoted either way or bare.
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


@dataclass(frozen=True)
class Rule:
    """`host` and all its subdomains, where the path starts with `path` (both as they are compared)."""

    verdict: str
    host: str
    path: str

    def __post_init__(self):
        if self.verdict not in ("allow", "block") or not self.host:
            raise ValueError(f"a rule allows or blocks paths of a host: {self}")


# ======== URLs ========


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def _rest(url: Column) -> Column:
    """What follows the first '://', null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(lowered(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def plain_url(url: Column) -> Column:
    """The URL without its fragment, its scheme and host in lower case; null where there is no '://' or no host."""
    scheme = lowered(F.substring_index(url, "://", 1))
    rest = F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(scheme, F.lit("://"), host_of(url), rest))


def moved_url(url: Column) -> Column:
    """Where servers commonly redirect a plain URL: https, no 'www.' or 'm.', no tracking parameters, no '.html', index page or slash at the end."""
    host = F.regexp_replace(host_of(url), rf"^(?:{'|'.join(FACES)})\.([^.]+\.)", "$1")
    path = F.regexp_replace(path_of(url), r"(?:/index)?(?:\.html?|\.php)?/*\z", "")
    asked = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda p: (p != "") & ~p.rlike(rf"^(?:{TRACKING})(?:=|$)"))
    query = F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise("")
    return F.when(host != "", F.concat(F.lit("https://"), host, path, query))


def resolved(link: Column, base: Column) -> Column:
    """A link's absolute URL, seen from the page at `base`; null where it is none of http or https."""
    root = F.regexp_extract(base, r"^[^:]*://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"^[^:]*://[^/?#]*(?:[^?#]*/)?", 0)
    shown = F.regexp_replace(F.regexp_replace(F.trim(link), "&amp;", "&"), r"[\t\n\r]", "")
    absolute = (
        F.when(shown.rlike(r"^(?i)https?://"), shown)
        .when(shown.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(shown.startswith("//"), F.concat(F.substring_index(base, "://", 1), F.lit(":"), shown))
        .when(shown.startswith("/"), F.concat(root, shown))
        .when(shown.startswith("?"), F.concat(F.regexp_extract(base, r"^[^?#]*", 0), shown))
        .when(shown.startswith("#") | (shown == ""), base)
        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), shown))
    )
    return F.when(base.isNotNull(), absolute)


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)\s{name}{_VALUE}"
    return F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)))


def declared_links(html: Column) -> Column:
    """Targets, as they are written, of the canonical links and immediate refreshes among a page's <link> and <meta> tags, outside comments and scripts."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    tags = F.regexp_extract_all(bare, F.lit(r"""(?is)<(?:link|meta)\b(?:[^>"']|"[^"]*"|'[^']*')*>"""), F.lit(0))

    def target(tag):
        canonical = _attribute(tag, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
        refresh = lowered(_attribute(tag, "http-equiv")) == "refresh"
        there = F.regexp_extract(_attribute(tag, "content"), r"(?is)^\s*[\d.]+\s*[;,]\s*(?:url\s*=)?\s*[\"']?([^\"']+)", 1)
        return F.when(canonical, _attribute(tag, "href")).when(refresh, there).otherwise("")

    # Most pages have neither; the plain search is far cheaper than taking the tags apart.
    some = html.rlike(r"(?i)canonical|http-equiv")
    return F.when(some, F.filter(F.transform(tags, target), lambda t: t != "")).otherwise(F.array().cast("array<string>"))


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None, url_column: str = "url", html_column: str | None = "html") -> DataFrame:
    """(one, other): plain URLs that redirects or canonical links make aliases.

    Every page's URL goes to where servers commonly redirect it and to what its html declares; `redirects` (source, target) has further
    ones, as a crawler logs them. URLs without a host are no node.
    """
    url = F.col(url_column).cast("string")
    base = plain_url(url)
    declared = declared_links(F.col(html_column).cast("string")) if html_column else F.array().cast("array<string>")
    there = F.transform(F.coalesce(declared, F.array().cast("array<string>")), lambda link: plain_url(resolved(link, base)))
    found = pages.select(base.alias("one"), there.alias("there")).where("one IS NOT NULL")
    edges = found.select("one", F.explode("there").alias("other"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(plain_url(F.col("source").cast("string")).alias("one"), plain_url(F.col("target").cast("string")).alias("other")))
    edges = saved(edges.where("one IS NOT NULL AND other IS NOT NULL"), "declared")
    nodes = found.select("one").unionByName(edges.select(F.col("other").alias("one")))
    moved = nodes.select("one", moved_url(F.col("one")).alias("other"))
    return edges.unionByName(moved).where("one <> other").distinct()


# ======== rules ========


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """(verdict, host, path) of a list of rules; longer lists come as a table of these columns."""
    parts = [F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path")) for r in rules]
    rows = F.array(*parts).cast("array<struct<verdict:string,host:string,path:string>>")
    return spark.range(1).select(F.inline(rows))


def fitted(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`urls` with column `fit`, the (verdict, rule) of the longest of `rules` (verdict, host, path) that fits a row's `host` and `path`; null
    where none does.

    A host is held against rules by each of its endings, so rules of other hosts are never met. Of rules equally long, one that allows wins.
    """
    rules = rules.where("host <> '' AND path IS NOT NULL AND verdict IN ('allow', 'block')").distinct()
    of_host = rules.groupBy(F.col("host").alias("rule_host")).agg(F.collect_list(F.struct(F.col("path").alias("rule_path"), "verdict")).alias("rules"))
    # Endings with more labels than any rule's host cannot fit.
    size = of_host.agg(F.count("*").alias("hosts"), F.max(F.size(F.split("rule_host", r"\."))).alias("labels")).first()
    ends = F.array(*(F.substring_index("host", ".", -n) for n in range(1, (size["labels"] or 0) + 1))).cast("array<string>")
    met = saved(urls.select("host", "path").distinct(), "hosts").withColumn("rule_host", F.explode(F.array_distinct(ends)))
    joined = met.join(F.broadcast(of_host) if size["hosts"] <= FEW_HOSTS else of_host, "rule_host")
    fits = F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"]))
    ranked = F.transform(fits, lambda r: F.struct(
        (F.length("rule_host") + F.length(r["rule_path"])).alias("size"), (r["verdict"] == "allow").alias("allows"),
        F.struct(r["verdict"].alias("verdict"), F.concat("rule_host", r["rule_path"]).alias("rule")).alias("fit"),
    ))
    best = joined.where(F.size(fits) > 0).select("host", "path", F.array_max(ranked).alias("best")).groupBy("host", "path").agg(F.max("best").alias("best"))
    best = saved(best.select("host", "path", F.col("best.fit").alias("fit")), "fits")
    # Both sides are plain scans: a URL of very many rows is split by AQE.
    return urls.join(best, ["host", "path"], "left").select(urls["*"], "fit")


def judged(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_column: str = "page_id", url_column: str = "url",
    html_column: str | None = "html",
) -> DataFrame:
    """(id, url, host, path, rule, verdict, reason) of every row.

    A rule that fits the URL decides ('rule'). Else a URL is blocked where an alias of it, page or not, is blocked by a rule ('alias'), and
    allowed otherwise ('default'). Null URLs and such without '://' have an empty host and path, no aliases and are allowed. Equal rows stay as they
    are; other columns are not read. Rules without a host or with another verdict are no rules. An empty table gives an empty result.
    """
    configured(pages.sparkSession)
    url = F.col(url_column).cast("string")
    rows = saved(pages.select(F.col(id_column).cast("long").alias("id"), url.alias("url"), plain_url(url).alias("node"), host_of(url).alias("host"), path_of(url).alias("path")), "urls")
    edges = saved(alias_edges(pages, redirects, url_column, html_column), "aliases")
    roots = saved(components(edges, "one", "other"), "roots")
    # Every URL that an edge names can be blocked and pass it on, whether it has a page or not.
    named = edges.select(F.explode(F.array("one", "other")).alias("node")).distinct().select("node", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    blocked = fitted(saved(named, "named"), rules).where("fit.verdict = 'block'").select("node")
    # A component's smallest URL is its root and has no row of its own.
    of_class = blocked.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root")).distinct()
    below = of_class.join(roots, "root").select("node")
    tainted = saved(below.unionByName(of_class.select(F.col("root").alias("node"))).distinct().withColumn("tainted", F.lit(True)), "tainted")
    own = saved(fitted(rows, rules), "ruled")
    found = own.join(tainted, "node", "left").select(own["*"], F.coalesce("tainted", F.lit(False)).alias("tainted"))
    by_alias = F.when(F.col("tainted"), "block").otherwise("allow")
    reason = F.when(F.col("fit").isNotNull(), "rule").when(F.col("tainted"), "alias").otherwise("default")
    return found.select(
        F.col("id").alias(id_column), "url", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_alias).alias("verdict"), reason.alias("reason")
    )
