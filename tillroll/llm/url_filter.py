"""URL rules whose block decisions reach redirect and canonical-link aliases."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, table
from tillroll.llm.components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Where markup does not count: comments, and elements whose content is text.
_NOT_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title)\b.*?(?:</\1\s*>|\z)"
_CANONICAL = (r"""(?is)<link\b[^>]*\srel\s*=\s*(?:"[^">]*\bcanonical\b|'[^'>]*\bcanonical\b|canonical\b)[^>]*>""")
_REFRESH = r"""(?is)<meta\b[^>]*\shttp-equiv\s*=\s*["']?\s*refresh\b[^>]*>"""
_BASE = r"(?is)<base\b[^>]*>"
_HREF = r"""(?is)[\s"']href\s*=\s*["']?\s*([^"'\s>]+)"""
_REFRESH_URL = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)"""
#: Named character references that a url can hold; numbered ones are decoded by number.
_NAMED = {"&amp;": "&", "&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">"}


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for a url without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _best(rules: tuple[Rule, ...], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits; null when none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def address(url: Column) -> Column:
    """What two spellings of one resource share: host, path without closing
    slashes, and the query.  Scheme and fragment go.  Null without a host."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)", 1)
    host = host_of(url)
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), query))


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _decoded(link: Column) -> Column:
    """``link`` with its character references decoded; a number that is no character becomes U+FFFD."""
    def character(number: Column) -> Column:
        char = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        point = F.when(char, number).otherwise(F.lit(0xFFFD).cast("bigint"))
        return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")

    def one(part: Column) -> Column:
        hexed = F.regexp_extract(part, "(?i)^&#x([0-9a-f]+);$", 1)
        number = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(F.regexp_extract(part, "^&#([0-9]+);$", 1))
        out = F.when(part.startswith("&#") & (F.length(part) > 2), _with(number.try_cast("bigint"), character))
        for name, plain in _NAMED.items():
            out = out.when(F.lower(part) == name, plain)
        return out.otherwise(part)

    parts = F.regexp_extract_all(link, F.lit("(?i)(&(?:#[0-9]+|#x[0-9a-f]+|[a-z]+);|[^&]+|&)"), F.lit(1))
    return F.when(link.contains("&"), F.array_join(F.transform(parts, one), "")).otherwise(link)


def _without_dots(url: Column) -> Column:
    """``url`` with the segments ``.`` and ``..`` of its path carried out."""
    def steps(path: Column) -> Column:
        return F.aggregate(
            F.split(path, "/"), F.array().cast("array<string>"),
            lambda done, step: F.when(step == ".", done)
            .when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
            .otherwise(F.concat(done, F.array(step))))

    head, tail = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), F.regexp_extract(url, r"(?s)^[^?#]*([?#].*)$", 1)
    dots = path_of(url).rlike(r"(?:^|/)\.\.?(?:/|$)")
    return F.when(dots, F.concat(head, F.array_join(steps(path_of(url)), "/"), tail)).otherwise(url)


def _absolute(link: Column, url: Column) -> Column:
    """``link`` as found on ``url``: absolute, scheme-relative, host-relative or
    relative to the path, dot segments carried out."""
    def joined(link: Column) -> Column:
        scheme, rooted = F.regexp_extract(url, r"(?s)^(.*?://)", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
        folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*/)", 1)
        return (F.when(link == "", None).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
                .when(link.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), link))
                .when(link.startswith("/"), F.concat(rooted, link))
                .when(link.startswith("?") | link.startswith("#"), F.concat(rooted, path_of(url), link))
                .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
                .otherwise(F.concat(rooted, F.when(folder == "", "/").otherwise(folder), link)))

    return _with(_with(link, joined), _without_dots)


def page_links(rows: DataFrame) -> DataFrame:
    """(src, dst) for every canonical link and refresh redirect of the pages (url, html).

    Every such tag counts, outside comments and scripts; character references
    are decoded, and relative targets start from the page's first base
    element or else from its url.
    """
    marked = rows.where(F.col("html").rlike("(?i)canonical|refresh")).select(
        F.col("url").alias("src"), F.regexp_replace("html", _NOT_MARKUP, "").alias("html"))

    def targets(tag: str, target: str) -> Column:
        return F.transform(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, target, 1))

    links = marked.select("src", _decoded(F.regexp_extract(F.regexp_extract("html", _BASE, 0), _HREF, 1)).alias("base"),
                          F.explode(F.concat(targets(_CANONICAL, _HREF), targets(_REFRESH, _REFRESH_URL))).alias("link"))
    start = F.coalesce(_absolute(F.col("base"), F.col("src")), F.col("src"))
    return links.select("src", _with(start, lambda base: _absolute(_decoded(F.col("link")), base)).alias("dst"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row of ``pages``.

    The longest fitting rule decides.  A url without a rule is an alias of all
    urls that redirects and canonical links connect it with, in either
    direction and over any number of steps; when a rule blocks one of them,
    the alias is blocked too, otherwise it is allowed.  A url's own allow rule
    always comes before what its aliases say.  Link targets count whether or
    not they are pages, and ``redirects`` (src, dst urls, such as a crawler's
    HTTP redirects) adds edges.  ``rules`` is a configured list, part of the
    plan.  A null url, or one without ``://``, has empty host and path, no
    rule and no alias: allowed; it meets no join.  Null html has no links.
    Whole pages are read, however long.  Repeated rows come back as often as
    they came, an empty table gives no rows, and other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    links = materialize(page_links(rows).distinct(), "page-links")
    if redirects is not None:
        links = links.unionByName(redirects.select("src", "dst"))
    links = links.where("src IS NOT NULL AND dst IS NOT NULL").select(
        "src", "dst", address(F.col("src")).alias("a"), address(F.col("dst")).alias("b"))
    links = materialize(links.where("a IS NOT NULL AND b IS NOT NULL").distinct(), "links")
    labels = connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))

    judged = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                         address(F.col("url")).alias("address"))
    rule = _best(rules, F.col("host"), F.col("path"), lambda r: r.host + r.path)
    judged = judged.withColumn("rule", rule).withColumn("ruled", _best(rules, F.col("host"), F.col("path"),
                                                                       lambda r: r.verdict))
    seen = judged.where("address IS NOT NULL").select("address", (F.col("ruled") == "block").alias("bad"))
    for end in ("src", "dst"):
        verdict = _best(rules, host_of(F.col(end)), path_of(F.col(end)), lambda r: r.verdict)
        seen = seen.unionByName(links.select(F.col("a" if end == "src" else "b").alias("address"),
                                             (verdict == "block").alias("bad")))
    bad = seen.where("bad").select("address").distinct()
    group = F.coalesce("component", "address")
    bad = materialize(bad.join(labels, bad["address"] == labels["vertex"], "left").select(group.alias("group")).distinct()
                      .withColumn("aliases_blocked", F.lit(True)), "blocked")  # stored, so that a hot group's join can split
    apart = judged.where("address IS NULL").withColumn("aliases_blocked", F.lit(None).cast("boolean"))
    named = judged.where("address IS NOT NULL")
    out = named.join(labels, named["address"] == labels["vertex"], "left").withColumn("group", group).join(bad, "group", "left")
    out = out.select(*apart.columns).unionByName(apart)
    verdict = F.coalesce("ruled", F.when(F.col("aliases_blocked"), "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages"))


def _sql_best(rules: tuple[Rule, ...], value) -> str:
    cases = sorted(rules, key=lambda r: (-len(r.host) - len(r.path), r))
    return "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
                              f"THEN '{value(r)}'" for r in cases) + " END"


OP5_SQL = f"""
WITH RECURSIVE u AS (
  SELECT page_id, url, html,
         COALESCE(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}'), '') AS host,
         COALESCE(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
j AS (SELECT *, {_sql_best(RULES, lambda r: r.host + r.path)} AS rule, {_sql_best(RULES, lambda r: r.verdict)} AS ruled,
             CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '')
                  || regexp_extract(url, '^.*?://[^/?#]*[^?#]*(\\?[^#]*)', 1, 's') END AS address
      FROM u),
x AS (
  SELECT address AS a, regexp_extract(regexp_extract(html, '<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>', 0, 'si'),
                                      '\\bhref\\s*=\\s*["'']?\\s*([^"''\\s>]+)', 1, 'si') AS link FROM j
  UNION ALL
  SELECT address, regexp_extract(regexp_extract(html, '<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>', 0, 'si'),
                                 '\\burl\\s*=\\s*["'']?\\s*([^"''\\s>]+)', 1, 'si') FROM j),
e AS (SELECT a, translate(regexp_extract(link, '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(link, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
             regexp_extract(link, '^.*?://[^/?#]*[^?#]*(\\?[^#]*)', 1, 's') AS query
      FROM x WHERE link LIKE '%://%' AND a IS NOT NULL),
g AS (SELECT a, host || regexp_replace(path, '/+$', '') || query AS b, {_sql_best(RULES, lambda r: r.verdict)} AS ruled FROM e),
both_ways AS (SELECT a, b FROM g UNION SELECT b, a FROM g),
bad AS (SELECT address AS v FROM j WHERE ruled = 'block' AND address IS NOT NULL UNION
        SELECT b FROM g WHERE ruled = 'block' UNION
        SELECT w.b FROM bad JOIN both_ways w ON w.a = bad.v)
SELECT page_id, host, path, rule,
       COALESCE(ruled, CASE WHEN address IN (SELECT v FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM j
"""
