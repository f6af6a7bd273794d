"""URL filters with redirect equivalence; DataFrame functions only.

Allow and block rules (host, path) fit a host and its subdomains where the url's path starts with the rule's path; the
longest rule that fits decides a url, an allow rule before a block rule of equal length. Urls that no rule fits take the
method's verdict: redirects and canonical links join urls into components, and a block decision reaches every alias in
its component, while a url that an allow rule fits stays allowed. Without a blocked alias the verdict is allow.

Edges come from <link rel=canonical>, from <meta http-equiv=refresh>, from an optional table of redirects, and from urls
that differ only in scheme, letter case of the host, fragment, tracking parameters or a slash at the end; the latter are
one node from the start. Components are found on the edges alone, so pages without links cost two narrow joins.

Defined cases: a null url, or one without ://, has an empty host and path, no rule and no alias, and is allowed; null or
empty html gives no edges; repeated rows are decided alike; an empty table gives an empty result; of other columns only
page_id, url and html are read. Links to urls that are no page still join pages."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import connected_components

#: Query parameters that do not tell pages apart (fixed values).
TRACKING = r"(?i)^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)"
COMMENT = r"(?s)<!--.*?(-->|$)"
TAG = r"(?is)<{name}\s[^>]*>"
#: The value of an attribute, with a white space before its name: quoted in one way or the other, or bare.
ATTRIBUTE = r"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'>\s]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules that the registered query applies (fixed values).
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _raw_host(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(_raw_host(url)), F.lit(""))


def path_of(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.coalesce(F.regexp_extract(F.substring(rest, F.length(_raw_host(url)) + 1, F.length(rest)), r"^[^?#]*", 0), F.lit(""))


def canonical(url: Column) -> Column:
    """The node of a url: host, path without slashes at its end, and the query without tracking parameters; null without ://."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    text = F.concat(host_of(url), F.regexp_replace(path_of(url), r"/+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))
    return F.when(F.instr(url, "://") > 0, text)


def rule_column(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """value(rule) of the longest rule that fits, else null."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.verdict != "allow", r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(value(r))) if out is None else out.when(fits, F.lit(value(r)))
    return F.lit(None).cast("string") if out is None else out


def resolved(base: Column, link: Column) -> Column:
    """An absolute url for a link found at `base`; null for an empty link."""
    link = F.regexp_replace(F.trim(link), "&amp;", "&")
    scheme = F.regexp_extract(base, r"^(.*?)://", 1)
    folder = F.regexp_extract(path_of(base), r"^.*/", 0)
    root = F.concat(scheme, F.lit("://"), _raw_host(base))
    return (
        F.when(link == "", None)
        .when(F.instr(link, "://") > 0, link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


def attribute(tag: Column, name: str) -> Column:
    return F.concat(*[F.regexp_extract(tag, ATTRIBUTE.format(name=name), i) for i in (1, 2, 3)])


def tags(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(TAG.format(name=name)), F.lit(0))


def page_edges(pages: DataFrame) -> DataFrame:
    """(u, v): the nodes that canonical links and refreshes of the pages join. `canonical` may be one of several words of rel; comments hold no tags."""
    html = F.regexp_replace("html", COMMENT, "")
    shown = pages.filter(F.col("url").contains("://") & F.col("html").isNotNull()).select("url", html.alias("html"))
    links = F.transform(F.filter(tags(F.col("html"), "link"), lambda t: attribute(t, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")), lambda t: attribute(t, "href"))
    refreshes = F.transform(F.filter(tags(F.col("html"), "meta"), lambda t: F.lower(F.trim(attribute(t, "http-equiv"))) == "refresh"), lambda t: F.regexp_extract(t, TARGET, 1))
    found = shown.select("url", F.explode(F.concat(links, refreshes)).alias("link"))
    linked = found.filter("link <> ''").select("url", resolved(F.col("url"), F.col("link")).alias("to"))
    return linked.select(canonical(F.col("url")).alias("u"), canonical(F.col("to")).alias("v"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and component of every page; `redirects` has from_url and to_url."""
    url = F.col("url")
    read = pages.select("page_id", url, host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("node"))
    ruled = read.withColumns(
        {"rule": rule_column(F.col("host"), F.col("path"), rules, lambda r: r.text), "decided": rule_column(F.col("host"), F.col("path"), rules, lambda r: r.verdict)}
    )
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionAll(redirects.select(canonical(F.col("from_url")).alias("u"), canonical(F.col("to_url")).alias("v")))
    component = connected_components(edges).withColumnRenamed("component", "root")
    # urls that are no node are joined with nothing: their null keys would all meet in one task
    placed = ruled.filter("node is not null").join(component, "node", "left").withColumn("component", F.coalesce("root", "node"))
    blocked = placed.filter("decided = 'block'").select("component").distinct().withColumn("aliased", F.lit(True))
    verdict = F.coalesce("decided", F.when(F.col("aliased"), "block"), F.lit("allow")).alias("verdict")
    columns = ["page_id", "host", "path", "rule", verdict, "component"]
    apart = ruled.filter("node is null").withColumns({"component": F.lit(None).cast("string"), "aliased": F.lit(False)})
    return placed.join(blocked, "component", "left").select(*columns).unionAll(apart.select(*columns))


def filter_pages(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    return judge(pages, rules, redirects).drop("component")


def _sql_rule(column: str) -> str:
    cases = "".join(
        f" WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{r.text if column == 'rule' else r.verdict}'"
        for r in sorted(RULES, key=lambda r: (-len(r.text), r.verdict != "allow", r.text))
    )
    return f"CASE{cases} END"


def _sql_node(url: str) -> str:
    rest = f"substr({url}, strpos({url}, '://') + 3)"
    host = f"translate(regexp_extract({rest}, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    path = f"regexp_extract(substr({rest}, length(regexp_extract({rest}, '^[^/?#]*')) + 1), '^[^?#]*')"
    kept = f"array_to_string(list_filter(string_split(regexp_extract({url}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}')), '&')"
    return f"CASE WHEN contains({url}, '://') THEN {host} || regexp_replace({path}, '/+$', '') || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END END"


def _sql_attribute(name: str) -> str:
    quoted = [f"regexp_extract(t, '(?is)\\\\s{name}\\\\s*=\\\\s*{q}', 1)" for q in ('"([^"]*)"', "''([^'']*)''", "([^\\\\s>\"'']+)")]
    return f"coalesce(nullif({quoted[0]}, ''), nullif({quoted[1]}, ''), {quoted[2]})".replace("\\\\", "\\")


ORACLE_SQL = f"""
WITH RECURSIVE parsed AS (
  SELECT page_id, url, html,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, url, html, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parsed),
hosted AS (
  SELECT page_id, url, html, translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path, {_sql_node('url')} AS node
  FROM split),
ruled AS (SELECT page_id, host, path, node, {_sql_rule('rule')} AS rule, {_sql_rule('verdict')} AS decided FROM hosted),
bare AS (
  SELECT url, array_to_string(list_transform(string_split(html, '<!--'), lambda x, i: CASE WHEN i = 1 THEN x WHEN contains(x, '-->') THEN substr(x, strpos(x, '-->') + 3) ELSE '' END), '') AS html
  FROM hosted WHERE contains(url, '://')),
tags AS (
  SELECT url, 'link' AS kind, unnest(regexp_split_to_array(html, '(?i)<link\\s')[2:]) AS rest FROM bare
  UNION ALL SELECT url, 'meta', unnest(regexp_split_to_array(html, '(?i)<meta\\s')[2:]) FROM bare),
attributes AS (
  SELECT url, kind, ' ' || split_part(rest, '>', 1) AS t FROM tags WHERE contains(rest, '>')),
links AS (
  SELECT url, {_sql_attribute('href')} AS link FROM attributes WHERE kind = 'link' AND list_contains(regexp_split_to_array(lower({_sql_attribute('rel')}), '\\s+'), 'canonical')
  UNION ALL SELECT url, regexp_extract(t, '(?is)\\burl\\s*=\\s*["'']?([^"''>\\s]+)', 1) FROM attributes WHERE kind = 'meta' AND lower(trim({_sql_attribute('http-equiv')})) = 'refresh'),
targets AS (
  SELECT url, CASE WHEN contains(link, '://') THEN link WHEN starts_with(link, '//') THEN regexp_extract(url, '^(.*?)://', 1) || ':' || link
    ELSE regexp_extract(url, '^.*?://[^/?#]*') || CASE WHEN starts_with(link, '/') THEN link ELSE '/' || link END END AS target
  FROM links WHERE link <> ''),
edges AS (
  SELECT {_sql_node('url')} AS u, {_sql_node('target')} AS v FROM targets
  UNION SELECT {_sql_node('target')}, {_sql_node('url')} FROM targets),
reach(node, other) AS (
  SELECT DISTINCT node, node FROM ruled WHERE node IS NOT NULL
  UNION SELECT r.node, e.v FROM reach r JOIN edges e ON e.u = r.other WHERE e.v IS NOT NULL),
blocked AS (
  SELECT DISTINCT r.node FROM reach r JOIN ruled b ON b.node = r.other WHERE b.decided = 'block')
SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN b.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN blocked b ON b.node = ruled.node
"""
