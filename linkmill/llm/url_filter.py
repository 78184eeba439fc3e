"""URL filter: host and path rules, spread over redirect-equivalent URLs.

A rule decides the URLs it fits. URLs joined by redirects or canonical links form one class; a class with a blocked
member blocks those of its members that no rule decides, unless an allow rule fits some member of the class.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm.common import lower_ascii, table
from linkmill.llm.components import components
from linkmill.session import written


class Rule(NamedTuple):
    """``host`` fits itself and its subdomains, ``path`` is a prefix; ``verdict`` is ``allow`` or ``block``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


#: The policy of the registered query.
RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]

#: Comments, scripts and styles may hold text that looks like a tag. One that isn't closed reaches to the end, so each
#: character is looked at once.
OPAQUE = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_key(url: Column) -> Column:
    """What makes two URLs one node: the URL without its fragment, its scheme and host in lower case."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    scheme = F.regexp_extract(bare, r"(?s)^(.*?://)", 1)
    rest = F.substr(bare, F.length(scheme) + F.length(url_host(bare)) + 1)
    return F.when(scheme != "", F.concat(lower_ascii(scheme), url_host(bare), rest)).otherwise(bare)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule (then the first by text) that fits, as ``struct(rule, verdict)``, or null.

    Rules are a policy that the caller passes as a list, so they are part of the plan and no data is shuffled.
    """
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The last condition that is wrapped around the others is asked first, so the longest rule goes last.
    for r in sorted(set(rules), key=lambda r: (len(str(r)), [-ord(c) for c in str(r)])):
        here = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        fits = F.when(here, F.struct(F.lit(str(r)).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(fits)
    return fits


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"""(?is)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.replace(F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3))), F.lit("&amp;"), F.lit("&"))


def _absolute(target: Column, url: Column) -> Column:
    """``target`` seen from ``url``; null if it names no page of the web. Dot segments stay as they are."""
    t = F.trim(target)
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url_path(url), r"(?s)^(.*/)", 1)
    return (
        F.when((t == "") | t.startswith("#") | (origin == ""), None)
        .when(t.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), t)
        .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t))
        .when(t.startswith("/"), F.concat(origin, t))
        .when(t.startswith("?"), F.concat(origin, url_path(url), t))
        .when(t.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), None)
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), t))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` that pages declare before their body: canonical links and immediate refreshes.

    Rows with a null ``url`` or ``html`` give none.
    """
    bare = F.regexp_replace("html", OPAQUE, " ")
    tags = (
        pages.where("url is not null and html is not null")
        # Most pages declare nothing; this test reads the html as it is and spares them the rest.
        .where(F.col("html").rlike(r"(?i)canonical|refresh"))
        .select("url", bare.alias("bare"))
        .select("url", F.split("bare", r"(?i)<body\b", 2)[0].alias("head"))
        .select("url", F.explode(F.regexp_extract_all("head", F.lit(r"(?is)<(?:link|meta)\b[^>]*+(?:>|\z)"), 0)).alias("tag"))
        .where(F.col("tag").endswith(">"))
    )
    tag = F.col("tag")
    canonical = tag.rlike(r"(?is)^<link\b") & F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"\s+"), "canonical")
    refresh = tag.rlike(r"(?is)^<meta\b") & (F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh")
    moved = F.regexp_extract(
        _attribute(tag, "content"), r"""(?is)^\s*[0-9.]+\s*[;,]\s*(?:url\s*=\s*)?["']?([^"']+)""", 1
    )
    target = F.when(canonical, _attribute(tag, "href")).when(refresh, moved)
    return tags.select(F.col("url").alias("src"), _absolute(target, F.col("url")).alias("dst")).where("dst is not null")


def judge_urls(urls: DataFrame, links: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """``urls`` (any columns, among them ``url``) with host, path, rule, verdict and the verdict's origin.

    ``links`` has string columns ``src`` and ``dst``: redirects, canonical links or any other alias relation. A URL
    that a rule fits has that rule's verdict, whatever its class says. Another URL is allowed if an allow rule fits
    some member of its class, else blocked if a block rule does, else it has ``default``. Members count whether or
    not they are among ``urls``. Columns of ``urls`` named like the new ones are replaced; a null url has empty host
    and path, no rule and the default; repeated rows are judged alike and all returned; empty tables give no rows.
    """
    own = ("host", "path", "rule", "verdict", "origin", "_node", "_fit", "_class")
    kept = [F.col(f"`{c}`") for c in urls.columns if c not in own]
    judged = (
        urls.select(*kept, url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        .withColumn("_fit", fitting_rule(F.col("host"), F.col("path"), rules))
        .withColumn("_node", node_key(F.col("url")))
    )
    edges = written(links.select(node_key(F.col("src")).alias("src"), node_key(F.col("dst")).alias("dst")), "url-links")
    members = components(edges, "src", "dst")
    fit = fitting_rule(url_host(F.col("node")), url_path(F.col("node")), rules)
    # Only the classes that some rule decides are passed on.
    classes = (
        members.withColumn("fit", fit["verdict"])
        .groupBy("component")
        .agg(F.max((F.col("fit") == "allow").cast("int")).alias("a"), F.max((F.col("fit") == "block").cast("int")).alias("b"))
        .where("a is not null or b is not null")
        .select("component", F.when(F.col("a") == 1, "allow").otherwise("block").alias("_class"))
    )
    decided = members.join(classes, "component").select(F.col("node").alias("_node"), "_class")
    return judged.join(decided, "_node", "left").select(
        *[F.col(f"`{c}`") for c in urls.columns if c not in own],
        "host",
        "path",
        F.col("_fit.rule").alias("rule"),
        F.coalesce("_fit.verdict", "_class", F.lit(default)).alias("verdict"),
        F.when(F.col("_fit").isNotNull(), "rule").when(F.col("_class").isNotNull(), "class").otherwise("default").alias("origin"),
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    judged = judge_urls(pages.select("page_id", "url"), page_links(pages), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
with recursive bare as (
  select page_id, url,
    regexp_extract(coalesce(url, ''), '(?s)^(.*?://)', 1) scheme,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) path,
    split_part(url, '#', 1) page, html
  from pages),
heads as (
  select url, path, regexp_extract(url, '(?s)^(.*?)://', 1) scheme, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) origin,
    regexp_split_to_array(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'), '(?i)<body\b')[1] head
  from bare where url is not null and html is not null),
tags as (select url, path, scheme, origin, unnest(regexp_extract_all(head, '(?is)<(?:link|meta)\b[^>]*>')) tag from heads),
attrs as (
  select *,
    lower(concat(regexp_extract(tag, '(?is)[\s"'']rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1), regexp_extract(tag, '(?is)[\s"'']rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2), regexp_extract(tag, '(?is)[\s"'']rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3))) rel,
    lower(concat(regexp_extract(tag, '(?is)[\s"'']http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1), regexp_extract(tag, '(?is)[\s"'']http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2), regexp_extract(tag, '(?is)[\s"'']http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3))) equiv,
    replace(concat(regexp_extract(tag, '(?is)[\s"'']href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1), regexp_extract(tag, '(?is)[\s"'']href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2), regexp_extract(tag, '(?is)[\s"'']href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3)), '&amp;', '&') href,
    replace(concat(regexp_extract(tag, '(?is)[\s"'']content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1), regexp_extract(tag, '(?is)[\s"'']content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2), regexp_extract(tag, '(?is)[\s"'']content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3)), '&amp;', '&') content
  from tags),
targets as (
  select *, trim(case when regexp_matches(tag, '(?is)^<link\b') and list_contains(regexp_split_to_array(rel, '\s+'), 'canonical') then href
    when regexp_matches(tag, '(?is)^<meta\b') and trim(equiv) = 'refresh'
      then regexp_extract(content, '(?is)^\s*[0-9.]+\s*[;,]\s*(?:url\s*=\s*)?["'']?([^"'']+)', 1) end, ' ') t
  from attrs),
resolved as (
  select url src, case when t is null or t = '' or t[1] = '#' or origin = '' then null
    when regexp_matches(t, '(?i)^[a-z][a-z0-9+.-]*://') then t
    when starts_with(t, '//') then scheme || ':' || t
    when starts_with(t, '/') then origin || t
    when starts_with(t, '?') then origin || path || t
    when regexp_matches(t, '(?i)^[a-z][a-z0-9+.-]*:') then null
    else origin || case when regexp_extract(path, '(?s)^(.*/)', 1) = '' then '/' else regexp_extract(path, '(?s)^(.*/)', 1) end || t end dst
  from targets),
ends as (select src, dst from resolved where dst is not null),
keyed as (
  select list_transform([src, dst], lambda u: case when contains(u, '://') then translate(regexp_extract(split_part(u, '#', 1), '(?s)^(.*?://[^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(split_part(u, '#', 1), '(?s)^.*?://[^/?#]*(.*)$', 1) else split_part(u, '#', 1) end) e
  from ends),
arcs as (select e[1] a, e[2] b from keyed union select e[2], e[1] from keyed),
reach(a, b) as (select a, a from arcs union select reach.a, arcs.b from reach join arcs on arcs.a = reach.b),
rules(rule, rhost, rpath, rverdict) as (values ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
places as (select distinct b u, regexp_extract(b, '(?s)^.*?://([^/?#]*)', 1) host, regexp_extract(b, '(?s)^.*?://[^/?#]*([^?#]*)', 1) path from reach),
placed as (select u, arg_max(rverdict, length(rule)) v from places join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by u),
classes as (select a node, case when bool_or(v = 'allow') then 'allow' else 'block' end v from reach join placed on u = b group by a),
fits as (select page_id, arg_max(rule, length(rule)) rule, arg_max(rverdict, length(rule)) v
  from bare join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
select bare.page_id, bare.host, bare.path, fits.rule, coalesce(fits.v, classes.v, 'allow') verdict
from bare left join fits using (page_id)
left join classes on classes.node = case when scheme <> '' then translate(regexp_extract(page, '(?s)^(.*?://[^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(page, '(?s)^.*?://[^/?#]*(.*)$', 1) else page end
"""
