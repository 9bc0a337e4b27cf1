"""URL filter with redirect equivalence.

Rules name a host (and its subdomains) and a path prefix; the longest that fits
a url decides.  Pages name their canonical address and redirects in their
head, and a table of redirects may be given: urls that such edges connect are
aliases.  A block rule on any of them blocks those aliases that no rule of
their own decides; an own allow rule always stands.
"""

from __future__ import annotations

import re
import string
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, stored, table
from .graph import connected_components

RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
# a refresh's content: seconds, a separator, and the target, in quotes or not
REFRESH = re.compile(r"\s*[\d.]*\s*[;,]?\s*(?:url\s*=\s*)?(.*)", re.I | re.S)


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A url's identity among aliases: host, path and query, without scheme and fragment; null without ``://``."""
    return _node(after_scheme(url))


def _node(rest: Column) -> Column:
    return F.concat(_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))


class _Head(HTMLParser):
    """The targets of a page's canonical links and refresh redirects, and its base address; comments and scripts hold no tags."""

    def __init__(self):
        super().__init__()
        self.base, self.targets = None, []

    def handle_starttag(self, tag, attrs):
        if tag not in ("link", "meta", "base"):
            return
        given = dict(reversed([(k, v or "") for k, v in attrs]))  # the first of a name counts
        if tag == "base" and self.base is None and "href" in given:
            self.base = given["href"].strip()
        elif tag == "link" and "canonical" in given.get("rel", "").lower().split():
            self.targets.append(given.get("href", "").strip())
        elif tag == "meta" and given.get("http-equiv", "").strip().lower() == "refresh":
            goal = REFRESH.match(given.get("content", ""))[1]
            self.targets.append((goal[1:].split(goal[0])[0] if goal[:1] in ("'", '"') else goal).strip())


def head_targets(html: str) -> tuple[str | None, list[str]]:
    """(base address or None, targets that are not empty) of a page."""
    head = _Head()
    try:
        head.feed(html)
        head.close()
    except AssertionError:  # a declaration that the parser does not know: what stood before it counts
        pass
    return head.base, [t for t in head.targets if t]


_REST = re.compile(r"([^/?#]*)([^?#]*)(\?[^#]*)?", re.S)


def resolved(goal: str, rest: str) -> str:
    """What follows the scheme of a target seen from an address whose ``rest`` follows its scheme, without the fragment.

    Absolute, ``//host``, ``/path``, ``?query``, ``#fragment`` or relative; dot
    segments of the result's path are removed.
    """
    host, path, query = (x or "" for x in _REST.match(rest).groups())
    if "://" in re.split("[?#]", goal, maxsplit=1)[0]:
        host, path, query = (x or "" for x in _REST.match(goal.split("://", 1)[1]).groups())
    elif goal.startswith("//"):
        host, path, query = (x or "" for x in _REST.match(goal[2:]).groups())
    else:
        p, q = re.match(r"([^?#]*)(\?[^#]*)?", goal, re.S).groups()
        if p.startswith("/"):
            path, query = p, q or ""
        elif p:
            path, query = path[: path.rfind("/") + 1] + p if "/" in path else "/" + p, q or ""
        elif q:
            query = q
        else:
            return host + path + query  # the page itself
    parts = []
    for part in path.split("/")[1:]:
        if part == "..":
            parts = parts[:-1]
        elif part != ".":
            parts.append(part)
    if path.rsplit("/", 1)[-1] in (".", ".."):
        parts.append("")
    return host + ("/" + "/".join(parts) if path else "") + query


def alias_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(u, v): nodes of pages and of the targets that their canonical links and refresh redirects name.

    Only pages with such a word are parsed; what is found is written out once.
    """
    url, html = F.col(url_col), F.col(html_col)
    some = pages.filter(F.instr(url, "://") > 0).filter(F.lower(html).rlike("canonical|refresh"))

    def parsed(batches):
        for pdf in batches:
            out = []
            for rest, text in zip(pdf["rest"], pdf["html"]):
                base, targets = head_targets(text)
                seat = resolved(base, rest) if base else rest
                out += [(rest, resolved(t, seat)) for t in targets]
            yield pd.DataFrame(out, columns=["page", "goal"], dtype=object)

    small_batches(pages.sparkSession)
    goals = some.select(after_scheme(url).alias("rest"), html.alias("html")).mapInPandas(parsed, "page string, goal string")
    return stored(goals.select(_node(F.col("page")).alias("u"), _node(F.col("goal")).alias("v")), "url-edges")


def decided(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of the distinct ``places`` (host, path) that a rule fits.

    The host's suffixes meet the rules by equality, the path prefix is checked
    after that; of the rules that fit, the longest (host and path together)
    decides, allow before block.
    """
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    r = rules.select(F.col("action"), _lower(F.col("host")).alias("rhost"), F.col("path").alias("rpath"))
    return (
        places.select("host", "path", F.explode(suffix).alias("rhost"))
        .join(r, "rhost")
        .filter(F.col("path").startswith(F.col("rpath")))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("rhost") + F.length("rpath")).alias("len"),
                    (F.col("action") == "allow").alias("first"),
                    F.concat("rhost", "rpath").alias("rule"),
                    "action",
                )
            ).alias("b")
        )
        .select("host", "path", "b.rule", "b.action")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame | None = None,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, by_alias) of every row.

    ``rules`` has the columns action (allow or block), host and path; a rule
    fits its host and all subdomains where the url's path starts with its path.
    ``redirects`` (from_url, to_url) adds edges to those in the pages' html.
    verdict: the own rule's action; else block if an alias has a block rule;
    else allow.  by_alias marks the second case.  A null url or one without
    ``://`` has an empty host and path, no rule and no alias, and is allowed;
    null html has no edges.  Rows that repeat each get a row; an empty table
    gives an empty result; of equally long rules allow counts; other columns are
    not read.  A very long page needs memory for itself only.

    Rules meet distinct (host, path) pairs, and only urls with edges enter the
    component search, so a hot host costs no more than its distinct paths.
    """
    spark = pages.sparkSession
    if rules is None:
        rules = spark.createDataFrame(RULES, "action string, host string, path string")
    url = F.col(url_col)
    seen = pages.select(
        F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node")
    )
    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("from_url")), node_of(F.col("to_url"))))
    comps = stored(connected_components(edges.filter("u is not null and v is not null")), "url-aliases")
    at = comps.select(
        "node",
        "component",
        F.regexp_extract("node", r"^([^/?]*)", 1).alias("host"),
        F.regexp_extract("node", r"^[^/?]*([^?]*)", 1).alias("path"),
    )
    places = seen.select("host", "path").union(at.select("host", "path")).distinct()
    own = stored(decided(places, rules), "url-rules")
    blocked = at.join(own, ["host", "path"]).filter("action = 'block'").select("component").distinct()
    aliases = comps.join(blocked, "component").select("node", F.lit(True).alias("hit"))
    return (
        seen.join(own, ["host", "path"], "left")
        .join(aliases, "node", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("action", F.when(F.col("hit"), F.lit("block")), F.lit("allow")).alias("verdict"),
            (F.col("action").isNull() & F.coalesce("hit", F.lit(False))).alias("by_alias"),
        )
    )


def op2_url_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))



OP2_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
s AS (
  SELECT page_id, html, url,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         CASE WHEN rest IS NOT NULL THEN regexp_extract(rest, '^[^/?#]*([^#]*)', 1) END AS tail FROM p),
n AS (SELECT *, CASE WHEN tail IS NOT NULL THEN host || tail END AS node FROM s),
live AS (
  SELECT host, path, tail, node, regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS html
    FROM n WHERE node IS NOT NULL AND regexp_matches(html, '(?i)canonical|refresh')),
lists AS (
  SELECT host, path, tail, node, regexp_extract_all(html, '(?is)<(?:link|meta|base)\b(?:[^>"'']|"[^"]*"|''[^'']*'')*>') AS tags FROM live),
tags AS (SELECT host, path, tail, node, unnest(tags) AS tag, generate_subscripts(tags, 1) AS k FROM lists),
attrs AS (
  SELECT host, path, tail, node, k, lower(regexp_extract(tag, '^<(\w+)', 1)) AS kind,
         [replace(replace(replace(replace(replace(trim(trim(trim(
            regexp_extract(tag, '(?is)[\s"'']' || x || '\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '"'), '''')),
            '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x2F;', '/'), '&amp;', '&')
          FOR x IN ['href', 'rel', 'http-equiv', 'content']] AS a FROM tags),
bases AS (SELECT node, arg_min(a[1], k) AS base FROM attrs WHERE kind = 'base' AND a[1] <> '' GROUP BY node),
t AS (
  SELECT DISTINCT host, path, tail, node, base,
         CASE WHEN kind = 'link' THEN a[1]
              ELSE trim(trim(trim(regexp_replace(a[4], '(?is)^\s*[\d.]*\s*[;,]?\s*(?:url\s*=\s*)?', ''), ''''), '"')) END AS goal
    FROM attrs LEFT JOIN bases USING (node)
   WHERE kind = 'link' AND list_contains(string_split_regex(lower(a[2]), '\s+'), 'canonical')
      OR kind = 'meta' AND lower(a[3]) = 'refresh'),
-- one step twice: the base seen from the page, the target seen from the base
step AS (
  SELECT node, goal, 1 AS turn, coalesce(base, '') AS g, host, path, regexp_extract(tail, '(\?.*)$', 1) AS query FROM t WHERE goal <> ''
  UNION ALL
  SELECT node, goal, turn + 1, CASE WHEN turn = 1 THEN goal ELSE '' END,
         CASE WHEN regexp_matches(g, '^[^?#]*://') THEN regexp_extract(g, '://([^/?#]*)', 1)
              WHEN starts_with(g, '//') THEN regexp_extract(g, '^//([^/?#]*)', 1) ELSE host END,
         CASE WHEN g = '' OR starts_with(g, '#') OR starts_with(g, '?') THEN path
              WHEN regexp_matches(g, '^([^?#]*://|//)[^/?#]*([?#]|$)') THEN ''
              ELSE '/' || array_to_string(list_reduce([[x] FOR x IN string_split(
                CASE WHEN regexp_matches(g, '^[^?#]*://') THEN regexp_extract(g, '://[^/?#]*([^?#]*)', 1)
                     WHEN starts_with(g, '//') THEN regexp_extract(g, '^//[^/?#]*([^?#]*)', 1)
                     WHEN starts_with(g, '/') THEN regexp_extract(g, '^([^?#]*)', 1)
                     ELSE CASE WHEN path LIKE '%/%' THEN regexp_extract(path, '^(.*/)', 1) ELSE '/' END || regexp_extract(g, '^([^?#]*)', 1) END
                , '/')[2:] IF x <> '.'],
                lambda u, w: CASE WHEN w[1] = '..' THEN u[:-2] ELSE list_concat(u, w) END, []::VARCHAR[]), '/') END,
         CASE WHEN g = '' OR starts_with(g, '#') THEN query ELSE regexp_extract(g, '^[^?#]*(\?[^#]*)', 1) END
    FROM step WHERE turn < 3),
a AS (SELECT node, host || path || query AS r FROM step WHERE turn = 3),
e AS (
  SELECT node AS x, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') || regexp_extract(r, '^[^/?#]*([^#]*)', 1) AS y FROM a),
b AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach AS (SELECT x AS node, x AS other FROM b UNION SELECT reach.node, b.y FROM reach JOIN b ON reach.other = b.x),
rules(action, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
places AS (
  SELECT host, path FROM n
  UNION SELECT regexp_extract(other, '^([^/?]*)', 1), regexp_extract(other, '^[^/?]*([^?]*)', 1) FROM reach),
own AS (
  SELECT host, path, rhost || rpath AS rule, action,
         row_number() OVER (PARTITION BY host, path ORDER BY length(rhost || rpath) DESC, action) AS k
    FROM places JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
hit AS (
  SELECT DISTINCT reach.node FROM reach JOIN own
      ON own.host = regexp_extract(other, '^([^/?]*)', 1) AND own.path = regexp_extract(other, '^[^/?]*([^?]*)', 1)
   WHERE k = 1 AND action = 'block')
SELECT n.page_id, n.host, n.path, own.rule,
       coalesce(own.action, CASE WHEN hit.node IS NOT NULL THEN 'block' END, 'allow') AS verdict,
       own.action IS NULL AND hit.node IS NOT NULL AS by_alias
  FROM n LEFT JOIN own ON n.host = own.host AND n.path = own.path AND own.k = 1 LEFT JOIN hit ON n.node = hit.node
"""
