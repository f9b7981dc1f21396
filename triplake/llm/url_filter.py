"""URL filters over redirect equivalence, with DataFrame functions only.

Rules allow or block a host (with its subdomains) and a path prefix.  Pages
that declare another address (canonical link, meta refresh) are aliases of
it; connected components over those edges carry decisions to aliases that no
rule fits: an explicit allow anywhere in the component decides first, then a
block, else the page is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from triplake.llm.common import connected_components, stored, table

#: (host, path, action)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

#: Parts that a host's pages are dealt into where they meet its rules.
SALTS = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What tells pages apart: host, path and query; not scheme or fragment.  Empty without a host."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    host = host_of(url)
    return F.when(host != "", F.concat(host, F.when(rest == "", "/").otherwise(rest))).otherwise("")


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action")) for h, p, a in rules])
    return spark.range(1).select(F.inline(rows))


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, ...)`` -> the same with ``rule`` and ``action`` of the longest rule that fits, else null.

    Rules meet the distinct hosts through the hosts' suffixes, so neither rules
    nor pages are compared one with another.  Of one rule given twice, allow wins.
    """
    hosts = urls.where("host <> ''").select("host").distinct()
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)),
                         lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    r = rules.select(F.col("host").alias("_suffix"), F.struct(
        F.length(F.concat("host", "path")).alias("n"), F.concat("host", "path").alias("rule"),
        (F.col("action") == "allow").alias("allow"), F.col("path").alias("start")).alias("_r"))
    fits = (hosts.select("host", F.explode(suffix).alias("_suffix")).join(r, "_suffix")
            .groupBy("host").agg(F.collect_list("_r").alias("_rules")))
    fits = fits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    best = F.array_max(F.filter("_rules", lambda x: F.col("path").startswith(x["start"])))
    salted = urls.withColumn("_salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    return (salted.join(fits, ["host", "_salt"], "left").withColumn("_best", best)
            .select(*urls.columns, F.col("_best.rule").alias("rule"),
                    F.when(F.col("_best.allow"), "allow").when(~F.col("_best.allow"), "block").alias("action")))


def declared_aliases(pages: DataFrame) -> DataFrame:
    """``(src, dst)`` addresses: each page's first canonical link and first meta refresh, resolved."""
    html = F.col("html")
    hints = pages.where(html.rlike("(?i)canonical|refresh")).select(
        "url", F.explode(F.array(F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1),
                                 F.regexp_extract(F.regexp_extract(html, REFRESH, 0), TARGET, 1))).alias("to"))
    to = F.replace(F.col("to"), F.lit("&amp;"), F.lit("&"))
    root = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*", 0)
    folder = F.concat(root, F.coalesce(F.nullif(F.regexp_extract(path_of(F.col("url")), r"(?s)^.*/", 0), F.lit("")), F.lit("/")))
    whole = (F.when(to.contains("://"), to).when(to.startswith("//"), F.concat(F.lit("http:"), to))
             .when(to.startswith("/"), F.concat(root, to)).otherwise(F.concat(folder, to)))
    return (hints.where("to <> ''").select(address(F.col("url")).alias("src"), address(whole).alias("dst"))
            .where("src <> '' AND dst <> ''"))


def alias_decisions(aliases: DataFrame, rules: DataFrame) -> DataFrame:
    """(address, decision) of the components that a rule decides."""
    nodes = stored(connected_components(aliases, "alias-components"), "aliases")
    known = nodes.withColumn("url", F.concat(F.lit("http://"), "node"))
    known = ruled(known.select("component", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), rules)
    decided = known.where("action IS NOT NULL").groupBy("component").agg(F.min("action").alias("decision"))  # allow < block
    return nodes.join(decided, "component").select(F.col("node").alias("_address"), "decision")


def judge(pages: DataFrame, rules: DataFrame, more_aliases: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    A null url, or one without ``://``, has empty host and path, no rule and is
    allowed.  ``more_aliases``: further ``(src, dst)`` addresses, such as a
    crawler's redirects.  Ids may be null or repeated: rows are judged alone.
    """
    aliases = declared_aliases(pages.select("url", "html"))
    if more_aliases is not None:
        aliases = aliases.unionByName(more_aliases.select("src", "dst"))
    url = F.col("url")
    p = ruled(pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), address(url).alias("_address")), rules)
    return (p.join(alias_decisions(aliases, rules), "_address", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("action", "decision", F.lit("allow")).alias("verdict")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), rule_table(spark))


ORACLE_SQL = r"""
WITH RECURSIVE rules(rhost, rpath, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), p AS (
  SELECT page_id, url, html,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1), '') AS rest
  FROM pages
), a AS (
  SELECT *, CASE WHEN host = '' THEN '' ELSE host || CASE WHEN rest = '' THEN '/' ELSE rest END END AS addr FROM p
), hints AS (
  SELECT addr, url, path, replace(t, '&amp;', '&') AS t FROM (
    SELECT addr, url, path, unnest([
      regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
      regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) AS t
    FROM a) WHERE t <> '' AND addr <> ''
), w AS (
  SELECT addr, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
              WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*') || t
              ELSE regexp_extract(url, '(?s)^.*?://[^/?#]*') || coalesce(nullif(regexp_extract(path, '(?s)^.*/'), ''), '/') || t END AS u
  FROM hints
), e AS (
  SELECT addr AS s, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         || CASE WHEN regexp_extract(u, '(?s)^.*?://[^/?#]*([^#]*)', 1) = '' THEN '/'
                 ELSE regexp_extract(u, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS t
  FROM w WHERE regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1) <> ''
), links AS (SELECT s, t FROM e UNION SELECT t, s FROM e
), reach AS (
  SELECT s AS node, s AS other FROM links
  UNION
  SELECT r.node, b.t FROM reach r JOIN links b ON b.s = r.other
), fit AS (
  SELECT k.kind, k.key, host, path, rhost || rpath AS rule, action, length(rhost || rpath) AS n
  FROM (SELECT DISTINCT 'n' AS kind, node AS key, regexp_extract(node, '^[^/?#]*') AS host,
               regexp_extract(node, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM reach
        UNION ALL SELECT DISTINCT 'p', '', host, path FROM p) k
  JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), best AS (
  SELECT kind, key, host, path, arg_max(rule, n) AS rule, arg_max(action, n) AS action FROM fit GROUP BY ALL
), decision AS (
  SELECT node, min(best.action) AS decision FROM reach JOIN best ON best.kind = 'n' AND best.key = reach.other GROUP BY node
)
SELECT page_id, a.host, a.path, best.rule, coalesce(best.action, decision.decision, 'allow') AS verdict
FROM a LEFT JOIN best ON best.kind = 'p' AND best.host = a.host AND best.path = a.path
       LEFT JOIN decision ON decision.node = a.addr
"""
