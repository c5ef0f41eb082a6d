"""URL filter: longest-rule lists and a path-template tree per host (DataFrame operators only).

1. A url is split into host and path; the longest fitting rule, if any, decides.
2. Templates. All counts are over distinct (host, path) pairs, so repeated rows change nothing. A
   path segment with a digit is variable. Any other segment stays literal where at least
   ``share`` of the host's paths at that depth (and ``min_support`` paths) have it; the rest
   become ``*``. A host so has at most ``1 / share`` literals a depth.
3. Tree. A node is known by its host, its depth and 120 bits that combine the hashes of (depth,
   segment) from the root on: the running XOR of a path's cells, so a path costs its length. Each
   node has its labelled paths ``n`` and, of these, blocked paths ``k``. The labels are an
   argument; the registered query takes the rules' verdicts.
4. Merging. Labelled sibling branches whose blocked share lies within two standard errors of
   the pooled share of all siblings are one branch, with summed counts.
5. Purity, from the root down: ``(k + weight * parent's purity) / (n + weight)`` for a branch
   with labelled paths of its own; the root's parent is the share over all labelled paths (a half
   without labels), and so is the purity of a branch without labels, whatever its siblings are.
   A template with labels of its own and a purity of at least ``reject_at`` is rejected; one
   without is never rejected, however many rows the table has.

Defined results: a null url, or one without ``://``, has empty host and path and the empty
template; empty tables give no rows; repeated rows are judged alike, each with a row. Only the
id and url columns are read. A busy host is dealt out by segment, node or path; the joins that
bring a frequent segment's, node's or url's few rows back stand last before an exchange or a
table, so adaptive execution splits them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwise.llm.helpers import LOWER, UPPER, ascii_lower, written

#: (verdict, host and path)
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
SHARE, MIN_SUPPORT, WEIGHT, REJECT_AT = 0.02, 3, 20.0, 0.9
ANY = "*"


def host_and_path(url: Column) -> tuple[Column, Column]:
    found = F.instr(url, "://")
    rest = F.when(found > 0, F.substr(url, found + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls if none does."""
    rule = verdict = None
    for what, text in sorted(rules, key=lambda r: -len(r[1])):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def hash_pair(text: Column) -> tuple[Column, Column]:
    """120 bits of a text as two numbers."""
    digest = F.md5(text.cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    return part(1), part(17)


def cells_of(paths: DataFrame) -> DataFrame:
    """(url, host, label, depth, segment): the segments of each path, ``*`` for those with a
    digit; depth from 1."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    cells = paths.select("url", "host", "label", F.posexplode(segments).alias("at", "segment"))
    return cells.select("url", "host", "label", (F.col("at") + 1).alias("depth"), F.when(F.col("segment").rlike("[0-9]"), ANY).otherwise(F.col("segment")).alias("segment"))


def templated(cells: DataFrame, share: float, min_support: int) -> DataFrame:
    """The cells with ``*`` for the segments that do not stay literal, and the nodes before and
    at each cell."""
    place = ["host", "depth", "segment"]
    counts = cells.groupBy(*place).agg(F.count("*").alias("n"))
    totals = counts.groupBy("host", "depth").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, ["host", "depth"]).where(
        (F.col("segment") != ANY) & (F.col("n") >= min_support) & (F.col("n") >= F.col("total") * share)
    )
    kept = kept.select("host", "depth", "segment", F.lit(True).alias("literal"))
    segment = F.when(F.col("literal"), F.col("segment")).otherwise(ANY)
    cells = cells.join(kept, place, "left").select("url", "host", "label", "depth", segment.alias("segment"))
    one, two = hash_pair(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("segment")))
    cells = cells.select("*", one.alias("one"), two.alias("two"))
    before = Window.partitionBy("url").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    up = [F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"up_{c}") for c in ("one", "two")]
    return cells.select("url", "host", "label", "depth", "segment", "one", "two", *up).select(
        "url", "host", "label", "depth", "segment", "up_one", "up_two",
        *[F.col(c).bitwiseXOR(F.col(f"up_{c}")).alias(f"node_{c}") for c in ("one", "two")],
    )


def branches_of(cells: DataFrame, paths: DataFrame) -> DataFrame:
    """(host, depth, node, own_n, branch_n, branch_k) of every node, siblings merged; a node
    without labels has zeros."""
    node, up = ["node_one", "node_two"], ["up_one", "up_two"]
    count = (F.count("label").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("k"))
    nodes = cells.groupBy("host", "depth", *up, *node).agg(*count)
    zero = F.lit(0).cast("long")
    roots = paths.groupBy("host").agg(*count).select("host", F.lit(0).alias("depth"), *[zero.alias(c) for c in (*up, *node)], "n", "k")
    nodes = nodes.unionByName(roots)
    siblings = ["host", "depth", *up]
    pooled = nodes.groupBy(*siblings).agg(F.sum("n").cast("double").alias("pool_n"), F.sum("k").cast("double").alias("pool_k"))
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    off = k * F.col("pool_n") - n * F.col("pool_k")
    similar = (F.col("n") > 0) & (off * off <= 4.0 * n * F.col("pool_k") * (F.col("pool_n") - F.col("pool_k")))
    nodes = nodes.join(pooled, siblings).withColumn("similar", similar)
    merged = nodes.where("similar").groupBy(*siblings).agg(F.sum("n").alias("merged_n"), F.sum("k").alias("merged_k"))
    return nodes.join(merged, siblings, "left").select(
        "host", "depth", *node, F.col("n").alias("own_n"),
        F.when(F.col("similar"), F.col("merged_n")).otherwise(F.col("n")).alias("branch_n"),
        F.when(F.col("similar"), F.col("merged_k")).otherwise(F.col("k")).alias("branch_k"),
    )


def judged(paths: DataFrame, share: float, min_support: int, weight: float, reject_at: float) -> DataFrame:
    """(url, template, rejected); paths: url, host, path, label 1/0/null, a row for each url."""
    labelled, blocked = paths.agg(F.count("label"), F.sum("label")).first()
    prior = float(blocked / labelled) if labelled else 0.5
    cells = written(templated(cells_of(paths), share, min_support), "cells")
    branches = written(branches_of(cells, paths), "branches")
    node = ["host", "depth", "node_one", "node_two"]
    zero = F.lit(0).cast("long")
    ends = paths.select("url", "host", F.lit(0).alias("depth"), F.lit("").alias("segment"), zero.alias("node_one"), zero.alias("node_two"))
    steps = cells.select("url", *node, "segment").unionByName(ends).join(branches, node)
    lines = steps.groupBy("url").agg(F.sort_array(F.collect_list(F.struct("depth", "segment", "own_n", "branch_n", "branch_k"))).alias("line"))
    purity = F.aggregate(
        "line", F.lit(prior), lambda p, x: F.when(x["own_n"] > 0, (x["branch_k"] + p * weight) / (x["branch_n"] + weight)).otherwise(F.lit(prior))
    )
    rejected = (F.element_at("line", -1)["own_n"] > 0) & (purity >= reject_at)
    template = F.array_join(F.transform(F.slice("line", 2, F.greatest(F.size("line") - 1, F.lit(0))), lambda x: x["segment"]), "/")
    return lines.select("url", template.alias("template"), rejected.alias("rejected"))


def url_filter(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES,
    share: float = SHARE, min_support: int = MIN_SUPPORT, weight: float = WEIGHT, reject_at: float = REJECT_AT,
) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, template."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    url = F.unhex(F.md5(F.concat(F.length("host").cast("string"), F.lit(":"), F.col("host"), F.col("path")).cast("binary")))
    rows = written(rows.select("*", rule.alias("rule"), verdict.alias("by_rule"), url.alias("url")), "urls")
    label = F.when(F.col("by_rule") == "block", 1).when(F.col("by_rule") == "allow", 0)
    paths = written(rows.select("url", "host", "path", label.alias("label")).distinct(), "paths")
    learned = judged(paths, share, min_support, weight, reject_at)
    verdict = F.coalesce("by_rule", F.when(F.col("rejected"), "block").otherwise("allow"))
    return rows.join(learned, "url", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template")


def oracle(rules: Sequence[tuple[str, str]] = RULES) -> str:
    when = {"rule": "", "verdict": ""}
    for what, text in sorted(rules, key=lambda r: -len(r[1])):
        h, slash, rest = text.partition("/")
        fits = f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{slash}{rest}') THEN "
        when = {"rule": when["rule"] + f"{fits}'{text}' ", "verdict": when["verdict"] + f"{fits}'{what}' "}
    return f"""
WITH RECURSIVE rest AS (
  SELECT page_id, row_number() OVER () AS r, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS u FROM pages),
parts AS (
  SELECT page_id, r, translate(regexp_extract(u, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (
  SELECT *, CASE {when["rule"]}END AS rule, CASE {when["verdict"]}END AS by_rule,
         list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
           lambda s: CASE WHEN regexp_matches(s, '[0-9]') THEN '*' ELSE s END) AS segs FROM parts),
paths AS (SELECT host, path, any_value(segs) AS segs, any_value(by_rule) AS by_rule, row_number() OVER () AS p FROM ruled GROUP BY host, path),
cells AS (SELECT p, host, unnest(range(1, len(segs) + 1)) AS d, unnest(segs) AS s FROM paths),
counted AS (SELECT host, d, s, count(*) AS n, sum(count(*)) OVER (PARTITION BY host, d) AS total FROM cells GROUP BY host, d, s),
kept AS (SELECT host, d, s FROM counted WHERE s <> '*' AND n >= {MIN_SUPPORT} AND n >= total * {SHARE}::DOUBLE),
templated AS (
  SELECT p, list(CASE WHEN kept.s IS NULL THEN '*' ELSE cells.s END ORDER BY cells.d) AS template
  FROM cells LEFT JOIN kept ON kept.host = cells.host AND kept.d = cells.d AND kept.s = cells.s GROUP BY p),
t AS (SELECT paths.*, coalesce(templated.template, []::VARCHAR[]) AS template FROM paths LEFT JOIN templated USING (p)),
steps AS (
  SELECT host, d, template[1:d] AS prefix, template[1:greatest(d - 1, 0)] AS parent, by_rule
  FROM (SELECT *, unnest(range(0, len(template) + 1)) AS d FROM t)),
nodes AS (SELECT host, d, parent, prefix, count(by_rule)::DOUBLE AS n, count(*) FILTER (by_rule = 'block')::DOUBLE AS k FROM steps GROUP BY ALL),
pooled AS (SELECT *, sum(n) OVER w AS bn, sum(k) OVER w AS bk FROM nodes WINDOW w AS (PARTITION BY host, d, parent)),
tested AS (SELECT *, n > 0 AND (k * bn - n * bk) * (k * bn - n * bk) <= 4.0::DOUBLE * n * bk * (bn - bk) AS alike FROM pooled),
branches AS (
  SELECT host, d, parent, prefix, n AS own,
    CASE WHEN alike THEN sum(n) FILTER (alike) OVER w ELSE n END AS n,
    CASE WHEN alike THEN sum(k) FILTER (alike) OVER w ELSE k END AS k
  FROM tested WINDOW w AS (PARTITION BY host, d, parent)),
prior AS (SELECT coalesce(count(*) FILTER (by_rule = 'block')::DOUBLE / nullif(count(by_rule), 0), 0.5) AS p FROM t),
down(host, d, prefix, own, p) AS (
  SELECT host, d, prefix, own, CASE WHEN own > 0 THEN (k + prior.p * {WEIGHT}::DOUBLE) / (n + {WEIGHT}::DOUBLE) ELSE prior.p END
  FROM branches, prior WHERE d = 0
  UNION ALL
  SELECT b.host, b.d, b.prefix, b.own, CASE WHEN b.own > 0 THEN (b.k + down.p * {WEIGHT}::DOUBLE) / (b.n + {WEIGHT}::DOUBLE) ELSE prior.p END
  FROM down JOIN branches b ON b.host = down.host AND b.d = down.d + 1 AND b.parent = down.prefix, prior)
SELECT page_id, ruled.host, ruled.path, rule,
       coalesce(ruled.by_rule, CASE WHEN down.own > 0 AND down.p >= {REJECT_AT} THEN 'block' ELSE 'allow' END) AS verdict,
       array_to_string(template, '/') AS template
FROM ruled JOIN t ON t.host = ruled.host AND t.path = ruled.path
JOIN down ON down.host = t.host AND down.d = len(t.template) AND down.prefix = t.template
"""
