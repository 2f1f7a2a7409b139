"""URL filter by a path-template tree, in DataFrame functions only.

Each host has a tree over the segments of its paths.  Level by level a segment that few of its node's urls share becomes
the wildcard ``*``, and siblings whose labelled block rate cannot be told from their node's share one branch ``~``.  Runs
of digits are ``#`` from the start.  A finished template is rejected when its labelled urls, smoothed by the rate over all
hosts, are mostly blocked; hand-written rules label urls and always decide their own.  The tree is grown
as deep as paths share nodes; all segments that a path has left alone are judged at once, as they have the same counts.

The tree is grown on distinct (host, shape) rows with counts, never on urls, and every step is a partial aggregation or a
join by (host, prefix, ...), so a host with a third of all urls is cut by partial sums and adaptive skew joins.

A null url, or one without ``://``, has an empty host and path; an empty path has the template of its host's root.
Urls of any length are judged whole.  Repeated rows are judged each; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.session import Scratch

#: A segment stays literal with this many urls, and this share of its node's urls.
MIN_URLS = 5
MIN_SHARE = 0.02
#: Siblings whose block rate lies within so many standard errors of their node's rate are merged.
MERGE_Z = 1.96
#: Weight, in urls, of the block rate of all labelled urls in a template's rate, and the rate that rejects.
PRIOR_WEIGHT = 4.0
REJECT = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"^[\s\S]*?://([^/?#]*)"
PATH = r"^[\s\S]*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host is the url's or a parent of it and whose path starts the url's."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _grown(tree: DataFrame, level: int) -> DataFrame:
    """``tree`` with one more segment in the prefix of each path that has no template yet, and templates where paths end."""
    parts = F.split("shape", "/", -1)
    done = tree.where("template is not null")
    paths = tree.where("template is null").withColumn("seg", F.get(parts, F.lit(level)))
    sums = [F.sum(c).alias(c) for c in ("urls", "blocked", "labelled")]
    children = paths.groupBy("host", "prefix", "seg").agg(*sums, F.count(F.lit(1)).alias("shapes"))
    totals = [F.sum(c).alias(f"all_{c}") for c in ("urls", "blocked", "labelled", "shapes")]
    nodes = children.groupBy("host", "prefix").agg(*totals)
    rate = F.col("all_blocked") / F.col("all_labelled")
    apart = F.abs(F.col("blocked") / F.col("labelled") - rate)
    kind = F.when(F.col("urls") < F.greatest(F.lit(float(MIN_URLS)), MIN_SHARE * F.col("all_urls")), "*").when(
        (F.col("labelled") > 0) & (apart <= MERGE_Z * F.sqrt(rate * (1 - rate) / F.col("labelled"))), "~"
    )
    branches = children.join(nodes, ["host", "prefix"]).select("host", "prefix", "seg", kind.alias("kind"), (F.col("all_shapes") == 1).alias("alone"))
    longer = F.concat("prefix", F.lit("/"), F.coalesce("kind", "seg"))
    rest = F.transform(F.slice(parts, level + 1, F.size(parts)), lambda x: F.coalesce("kind", x))
    ended = F.when(F.col("alone"), F.concat("prefix", F.lit("/"), F.array_join(rest, "/"))).when(F.size(parts) == level + 1, longer)
    grown = paths.join(branches, ["host", "prefix", "seg"]).withColumn("template", ended).withColumn("prefix", longer)
    return done.unionByName(grown.select(tree.columns))


def template_tree(urls: DataFrame) -> DataFrame:
    """(host, shape, template, rate): ``urls`` has host, shape and blocked (true, false, or null without a label)."""
    scratch = Scratch(urls.sparkSession)
    counted = urls.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("urls"),
        F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0)).alias("blocked"),
        F.count("blocked").alias("labelled"),
    )
    whole = F.when(~F.contains("shape", F.lit("/")), "")
    tree = scratch.write(counted.select("*", F.lit("").alias("prefix"), whole.alias("template")), "url-tree")
    level = 0
    while tree.where("template is null").limit(1).count():
        level += 1
        before, tree = tree, scratch.write(_grown(tree, level), "url-tree")
        scratch.drop(before)
    total = tree.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    prior = (total["b"] or 0) / total["l"] if total["l"] else 0.0
    rates = tree.groupBy("host", "template").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    rates = rates.select("host", "template", ((F.col("b") + PRIOR_WEIGHT * prior) / (F.col("l") + PRIOR_WEIGHT)).alias("rate"),
                         F.col("l").alias("labelled_urls"))
    return tree.select("host", "shape", "template").join(rates, ["host", "template"])


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], id: str = "page_id", url: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, template, rate) of every row; the rate is the template's smoothed block rate."""
    known = pages.select(F.col(f"`{id}`").alias("id"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    known = known.withColumns({"rule": rule, "ruled": verdict, "shape": F.regexp_replace("path", "[0-9]+", "#")})
    tree = template_tree(known.select("host", "shape", (F.col("ruled") == "block").alias("blocked")))
    by_method = F.when((F.col("labelled_urls") > 0) & (F.col("rate") >= REJECT), "block").otherwise("allow")
    return known.join(tree, ["host", "shape"], "left").select(
        F.col("id").alias(id), "host", "path", "rule", F.coalesce("ruled", by_method).alias("verdict"), "template", "rate"
    )


def duckdb_sql(rules: Sequence[tuple[str, str]]) -> str:
    """The same over the view ``pages``."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))

    def case(value) -> str:
        arms = []
        for text, what in ordered:
            name, slash, tail = text.partition("/")
            arms.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + tail}') THEN '{value(text, what)}'")
        return f"CASE {' '.join(arms)} END"

    share = f"greatest({float(MIN_URLS)}::DOUBLE, {MIN_SHARE}::DOUBLE * CAST(all_urls AS DOUBLE))"
    apart = f"abs(CAST(blocked_here AS DOUBLE) / labelled_here - p) <= {MERGE_Z}::DOUBLE * sqrt(p * (1 - p) / labelled_here)"
    child, node = "PARTITION BY host, prefix, parts[level + 2]", "PARTITION BY host, prefix"
    grown = f"""SELECT 0 AS level, host, shape, urls, blocked, labelled, parts, '' AS prefix, CASE WHEN len(parts) = 1 THEN '' END AS template FROM counted
  UNION ALL SELECT level + 1, host, shape, urls, blocked, labelled, parts, longer,
    CASE WHEN alone THEN prefix || '/' || array_to_string(list_transform(parts[level + 2:], lambda x: coalesce(kind, x)), '/') WHEN len(parts) = level + 2 THEN longer END
  FROM (SELECT *, CASE WHEN CAST(urls_here AS DOUBLE) < {share} THEN '*' WHEN labelled_here > 0 AND {apart} THEN '~' END AS kind,
      prefix || '/' || coalesce(kind, seg) AS longer
    FROM (SELECT *, parts[level + 2] AS seg, sum(urls) OVER ({child}) AS urls_here, sum(blocked) OVER ({child}) AS blocked_here,
      sum(labelled) OVER ({child}) AS labelled_here, sum(urls) OVER ({node}) AS all_urls, count(*) OVER ({node}) = 1 AS alone,
      CAST(sum(blocked) OVER ({node}) AS DOUBLE) / nullif(sum(labelled) OVER ({node}), 0) AS p FROM grown WHERE template IS NULL))"""
    return f"""WITH RECURSIVE split AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{HOST}', 1), ''), '{UPPER}', '{LOWER}') AS host,
  coalesce(regexp_extract(url, '{PATH}', 1), '') AS path FROM pages),
known AS (SELECT *, {case(lambda t, w: t)} AS rule, {case(lambda t, w: w)} AS ruled, regexp_replace(path, '[0-9]+', '#', 'g') AS shape FROM split),
counted AS (SELECT host, shape, count(*) AS urls, coalesce(sum(CAST(ruled = 'block' AS BIGINT)), 0) AS blocked,
  count(ruled) AS labelled, string_split(shape, '/') AS parts FROM known GROUP BY host, shape),
grown AS ({grown}),
tree AS (SELECT * FROM grown WHERE template IS NOT NULL),
prior AS (SELECT coalesce(CAST(sum(blocked) AS DOUBLE) / nullif(sum(labelled), 0), 0) AS g FROM tree),
rates AS (SELECT host, template, sum(labelled) AS l,
  (sum(blocked) + {PRIOR_WEIGHT}::DOUBLE * (SELECT g FROM prior)) / (sum(labelled) + {PRIOR_WEIGHT}::DOUBLE) AS rate FROM tree GROUP BY 1, 2)
SELECT page_id, k.host, k.path, rule,
  coalesce(ruled, CASE WHEN l > 0 AND rate >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, r.template, rate
FROM known k JOIN tree t ON k.host = t.host AND k.shape = t.shape JOIN rates r ON r.host = t.host AND r.template = t.template"""
