"""URL filter: rules by host and path, and for the rest a path-template tree,
in DataFrame functions only.

The tree is grown per host, one path segment at a time, from distinct paths:
repeating rows changes nothing. Below a node, a segment that one path in
``LITERAL_ONE_IN`` or more has stays as it is; all others are variable and become
the wildcard ``*``. It is grown until every path has ended: a path that is alone
below its node is literal from there on and ends at once, so there are as many
rounds as the longest way that two paths of a host have in common.

Urls that a rule fits are the labels. Label counts are summed from the leaves up.
A branch is like its siblings if its share of allowed urls doesn't differ from
that of all of them together (a test of proportions at ``SIMILAR`` standard
errors). A branch that is like its siblings, and below which every labelled branch
is like its own, is merged with those of its siblings of which that is true too; so whole
subtrees are merged, as far up as they agree. A labelled template is judged by
the counts of the highest branch it was merged into: it is rejected if their
smoothed share of allowed urls, (allowed + 1) / (labelled + 2), is below
``PURITY``. A template without any label has 1/2, so it is allowed.

Paths are counted with map-side aggregation, and what is joined back are tables
per node, path or template, never grouped rows: a host that has a third of all
urls is no group of its own.

Defined cases: a url that is null or lacks ``://`` has an empty host and path,
fits no rule and is judged with the others of the empty host; a null
``page_id`` is kept; repeated rows each get their row and count once in the tree;
a url of any length is taken whole; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LITERAL_ONE_IN = 50
SIMILAR = 2.0
PURITY = 0.3
A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


def located(pages: DataFrame) -> DataFrame:
    """(page_id, host, path): the host after the first ``://``, A-Z lower-cased, and the path up to a query."""
    url = F.coalesce("url", F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return pages.select("page_id", F.translate(host, A_Z, a_z).alias("host"),
                        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"))


def ruled(rows: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds ``rule`` and ``ruling``. ``rules``: (host, path, allow or block); the
    longest that fits wins (a list kept by hand: it becomes one CASE expression)."""
    rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):  # later ones override
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        ruling = F.when(fits, F.lit(verdict)).otherwise(ruling)
    return rows.withColumns({"rule": rule, "ruling": ruling})


def templates(paths: DataFrame) -> DataFrame:
    """(host, path, ruling, template, chain) of distinct ``paths`` (host, path, ruling);
    chain: the nodes from the host down to the path's own, then the template."""
    spark = paths.sparkSession
    segments = F.split(F.substring("path", 2, 1 << 30), "/")
    left = paths.select("host", "path", "ruling", segments.alias("segments"), F.col("host").alias("node"),
                        F.array("host").alias("chain"))
    ended: list[DataFrame] = []
    d = 0
    while d == 0 or not left.isEmpty():
        segment = F.get("segments", F.lit(d))
        each = left.groupBy("node", segment.alias("s")).agg(F.count("*").alias("n"))
        total = each.groupBy("node").agg(F.sum("n").alias("of"))
        literal = stored(spark, each.join(total, "node").where(LITERAL_ONE_IN * F.col("n") >= F.col("of"))
                         .select(F.col("node").alias("at"), "s", (F.col("of") == 1).alias("alone")), "literal")
        below = left.join(literal, (F.col("node") == F.col("at")) & (segment == F.col("s")), "left")
        alone, last = F.coalesce("alone", F.lit(False)), F.size("segments") == d + 1
        rest = F.array_join(F.slice("segments", F.lit(d + 1), F.size("segments") - d), "/")
        step = F.when(alone, rest).otherwise(F.coalesce("s", F.lit("*")))
        chain = F.concat("chain", F.when(~alone & last, F.array("next", "next")).otherwise(F.array("next")))
        grown = stored(spark, below.withColumn("next", F.concat("node", F.lit("/"), step)).select(
            "host", "path", "ruling", "segments", F.col("next").alias("node"), chain.alias("chain"),
            (alone | last).alias("done")), "grown")
        ended.append(grown.where("done"))
        left = grown.where("NOT done").drop("done")
        d += 1
    return reduce(DataFrame.unionByName, ended).select("host", "path", "ruling", F.col("node").alias("template"), "chain")


def purity(grown: DataFrame) -> DataFrame:
    """(template, purity) by the labels of its urls, and of the branches it is merged with."""
    spark = grown.sparkSession
    allowed = F.coalesce(F.sum((F.col("ruling") == ALLOW).cast("long")), F.lit(0))
    leaves = stored(spark, grown.groupBy("template").agg(
        F.first("chain").alias("chain"), allowed.alias("allowed"), F.count("ruling").alias("labelled")), "templates")
    up = stored(spark, leaves.where("labelled > 0")
                .select("template", "allowed", "labelled", "chain", F.posexplode("chain").alias("depth", "branch"))
                .withColumn("parent", F.get("chain", F.col("depth") - 1)).drop("chain"), "up")
    branches = up.groupBy("depth", "branch").agg(F.first("parent").alias("parent"), F.sum("allowed").alias("allowed"),
                                                 F.sum("labelled").alias("labelled"))
    branches = stored(spark, branches, "branches")
    pool = branches.select((F.col("depth") + 1).alias("depth"), F.col("branch").alias("parent"),
                           ((F.col("allowed") + 1) / (F.col("labelled") + 2)).alias("p"))
    p = F.col("p")
    near = F.abs(F.col("allowed") / F.col("labelled") - p) <= SIMILAR * F.sqrt(p * (1 - p) / F.col("labelled"))
    tested = stored(spark, branches.join(pool, ["depth", "parent"]).withColumn("similar", near).drop("p"), "tested")
    placed = stored(spark, up.select("template", "depth", "branch").join(
        tested.select("depth", "branch", "parent", "similar"), ["depth", "branch"]), "branches")
    # how deep a branch reaches that is not like its siblings: all below it must be
    odd = placed.where("NOT similar").groupBy("template").agg(F.max("depth").alias("odd"))
    deepest = placed.join(odd, "template").groupBy("depth", "branch").agg(F.max("odd").alias("odd"))
    whole = stored(spark, tested.where("similar").join(deepest, ["depth", "branch"], "left")
                   .where("odd IS NULL OR odd < depth").drop("odd", "similar"), "whole")
    merged = whole.groupBy("depth", "parent").agg(F.sum("allowed").alias("all_allowed"),
                                                  F.sum("labelled").alias("all_labelled"))
    highest = (placed.join(whole.select("depth", "branch"), ["depth", "branch"]).groupBy("template")
               .agg(F.min(F.struct("depth", "parent")).alias("at")).select("template", "at.*"))
    judged_by = highest.join(merged, ["depth", "parent"]).select("template", "all_allowed", "all_labelled")
    return leaves.join(judged_by, "template", "left").select(
        "template", ((F.coalesce("all_allowed", "allowed") + 1)
                     / (F.coalesce("all_labelled", "labelled") + 2)).alias("purity"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of ``pages``."""
    spark = pages.sparkSession
    rows = stored(spark, ruled(located(pages), rules), "urls")
    grown = templates(rows.select("host", "path", "ruling").distinct())  # a path has one ruling
    found = grown.select("host", "path", "template").join(purity(grown), "template")
    verdict = F.coalesce("ruling", F.when(F.col("purity") < PURITY, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return rows.join(stored(spark, found, "purity"), ["host", "path"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")


def duckdb_sql(rules: list[tuple[str, str, str]]) -> str:
    """The same for DuckDB, over a table ``pages``."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
    case = {w: "CASE " + " ".join(
        f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}') THEN '{x}'"
        for h, p, v in ordered for x in [h + p if w == 0 else v]) + " END" for w in (0, 1)}
    parts = [f"""u AS (SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{A_Z}', '{a_z}') AS host,
            regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM (SELECT page_id, coalesce(url, '') AS url FROM pages))""",
             f"""r0 AS (SELECT *, {case[0]} AS rule, {case[1]} AS ruling FROM u)""",
             f"""g AS (SELECT DISTINCT host, path, ruling, string_split(substr(path, 2), '/') AS seg, 0 AS d,
            host AS node, [host] AS chain FROM r0
            UNION ALL SELECT host, path, ruling, seg, d + 1, node || '/' || s, list_append(chain, node || '/' || s)
            FROM (SELECT *, CASE WHEN {LITERAL_ONE_IN} * count(*) OVER (PARTITION BY node, seg[d + 1])
                    >= count(*) OVER (PARTITION BY node) THEN seg[d + 1] ELSE '*' END AS s FROM g WHERE d < len(seg)))""",
             "t AS (SELECT host, path, ruling, node AS template, list_append(chain, node) AS chain FROM g WHERE d = len(seg))",
             """c AS (SELECT template, any_value(chain) AS chain, count(*) FILTER (ruling = 'allow') AS a, count(ruling) AS l
            FROM t GROUP BY template)""",
             """e AS (SELECT template, a, l, depth, chain[depth + 1] AS branch, chain[depth] AS parent
            FROM (SELECT *, unnest(range(len(chain))) AS depth FROM c WHERE l > 0))""",
             "b AS (SELECT depth, branch, any_value(parent) AS parent, sum(a) AS a, sum(l) AS l FROM e GROUP BY depth, branch)",
             f"""x AS (SELECT depth, branch, parent, a, l, abs(a / l - p) <= {SIMILAR} * sqrt(p * (1 - p) / l) AS alike
            FROM b JOIN (SELECT depth + 1 AS depth, branch AS parent, (a + 1) / (l + 2) AS p FROM b) USING (depth, parent))""",
             """y AS (SELECT e.template, x.* FROM e JOIN x USING (depth, branch))""",
             "o AS (SELECT template, max(depth) AS odd FROM y WHERE NOT alike GROUP BY template)",
             "v AS (SELECT depth, branch, max(odd) AS odd FROM y JOIN o USING (template) GROUP BY depth, branch)",
             "w AS (SELECT x.* FROM x LEFT JOIN v USING (depth, branch) WHERE alike AND (odd IS NULL OR odd < depth))",
             "m AS (SELECT depth, parent, sum(a) AS ma, sum(l) AS ml FROM w GROUP BY depth, parent)",
             """h AS (SELECT y.template, min(y.depth) AS depth, arg_min(y.parent, y.depth) AS parent
            FROM y JOIN w USING (depth, branch) GROUP BY 1)""",
             """q AS (SELECT template, (coalesce(ma, a) + 1) / (coalesce(ml, l) + 2) AS purity
            FROM c LEFT JOIN h USING (template) LEFT JOIN m USING (depth, parent))"""]
    return "WITH RECURSIVE " + ",\n".join(parts) + f"""
        SELECT page_id, host, path, rule, coalesce(r0.ruling, CASE WHEN purity < {PURITY} THEN 'block' ELSE 'allow' END)
            AS verdict, template, purity FROM r0 JOIN t USING (host, path) JOIN q USING (template)"""
