"""URL filter: rules first, then trust that spreads over the graph of hosts. DataFrame and SQL functions only.

Rules name a host and the start of a path; the longest that fits a URL decides. The hosts of pages that rules
allow are the trusted seeds of one personalised PageRank, which follows links; those of pages that rules
block are the seeds of another, which follows links backwards: who links to the bad is suspect. A host whose
distrust outweighs its trust by ``threshold`` blocks the pages that no rule judges.

Edges lead from a page's host to the hosts it links to by full URL, weighted by the number of links, and both
ways between a host and the domains above it, of ``LEVELS`` to two labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.scratch import stage

LEVELS = 4
#: The ranks are final when a stretch of rounds changes none of them by more than this share of itself.
TOLERANCE = 1e-6
#: Rounds in a stretch, which ends in a table. The SQL form has ROUNDS in all.
STRETCH = 5
ROUNDS = 10
DAMPING = 0.85
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
AFTER = "CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END"
LINK = r"(?i)(?:href|src)\\s*=\\s*[\"\']?\\s*[a-z][a-z0-9+.-]*://([^/?#\"\'\\s>]*)"


def addresses(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path`` of a URL; both are empty without ``://`` or for null."""
    split = pages.withColumn("host", F.expr(f"regexp_extract({AFTER.replace('url', f'`{url_col}`')}, '^[^/?#]*', 0)"))
    split = split.withColumn(
        "path",
        F.expr(f"regexp_extract(substring({AFTER.replace('url', f'`{url_col}`')}, length(host) + 1), '^[^?#]*', 0)"),
    )
    return split.withColumns({"host": F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER), "path": F.coalesce("path", F.lit(""))})


def rule_table(spark, rules) -> DataFrame:
    """(rule, rule_host, rule_path, verdict) of pairs like ("block", "example.com/en/")."""
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in rules]
    listed = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return listed.selectExpr("rule", "substring_index(rule, '/', 1) AS rule_host", "substring(rule, instr(rule, '/')) AS rule_path", "verdict")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): what rules fit a host or a domain above it, longest first. A host has as many as name its domains."""
    most = rules.agg(F.max(F.expr("size(split(rule_host, '[.]'))")).alias("n")).first()["n"] or 0
    if not most:
        return hosts.selectExpr("host", "cast(array() AS array<struct<size: int, rule: string, rule_path: string, verdict: string>>) AS rules")
    above = hosts.selectExpr("host", f"explode(array_distinct(transform(sequence(1, {most}), k -> substring_index(host, '.', -k)))) AS rule_host")
    return (
        above.join(rules, "rule_host")
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct(F.expr("-length(rule)").alias("size"), "rule", "rule_path", "verdict"))).alias("rules"))
    )


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(src, dst, weight) between hosts of ``pages`` (with ``host``), the hosts they link to and the domains above."""
    links = pages.select("host", F.expr(f"explode(regexp_extract_all(`{html_col}`, '{LINK}', 1))").alias("dst")).select(
        F.col("host").alias("src"), F.translate("dst", UPPER, LOWER).alias("dst")
    )
    counted = stage(links.filter("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")), "links")
    hosts = pages.select("host").unionAll(counted.select("dst")).distinct().filter("host <> ''")
    up = (
        hosts.selectExpr(
            f"array_distinct(array_prepend(transform(sequence({LEVELS}, 2, -1), k -> substring_index(host, '.', -k)), host)) AS chain"
        )
        .selectExpr("explode(transform(sequence(1, greatest(size(chain) - 1, 1)), i -> struct(chain[i - 1] AS src, get(chain, i) AS dst))) AS e")
        .select("e.*")
        .filter("dst IS NOT NULL AND dst <> ''")
        .distinct()
    )
    both = up.unionAll(up.selectExpr("dst", "src")).selectExpr("src", "dst", "1D AS weight")
    return counted.unionAll(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) at the end; ``seeds``: (host, allowed, blocked), counts of pages.

    Both ranks run as one graph with two layers: trust over the edges, distrust over the reversed edges. They
    end when a stretch of rounds changes no rank by more than ``tolerance`` of itself. The rank of a host that is
    reached for the first time changes by all of it, so however far a host is from the seeds, it has its ranks.
    """
    two = edges.selectExpr("'t' AS layer", "src", "dst", "weight").unionAll(edges.selectExpr("'d' AS layer", "dst AS src", "src AS dst", "weight"))
    out = two.groupBy("layer", "src").agg(F.sum("weight").alias("total"))
    steps = stage(two.join(out, ["layer", "src"]).selectExpr("layer", "src", "dst", "weight / total AS share"), "steps")
    totals = seeds.agg(F.sum("allowed").alias("t"), F.sum("blocked").alias("d")).first()
    start = stage(
        seeds.selectExpr(
            f"explode(array(struct('t' AS layer, host, allowed / {float(totals['t'] or 1)!r}D AS jump), struct('d' AS layer, host, blocked / {float(totals['d'] or 1)!r}D AS jump))) AS s"
        ).select("s.*").filter("jump > 0"),
        "seeds",
    )
    rank = start.selectExpr("layer", "host", "jump AS rank")
    jumped = start.selectExpr("layer", "host", f"{1 - damping!r}D * jump AS rank")
    moving = True
    while moving:
        old = rank.selectExpr("layer", "host", "0D AS rank", "rank AS before")
        for _ in range(STRETCH):
            moved = (
                rank.withColumnRenamed("host", "src").join(steps, ["layer", "src"])
                .selectExpr("layer", "dst AS host", f"{damping!r}D * rank * share AS rank")
            )
            rank = moved.unionAll(jumped).groupBy("layer", "host").agg(F.sum("rank").alias("rank"))
        both = rank.selectExpr("*", "0D AS before").unionAll(old).groupBy("layer", "host").agg(F.sum("rank").alias("rank"), F.sum("before").alias("before"))
        both = stage(both, "rank")
        rank = both.select("layer", "host", "rank")
        moving = not both.filter(f"abs(rank - before) > {tolerance!r}D * rank").isEmpty()
    return rank.groupBy("host").agg(
        F.sum(F.expr("CASE WHEN layer = 't' THEN rank ELSE 0D END")).alias("trust"),
        F.sum(F.expr("CASE WHEN layer = 'd' THEN rank ELSE 0D END")).alias("distrust"),
    )


def judge(
    pages: DataFrame, rules, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    tolerance: float = TOLERANCE, threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, host, path, rule, verdict, distrust) for every row of ``pages``; ``distrust`` is the host's, 0 to 1.

    A null URL or one without ``://`` has an empty host and path: no rule fits, no links count, and it is allowed, as
    is any host that neither rank reaches. Null HTML has no links; repeated rows are judged each; no rules give
    no seeds and allow all; an empty table gives no rows.
    """
    spark = pages.sparkSession
    known = addresses(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")))
    where = stage(known.select("id", "host", "path"), "addresses")
    hosts = stage(where.select("host").distinct(), "hosts")
    fitting = hosts.selectExpr("host", "cast(null AS array<struct<size: int, rule: string, rule_path: string, verdict: string>>) AS rules").limit(0)
    if rules:
        fitting = stage(host_rules(hosts, rule_table(spark, rules)), "fitting")
    ruled = (
        where.join(fitting, "host", "left")
        .selectExpr("id", "host", "path", "get(filter(rules, r -> startswith(path, r.rule_path)), 0) AS hit")
        .selectExpr("id", "host", "path", "hit.rule AS rule", "hit.verdict AS verdict")
    )
    seeds = stage(
        ruled.groupBy("host").agg(
            F.count_if(F.col("verdict") == "allow").cast("double").alias("allowed"), F.count_if(F.col("verdict") == "block").cast("double").alias("blocked")
        ),
        "counts",
    )
    edges = stage(host_edges(known.select("host", "html")), "edges")
    ranks = propagate(edges, seeds, tolerance)
    share = "coalesce(distrust / nullif(trust + distrust, 0D), 0D)"
    hosts = stage(fitting.join(ranks, "host", "full").selectExpr("host", "rules", f"{share} AS distrust"), "judged")
    return (
        where.join(hosts, "host", "left")
        .selectExpr("id", "host", "path", "get(filter(rules, r -> startswith(path, r.rule_path)), 0) AS hit", "coalesce(distrust, 0D) AS distrust")
        .selectExpr(
            "id", "host", "path", "hit.rule AS rule",
            f"coalesce(hit.verdict, CASE WHEN distrust > {threshold!r}D THEN 'block' ELSE 'allow' END) AS verdict", "distrust",
        )
    )
