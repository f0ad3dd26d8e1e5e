"""URL filter: stated rules first, link-graph propagation for the rest.

Hosts are nodes; links of the pages' markup between hosts, and from a host to its parent domain, are edges. Trust is
personalised PageRank from the hosts that a rule allows; distrust is the same walk over reversed edges from the hosts
that a rule blocks. A host whose distrust exceeds its trust by the threshold is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.runtime import cut

# (verdict, host, path): fixed values
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
LINK = r"""(?i)\bhref\s*=\s*["']?[a-z][a-z0-9+.-]*://([^/?#"'\s>]*)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://``; both empty without one or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.regexp_replace(F.coalesce(rest, F.lit("")), r"(?s)[?#].*$", "")
    slash = F.instr(rest, "/")
    host = F.when(slash > 0, rest.substr(F.lit(1), slash - 1)).otherwise(rest)
    path = F.when(slash > 0, rest.substr(slash, F.length(rest))).otherwise("")
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null without one."""
    rule = verdict = F.lit(None).cast("string")
    for says, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, weight: distinct pages with a link from a host to another, and each host's parent domain."""
    linked = pages.where(F.col("host") != "").select(
        "host", F.array_distinct(F.transform(
            F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)),
            lambda h: F.translate(h, UPPER, LOWER))).alias("to"))
    links = linked.select(F.col("host").alias("src"), F.explode("to").alias("dst"))
    links = links.where("src <> dst and dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    names = pages.where(F.col("host") != "").select(F.col("host").alias("src")).distinct().unionByName(
        links.select(F.col("dst").alias("src"))).distinct()
    parents = names.select("src", F.regexp_extract("src", r"^[^.]+\.(.+\..+)$", 1).alias("dst")).where(
        "dst <> ''").withColumn("weight", F.lit(1.0))
    return links.unionByName(parents).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6,
              together: int = 4) -> DataFrame:
    """host, score: PageRank that restarts at ``seeds`` (host, seed; seeds sum to 1).

    edges has src, dst and weight. A host without outgoing edges sends nothing on; its mass is not restarted. Rounds go on,
    ``together`` of them between two written tables, until no host is reached for the first time any more and all scores
    together change by ``tolerance`` at most.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("_all"))
    steps = cut(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("_all")).alias("share")), "host-steps")
    start = cut(seeds, "host-seeds")
    rank = start.select("host", F.col("seed").alias("score"))
    while True:
        before = rank
        for _ in range(together):
            moved = steps.join(rank, F.col("src") == F.col("host")).select(
                F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"))
            rank = moved.unionByName(start.select("host", (F.col("seed") * (1 - damping)).alias("score"))).groupBy(
                "host").agg(F.sum("score").alias("score"))
        rank = cut(rank, "host-rank")
        change = rank.select("host", F.col("score").alias("now")).join(before, "host", "full").agg(
            F.sum(F.abs(F.coalesce("now", F.lit(0.0)) - F.coalesce("score", F.lit(0.0)))).alias("moved"),
            F.sum(F.col("score").isNull().cast("long")).alias("new")).first()
        if not change["new"] and (change["moved"] or 0.0) <= tolerance:
            return rank


def judge_pages(pages: DataFrame, rules=RULES, threshold: float = 0.0) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page.

    Scores have ten significant digits. A rule's verdict stands. Without one a host is blocked when distrust - trust > ``threshold``; hosts that no walk
    reaches, and pages without a host, are allowed. Null urls have empty host and path; null html has no links.
    Repeated pages are judged one by one; an empty table gives no rows.
    """
    host, path = split_url(F.col("url"))
    parsed = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("says"))
    seeds = cut(ruled.where(F.col("host") != "").groupBy("host").agg(
        F.sum(F.when(F.col("says") == "allow", 1.0).otherwise(0.0)).alias("allow"),
        F.sum(F.when(F.col("says") == "block", 1.0).otherwise(0.0)).alias("block")), "host-rules")
    total = seeds.agg(F.sum("allow").alias("a"), F.sum("block").alias("b")).first()
    edges = cut(host_edges(parsed), "host-edges")
    good = seeds.where("allow > 0").select("host", (F.col("allow") / F.lit(total["a"] or 1.0)).alias("seed"))
    bad = seeds.where("block > 0").select("host", (F.col("block") / F.lit(total["b"] or 1.0)).alias("seed"))
    trust = propagate(edges, good).withColumnRenamed("score", "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = propagate(back, bad).withColumnRenamed("score", "distrust")
    scores = cut(trust.join(distrust, "host", "full").select(
        "host", *[F.format_string("%.9e", F.coalesce(c, F.lit(0.0))).cast("double").alias(c)
                  for c in ("trust", "distrust")]),
        "host-scores")  # ten significant digits: seeds sum to 1, so scores shrink as the table grows
    zero = F.lit(0.0)
    judged = ruled.join(scores, "host", "left").withColumns(
        {"trust": F.coalesce("trust", zero), "distrust": F.coalesce("distrust", zero)})
    spread = F.when(F.col("distrust") - F.col("trust") > threshold, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("says", spread).alias("verdict"),
                         "trust", "distrust")
