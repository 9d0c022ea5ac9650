"""URL filters: rules for hosts and paths, and trust that spreads over the link graph of hosts.

Trust is a personalised PageRank from hosts whose pages the rules allow, along links. Distrust is
the same from hosts whose pages the rules block, against the links: who links to a blocked host is
suspect. A seed weighs as the share of its pages that a rule allows (or blocks). Scores are those of PageRank over
``1 - damping``, so that a host has its own seed plus what is left of the scores of its neighbours, and a host without links has its seed;
what a host without outgoing links would pass on is lost. Rounds go on until no score changes by ``TOLERANCE``. A host whose
distrust exceeds its trust and a threshold is blocked; a rule for a page always goes first. All
steps are DataFrame operations; a round is one join and one sum over distinct host edges, so a page
that links a thousand times or a host with a third of all pages adds one weight to an edge.

Defined cases: a missing url, or one without ``://``, has an empty host and path and no rule; an
empty host takes no part in the graph and is allowed; missing html has no links. Repeated rows are judged each. Columns of any name are kept, but for those set here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.llm.common import broadcast_if_small
from semprune.session import materialize

DAMPING = 0.85
TOLERANCE = 1e-4
THRESHOLD = 0.1

#: (verdict, host, start of the path)
Rule = tuple[str, str, str]

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """Between ``://`` and the path, with ASCII letters lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits a page, nulls without one."""
    fits = lambda r: ((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2])
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    pick = lambda value: reduce(lambda c, r: c.when(fits(r), value(r)), longest, F.when(F.lit(False), None))
    return pick(lambda r: F.lit(r[1] + r[2])).cast("string"), pick(lambda r: F.lit(r[0])).cast("string")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts; the weights of a source sum to one."""
    links = F.regexp_extract_all(F.col("html"), F.lit(r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^\s"'>]+)"""), F.lit(1))
    found = pages.where("html IS NOT NULL AND host <> ''").select(F.col("host").alias("src"), F.explode(links).alias("link"))
    target = host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    counted = found.select("src", target.alias("dst")).where("dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    counted = materialize(counted, "host-links")
    totals = counted.groupBy("src").agg(F.sum("n").alias("total"))
    return materialize(counted.join(totals, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("weight")), "host-edges")


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, score): seed plus ``damping`` times the scores that edges bring; ``seeds`` is (host, seed), ``edges`` (src, dst, weight).

    Weights of a source sum to one, so the sum of all changes falls by ``damping`` a round.
    """
    ends = edges.select(F.explode(F.array("src", "dst")).alias("host"))
    hosts = seeds.select("host").unionByName(ends).distinct()
    base = materialize(hosts.join(seeds, "host", "left").select("host", F.coalesce("seed", F.lit(0.0)).alias("seed")), "host-seeds")
    scores = base.select("host", F.col("seed").alias("score"))
    while True:
        sent = edges.join(scores.withColumnRenamed("host", "src"), "src").select(F.col("dst").alias("host"), (F.col("score") * F.col("weight")).alias("part"))
        got = sent.groupBy("host").agg(F.sum("part").alias("got"))
        moved = base.join(scores, "host").join(got, "host", "left")
        moved = moved.select("host", F.col("score").alias("before"), (F.col("seed") + damping * F.coalesce("got", F.lit(0.0))).alias("score"))
        moved = materialize(moved, "host-scores")
        scores = moved.select("host", "score")
        if (moved.agg(F.max(F.abs(F.col("score") - F.col("before")))).first()[0] or 0.0) < tolerance:
            return scores


def judge_pages(pages: DataFrame, rules: list[Rule], threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with host, path, rule and verdict (allow or block)."""
    url = F.col("url")
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    placed = pages.select(*kept, host_of(url).alias("host"), path_of(url).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = placed.withColumns({"rule": name, "verdict": verdict})
    hosts = ruled.where("host <> ''").groupBy("host").agg(
        (F.count_if(F.col("verdict") == "allow") / F.count("*")).alias("trusted"),
        (F.count_if(F.col("verdict") == "block") / F.count("*")).alias("blocked"),
    )
    hosts = materialize(hosts, "host-shares")
    edges = host_edges(placed)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    incoming = back.groupBy("src").agg(F.sum("weight").alias("total"))
    back = materialize(back.join(incoming, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("weight")), "host-edges-back")
    trust = propagate(hosts.select("host", F.col("trusted").alias("seed")), edges)
    distrust = propagate(hosts.select("host", F.col("blocked").alias("seed")), back)
    scores = trust.withColumnRenamed("score", "trust").join(distrust.withColumnRenamed("score", "distrust"), "host", "full")
    suspects = scores.where(F.coalesce("distrust", F.lit(0.0)) > F.greatest(F.coalesce("trust", F.lit(0.0)), F.lit(threshold)))
    suspects = materialize(suspects.select(F.col("host").alias("_host")), "host-suspects")
    found = ruled.join(broadcast_if_small(suspects, 64), F.col("host") == F.col("_host"), "left")
    method = F.when(F.col("_host").isNotNull(), "block").otherwise("allow")
    return found.withColumn("verdict", F.coalesce("verdict", method)).drop("_host")
