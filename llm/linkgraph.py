"""URL verdicts: rules first, then trust and distrust carried over the graph of host links.  DataFrame functions alone.

A link ``href`` or ``src`` with a host of its own gives an edge from the page's
host to that host; relative links stay on the host and count as none.  Edges are
counted per pair of hosts with map-side partial sums before the shuffle, and an
edge carries its share of its source's links.  A host is a trusted (blocked)
seed if rules allow (block) at least ``seed_share`` of its pages.  Trust runs
along the edges from the trusted seeds and distrust against them from the
blocked seeds, both as personalised PageRank in one loop of joins:
``x = (1 - damping) * seeds + damping * x P``; what reaches a host without
further edges stays there.  The loop ends when no host's score moves by more than
``tolerance``; as a round shrinks what is left by ``damping``, that takes at most
``log(tolerance / seeds) / log(damping)`` rounds.  A host is blocked if its distrust is at least
``least`` and above its trust.

Each block of rounds is written to the shared checkpoint folder, so a lost
executor repeats a few joins at most.  Scores have one row per host and kind, so
the joins with pages and edges split a hot host like any skewed join.

Defined results: a url that is null or has no ``://`` has empty host and path,
fits no rule and is allowed; null html has no links; rows with equal or null
``page_id`` are judged one by one; an empty table stays empty.  Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
BLOCK_ROUNDS = 4


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting (verdict, host, path) as ``struct<length, rule, verdict>``, null if none fits."""
    fits = [F.when((F.concat(F.lit("."), host).endswith(F.lit("." + h))) & path.startswith(F.lit(p)),
                   F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links`` of the links between different hosts; ``pages`` has ``host, html``."""
    target = F.explode(F.array_distinct(F.regexp_extract_all(F.col("html"), F.lit(LINK), 1)))
    links = pages.select(F.col("host").alias("src"), target.alias("dst")).withColumn("dst", F.translate("dst", UPPER, LOWER))
    return links.where((F.col("src") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """``host, trust, distrust`` of every host reached from the seeds (``host, trusted, blocked``)."""
    out = edges.groupBy("src").agg(F.sum("links").alias("all_out"))
    into = edges.groupBy("dst").agg(F.sum("links").alias("all_in"))
    steps = cut_lineage(
        edges.join(out, "src").select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"),
                                      (F.col("links") / F.col("all_out")).alias("share"))
        .unionByName(edges.join(into, "dst").select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"),
                                                    F.col("src").alias("to"), (F.col("links") / F.col("all_in")).alias("share"))))
    start = cut_lineage(
        seeds.where("trusted").select(F.lit("trust").alias("kind"), "host", F.lit(1.0 - damping).alias("score"))
        .unionByName(seeds.where("blocked").select(F.lit("distrust").alias("kind"), "host", F.lit(1.0 - damping).alias("score"))))
    scores = start
    while True:
        before = scores
        for _ in range(BLOCK_ROUNDS):
            moved = scores.join(steps, ["kind", "host"]).select(
                "kind", F.col("to").alias("host"), (F.lit(damping) * F.col("score") * F.col("share")).alias("score"))
            scores = start.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        scores = cut_lineage(scores)
        moves = scores.join(before.withColumnRenamed("score", "before"), ["kind", "host"], "left").agg(
            F.max(F.abs(F.col("score") - F.coalesce("before", F.lit(0.0)))).alias("most")).first().most
        if moves is None or moves <= tolerance:
            break
    of = lambda kind: F.round(F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)), 9)
    return scores.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], seed_share: float = 0.5, least: float = 0.01,
               damping: float = 0.85) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every row of ``pages``."""
    host, path = host_and_path(F.col("url"))
    cut = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"),
                       F.col("html").cast("string").alias("html"))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = cut.select("page_id", "host", "path", rule.alias("fit"))
    share = lambda v: F.avg(F.coalesce(F.col("fit.verdict") == v, F.lit(False)).cast("double")) >= seed_share
    seeds = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trusted"), share("block").alias("blocked"))
    scores = propagate(seeds, cut_lineage(host_edges(cut)), damping)
    joined = ruled.join(scores, "host", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    method = F.when((F.col("distrust") >= least) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")
