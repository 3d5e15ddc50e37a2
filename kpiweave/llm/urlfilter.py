"""URL verdicts: rules first, then trust and distrust propagated over the host graph."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiweave.llm.stage import written

Rule = tuple[str, str, str]  # verdict, host, path

DAMPING = 0.85
ROUNDS = 8
ROUNDS_PER_STAGE = 4
TOLERANCE = 1e-6
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)\bhref\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null. A rule fits its host and all subdomains where the path
    starts with the rule's. The rules are configuration of a bounded size, compiled into one expression."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float | None = None) -> DataFrame:
    """What (node, mass) collects over ``edges`` (src, dst, part) in the units of ``seeds`` (node, share): a seed has its share,
    and every node passes on what it has, times the edge's part, damped by each step. It takes ``ROUNDS`` rounds or, with
    ``tolerance``, goes on until no mass is further than that from its limit, where the parts that reach a node sum to one
    at most.

    Every round is one join on src and one sum by dst, combined before its shuffle; a hub's edges are one row per
    neighbour, and a join split by AQE spreads them. The state is written every few rounds to keep the plan short."""
    mass = before = seeds.select("node", F.col("share").alias("mass"))
    left = DAMPING**ROUNDS_PER_STAGE / (1 - DAMPING**ROUNDS_PER_STAGE)  # what is to come, of the last stage's growth
    done = 0
    while True:
        for _ in range(ROUNDS_PER_STAGE):
            spread = (
                mass.join(edges, mass["node"] == edges["src"])
                .select(F.col("dst").alias("node"), (F.col("part") * F.col("mass") * DAMPING).alias("mass"))
            )
            mass = spread.unionByName(seeds.select("node", F.col("share").alias("mass"))).groupBy("node").agg(F.sum("mass").alias("mass"))
        mass, done = written(mass, "url-mass"), done + ROUNDS_PER_STAGE
        if tolerance is None:
            if done >= ROUNDS:
                return mass
            continue
        grown = mass.join(before.select("node", F.col("mass").alias("old")), "node", "left")
        most = grown.agg(F.max(F.col("mass") - F.coalesce("old", F.lit(0.0)))).first()[0] or 0.0
        if most * left <= tolerance:
            return mass
        before = mass


def judge(
    pages: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, host, path, rule, verdict, host_score) of each page.

    A rule's verdict stands. Other pages take their host's: pages that rules allow are seeds of trust, which follows
    links; pages that rules block are seeds of distrust, which follows links backwards, to those who link there. Both
    are chances: distrust is that of a walk from a page of the host to end at a blocked page, where it ends at a page with
    a rule and else follows one of the host's links, damped by each step; trust the same against the links, for allowed
    pages. So neither shrinks with a host's pages nor with others that have the same links. A host's score is distrust -
    trust; from ``threshold`` on the host is blocked. Scores are within 2 * ``TOLERANCE`` of their limit.

    A host that nothing reaches is allowed, as is an empty one (null url, or none with ``://``): it takes part in no link.
    Links are href values with a host of their own; relative ones and those to their own host lead nowhere else and are
    left out; those to hosts without pages count and end there. Repeated rows are judged alike and count each."""
    url = F.col(url_column)
    parsed = (
        pages.select(
            F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
            F.transform(
                F.coalesce(F.regexp_extract_all(F.col(html_column), F.lit(LINK), F.lit(1)), F.array().cast("array<string>")),
                lambda h: F.translate(h, UPPER, LOWER),
            ).alias("links"),
        )
        .withColumn("matched", matching_rule(F.col("host"), F.col("path"), rules))
        .select("id", "host", "path", "links", F.col("matched.rule").alias("rule"), F.col("matched.verdict").alias("verdict"))
    )
    parsed = written(parsed, "url-pages")
    hosts = written(
        parsed.where("host <> ''").groupBy("host").agg(
            F.count("*").alias("pages"), F.count_if(F.col("verdict") == "allow").alias("allowed"),
            F.count_if(F.col("verdict") == "block").alias("blocked"),
        ),
        "url-hosts",
    )
    links = written(
        parsed.where("host <> ''").select(F.col("host").alias("src"), F.explode("links").alias("dst"))
        .where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n")),
        "url-links",
    )
    free = (1 - (F.col("allowed") + F.col("blocked")) / F.col("pages")).alias("free")  # chance to go on from a page of the host
    walks = lambda a, b: links.select(F.col(a).alias("src"), F.col(b).alias("dst"), "n").join(
        links.groupBy(F.col(b).alias("dst")).agg(F.sum("n").alias("total")), "dst"
    ).join(hosts.select(F.col("host").alias("dst"), free), "dst").select("src", "dst", (F.col("free") * F.col("n") / F.col("total")).alias("part"))
    seeds = lambda kind: hosts.where(F.col(kind) > 0).select(F.col("host").alias("node"), (F.col(kind) / F.col("pages")).alias("share"))
    reached = lambda kind, a, b, name: propagate(
        written(walks(a, b).where("part > 0"), "url-edges"), seeds(kind), TOLERANCE
    ).select(F.col("node").alias("host"), F.col("mass").alias(name))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    scored = (
        hosts.join(reached("allowed", "src", "dst", "trust"), "host", "left").join(reached("blocked", "dst", "src", "distrust"), "host", "left")
        .select("host", F.round(zero(F.col("distrust")) - zero(F.col("trust")), 9).alias("host_score"))
    )
    return (
        parsed.drop("links").join(scored, "host", "left")
        .select(
            "id", "host", "path", "rule",
            F.coalesce("verdict", F.when(F.col("host_score") >= threshold, "block").otherwise("allow")).alias("verdict"),
            "host_score",
        )
    )
