"""URL filter: listed rules first, then trust and distrust spread over the host graph.

Hosts whose pages a rule allows are seeds of trust, hosts whose pages a rule blocks
are seeds of distrust, each by the share of its pages. Trust runs along links, since
a trusted host links to hosts it vouches for; distrust runs against them, since who
links to a blocked host is to be distrusted. Both are personalised PageRank vectors
over host edges, worked out in the same rounds. A host is blocked where its distrust
passes a threshold and its trust; pages that no rule fits follow their host.

All of it is column expressions, joins and grouping. Pages are folded to hosts and
host pairs inside their tasks; a round moves rows of hosts and of host pairs only.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.functions.session import release
from odflux.llm.common import cut_lineage

DAMPING, ROUNDS, SETTLED = 0.85, 40, 1e-6
#: Distrust from which a host is blocked: as much as a host gets with this share of its pages blocked by rules.
BLOCK_FROM = 0.5
#: Edges of a host that one task joins at most, about; a hub has several slices.
EDGES_PER_SLICE = 100_000
#: Links with a host: an anchor's address, of any or no scheme. Relative links stay on their host and are no edges.
ANCHOR = r"""(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


class Rule(NamedTuple):
    """``action`` is allow or block; fits a host and its subdomains where the path begins with ``path``."""

    action: str
    host: str
    path: str


def _lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; empty if there is none."""
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct of the longest rule's text and action, null where none fits.

    Longest is by characters of host and path; of equally long ones the longer host
    wins, then block. The list becomes one expression, so it should stay short.
    """
    found = F.lit(None).cast("struct<rule: string, action: string>")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host), r.action == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.action).alias("action"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target, links): anchors from pages of one host to another host; hosts without a name are none."""
    named = pages.select(url_host(F.col(url)).alias("source"), F.explode(
        F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(1))).alias("target")).withColumn("target", _lower(F.col("target")))
    return named.where("source <> '' and target <> '' and source <> target").groupBy("source", "target").agg(
        F.count(F.lit(1)).alias("links"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS,
              settled: float = SETTLED) -> DataFrame:
    """(host, trust, distrust) of every host of ``seeds(host, trust, distrust)`` and ``links(source, target, links)``.

    Each vector is ``seed + damping * what arrives``, over links for trust and against them
    for distrust: personalised PageRank in units of a seed, so a host that nothing reaches
    has just its seed. What a host has is shared out by the number of links, and none is
    shared by a host without links in that direction. Rounds end once no value
    moves by ``settled``, or after ``rounds`` of them. A hub's edges are cut into slices by
    their far end, so no task holds them all; the vectors are written each round.
    """
    if rounds < 1 or not 0 <= damping < 1:
        raise ValueError("rounds must be at least 1 and damping within [0, 1)")
    links = cut_lineage(links)
    arcs = links.select(F.explode(F.array(
        F.struct(F.lit(False).alias("against"), F.col("source").alias("host"), F.col("target").alias("to"), "links"),
        F.struct(F.lit(True).alias("against"), F.col("target").alias("host"), F.col("source").alias("to"), "links"))).alias("e")).select("e.*")
    out = arcs.groupBy("host", "against").agg(
        F.sum("links").alias("total"), F.ceil(F.count(F.lit(1)) / F.lit(EDGES_PER_SLICE)).cast("int").alias("slices"))
    shares = arcs.join(out, ["host", "against"]).select(
        "host", "against", F.pmod(F.xxhash64("to"), F.col("slices")).cast("int").alias("slice"), "to",
        (F.col("links") / F.col("total")).alias("share")).repartition("host", "against", "slice").persist(StorageLevel.MEMORY_AND_DISK)
    hosts = seeds.select("host", "trust", "distrust").union(links.select(
        F.explode(F.array("source", "target")).alias("host"), F.lit(0.0), F.lit(0.0)))
    bases = hosts.groupBy("host").agg(F.max("trust").alias("trust"), F.max("distrust").alias("distrust")).select("host", F.explode(F.array(
        F.struct(F.lit(False).alias("against"), F.col("trust").alias("base")),
        F.struct(F.lit(True).alias("against"), F.col("distrust").alias("base")))).alias("b")).select("host", "b.*")
    state = cut_lineage(bases.join(out, ["host", "against"], "left").select(
        "host", "against", "base", F.coalesce("slices", F.lit(0)).alias("slices"), F.col("base").alias("score")))
    for _ in range(rounds):
        sent = state.where("slices > 0 and score > 0").select(
            "host", "against", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "score")
        arrived = shares.join(sent, ["host", "against", "slice"]).groupBy(F.col("to").alias("host"), "against").agg(
            F.sum(F.col("share") * F.col("score")).alias("arrived"))
        score = F.col("base") + F.lit(damping) * F.coalesce("arrived", F.lit(0.0))
        before, state = state, cut_lineage(state.join(arrived, ["host", "against"], "left").select(
            "host", "against", "base", "slices", score.alias("score"), F.abs(score - F.col("score")).alias("moved")))
        release(before)
        moved = state.agg(F.max("moved")).first()[0]
        if moved is None or moved < settled:
            break
    shares.unpersist()
    release(links)
    return state.groupBy("host").agg(F.max(F.when(~F.col("against"), F.col("score"))).alias("trust"),
                                     F.max(F.when(F.col("against"), F.col("score"))).alias("distrust"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", html: str = "html", threshold: float = BLOCK_FROM,
               damping: float = DAMPING, rounds: int = ROUNDS, settled: float = SETTLED) -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of those names are replaced, other columns and all rows stay.

    A null url, or one without ``://``, has an empty host, is no node of the graph and is
    allowed unless a rule fits. Repeated pages count as often as they stand there.
    """
    bad = [r for r in rules if r.action not in ("allow", "block") or not r.host]
    if bad:
        raise ValueError(f"rules need allow or block and a host: {bad}")
    where = {"host": url_host(F.col(url).cast("string")), "path": url_path(F.col(url).cast("string"))}
    fitted = pages.select(where["host"].alias("host"), fitting_rule(where["host"], where["path"], rules)["action"].alias("action"))
    seeds = fitted.where("host <> ''").groupBy("host").agg(
        F.avg((F.coalesce("action", F.lit("")) == "allow").cast("double")).alias("trust"),
        F.avg((F.coalesce("action", F.lit("")) == "block").cast("double")).alias("distrust"))
    scores = propagate(seeds, host_links(pages, url, html), damping, rounds, settled)
    blocked = scores.where((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))).select(
        F.col("host").alias("__host"), F.lit("block").alias("__by_graph"))
    others = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    placed = pages.select(*others, where["host"].alias("host"), where["path"].alias("path"),
                          fitting_rule(where["host"], where["path"], rules).alias("__rule"))
    judged = placed.join(blocked, placed["host"] == blocked["__host"], "left")
    return judged.select(*others, "host", "path", F.col("__rule.rule").alias("rule"),
                         F.coalesce("__rule.action", "__by_graph", F.lit("allow")).alias("verdict"))
