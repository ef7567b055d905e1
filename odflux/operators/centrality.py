"""PageRank, betweenness and the composite importance score as DataFrame iterations.

State is always a distributed frame keyed by node or by (source, node). Each
round is a join and a partially aggregated ``groupBy``, so a hub with a third of
all edges folds before the shuffle and its edges are spread over many tasks.
Each round's state is written to the checkpoint folder: a lost executor costs
one round at most, and the plan of a round stays the same size.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.functions.columns import or_zero
from odflux.functions.session import cut_lineage, ensure_checkpoint_dir, release
from odflux.operators.path_sums import path_sums
from odflux.operators.projection import distribution

EDGES_PER_SLICE = 250_000
#: Links that a task of a betweenness run may hold (some 60 bytes each at most); larger graphs go by joins.
LINKS_IN_TASK = 5_000_000
#: Rows (source, node) that the tables of a betweenness run by joins may hold at once; more sources take turns.
PAIRS_AT_ONCE = 50_000_000
NARROW_RANGE = 1e-12


@dataclass(frozen=True)
class RankRun:
    scores: DataFrame
    iterations: int
    converged: bool


# Named parameter sets of the two centrality passes.
PAGERANK_PRESETS = {
    "demand_pull": {"max_iter": 30, "damping": 0.85, "tol": 1e-7, "weight": "trip_count"},
    "topology_only": {"max_iter": 20, "weight": None},
}
BETWEENNESS_PRESETS = {
    "exact": {"sample": None, "weight": None},
    "travel_time": {"sample": None, "weight": "avg_duration_seconds"},
}
IMPORTANCE_PRESETS = {"default": (0.65, 0.35), "balanced": (0.5, 0.5), "corridor": (0.3, 0.7)}


def sampled_corridors(sample: int, seed: int) -> dict:
    return {"sample": sample, "seed": seed, "weight": None}


def _laid_out(nodes: DataFrame, edges: DataFrame, weight: str | None,
              base: Column) -> tuple[DataFrame, DataFrame]:
    """Edges as (src, slice, dst, share) and nodes as (id, base, slices), placed once and kept.

    Edges stay where they are for the whole run; only node-sized frames move.
    The edges of a hub are cut into slices by destination, so no partition
    holds more than a bounded part of them.
    """
    places = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = or_zero(F.col(weight)) if weight else F.lit(1.0)
    pairs = edges.select("src", "dst", w.alias("w")).groupBy("src", "dst").agg(F.sum("w").alias("w"))
    pairs = pairs.where(F.col("w") > 0)
    out = pairs.groupBy("src").agg(
        F.sum("w").alias("total"), F.ceil(F.count(F.lit(1)) / F.lit(EDGES_PER_SLICE)).cast("int").alias("slices"))
    shares = pairs.join(out, "src").select(
        "src", F.pmod(F.hash("dst"), F.col("slices")).alias("slice"), "dst",
        (F.col("w") / F.col("total")).alias("share"))
    state = nodes.select("id", base.alias("base")).join(
        out.select(F.col("src").alias("id"), "slices"), "id", "left").fillna(0, ["slices"])
    return (shares.repartition(places, "src", "slice").persist(StorageLevel.MEMORY_AND_DISK),
            state.repartition(places, "id").persist(StorageLevel.MEMORY_AND_DISK))


def pagerank(nodes: DataFrame, edges: DataFrame, max_iter: int = 20, damping: float = 0.85,
             tol: float = 1e-7, weight: str | None = "trip_count", seeds: Iterable[int] | None = None,
             scaler: str | None = None) -> RankRun:
    """``score = (1-d)·base + d·Σ share·score``; ``base`` is 1, or the seed flag when personalised.

    Scores are not normalised and the mass of sinks is not redistributed. Stops
    once no score moves by ``tol``; ``tol=0`` runs exactly ``max_iter`` rounds.
    """
    if max_iter < 1 or not 0 <= damping < 1:
        raise ValueError("max_iter must be at least 1 and damping within [0, 1)")
    flag = F.lit(1.0) if seeds is None else F.col("id").isin(*list(seeds)).cast("double")
    shares, state = _laid_out(nodes, edges, weight, flag * (1.0 - damping))
    ranks = state.select("*", F.col("base").alias("score"))
    iterations, converged = 0, False
    while iterations < max_iter and not converged:
        sent = ranks.where(F.col("slices") > 0).select(
            F.col("id").alias("src"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "score")
        received = (
            shares.join(sent, ["src", "slice"]).groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("share") * F.col("score")).alias("received"))
        )
        score = F.col("base") + F.lit(damping) * or_zero(F.col("received"))
        # Only the node frame is written each round, so the plan of a round never grows; the round before is done with.
        before, ranks = ranks, cut_lineage(ranks.join(received, "id", "left").select(
            "id", "base", "slices", score.alias("score"), F.abs(score - F.col("score")).alias("shift")))
        release(before)
        iterations += 1
        if tol > 0:
            shift = ranks.agg(F.max("shift")).first()[0]
            converged = shift is None or shift < tol
    shares.unpersist()
    state.unpersist()
    scores = ranks.select("id", "score")
    return RankRun(scale_scores(scores, scaler) if scaler else scores, iterations, converged)


def scale_scores(scores: DataFrame, scaler: str) -> DataFrame:
    """Rescale ``score``: minmax, max, mean, log, stdscore, l1norm or l2norm."""
    s = F.col("score")
    whole = {
        "lo": F.min(s), "hi": F.max(s), "top": F.max(F.abs(s)), "avg": F.avg(s), "sd": F.stddev_pop(s),
        "l1": F.sum(F.abs(s)), "l2": F.sqrt(F.sum(s * s)),
    }
    of = lambda name: scores.agg(whole[name].alias(name)).scalar()
    spread = lambda: scores.agg((whole["hi"] - whole["lo"]).alias("r")).scalar()
    formulas = {
        "minmax": lambda: (s - of("lo"), spread()),
        "max": lambda: (s, of("top")),
        "mean": lambda: (s - of("avg"), spread()),
        "stdscore": lambda: (s - of("avg"), of("sd")),
        "l1norm": lambda: (s, of("l1")),
        "l2norm": lambda: (s, of("l2")),
    }
    if scaler == "log":
        return scores.withColumn("score", F.log(s))
    if scaler not in formulas:
        raise ValueError(f"unknown scaler {scaler!r}")
    top, bottom = formulas[scaler]()
    return scores.withColumn("score", or_zero(F.try_divide(top, bottom)))


# --- betweenness -----------------------------------------------------------

def _sources(nodes: DataFrame, sample: int | None, seed: int | None) -> DataFrame:
    ids = nodes.select(F.col("id").alias("source"))
    if sample is None:
        return ids
    return ids.orderBy(F.xxhash64("source", F.lit(seed or 0)), "source").limit(sample)


class _LevelTable:
    """Rows of all rounds of one run in one table, a folder per level: a round adds its folder, a reader prunes to a level."""

    def __init__(self, spark: SparkSession, columns: str):
        self.spark, self.columns, self.levels = spark, columns, 0
        self.path = f"{ensure_checkpoint_dir(spark)}/levels-{uuid.uuid4().hex}"

    def put(self, frame: DataFrame, level: int | None = None) -> DataFrame:
        level = self.levels if level is None else level
        frame.write.parquet(f"{self.path}/level={level}")
        self.levels = max(self.levels, level + 1)
        return self.at(level)

    def whole(self) -> DataFrame:
        return self.spark.read.schema(f"{self.columns}, level int").parquet(self.path)

    def at(self, level: int) -> DataFrame:
        return self.spark.read.schema(self.columns).parquet(f"{self.path}/level={level}")

    def drop(self) -> None:
        location = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        location.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(location, True)


def _columns_of(nodes: DataFrame, more: str) -> str:
    kind = dict(nodes.dtypes)["id"]
    return f"source {kind}, node {kind}, {more}"


def _hop_levels(sources: DataFrame, links: DataFrame, table: _LevelTable) -> None:
    """Breadth-first rounds: level k of ``table`` holds (source, node, paths) at distance k."""
    frontier = table.put(sources.select("source", F.col("source").alias("node"), F.lit(1.0).alias("paths")))
    while not frontier.isEmpty():
        frontier = table.put(
            frontier.join(links, F.col("node") == F.col("src"))
            .groupBy("source", F.col("dst").alias("node")).agg(F.sum("paths").alias("paths"))
            .join(table.whole().select("source", "node"), ["source", "node"], "left_anti"))
    table.levels -= 1  # the last one is empty


def _relax(sources: DataFrame, links: DataFrame) -> DataFrame:
    """Least cost from each source: (source, node, cost), by repeated relaxation of improved rows."""
    best = cut_lineage(sources.select("source", F.col("source").alias("node"), F.lit(0.0).alias("cost")))
    changed = best
    while True:
        offers = (
            changed.join(links, F.col("node") == F.col("src"))
            .groupBy("source", F.col("dst").alias("node")).agg(F.min(F.col("cost") + F.col("w")).alias("offer"))
        )
        better = cut_lineage(
            offers.join(best, ["source", "node"], "left")
            .where(F.col("cost").isNull() | (F.col("offer") < F.col("cost")))
            .select("source", "node", F.col("offer").alias("cost"))
        )
        if better.isEmpty():
            release(better)
            if changed is not best:
                release(changed)
            return best
        before, best = best, cut_lineage(best.join(better, ["source", "node"], "left_anti").unionByName(better))
        release(before)
        if changed is not before:
            release(changed)
        changed = better


def _weighted_levels(sources: DataFrame, links: DataFrame, table: _LevelTable) -> DataFrame:
    """Shortest-path levels by longest hop count go to ``table``; the shortest-path links themselves are returned."""
    best = _relax(sources, links)
    arrive = best.select("source", F.col("node").alias("dst"), F.col("cost").alias("there"))
    tight = cut_lineage(
        best.join(links, F.col("node") == F.col("src"))
        .join(arrive, ["source", "dst"])
        .where(F.col("cost") + F.col("w") == F.col("there"))
        .select("source", "src", "dst")
    )
    depth = cut_lineage(best.select("source", "node", F.lit(0).alias("level")))
    raised = depth.where(F.col("source") == F.col("node"))
    step = 0
    while True:
        step += 1
        reached, raised = raised, cut_lineage(
            raised.join(tight.withColumnRenamed("src", "node"), ["source", "node"])
            .select("source", F.col("dst").alias("node")).distinct()
        )
        release(reached)
        if raised.isEmpty():
            release(raised)
            break
        before, depth = depth, cut_lineage(
            depth.join(raised.withColumn("_up", F.lit(step)), ["source", "node"], "left")
            .select("source", "node", F.coalesce("_up", "level").alias("level"))
        )
        release(before)
    table.put(sources.select("source", F.col("source").alias("node"), F.lit(1.0).alias("paths")))
    for k in range(1, step):
        at_k = depth.where(F.col("level") == k).select("source", F.col("node").alias("dst"))
        table.put(
            tight.join(at_k, ["source", "dst"])
            .join(table.whole().select("source", F.col("node").alias("src"), "paths"), ["source", "src"])
            .groupBy("source", F.col("dst").alias("node")).agg(F.sum("paths").alias("paths")))
    release(depth)
    release(best)
    return tight


def _dependencies(nodes: DataFrame, edges: DataFrame, sources: DataFrame, weight: str | None,
                  pairs_at_once: int | None = None) -> DataFrame:
    """(id, total, squares) of every node that lies between: sums over the sources of its share of their shortest paths.

    Sources are dealt out to tasks that walk the graph from each. Graphs of more than ``LINKS_IN_TASK`` links
    are not sent to tasks but joined with the sources, round by round. Sources whose rows (source, node) may then be more
    than ``pairs_at_once`` take turns, dealt by hash: the tables of a turn are deleted before the next, and what
    stays of it is one row a node. The work is that of all pairs; memory and disk are not.
    """
    limit = PAIRS_AT_ONCE if pairs_at_once is None else pairs_at_once
    nodes, sources = cut_lineage(nodes.select("id")), cut_lineage(sources)
    edges = cut_lineage(edges.select("src", "dst", *([weight] if weight else [])))
    try:
        if edges.count() <= LINKS_IN_TASK:
            return _walked(nodes, edges, sources, weight)
        turns = max(1, math.ceil(nodes.count() * sources.count() / limit))
        if turns == 1:
            return _turn(nodes, edges, sources, weight)
        total = None
        for k in range(turns):
            found = _turn(nodes, edges, sources.where(F.pmod(F.xxhash64("source"), F.lit(turns)) == k), weight)
            if total is None:
                total = found
                continue
            before, total = total, cut_lineage(total.unionByName(found).groupBy("id").agg(
                F.sum("total").alias("total"), F.sum("squares").alias("squares")))
            release(before)
            release(found)
            # Shuffle files go when the JVM collects the plans they belong to.
            nodes.sparkSession._jvm.System.gc()
        return total
    finally:
        for frame in (nodes, edges, sources):
            release(frame)


def _links(edges: DataFrame, weight: str | None) -> DataFrame:
    """The least of the parallel edges of each pair."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return edges.where(F.col("src") != F.col("dst")).groupBy("src", "dst").agg(F.min(w).alias("w"))


def _refuse_free(links: DataFrame, weight: str) -> None:
    if not links.where(F.col("w").isNull() | (F.col("w") <= 0)).isEmpty():
        raise ValueError(f"path costs in {weight!r} must be positive")


def _walked(nodes: DataFrame, edges: DataFrame, sources: DataFrame, weight: str | None) -> DataFrame:
    """``_dependencies`` by tasks that each hold the links and take their sources one by one."""
    spark = nodes.sparkSession
    links = cut_lineage(_links(edges, weight))
    try:
        if weight:
            _refuse_free(links, weight)
        tasks = max(1, min(4 * spark.sparkContext.defaultParallelism, sources.count()))
        # One key for each partition, so that no task has the sources of two.
        keys = [r["key"] for r in spark.range(32 * tasks).groupBy(F.pmod(F.hash("id"), F.lit(tasks))).agg(F.min("id").alias("key")).collect()]
        of = F.array(*[F.lit(k) for k in keys])
        dealt = sources.where(F.col("source").isNotNull()).withColumn("key", F.element_at(of, F.pmod(F.xxhash64("source"), F.lit(len(keys))).cast("int") + 1))
        copies = links.withColumn("key", F.explode(of))
        found = (dealt.repartition(tasks, "key").groupBy("key").cogroup(copies.repartition(tasks, "key").groupBy("key"))
                 .applyInArrow(path_sums(weight is not None), f"id {dict(links.dtypes)['src']}, total double, squares double"))
        summed = found.groupBy("id").agg(F.sum("total").alias("total"), F.sum("squares").alias("squares"))
        return cut_lineage(nodes.select("id").join(summed, "id", "left").select(
            "id", or_zero(F.col("total")).alias("total"), or_zero(F.col("squares")).alias("squares")))
    finally:
        release(links)


def _turn(nodes: DataFrame, edges: DataFrame, sources: DataFrame, weight: str | None) -> DataFrame:
    """``_dependencies`` of some sources, by joins.

    All rounds of a run are folders of two tables, paths forwards and credit
    backwards, which are deleted at its end; no plan is a union that grows by the round.
    """
    links = _links(edges, weight).persist(StorageLevel.MEMORY_AND_DISK)
    sources = cut_lineage(sources)
    spark, tight = nodes.sparkSession, None
    paths = _LevelTable(spark, _columns_of(nodes, "paths double"))
    credits = _LevelTable(spark, _columns_of(nodes, "paths double, credit double"))
    handed = _LevelTable(spark, _columns_of(nodes, "credit double"))
    try:
        if weight:
            _refuse_free(links, weight)
            tight = _weighted_levels(sources, links, paths)
        else:
            _hop_levels(sources, links, paths)
        last = paths.levels - 1
        # Backwards: each node hands its share to the nodes right before it on shortest paths.
        for k in range(last, 0, -1):
            here = paths.at(k)
            if k == last:
                credited = here.withColumn("credit", F.lit(0.0))
            else:
                # By hops only the level after hands anything to this one; by cost any later level may.
                came = (handed.at(k + 1) if tight is None else handed.whole()).groupBy("source", "node").agg(F.sum("credit").alias("credit"))
                credited = here.join(came, ["source", "node"], "left").select("source", "node", "paths", or_zero(F.col("credit")).alias("credit"))
            giver = credits.put(credited, k).select("source", F.col("node").alias("dst"), ((1.0 + F.col("credit")) / F.col("paths")).alias("unit"))
            if k == 1:
                break  # what is left goes to the sources themselves
            if tight is None:
                given = giver.join(links.select("src", "dst"), "dst").join(paths.at(k - 1).withColumnRenamed("node", "src"), ["source", "src"])
            else:
                given = giver.join(tight, ["source", "dst"]).join(
                    paths.whole().select("source", F.col("node").alias("src"), "paths"), ["source", "src"])
            handed.put(given.select("source", F.col("src").alias("node"), (F.col("paths") * F.col("unit")).alias("credit")), k)
        if last < 1:
            return cut_lineage(nodes.select("id", F.lit(0.0).alias("total"), F.lit(0.0).alias("squares")))
        summed = credits.whole().groupBy(F.col("node").alias("id")).agg(
            F.sum("credit").alias("total"), F.sum(F.col("credit") * F.col("credit")).alias("squares"))
        return cut_lineage(nodes.select("id").join(summed, "id", "left").select(
            "id", or_zero(F.col("total")).alias("total"), or_zero(F.col("squares")).alias("squares")))
    finally:
        links.unpersist()
        for table in (paths, credits, handed):
            table.drop()
        if tight is not None:
            release(tight)
        release(sources)


def betweenness(nodes: DataFrame, edges: DataFrame, sample: int | None = None, seed: int | None = None,
                weight: str | None = None, directed: bool = True) -> DataFrame:
    """(id, score): shortest paths through each node, ends excluded.

    Exact over all sources, or the part that ``sample`` sources, picked by a seeded
    hash, account for; ``betweenness_estimate`` scales that up and says how far off it may be.
    With ``weight`` a path costs the sum of that (positive) edge column. A graph
    listed in both directions counts every pair twice; ``directed=False`` halves.
    """
    halves = 1.0 if directed else 0.5
    found = _dependencies(nodes, edges, _sources(nodes, sample, seed), weight)
    return found.select("id", (F.col("total") * halves).alias("score"))


def betweenness_estimate(nodes: DataFrame, edges: DataFrame, sample: int, seed: int = 42, weight: str | None = None,
                         directed: bool = True, doubt: float = 0.05) -> DataFrame:
    """(id, score, error_bound) from ``sample`` seeded pivots; rounds keep sample x nodes rows, not nodes x nodes.

    A node's share of one source's paths lies between 0 and n - 2. With probability
    1 - ``doubt``, over the draw of the pivots, every node's exact score is within its
    bound: the lesser of Hoeffding's, from that range, and the empirical Bernstein
    bound, from the spread over the pivots, each at half the doubt shared by all nodes. All
    nodes as pivots give exact scores and a bound of 0.
    """
    if sample < 1 or not 0 < doubt < 1:
        raise ValueError("at least one pivot, and a doubt within (0, 1)")
    n = nodes.count()
    k = min(sample, n)
    found = _dependencies(nodes, edges, _sources(nodes, sample, seed), weight)
    halves, most = 1.0 if directed else 0.5, float(max(n - 2, 0))
    if not k:
        return found.select("id", F.col("total").alias("score"), F.lit(0.0).alias("error_bound"))
    # Two sides, two bounds and n nodes share the doubt.
    hoeffding = F.lit(most * math.sqrt(math.log(4.0 * n / doubt) / (2.0 * k)))
    one = math.log(8.0 * n / doubt)
    spread = F.greatest(F.col("squares") - F.col("total") * F.col("total") / k, F.lit(0.0)) / max(k - 1, 1)
    bernstein = F.sqrt(spread * 2.0 * one / k) + F.lit(7.0 * most * one / (3.0 * max(k - 1, 1)))
    bound = F.lit(0.0) if k == n else F.least(hoeffding, bernstein) * n * halves
    return found.select("id", (F.col("total") * (n / k) * halves).alias("score"), bound.alias("error_bound"))


# --- importance ------------------------------------------------------------

def _unit_range(scores: DataFrame, column: str) -> Column:
    """Column scaled to [0, 1]; 0 throughout when all values are the same."""
    lo = scores.agg(F.min(column).alias("lo")).scalar()
    width = scores.agg((F.max(column) - F.min(column)).alias("w")).scalar()
    return F.when(width <= NARROW_RANGE, 0.0).otherwise((F.col(column) - lo) / width)


def zone_importance(pagerank_scores: DataFrame, betweenness_scores: DataFrame, w_pr: float = 0.65,
                    w_bc: float = 0.35) -> DataFrame:
    """One row per zone: both scores, both on [0, 1], their weighted mix, rank and corridor bias."""
    if w_pr < 0 or w_bc < 0 or w_pr + w_bc <= 0:
        raise ValueError("weights must be non-negative and not both zero")
    both = (
        pagerank_scores.select(F.col("id").alias("location_id"), F.col("score").alias("page_rank_score"))
        .join(betweenness_scores.select(F.col("id").alias("location_id"), F.col("score").alias("betweenness_score")),
              "location_id", "full_outer")
        .fillna(0.0, ["page_rank_score", "betweenness_score"])
    )
    share = w_pr / (w_pr + w_bc)
    scaled = both.select(
        "*",
        _unit_range(both, "page_rank_score").alias("page_rank_normalised"),
        _unit_range(both, "betweenness_score").alias("betweenness_normalised"),
    ).select(
        "*",
        (F.col("page_rank_normalised") * F.lit(share)
         + F.col("betweenness_normalised") * F.lit(w_bc / (w_pr + w_bc))).alias("importance_score"),
        (F.col("betweenness_normalised") - F.col("page_rank_normalised")).alias("corridor_bias"),
    )
    return global_rank(scaled, [F.desc("importance_score"), F.asc("location_id")], "importance_rank")


def global_rank(frame: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1-based position in a total order, without sorting everything in one task.

    Rows are range-partitioned and sorted, numbered inside their partition, and
    shifted by the sizes of the partitions before. Only those sizes meet in one
    place, one row per partition.
    """
    from pyspark.sql import Window

    placed = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = placed.select("*", F.monotonically_increasing_id().alias("_seq"))
    seq = cut_lineage(numbered.select("*", F.shiftright("_seq", 33).alias("_part")))
    sizes = seq.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.col("_seq") - F.shiftleft(F.col("_part"), 33)
    return seq.join(offsets, "_part").withColumn(name, (inside + F.col("_off") + 1).cast("int")) \
        .drop("_seq", "_part", "_off")


def corridor_zones(scores: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Zones that carry traffic beyond what their own pull explains, strongest first."""
    return scores.where(F.col("corridor_bias") >= threshold).orderBy(F.desc("corridor_bias"), "location_id")


def top_scores(scores: DataFrame, limit: int = 0) -> DataFrame:
    ranked = scores.orderBy(F.desc("score"), F.asc("id"))
    return ranked.limit(limit) if limit else ranked


def score_distribution(scores: DataFrame, col: str = "score", exact: bool = False) -> DataFrame:
    return distribution(scores, col, exact)


def analyse_centrality(nodes: DataFrame, edges: DataFrame, pagerank_args: dict | None = None,
                       betweenness_args: dict | None = None, weights: tuple[float, float] = (0.65, 0.35)) -> DataFrame:
    """Both passes and the ranking; an empty graph is an error."""
    if nodes.isEmpty():
        raise ValueError("centrality needs a graph of at least one node")
    ranked = pagerank(nodes, edges, **(pagerank_args or PAGERANK_PRESETS["demand_pull"]))
    if not ranked.converged:
        import warnings
        warnings.warn(f"ranks still moved after round {ranked.iterations}; allow more rounds or a wider tolerance")
    args = betweenness_args or BETWEENNESS_PRESETS["exact"]
    if args.get("sample"):
        between = betweenness_estimate(nodes, edges, **{k: v for k, v in args.items() if v is not None}).select("id", "score")
    else:
        between = betweenness(nodes, edges, **args)
    return zone_importance(ranked.scores, between, *weights)
