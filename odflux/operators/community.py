"""Louvain communities, modularity, partition stability and community profiles."""

from __future__ import annotations

import warnings

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from odflux.functions.columns import half_open, long_or_zero, or_zero, safe_ratio
from odflux.functions.session import cut_lineage, release
from odflux.operators.centrality import EDGES_PER_SLICE, global_rank
from odflux.operators.projection import UNDIRECTED, GraphSpec

MEANINGFUL_MODULARITY = 0.3
STABLE_RAND_INDEX = 0.9
LINKS_PER_PLACE = 50_000

# Named parameter sets of the community pass.
LOUVAIN_PRESETS = {
    "catchments": {"max_levels": 10, "max_iter": 10, "tol": 1e-4, "weight": "trip_count"},
    "topology_only": {"weight": None},
    "hierarchical": {"weight": "trip_count", "intermediate": True},
    "seeded": {"weight": "trip_count", "seed_col": "community_id"},
}


def coarse(min_size: int) -> dict:
    return {"weight": "trip_count", "min_size": min_size}


def require_undirected(spec: GraphSpec) -> None:
    if spec.orientation != UNDIRECTED:
        raise ValueError(
            f"{spec.name} lists its edges as {spec.orientation}; give Louvain edges in both directions, "
            "as GraphSpec(orientation='undirected') makes them"
        )


def _folded(edges: DataFrame, weight: str | None) -> DataFrame:
    w = or_zero(F.col(weight)) if weight else F.lit(1.0)
    return edges.groupBy("src", "dst").agg(F.sum(w).alias("w")).where(F.col("w") > 0)


def modularity(edges: DataFrame, assignment: DataFrame, weight: str | None = "trip_count") -> DataFrame:
    """One row: Q of ``assignment(id, community_id)`` on edges listed in both directions."""
    return _modularity(_folded(edges, weight), assignment.select("id", F.col("community_id").alias("c")))


def _community_totals(links: DataFrame, member: DataFrame) -> DataFrame:
    """(c, inside, total): weight staying in and weight leaving from each community."""
    ends = (
        links.join(member.select(F.col("id").alias("src"), F.col("c").alias("cs")), "src")
        .join(member.select(F.col("id").alias("dst"), F.col("c").alias("cd")), "dst")
    )
    same = F.when(F.col("cs") == F.col("cd"), F.col("w")).otherwise(0.0)
    return ends.groupBy(F.col("cs").alias("c")).agg(F.sum(same).alias("inside"), F.sum("w").alias("total"))


def _modularity(links: DataFrame, member: DataFrame) -> DataFrame:
    sums = _community_totals(links, member).agg(
        F.sum("inside").alias("i"), F.sum("total").alias("t"), F.sum(F.col("total") * F.col("total")).alias("tt"))
    t = F.col("t")
    return sums.select(or_zero(F.try_divide(F.col("i"), t) - F.try_divide(F.col("tt"), t * t)).alias("modularity"))


def _placed(links: DataFrame, member: DataFrame) -> tuple[DataFrame, DataFrame, float, int]:
    """Links of one level dealt out by their far end once, a hub's in slices, ``state(id, c, k, own, slices)``, the sum of all k, and the number of places.

    Turns move node-sized frames to the links; the links stay where they are. A link carries what
    holds for its near end throughout the level, and each node has a link of no weight to itself,
    by which it hears of its own community. ``slices`` serves both ends, as links are listed in both directions.
    """
    loop = F.col("src") == F.col("dst")
    ends = links.groupBy(F.col("src").alias("id")).agg(
        F.sum("w").alias("k"), F.sum(F.when(loop, F.col("w")).otherwise(0.0)).alias("own"), F.count_if(~loop).alias("n"))
    state = cut_lineage(member.join(ends, "id", "left").select(
        "id", "c", or_zero(F.col("k")).alias("k"), or_zero(F.col("own")).alias("own"),
        (F.floor(F.coalesce("n", F.lit(0)) / F.lit(EDGES_PER_SLICE)) + 1).cast("int").alias("slices")))
    # few links take few places, so that small levels are not spent on empty tasks
    whole, rows = state.agg(F.sum("k"), F.count(F.lit(1))).first()
    rows += links.where(~loop).count()
    places = min(int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // LINKS_PER_PLACE) or 1)
    near = state.select(F.col("id").alias("src"), "k", F.col("slices").alias("pieces"))
    far = state.select(F.col("id").alias("dst"), "slices")
    between = links.where(~loop).select("src", "dst", "w").join(near, "src").join(far, "dst").select(
        "src", "dst", "w", "k", "pieces", F.lit(None).cast("double").alias("own"),
        F.pmod(F.xxhash64("src"), F.col("slices")).cast("int").alias("slice"))
    themselves = state.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("w"), "k",
                              F.col("slices").alias("pieces"), "own", F.lit(0).alias("slice"))
    dealt = between.unionByName(themselves).repartition(places, "dst", "slice")
    return dealt.persist(StorageLevel.MEMORY_AND_DISK), state, whole or 0.0, places


def _weighed(placed: DataFrame, places: int, state: DataFrame, whole: float, turn: int) -> DataFrame:
    """One turn: every node of ``state(id, c, k, own, slices)`` with its best community.

    A node weighs staying against each neighbouring community by
    ``w(node, c) - k·total(c)/whole``; ties go to the smaller label. Only a
    hashed half of the nodes may move per turn, so neighbours rarely swap
    labels. ``inner`` is the weight the node sends into its own community and
    ``around`` that community's weight: the modularity of the membership as it was
    is a plain sum of them over nodes. What a node hears is shuffled once, a
    hub's in pieces by community, and is summed and compared where it arrives.
    """
    sizes = state.groupBy("c").agg(F.sum("k").alias("total"))
    told = state.join(sizes, "c").select(
        F.col("id").alias("dst"), "c", "total", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    heard = placed.join(told, ["dst", "slice"]).select(
        F.col("src").alias("id"), F.pmod(F.xxhash64("c"), F.col("pieces")).cast("int").alias("piece"), "c", "total", "w", "k", "own",
        F.col("pieces").alias("slices"), (F.col("src") == F.col("dst")).alias("itself"))
    options = heard.repartition(places, "id", "piece").groupBy("id", "piece", "c").agg(
        F.sum("w").alias("to_c"), F.max("total").alias("total"), F.max("k").alias("k"), F.max("own").alias("own"),
        F.max("slices").alias("slices"), F.max("itself").alias("stays"))
    others = F.col("total") - F.when(F.col("stays"), F.col("k")).otherwise(0.0)
    scored = options.withColumn("gain", F.col("to_c") - F.col("k") * others / F.lit(whole))
    at_its_own = lambda name: F.max(F.when(F.col("stays"), F.col(name)))
    picked = scored.groupBy("id").agg(
        at_its_own("c").alias("home"), F.max("k").alias("k"), F.max("own").alias("own"), F.max("slices").alias("slices"),
        at_its_own("gain").alias("stay"), at_its_own("to_c").alias("inner"), at_its_own("total").alias("around"),
        F.max("gain").alias("top"),
        F.min_by("c", F.struct(-F.col("gain"), F.col("c"))).alias("best"),
    )
    free = F.pmod(F.xxhash64("id", F.lit(turn // 2)), F.lit(2)) == turn % 2
    moves = free & (F.col("top") > F.col("stay") + 1e-12)
    return picked.select(
        "id", F.when(moves, F.col("best")).otherwise(F.col("home")).alias("c"), "k", "own", "slices",
        (F.col("inner") + F.col("own")).alias("inner"), "around", moves.alias("moves"))


def _turned(placed: DataFrame, places: int, state: DataFrame, whole: float, turn: int) -> tuple[DataFrame, float, int]:
    """The state after a turn, written, with the modularity of the one before and the nodes moved, added up while it was written."""
    sums = Observation()
    watched = _weighed(placed, places, state, whole, turn).observe(
        sums, F.sum("inner").alias("inside"), F.sum(F.col("k") * F.col("around")).alias("squares"), F.count_if("moves").alias("moved"))
    after = cut_lineage(watched.select("id", "c", "k", "own", "slices"))
    found = sums.get
    return after, found["inside"] / whole - found["squares"] / (whole * whole), found["moved"]


def _one_level(links: DataFrame, member: DataFrame, max_iter: int, tol: float) -> tuple[DataFrame, float]:
    """Moves nodes until two turns in a row gain nothing; a turn that loses modularity is undone."""
    placed, kept, whole, places = _placed(links, member)
    if whole <= 0:
        placed.unpersist()
        return kept.select("id", "c"), 0.0
    quality, idle, trial, moved, last = None, 0, kept, 0, 2 * max_iter
    for turn in range(last + 1):
        after, reached, moving = _turned(placed, places, trial, whole, turn)
        if quality is None or reached > quality:
            idle = 0 if quality is None or reached - quality > tol else idle + 1
            if kept is not trial:
                release(kept)
            kept, quality, trial, moved = trial, reached, after, moving
        else:
            idle += 1
            release(trial)
            if moved:
                # undo, and let the other half of the nodes try from the kept membership
                release(after)
                if idle >= 2 or turn == last:
                    trial = kept
                    break
                trial, _, moved = _turned(placed, places, kept, whole, turn)
            else:
                # nobody had moved, so this turn did start from the kept membership
                trial, moved = after, moving
        if idle >= 2:
            break
    placed.unpersist()
    if trial is not kept:
        release(trial)
    return kept.select("id", "c"), quality


def louvain(nodes: DataFrame, edges: DataFrame, max_levels: int = 10, max_iter: int = 10, tol: float = 1e-4,
            weight: str | None = "trip_count", seed_col: str | None = None, consecutive_ids: bool = False,
            min_size: int | None = None, intermediate: bool = False) -> DataFrame:
    """(id, community_id, levels[, intermediate_ids]) by modularity maximisation.

    ``edges`` must list an undirected graph in both directions. Every accepted
    round raises modularity, so the result never falls below the start (the
    seeds, or one community per node).
    """
    if consecutive_ids and seed_col:
        raise ValueError("numbering communities anew would lose the seeds' names; choose one of the two")
    if max_levels < 1 or max_iter < 1 or tol <= 0 or (min_size is not None and min_size < 1):
        raise ValueError("max_levels, max_iter and min_size must be at least 1 and tol positive")
    # a table, not a cache: a cached frame would bring the plan of its edges into every turn
    links = cut_lineage(_folded(edges, weight).select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"), "w"))
    if seed_col:
        # Unseeded nodes get labels above every seed so they cannot collide with one.
        top = nodes.agg(F.coalesce(F.max(F.abs(seed_col)), F.lit(0)).cast("long").alias("t")).scalar()
        label = F.coalesce(F.col(seed_col).cast("long"), F.col("id").cast("long") + top + 1)
    else:
        label = F.col("id").cast("long")
    start = nodes.select(F.col("id").cast("long").alias("id"), label.alias("c"))
    links_now = links
    member = cut_lineage(start)
    chains = member.select("id", F.col("c").alias("top"), F.array().cast("array<long>").alias("steps"))
    reached, level, best = None, 0, None
    while level < max_levels:
        member, quality = _one_level(links_now, member, max_iter, tol)
        if best is not None and quality - best <= tol:
            break
        best = quality
        level += 1
        node_to = member.select(F.col("id").alias("top"), F.col("c").alias("_c"))
        key = chains if reached else chains.withColumn("top", F.col("id"))
        chains = cut_lineage(key.join(node_to, "top").select(
            "id", F.col("_c").alias("top"), F.array_append("steps", F.col("_c")).alias("steps")))
        reached = chains
        folded = (
            links_now.join(member.select(F.col("id").alias("src"), F.col("c").alias("cs")), "src")
            .join(member.select(F.col("id").alias("dst"), F.col("c").alias("cd")), "dst")
            .groupBy("cs", "cd").agg(F.sum("w").alias("w"))
            .select(F.col("cs").alias("src"), F.col("cd").alias("dst"), "w")
        )
        finer, links_now = links_now, cut_lineage(folded)
        release(finer)
        member = cut_lineage(member.select(F.col("c").alias("id")).distinct().withColumn("c", F.col("id")))
    release(links_now)

    out = chains.select("id", F.col("top").alias("community_id"), F.col("steps").alias("intermediate_ids"))
    if min_size is not None:
        big = out.groupBy("community_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_size)
        out = out.join(big.select("community_id"), "community_id", "left_semi")
    if consecutive_ids:
        labels = global_rank(out.select("community_id").distinct(), [F.asc("community_id")], "_rank")
        out = out.join(labels, "community_id").withColumn("community_id", (F.col("_rank") - 1).cast("long"))
    out = out.withColumn("levels", F.size("intermediate_ids"))
    kept = ["id", "community_id", "levels"] + (["intermediate_ids"] if intermediate else [])
    return out.select(*kept)


def louvain_summary(edges: DataFrame, found: DataFrame, weight: str | None = "trip_count") -> DataFrame:
    """(level, communities, modularity, smallest, mean_size, largest, is_meaningful) for each level of ``found``.

    ``found`` is a Louvain result with ``intermediate_ids``; its levels are few by
    ``max_levels``, and each is one row of sums. All come from one pass over the links. Level 0 is the start, one community per node.
    """
    top = found.agg(F.max(F.size("intermediate_ids"))).first()[0] or 0
    # all levels in one pass over the links: a node's label at level 0 is itself
    labels = found.select("id", F.concat(F.array(F.col("id").cast("long")), "intermediate_ids").alias("labels"))
    ends = (
        _folded(edges, weight).join(labels.select(F.col("id").alias("src"), F.col("labels").alias("near")), "src")
        .join(labels.select(F.col("id").alias("dst"), F.col("labels").alias("far")), "dst")
        .select("w", F.posexplode(F.arrays_zip("near", "far")).alias("level", "at"))
    )
    same = F.when(F.col("at.near") == F.col("at.far"), F.col("w")).otherwise(0.0)
    totals = ends.where(F.col("at.near").isNotNull()).groupBy("level", F.col("at.near").alias("c")).agg(
        F.sum(same).alias("inside"), F.sum("w").alias("total"))
    t = F.col("t")
    quality = totals.groupBy("level").agg(
        F.sum("inside").alias("i"), F.sum("total").alias("t"), F.sum(F.col("total") * F.col("total")).alias("tt"),
    ).select("level", (F.try_divide(F.col("i"), t) - F.try_divide(F.col("tt"), t * t)).alias("modularity"))
    sizes = labels.select(F.posexplode("labels").alias("level", "c")).groupBy("level", "c").count().groupBy("level").agg(
        F.count("*").alias("communities"), F.min("count").alias("smallest"), F.avg("count").alias("mean_size"), F.max("count").alias("largest"))
    told = (
        found.sparkSession.range(top + 1).select(F.col("id").cast("int").alias("level"))
        .join(sizes, "level", "left").join(quality, "level", "left").orderBy("level")
        .select("level", F.coalesce("communities", F.lit(0)).alias("communities"), or_zero(F.col("modularity")).alias("modularity"),
                "smallest", "mean_size", "largest", (or_zero(F.col("modularity")) >= MEANINGFUL_MODULARITY).alias("is_meaningful"))
    )
    # a handful of rows, worked out once whatever is asked of them
    return found.sparkSession.createDataFrame(told.collect(), (
        "level int, communities long, modularity double, smallest long, mean_size double, largest long, is_meaningful boolean"))


# --- stability -------------------------------------------------------------

def shared_zones(previous: DataFrame, current: DataFrame) -> DataFrame:
    return previous.select("location_id").intersect(current.select("location_id"))


def rand_index(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Agreement of two partitions ``(location_id, community_id)``, blind to label names.

    Pairs are counted from the contingency table of the two labels, never listed.
    """
    both = (
        previous.select("location_id", F.col("community_id").alias("a"))
        .join(current.select("location_id", F.col("community_id").alias("b")), "location_id")
    )
    pairs = lambda n: F.floor(n * (n - 1) / F.lit(2)).cast("long")
    cells = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    margins = cells.select("n", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.lit(None).cast("long").alias("label"), F.lit(0).alias("x")),
        F.struct(F.lit(1).alias("side"), F.col("a").cast("long").alias("label"), F.lit(0).alias("x")),
        F.struct(F.lit(2).alias("side"), F.col("b").cast("long").alias("label"), F.lit(0).alias("x")),
    )).alias("m"), "a", "b")
    sums = margins.groupBy("m.side", F.col("m.label")).agg(
        F.sum("n").alias("n"), F.sum(pairs(F.col("n"))).alias("cell_pairs"))
    by_side = sums.agg(
        F.coalesce(F.sum(F.when(F.col("side") == 0, F.col("n"))), F.lit(0)).cast("long").alias("n"),
        F.coalesce(F.sum(F.when(F.col("side") == 0, F.col("cell_pairs"))), F.lit(0)).cast("long").alias("together"),
        F.coalesce(F.sum(F.when(F.col("side") == 1, pairs(F.col("n")))), F.lit(0)).cast("long").alias("a_pairs"),
        F.coalesce(F.sum(F.when(F.col("side") == 2, pairs(F.col("n")))), F.lit(0)).cast("long").alias("b_pairs"),
    )
    total = pairs(F.col("n"))
    agree = total + 2 * F.col("together") - F.col("a_pairs") - F.col("b_pairs")
    index = F.when(F.col("n") == 0, 0.0).when(F.col("n") < 2, 1.0).otherwise(agree / total.cast("double"))
    return by_side.select(
        F.col("n").alias("shared_zones"), agree.alias("agreeing_pairs"),
        (total - agree).alias("disagreeing_pairs"), index.alias("rand_index"),
        (index >= STABLE_RAND_INDEX).alias("is_stable"),
    )


def persisted_assignments(zones: DataFrame) -> DataFrame:
    return zones.where(F.col("community_id").isNotNull()).select(
        "location_id", F.col("community_id").cast("long").alias("community_id"))


# --- profiles --------------------------------------------------------------

def community_volume(flows: DataFrame, assignment: DataFrame, start: int | None = None,
                     end: int | None = None) -> DataFrame:
    """Trips of each community that stay inside it and that leave it."""
    member = assignment.select("location_id", "community_id")
    trips = long_or_zero(F.col("trip_count"))
    ends = (
        flows.where(half_open(F.col("window_start"), start, end))
        .groupBy("origin_id", "destination_id").agg(F.sum(trips).alias("trips"))
        .join(member.toDF("origin_id", "community_id"), "origin_id")
        .join(member.toDF("destination_id", "_other"), "destination_id")
    )
    inside = F.col("community_id") == F.col("_other")
    return ends.groupBy("community_id").agg(
        F.sum(F.when(inside, F.col("trips")).otherwise(0)).cast("long").alias("internal_trip_count"),
        F.sum(F.when(~inside, F.col("trips")).otherwise(0)).cast("long").alias("external_trip_count"),
    )


def community_members(zones: DataFrame) -> DataFrame:
    """One row per zone that belongs to a community."""
    return zones.where(F.col("community_id").isNotNull()).select(F.col("community_id").cast("long").alias("community_id"), "location_id")


def community_profiles(zones: DataFrame, flows: DataFrame, start: int | None = None, end: int | None = None,
                       top_n: int = 5, member_lists: bool = False) -> DataFrame:
    """Size, leading zones, borough mix, internal and external trips, cohesion.

    ``member_lists=True`` adds the id list of each community, the one column that
    grows with a community; ``community_members`` has the same as rows.
    """
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    score = or_zero(F.col("importance_score")) if "importance_score" in zones.columns else F.lit(0.0)
    members = zones.where(F.col("community_id").isNotNull()).select(
        F.col("community_id").cast("long").alias("community_id"), "location_id",
        F.coalesce("zone_name", F.lit("")).alias("zone_name"), F.coalesce("borough", F.lit("")).alias("borough"),
        score.alias("_score"),
    )
    order = Window.partitionBy("community_id").orderBy(F.desc("_score"), "location_id")
    leading = (
        members.withColumn("_pos", F.row_number().over(order)).where(F.col("_pos") <= top_n)
        .groupBy("community_id").agg(F.sort_array(F.collect_list(F.struct("_pos", "zone_name"))).alias("_top"))
        .select("community_id", F.col("_top.zone_name").alias("top_zones"))
    )
    ids = [F.sort_array(F.collect_list("location_id")).alias("location_ids")] if member_lists else []
    sizes = members.groupBy("community_id").agg(F.count(F.lit(1)).alias("size"), *ids)
    boroughs = (
        members.where(F.col("borough") != "").groupBy("community_id", "borough").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("community_id").agg(
            F.max(F.struct("n", "borough")).alias("_most"), F.sum("n").alias("_known"),
            F.count(F.lit(1)).alias("borough_spread"))
    )
    volume = community_volume(flows, members, start, end)
    inside, outside = long_or_zero(F.col("internal_trip_count")), long_or_zero(F.col("external_trip_count"))
    joined = (sizes.join(leading, "community_id").join(boroughs, "community_id", "left")
              .join(volume, "community_id", "left"))
    return joined.select(
        "community_id", "size", *(["location_ids"] if member_lists else []), "top_zones",
        F.coalesce("_most.borough", F.lit("")).alias("dominant_borough"),
        safe_ratio(F.col("_most.n"), F.col("_known")).alias("dominant_borough_share"),
        long_or_zero(F.col("borough_spread")).alias("borough_spread"),
        inside.alias("internal_trip_count"), outside.alias("external_trip_count"),
        safe_ratio(inside, inside + outside).alias("cohesion"),
    ).orderBy(F.desc("size"), "community_id")


def cross_borough_communities(profiles: DataFrame) -> DataFrame:
    return profiles.where(F.col("borough_spread") > 1).orderBy(
        F.desc("borough_spread"), F.desc("size"), "community_id")


def weak_communities(profiles: DataFrame, threshold: float = 0.5) -> DataFrame:
    return profiles.where(F.col("cohesion") < threshold).orderBy("cohesion", "community_id")


def analyse_communities(spec: GraphSpec, nodes: DataFrame, edges: DataFrame, zones: DataFrame, flows: DataFrame,
                        args: dict | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Detect, compare with the stored partition, profile: (assignments, profiles, drift, summary of the levels)."""
    require_undirected(spec)
    edges = cut_lineage(edges)
    if edges.isEmpty():
        raise ValueError(f"projection {spec.name} has no relationships; every zone would be its own community")
    chosen = args or LOUVAIN_PRESETS["catchments"]
    found = cut_lineage(louvain(nodes, edges, **{**chosen, "intermediate": True}))
    summary = louvain_summary(edges, found, chosen.get("weight", "trip_count"))
    if not summary.orderBy(F.desc("level")).first()["is_meaningful"]:
        warnings.warn(f"{spec.name} hardly falls into communities: modularity stays under {MEANINGFUL_MODULARITY}")
    # community ids live in the zone dimension; locations keep their own column name there
    assignments = cut_lineage(found.select(
        F.col("id").cast("int").alias("location_id"), "community_id", F.col("levels").alias("community_levels")))
    if "community_id" in zones.columns:
        drift = rand_index(persisted_assignments(zones), assignments)
    else:
        drift = rand_index(assignments.limit(0), assignments)
    placed = zones.drop("community_id").join(assignments.drop("community_levels"), "location_id", "left")
    profiles = community_profiles(placed, flows, spec.window_from, spec.window_to)
    return assignments, profiles, drift, summary
