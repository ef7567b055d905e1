import heapq
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odflux.operators import centrality, community, projection
from odflux.sources.tables import path_exists


def graph(spark, pairs, extra=()):
    ids = sorted({x for s, d, _ in pairs for x in (s, d)} | set(extra))
    return (spark.createDataFrame([(i,) for i in ids], "id int"),
            spark.createDataFrame([(s, d, float(w)) for s, d, w in pairs], "src int, dst int, trip_count double"))


def as_map(frame, value="score"):
    return {r["id"]: r[value] for r in frame.collect()}


def brute_betweenness(pairs, ids):
    out = defaultdict(dict)
    for s, d, w in pairs:
        out[s][d] = min(w, out[s].get(d, w))
    score = dict.fromkeys(ids, 0.0)
    for s in ids:
        dist, paths, before, order, heap = {s: 0}, defaultdict(float), defaultdict(list), [], [(0, s)]
        paths[s] = 1.0
        done = set()
        while heap:
            d, v = heapq.heappop(heap)
            if v in done:
                continue
            done.add(v)
            order.append(v)
            for t, w in out[v].items():
                if t not in dist or d + w < dist[t]:
                    dist[t], paths[t], before[t] = d + w, paths[v], [v]
                    heapq.heappush(heap, (d + w, t))
                elif d + w == dist[t] and v not in before[t]:
                    paths[t] += paths[v]
                    before[t].append(v)
        credit = defaultdict(float)
        for v in reversed(order):
            for p in before[v]:
                credit[p] += paths[p] / paths[v] * (1 + credit[v])
            if v != s:
                score[v] += credit[v]
    return score


def test_pagerank_converges_and_counts_rounds(spark):
    nodes, edges = graph(spark, [(1, 2, 1), (2, 3, 1), (3, 1, 1)], extra=[4])
    run = centrality.pagerank(nodes, edges, max_iter=200, tol=1e-3)
    got = as_map(run.scores)
    assert run.converged and run.iterations < 200
    assert got[1] == pytest.approx(1.0, abs=0.02) and got[4] == pytest.approx(0.15)


def test_hub_edges_are_sliced_without_changing_scores(spark, monkeypatch):
    pairs = [(0, i, i) for i in range(1, 40)] + [(i, 0, 1) for i in range(1, 40)]
    nodes, edges = graph(spark, pairs)
    whole = as_map(centrality.pagerank(nodes, edges, max_iter=3, tol=0).scores)
    monkeypatch.setattr(centrality, "EDGES_PER_SLICE", 5)
    sliced = as_map(centrality.pagerank(nodes, edges, max_iter=3, tol=0).scores)
    assert sliced == pytest.approx(whole)


@pytest.mark.parametrize("weighted", [False, True])
def test_betweenness_equals_brute_force(spark, weighted):
    rng = random.Random(5)
    pairs = list({(rng.randrange(9), rng.randrange(9)): 0 for _ in range(24)})
    pairs = [(s, d, rng.randrange(1, 4)) for s, d in pairs if s != d]
    nodes, edges = graph(spark, pairs, extra=range(9))
    got = as_map(centrality.betweenness(nodes, edges, weight="trip_count" if weighted else None))
    want = brute_betweenness([(s, d, w if weighted else 1) for s, d, w in pairs], range(9))
    assert got == pytest.approx(want)


@pytest.mark.parametrize("weighted", [False, True])
def test_betweenness_in_turns_leaves_no_table_of_a_turn(spark, monkeypatch, weighted):
    import os

    rng = random.Random(11)
    pairs = [(s, d, rng.randint(1, 4)) for s in range(9) for d in range(9) if s != d and rng.random() < 0.3]
    nodes, edges = graph(spark, pairs, range(9))
    most, held = [0], centrality._turn

    def counted(nodes, edges, sources, weight):
        most[0] = max(most[0], sources.count())
        return held(nodes, edges, sources, weight)

    monkeypatch.setattr(centrality, "_turn", counted)
    monkeypatch.setattr(centrality, "PAIRS_AT_ONCE", 30)
    root = centrality.ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    got = as_map(centrality.betweenness(nodes, edges, weight="trip_count" if weighted else None))
    assert got == pytest.approx(brute_betweenness([(s, d, w if weighted else 1) for s, d, w in pairs], range(9)))
    assert most[0] < 9
    assert len(set(os.listdir(root)) - before) <= 3, "tables of the turns are still there"


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("names", ["int", "string"])
def test_betweenness_keeps_no_row_of_a_source_and_node(spark, monkeypatch, weighted, names):
    rng = random.Random(13)
    pairs = [(s, d, rng.randint(1, 4)) for s in range(12) for d in range(12) if s != d and rng.random() < 0.2]
    nodes, edges = (f.select(*[F.col(c).cast(names).alias(c) if c != "trip_count" else F.col(c) for c in f.columns])
                    for f in graph(spark, pairs, range(14)))
    weight = "trip_count" if weighted else None
    want = brute_betweenness([(s, d, w if weighted else 1) for s, d, w in pairs], range(14))
    with monkeypatch.context() as patch:
        patch.setattr(centrality, "_turn", None)
        walked = centrality._dependencies(nodes, edges, centrality._sources(nodes, None, None), weight).collect()
    assert {int(r["id"]): r["total"] for r in walked} == pytest.approx(want)
    monkeypatch.setattr(centrality, "LINKS_IN_TASK", 0)  # as a graph too large for a task goes
    joined = centrality._dependencies(nodes, edges, centrality._sources(nodes, None, None), weight).collect()
    assert {r["id"]: r["squares"] for r in joined} == pytest.approx({r["id"]: r["squares"] for r in walked})


def test_sampled_betweenness_is_repeatable(spark):
    nodes, edges = graph(spark, [(i, i + 1, 1) for i in range(8)])
    runs = [as_map(centrality.betweenness(nodes, edges, sample=4, seed=3)) for _ in range(2)]
    assert runs[0] == runs[1]
    with pytest.raises(ValueError):
        centrality.betweenness(nodes, edges.withColumn("cost", F.lit(0.0)), weight="cost")


def test_flat_scores_have_no_importance(spark):
    rows = spark.createDataFrame([(2, 1.0), (1, 1.0)], "id int, score double")
    got = centrality.zone_importance(rows, rows).orderBy("importance_rank").collect()
    assert [(r["location_id"], r["importance_rank"], r["importance_score"]) for r in got] == [(1, 1, 0.0), (2, 2, 0.0)]


def cliques(spark):
    pairs = []
    for block in range(3):
        ids = range(block * 5, block * 5 + 5)
        pairs += [(a, b, 5) for a in ids for b in ids if a != b]
    for a, b in ((0, 5), (5, 10), (10, 0)):
        pairs += [(a, b, 1), (b, a, 1)]
    return graph(spark, pairs)


def test_louvain_finds_planted_communities(spark):
    nodes, edges = cliques(spark)
    found = community.louvain(nodes, edges, consecutive_ids=True)
    groups = defaultdict(set)
    for r in found.collect():
        groups[r["community_id"]].add(r["id"])
    assert sorted(map(sorted, groups.values())) == [list(range(b, b + 5)) for b in (0, 5, 10)]
    assert set(groups) == {0, 1, 2}
    assert community.modularity(edges, found).first()[0] > 0.6


def test_summary_of_levels(spark):
    nodes, edges = cliques(spark)
    found = community.louvain(nodes, edges, intermediate=True)
    levels = community.louvain_summary(edges, found).orderBy("level").collect()
    assert (levels[0]["communities"], levels[-1]["communities"], levels[-1]["largest"]) == (15, 3, 5)
    assert [r["modularity"] for r in levels] == sorted(r["modularity"] for r in levels) and levels[-1]["is_meaningful"]
    assert levels[-1]["modularity"] == pytest.approx(community.modularity(edges, found).first()[0])


def test_summary_takes_all_levels_in_one_pass(spark):
    _, edges = cliques(spark)

    def summed(levels):
        found = spark.createDataFrame([(i, [i // 5 * 5 if n % 2 else i % 3 for n in range(levels)]) for i in range(15)],
                                      "id int, intermediate_ids array<long>")
        spark.sparkContext.setJobGroup(f"summary-{levels}", "")
        rows = community.louvain_summary(edges, found).collect()
        spark.sparkContext.setJobGroup("other", "")
        for r in rows:
            label = F.col("id").cast("long") if r["level"] == 0 else F.element_at("intermediate_ids", r["level"])
            by_itself = community.modularity(edges, found.select("id", label.alias("community_id"))).first()[0]
            assert r["modularity"] == pytest.approx(by_itself)
        assert [(r["level"], r["communities"], r["smallest"], r["largest"]) for r in rows] == [
            (n, *((15, 1, 1) if n == 0 else (3, 5, 5))) for n in range(levels + 1)]
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"summary-{levels}"))

    assert summed(6) < summed(2) + 4


def test_summary_of_nothing(spark):
    _, edges = cliques(spark)
    found = spark.createDataFrame([], "id int, intermediate_ids array<long>")
    got = [tuple(r) for r in community.louvain_summary(edges, found).collect()]
    assert got == [(0, 0, 0.0, None, None, None, False)]


def test_no_turn_of_louvain_is_taken_twice(spark, monkeypatch):
    nodes, edges = cliques(spark)
    taken, turned = [], community._turned

    def watched(placed, *rest):
        state, _, turn = rest[-3:]
        taken.append((turn, tuple(sorted((r["id"], r["c"]) for r in state.collect()))))
        return turned(placed, *rest)

    monkeypatch.setattr(community, "_turned", watched)
    community.louvain(nodes, edges)
    assert len(set(taken)) == len(taken)


@pytest.mark.parametrize("per_slice", [2, 250_000])
def test_louvain_of_a_hub_in_pieces(spark, monkeypatch, per_slice):
    """Each turn against plain loops: hubs are cut at both ends, loops and isolated nodes count."""
    monkeypatch.setattr(community, "EDGES_PER_SLICE", per_slice)
    pairs = [(0, b, 1 + b % 3) for b in range(1, 9)] + [(1, 2, 4), (3, 4, 4), (5, 6, 2), (7, 8, 3)]
    both = pairs + [(b, a, w) for a, b, w in pairs] + [(2, 2, 3)]
    nodes, _ = graph(spark, pairs)
    nodes = nodes.select("id").unionByName(spark.range(20, 21).select(F.col("id").cast("int").alias("id")))
    links = spark.createDataFrame([(a, b, float(w)) for a, b, w in both], "src long, dst long, w double")
    member = nodes.select(F.col("id").cast("long").alias("id"), (F.col("id") % 5).cast("long").alias("c"))
    placed, state, whole, places = community._placed(links, member)
    c = {r["id"]: r["c"] for r in member.collect()}
    k = {i: sum(w for a, _, w in both if a == i) for i in c}
    for turn in (0, 1):
        free = {r["id"]: r["f"] == turn % 2 for r in state.select(
            "id", F.pmod(F.xxhash64("id", F.lit(turn // 2)), F.lit(2)).alias("f")).collect()}
        want = {}
        for i in c:
            gains = {}
            for label in {c[i]} | {c[b] for a, b, _ in both if a == i}:
                to_c = sum(w for a, b, w in both if a == i and b != i and c[b] == label)
                gains[label] = to_c - k[i] * (sum(k[j] for j in c if c[j] == label) - (k[i] if label == c[i] else 0)) / whole
            best = min(gains, key=lambda label: (-gains[label], label))
            want[i] = best if free[i] and gains[best] > gains[c[i]] + 1e-12 else c[i]
        state, quality, moved = community._turned(placed, places, state, whole, turn)
        inside = sum(w for a, b, w in both if c[a] == c[b]) / whole
        squares = sum(sum(k[j] for j in c if c[j] == label) ** 2 for label in set(c.values())) / whole ** 2
        assert quality == pytest.approx(inside - squares) and moved == sum(want[i] != c[i] for i in c)
        assert {r["id"]: r["c"] for r in state.collect()} == want
        c = want
    placed.unpersist()


def test_seeded_louvain_keeps_its_labels(spark):
    nodes, edges = cliques(spark)
    seeded = nodes.withColumn("community_id", (F.floor(F.col("id") / 5) * 100).cast("long"))
    got = as_map(community.louvain(seeded, edges, seed_col="community_id"), "community_id")
    assert set(got.values()) == {0, 100, 200}
    with pytest.raises(ValueError):
        community.louvain(seeded, edges, seed_col="community_id", consecutive_ids=True)


def test_directed_projection_is_refused():
    with pytest.raises(ValueError, match="undirected"):
        community.require_undirected(projection.FLOW_VOLUME)


def test_rand_index_edges(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "location_id int, community_id long")
    empty = rows((1, 1)).limit(0)
    assert community.rand_index(empty, rows((1, 1))).first()["rand_index"] == 0.0
    assert community.rand_index(rows((1, 1)), rows((1, 9))).first()["rand_index"] == 1.0
    got = community.rand_index(rows((1, 1), (2, 1), (3, 2)), rows((1, 8), (2, 7), (3, 7))).first()
    assert (got["agreeing_pairs"], got["disagreeing_pairs"]) == (1, 2)


def test_generations_are_retired(spark, tmp_path):
    nodes, edges = graph(spark, [(1, 2, 1)])
    root = str(tmp_path / "graphs")
    made = [projection.refresh_projection(projection.FLOW_VOLUME, nodes, edges, root, retain=2) for _ in range(3)]
    assert made == [1, 2, 3]
    assert projection.generations_of(spark, root, "zone_flow_volume") == [3, 2]
    assert projection.active_projection(spark, root, "zone_flow_volume")[1].count() == 1
    projection.drop_projection(spark, root, "zone_flow_volume")
    assert not path_exists(spark, f"{root}/zone_flow_volume/g=3")


def test_superseded_tables_are_deleted(spark):
    from odflux.functions import cut_lineage, release
    from odflux.sources.tables import path_exists
    kept = cut_lineage(spark.range(3))
    path = kept._cut_path
    assert path_exists(spark, path) and kept.count() == 3
    release(kept)
    release(spark.range(1))
    assert not path_exists(spark, path)
