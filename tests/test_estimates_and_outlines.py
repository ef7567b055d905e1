"""Estimated betweenness, what graph runs leave behind, progress log, outlines, joined snapshots."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from odflux.functions import ensure_checkpoint_dir
from odflux.operators import centrality, community
from odflux.sources import polygons, tables


def a_graph(spark, n=16, links=40, seed=6):
    draw = random.Random(seed)
    rows = [(draw.randrange(n), draw.randrange(n), float(draw.randint(1, 5))) for _ in range(links)]
    return (spark.createDataFrame([(i,) for i in range(n)], "id int"),
            spark.createDataFrame([r for r in rows if r[0] != r[1]], "src int, dst int, w double"))


def scores(frame):
    return {r["id"]: r["score"] for r in frame.collect()}


def test_estimate_of_all_pivots_is_exact_and_of_some_within_its_bound(spark):
    nodes, edges = a_graph(spark)
    exact = scores(centrality.betweenness(nodes, edges))
    whole = centrality.betweenness_estimate(nodes, edges, 16)
    assert scores(whole) == pytest.approx(exact) and whole.where("error_bound <> 0").isEmpty()
    some = {r["id"]: r for r in centrality.betweenness_estimate(nodes, edges, 8, 3).collect()}
    assert all(abs(some[i].score - exact[i]) <= some[i].error_bound for i in exact)
    assert sum(r.score for r in some.values()) == pytest.approx(sum(exact.values()), rel=0.6)


def test_more_pivots_give_narrower_bounds(spark):
    nodes, edges = a_graph(spark)
    few, many = (centrality.betweenness_estimate(nodes, edges, k).agg(F.avg("error_bound")).first()[0] for k in (4, 12))
    assert many < few
    for bad in ((0, 0.05), (5, 0.0), (5, 1.0)):
        with pytest.raises(ValueError):
            centrality.betweenness_estimate(nodes, edges, bad[0], doubt=bad[1])
    assert centrality.betweenness_estimate(nodes.limit(0), edges.limit(0), 3).count() == 0
    alone = centrality.betweenness_estimate(nodes, edges.limit(0), 3)
    assert alone.where("score <> 0").isEmpty() and alone.count() == 16


def test_a_run_leaves_its_result_only(spark):
    nodes, edges = a_graph(spark)
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    kept = centrality.betweenness(nodes, edges)
    new = set(os.listdir(folder)) - before
    assert len(new) == 1 and not any(name.startswith("levels-") for name in new) and kept.count() == 16


def test_sampled_analysis_ranks_every_zone(spark):
    nodes, edges = a_graph(spark)
    ranked = centrality.analyse_centrality(nodes, edges.withColumn("trip_count", F.col("w")), pagerank_args={"max_iter": 2}, betweenness_args={"sample": 5, "seed": 1, "weight": None})
    assert sorted(r.importance_rank for r in ranked.collect()) == list(range(1, 17))


def test_turns_report_the_modularity_that_a_plain_count_gives(spark, monkeypatch):
    nodes, edges = a_graph(spark, 24, 90)
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    links = community._folded(both, "w").select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"), "w")
    member = nodes.select(F.col("id").cast("long").alias("id"), F.col("id").cast("long").alias("c"))
    kept, quality = community._one_level(links, member, 10, 1e-4)
    assert quality == pytest.approx(community._modularity(links, kept).first()[0], abs=1e-9) and quality > 0.1
    assert kept.count() == 24
    monkeypatch.setattr(community, "EDGES_PER_SLICE", 2)  # a hub in many slices moves alike
    sliced, same = community._one_level(links, member, 10, 1e-4)
    assert same == pytest.approx(quality) and sorted(map(tuple, sliced.collect())) == sorted(map(tuple, kept.collect()))


def test_outlines_are_written_in_blocks_and_read_back(spark, tmp_path):
    rows = [(i, f"Zone {i}", None if i == 3 else 40.0 + i, -70.0 - i) for i in range(1, 12)]
    zones = spark.createDataFrame(rows, "location_id int, zone_name string, latitude double, longitude double")
    path = str(tmp_path / "shapes")
    polygons.write_zone_polygons(zones, path, 0.5, features_per_file=4)
    documents = [json.loads(line) for f in os.listdir(path) if f.endswith(".json") for line in open(f"{path}/{f}") if line.strip()]
    assert sorted(len(d["features"]) for d in documents) == [2, 4, 4] and all(d["type"] == "FeatureCollection" for d in documents)
    got = {r.location_id: r for r in polygons.outline_corners(polygons.load_zone_polygons(spark, path)).collect()}
    assert set(got) == set(range(1, 12)) - {3}
    assert tuple(got[5]) == (5, 5, -75.5, -74.5, 44.5, 45.5)


def test_copies_that_differ_leave_the_greatest(spark):
    zones = spark.createDataFrame([(1, 0.5, 3), (1, 0.9, None), (2, None, 7)], "location_id int, page_rank_score double, community_id long").repartition(3)
    got = {r.location_id: (r.page_rank_score, r.community_id) for r in tables.zone_graph_features(zones).collect()}
    assert got == {1: (0.9, -1), 2: (0.0, 7)}
    groups = spark.createDataFrame([(1, 5, 0.1), (1, 6, 0.0)], "community_id long, size long, cohesion double")
    assert [tuple(r) for r in tables.community_features(groups).collect()] == [(1, 6.0, 0.0)]
