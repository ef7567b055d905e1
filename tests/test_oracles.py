"""Registered queries against their SQL twins. ``ODFLUX_ALL=1`` runs every key."""

import os

import pytest

from registry.oracles import oracle_sql
from registry.queries import QUERIES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "parse_trips", "trip_rejects", "event_ids", "decode_events", "dedup_events", "demand_windows", "zone_flows",
    "upsert_demand_windows", "stream_demand", "surge_score", "zone_rollup", "graph_projection", "pagerank_topk",
    "betweenness", "zone_importance", "modularity", "rand_index", "community_profiles", "complete_grid",
    "rolling_features", "asof_snapshots", "community_peers", "flow_features", "training_matrix", "inference_matrix",
    "forecast_metrics", "fold_bounds", "demand_map", "residual_quantiles", "event_value_distribution", "projection_summary",
    "scan_trip_files", "stream_late_data", "stream_restart", "projection_windows", "betweenness_weighted", "assemble_vector",
    "zone_polygons", "mappable_flows", "training_matrix_snapshots",
]
KEYS = sorted(oracle_sql()) if os.environ.get("ODFLUX_ALL") else SAMPLE
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


@pytest.fixture(scope="module")
def truth():
    return connect(SF_DIR), oracle_sql()


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_sql(spark, truth, name):
    con, sql = truth
    assert difference(spark, con, SF_DIR, name, sql[name]) is None


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(QUERIES)
