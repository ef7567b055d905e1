"""The given tables seen as zones, trips, raw rows and snapshots.

Each view is one SQL text for both engines; the few words that differ are
filled in per engine. Suppliers are the zones, so the zone dimension grows with
the data. Events are trips between zones in time; order lines are trips
between zones for the graph.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_WORDS = {
    "spark": {
        "MS": "unix_millis(CAST(ts AS TIMESTAMP))",
        "SHIP_MS": "unix_millis(CAST(l_shipdate AS TIMESTAMP))",
        "K": "CAST(get_json_object(props,'$.k') AS BIGINT)",
        "STR": "STRING", "D": "div",
        "IN3": "LATERAL VIEW explode(array(0,1,2)) s AS i",
        "AT_A": "date_format({t},'yyyy-MM-dd HH:mm:ss')",
        "AT_B": "date_format({t},\"yyyy-MM-dd'T'HH:mm:ss\")",
        "AT_C": "date_format({t},'MM/dd/yyyy HH:mm:ss')",
        "AT_D": "date_format({t},'MM/dd/yyyy hh:mm:ss a')",
        "T0": "CAST(ts AS TIMESTAMP)", "T1": "(CAST(ts AS TIMESTAMP) + make_dt_interval(0,0,0,120+30*k))",
    },
    "duck": {
        "MS": "CAST(floor(epoch_us(ts)/1000) AS BIGINT)",
        "SHIP_MS": "CAST(floor(epoch_us(l_shipdate)/1000) AS BIGINT)",
        "K": "CAST(json_extract_string(props,'$.k') AS BIGINT)",
        "STR": "VARCHAR", "D": "//",
        "IN3": ", (SELECT unnest([0,1,2]) AS i) s",
        "AT_A": "strftime({t},'%Y-%m-%d %H:%M:%S')",
        "AT_B": "strftime({t},'%Y-%m-%dT%H:%M:%S')",
        "AT_C": "strftime({t},'%m/%d/%Y %H:%M:%S')",
        "AT_D": "strftime({t},'%m/%d/%Y %I:%M:%S %p')",
        "T0": "ts", "T1": "(ts + to_seconds(120+30*k))",
    },
}


def _clock(t: str) -> str:
    """A wall-clock text in one of four layouts, and one with a fraction."""
    layouts = {0: "AT_A", 1: "AT_B", 2: "AT_C", 3: "AT_D"}
    arms = " ".join(f"WHEN {n} THEN <{name}:{t}>" for n, name in layouts.items())
    return f"CASE event_id % 5 {arms} ELSE concat(<AT_A:{t}>, '.250') END"


VIEWS: dict[str, tuple[list[str], str]] = {
    "zones": ([], """
        SELECT CAST(s_suppkey + 1 AS INT) AS location_id, s_name AS zone_name, r_name AS borough,
               CASE WHEN s_suppkey % 3 = 0 THEN 'Core' ELSE 'Outer' END AS service_zone
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "zones_x": (["zones"], """
        SELECT location_id, zone_name, CASE WHEN location_id % 10 = 4 THEN '' ELSE borough END AS borough, service_zone,
               CASE WHEN location_id % 7 = 3 THEN NULL ELSE CAST(40 AS DOUBLE) + CAST(location_id % 10 AS DOUBLE)/CAST(8 AS DOUBLE) END AS latitude,
               CASE WHEN location_id % 7 = 3 THEN NULL ELSE CAST(-74 AS DOUBLE) + CAST(location_id % 6 AS DOUBLE)/CAST(8 AS DOUBLE) END AS longitude,
               CAST((location_id*7) % 11 AS DOUBLE)/CAST(10 AS DOUBLE) AS page_rank_score,
               CASE WHEN location_id % 9 = 5 THEN NULL ELSE CAST((location_id*5) % 7 AS DOUBLE) END AS betweenness_score,
               CAST((location_id*13) % 17 AS DOUBLE)/CAST(16 AS DOUBLE) AS importance_score,
               CAST((location_id*13) % 17 AS INT) AS importance_rank,
               CAST((location_id*3) % 8 AS DOUBLE)/CAST(8 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS corridor_bias,
               CASE WHEN location_id % 9 = 0 THEN NULL ELSE CAST(location_id % 4 AS BIGINT) END AS community_id,
               CAST((location_id*11) % 23 AS BIGINT) AS latest_trip_count,
               CAST((location_id*11) % 23 + 5 AS BIGINT) AS peak_trip_count,
               CAST((location_id*11) % 23 AS DOUBLE)/CAST(16 AS DOUBLE) AS latest_demand_per_minute
        FROM zones"""),
    "trips_e": (["n_zones"], """
        SELECT event_id, CAST(1 + user_id % n AS INT) AS pickup_location_id,
               CAST(1 + (user_id*3 + k) % n AS INT) AS dropoff_location_id,
               pickup_epoch_millis, pickup_epoch_millis + (120 + 30*k)*1000 AS dropoff_epoch_millis,
               120 + 30*k AS trip_duration_seconds, CAST(event_id % 6 AS INT) AS passenger_count,
               value/CAST(20 AS DOUBLE) AS trip_distance_miles,
               (value/CAST(20 AS DOUBLE))/(CAST(120+30*k AS DOUBLE)/CAST(3600 AS DOUBLE)) AS average_speed_mph,
               value AS fare_amount, value*CAST(0.1 AS DOUBLE) AS tip_amount, value*CAST(1.1 AS DOUBLE) AS total_amount,
               CAST(user_id % 3 AS INT) AS vendor_id
        FROM (SELECT *, {MS} AS pickup_epoch_millis, {K} AS k, (SELECT n FROM n_zones) AS n FROM events) e"""),
    "trips_s": (["n_zones"], """
        SELECT CAST(1 + s AS INT) AS pickup_location_id,
               CAST(1 + (CASE WHEN p % 4 < 3 THEN s - s % 10 + p % 10 ELSE s*3 + p % 8 END) % n AS INT) AS dropoff_location_id,
               ship_ms AS pickup_epoch_millis, CAST(60*(1 + p % 50) AS BIGINT) AS trip_duration_seconds,
               CAST(l_linenumber % 5 AS INT) AS passenger_count, l_quantity AS trip_distance_miles,
               l_quantity*CAST(2 AS DOUBLE) AS average_speed_mph, l_extendedprice AS fare_amount,
               l_extendedprice AS total_amount, l_tax AS tip_amount
        FROM (SELECT *, l_suppkey AS s, l_partkey AS p, {SHIP_MS} AS ship_ms, (SELECT n FROM n_zones) AS n FROM lineitem) l"""),
    "n_zones": ([], "SELECT count(*) AS n FROM supplier"),
    "raw_trips": (["n_zones"], f"""
        SELECT event_id, CAST(user_id % 3 AS {{STR}}) AS vendor_id,
               CASE WHEN event_id % 101 = 0 THEN 'not a time' ELSE {_clock('T0')} END AS pickup_datetime,
               CASE WHEN event_id % 103 = 0 THEN '' WHEN event_id % 107 = 0 THEN {_clock('T0')} ELSE {_clock('T1')} END AS dropoff_datetime,
               CASE WHEN event_id % 109 = 0 THEN '' WHEN event_id % 113 = 0 THEN '900000' ELSE CAST(1 + user_id % n AS {{STR}}) END AS pickup_location_id,
               concat(' ', CAST(1 + (user_id*3 + k) % n AS {{STR}}), '.0 ') AS dropoff_location_id,
               CASE WHEN event_id % 127 = 0 THEN 'NaN' WHEN event_id % 131 = 0 THEN '-1.0' ELSE CAST(CAST(floor(value/20.0) AS BIGINT) AS {{STR}}) END AS trip_distance,
               CASE WHEN event_id % 137 = 0 THEN 'abc' ELSE CAST(value AS {{STR}}) END AS total_amount,
               CASE WHEN event_id % 7 = 0 THEN '-2' ELSE CAST(event_id % 6 AS {{STR}}) END AS passenger_count,
               'n' AS store_and_fwd_flag, 'events' AS source_file, event_id AS source_line
        FROM (SELECT *, {{K}} AS k, (SELECT n FROM n_zones) AS n FROM events) e"""),
    "snapshots_f": (["zones"], """
        SELECT z.location_id, CAST((z.location_id*7 + i*3) % 11 AS DOUBLE)/CAST(10 AS DOUBLE) AS page_rank_score,
               CAST((z.location_id*5 + i) % 7 AS DOUBLE) AS betweenness_score,
               CAST((z.location_id + i) % 4 AS BIGINT) AS community_id,
               CAST(1704067200000 + i*864000000 AS BIGINT) AS snapshot_start
        FROM zones z {IN3} WHERE NOT (z.location_id % 4 = 3 AND i = 0)"""),
    "parts_a": (["zones"], """
        SELECT location_id, CAST(location_id % 4 AS BIGINT) AS previous_community,
               CAST(CASE WHEN location_id % 7 = 0 THEN (location_id+1) % 4 + 10 ELSE location_id % 4 + 10 END AS BIGINT) AS current_community
        FROM zones"""),
    "scores_f": (["zones"], """
        SELECT location_id AS id, CAST((location_id*37) % 101 AS DOUBLE)/CAST(8 AS DOUBLE) AS page_rank,
               CAST((location_id*53) % 97 AS DOUBLE)/CAST(4 AS DOUBLE) AS betweenness
        FROM zones"""),
}


def render(name: str, engine: str) -> str:
    words = _WORDS[engine]
    text = VIEWS[name][1]
    text = re.sub(r"<(\w+):(\w+)>", lambda m: words[m[1]].replace("{t}", words[m[2]]), text)
    for word in ("MS", "SHIP_MS", "K", "STR", "D", "IN3"):
        text = text.replace("{" + word + "}", words[word])
    return text


def tables(spark: SparkSession, sf_dir: str) -> None:
    """Registers the given tables the views read; their schemas are read once per session and folder."""
    for name in BASE:
        place = (spark.sparkContext.applicationId, sf_dir, name)
        if place not in _frames:
            _frames[place] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        _frames[place].createOrReplaceTempView(name)


_frames: dict[tuple[str, str, str], DataFrame] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables(spark, sf_dir)

    def put(n: str) -> None:
        for needed in VIEWS[n][0]:
            put(needed)
        spark.sql(render(n, "spark")).createOrReplaceTempView(n)

    put(name)
    return spark.table(name)
