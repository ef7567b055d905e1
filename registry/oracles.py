"""The SQL twin of each registered query, for DuckDB over the same tables."""

from __future__ import annotations

from registry.views import VIEWS, render

SLIDE, WIDTH = 300_000, 900_000                # slots of 5 minutes, windows of 15
DAY_SLOTS = 288
LAGS, SPANS, HORIZON = (1, 2, 3, 6, 12), (6, 12, 36), 3
LOOKBACK = 7 * DAY_SLOTS
YEAR = 31_536_000_000
EST = 18_000_000                               # the events lie in one winter month
MID = 1_705_320_000_000                        # 2024-01-15 12:00 UTC
SNAPSHOT_AT = 1_706_000_000_000
CYCLES = [1_704_931_200_000 + i * 432_000_000 for i in range(3)]  # from 2024-01-11 every five days

ZERO = ["trip_count", "passenger_total", "demand_per_minute", "total_revenue", "total_tips",
        "distinct_destinations", "is_surge"]
CARRY = ["avg_trip_distance_miles", "avg_duration_seconds", "avg_speed_mph", "avg_fare_amount",
         "baseline_demand_per_minute", "surge_ratio"]
SCORES = ["page_rank_score", "betweenness_score", "importance_score", "importance_rank", "corridor_bias"]
CALENDAR = ["hour_of_day", "minute_of_day", "day_of_week", "is_weekend", "hour_sin", "hour_cos", "weekday_sin",
            "weekday_cos"]
FLOWS = ["inbound_trip_count", "inbound_zone_count", "outbound_trip_count", "outbound_zone_count", "net_flow"]
LAG_COLS = [f"{c}_lag_{n}" for n in LAGS for c in ("trip_count", "demand_per_minute")]
SEASON_COLS = ["trip_count_lag_day", "trip_count_lag_week"]
ROLL_COLS = [f"trip_count_{f}_{n}" for n in SPANS for f in ("mean", "stddev", "max", "min", "trend")]


def dp(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,8)),{n}) AS DOUBLE)"


def r6(x: str) -> str:
    return f"(CASE WHEN round({x},6)=0 THEN CAST(0 AS DOUBLE) ELSE round({x},6) END)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def spread(trips: str, slide: int, width: int) -> str:
    n = -(-width // slide)
    at = f"((pickup_epoch_millis // {slide})*{slide} - i*{slide})"
    return (f"(SELECT t.*, {at} AS window_start FROM {trips} t, (SELECT unnest(range(0,{n})) AS i) x "
            f"WHERE pickup_epoch_millis < {at} + {width})")


def mean(c: str, n: int) -> str:
    return f"coalesce({dp(f'avg({c})', n)},0)"


def demand_sql(trips: str, slide: int, width: int) -> str:
    return f"""SELECT pickup_location_id AS location_id, window_start, window_start + {width} AS window_end,
        CAST({width // 1000} AS BIGINT) AS window_seconds, count(*) AS trip_count,
        CAST(sum(coalesce(passenger_count,0)) AS BIGINT) AS passenger_total,
        {dbl('count(*)')}/{dbl(width / 60000)} AS demand_per_minute,
        {mean('trip_distance_miles', 4)} AS avg_trip_distance_miles, {mean('trip_duration_seconds', 2)} AS avg_duration_seconds,
        {mean('average_speed_mph', 3)} AS avg_speed_mph, {mean('fare_amount', 4)} AS avg_fare_amount,
        {dp('sum(coalesce(total_amount,0))', 2)} AS total_revenue, {dp('sum(coalesce(tip_amount,0))', 2)} AS total_tips,
        count(DISTINCT dropoff_location_id) AS distinct_destinations
        FROM {spread(trips, slide, width)} GROUP BY pickup_location_id, window_start"""


def flow_sql(trips: str, slide: int, width: int) -> str:
    return f"""SELECT pickup_location_id AS origin_id, dropoff_location_id AS destination_id, window_start,
        window_start + {width} AS window_end, count(*) AS trip_count,
        {mean('trip_duration_seconds', 2)} AS avg_duration_seconds, {mean('trip_distance_miles', 4)} AS avg_trip_distance_miles,
        {mean('average_speed_mph', 3)} AS avg_speed_mph, {dp('sum(coalesce(total_amount,0))', 2)} AS total_revenue
        FROM {spread(trips, slide, width)} GROUP BY pickup_location_id, dropoff_location_id, window_start"""


DEMAND_COLS = ["location_id", "window_start", "window_end", "window_seconds", "trip_count", "passenger_total",
               "demand_per_minute", "avg_trip_distance_miles", "avg_duration_seconds", "avg_speed_mph",
               "avg_fare_amount", "total_revenue", "total_tips", "distinct_destinations"]
FLOW_COLS = ["origin_id", "destination_id", "window_start", "window_end", "trip_count", "avg_duration_seconds",
             "avg_trip_distance_miles", "avg_speed_mph", "total_revenue"]
DOUBLES = {"demand_per_minute", "avg_trip_distance_miles", "avg_duration_seconds", "avg_speed_mph", "avg_fare_amount",
           "total_revenue", "total_tips", "surge_ratio", "baseline_demand_per_minute"}
BEFORE = "OVER (PARTITION BY location_id ORDER BY window_start ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
ORDERED = "OVER (PARTITION BY location_id ORDER BY window_start)"


def grid_sql(demand: str, minimum: int) -> str:
    carry = ", ".join(
        f"coalesce(last_value(d.{c} IGNORE NULLS) OVER (PARTITION BY a.location_id ORDER BY s.window_start "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),0) AS {c}" for c in CARRY)
    zero = ", ".join(f"coalesce(d.{c},0) AS {c}" for c in ZERO)
    return f"""SELECT a.location_id, s.window_start, coalesce(d.window_end, s.window_start + {WIDTH}) AS window_end, {zero}, {carry}
        FROM (SELECT location_id FROM {demand} WHERE location_id IN (SELECT location_id FROM zones)
              GROUP BY location_id HAVING count(*) >= {minimum}) a
        CROSS JOIN (SELECT unnest(range(lo, hi + 1, {SLIDE})) AS window_start
                    FROM (SELECT min(window_start) AS lo, max(window_start) AS hi FROM {demand})) s
        LEFT JOIN {demand} d ON d.location_id = a.location_id AND d.window_start = s.window_start"""


def lag_cols() -> str:
    return ", ".join(f"coalesce(lag({c},{n}) {ORDERED},0) AS {c}_lag_{n}" for n in LAGS for c in ("trip_count", "demand_per_minute"))


def season_cols() -> str:
    return (f"coalesce(lag(trip_count,{DAY_SLOTS}) {ORDERED},0) AS trip_count_lag_day, "
            f"coalesce(lag(trip_count,{7 * DAY_SLOTS}) {ORDERED},0) AS trip_count_lag_week")


def roll_cols() -> str:
    out = []
    for n in SPANS:
        w = BEFORE.format(n=n)
        for f, e in (("mean", f"avg(trip_count) {w}"), ("stddev", f"stddev_samp(trip_count) {w}"),
                     ("max", f"max(trip_count) {w}"), ("min", f"min(trip_count) {w}")):
            out.append(f"coalesce({e},0) AS trip_count_{f}_{n}")
        out.append(f"trip_count - coalesce(avg(trip_count) {w},0) AS trip_count_trend_{n}")
    return ", ".join(out)


def calendar_cols() -> str:
    t = f"make_timestamp((window_start-{EST})*1000)"
    m, d = f"(hour({t})*60+minute({t}))", f"dayofweek({t})"
    return (f"{dbl(f'hour({t})')} AS hour_of_day, {dbl(m)} AS minute_of_day, {dbl(d)} AS day_of_week, "
            f"CASE WHEN {d} IN (0,6) THEN {dbl(1)} ELSE {dbl(0)} END AS is_weekend, "
            f"sin({m}*2*pi()/1440) AS hour_sin, cos({m}*2*pi()/1440) AS hour_cos, "
            f"sin({d}*2*pi()/7) AS weekday_sin, cos({d}*2*pi()/7) AS weekday_cos")


def target_cols() -> str:
    return (f"lead(trip_count,{HORIZON}) {ORDERED} AS target_trip_count, "
            f"lead(window_start,{HORIZON}) {ORDERED} AS target_window_start")


PRESSURE = """SELECT coalesce(i.location_id,o.location_id) AS location_id, coalesce(i.window_start,o.window_start) AS window_start,
    coalesce(it,0) AS inbound_trip_count, coalesce(iz,0) AS inbound_zone_count, coalesce(ot,0) AS outbound_trip_count,
    coalesce(oz,0) AS outbound_zone_count, coalesce(it,0)-coalesce(ot,0) AS net_flow
    FROM (SELECT destination_id AS location_id, window_start, CAST(sum(trip_count) AS DOUBLE) AS it, CAST(count(DISTINCT origin_id) AS DOUBLE) AS iz FROM {f} GROUP BY ALL) i
    FULL JOIN (SELECT origin_id AS location_id, window_start, CAST(sum(trip_count) AS DOUBLE) AS ot, CAST(count(DISTINCT destination_id) AS DOUBLE) AS oz FROM {f} GROUP BY ALL) o
    ON i.location_id = o.location_id AND i.window_start = o.window_start"""

ZONE_SIDE = """SELECT z.location_id, coalesce(page_rank_score,0) AS page_rank_score, coalesce(betweenness_score,0) AS betweenness_score,
    coalesce(importance_score,0) AS importance_score, CAST(coalesce(importance_rank,0) AS DOUBLE) AS importance_rank,
    coalesce(corridor_bias,0) AS corridor_bias, coalesce(z.community_id,-1) AS community_id,
    coalesce(c.community_size,0) AS community_size, coalesce(c.community_cohesion,0) AS community_cohesion
    FROM zones_x z LEFT JOIN comm c ON c.community_id = coalesce(z.community_id,-1)"""


TODAY = "JOIN zone_side s ON s.location_id = f.location_id"
AS_OF = "ASOF LEFT JOIN snaps s ON s.location_id = f.location_id AND f.window_start >= s.snapshot_start"


def matrix_sql(demand: str, flows: str, target: bool, scores: str = TODAY) -> str:
    """Grid -> time features -> graph scores -> peers -> flows, over named demand and flow rows."""
    goal = f", {target_cols()}" if target else ""
    return f"""SELECT m.*, coalesce(p.inbound_trip_count,0) AS inbound_trip_count, coalesce(p.inbound_zone_count,0) AS inbound_zone_count,
        coalesce(p.outbound_trip_count,0) AS outbound_trip_count, coalesce(p.outbound_zone_count,0) AS outbound_zone_count,
        coalesce(p.net_flow,0) AS net_flow, CAST(floor(m.window_start/86400000) AS BIGINT) AS window_day
        FROM (SELECT g.*, CASE WHEN count(*) OVER q > 1 THEN (sum(trip_count) OVER q - trip_count)/(count(*) OVER q - 1) ELSE 0 END AS community_peer_mean_demand,
                     CASE WHEN sum(trip_count) OVER q > 0 THEN trip_count/(sum(trip_count) OVER q) ELSE 0 END AS community_demand_share
              FROM (SELECT f.*, {', '.join(f'coalesce(s.{c},0) AS {c}' for c in SCORES)}, coalesce(s.community_id,-1) AS community_id,
                           coalesce(s.community_size,0) AS community_size, coalesce(s.community_cohesion,0) AS community_cohesion
                    FROM (SELECT *, {lag_cols()}, {season_cols()}, {roll_cols()}, {calendar_cols()}{goal} FROM ({grid_sql(demand, 1)})) f
                    {scores}) g
              WINDOW q AS (PARTITION BY community_id, window_start)) m
        LEFT JOIN ({PRESSURE.format(f=flows)}) p ON p.location_id = m.location_id AND p.window_start = m.window_start"""


MATRIX_COLS = (["location_id", "window_start", "window_end"] + ZERO + CARRY + LAG_COLS + SEASON_COLS + ROLL_COLS + CALENDAR
               + SCORES + ["community_id", "community_size", "community_cohesion", "community_peer_mean_demand",
                           "community_demand_share"] + FLOWS + ["window_day"])
TARGET_COLS = ["target_trip_count", "target_window_start"]
WHOLE = {"location_id", "window_start", "window_end", "community_id", "window_day", "target_window_start", "window_seconds"}

CTES: dict[str, tuple[list[str], str]] = {
    **{n: (d, render(n, "duck")) for n, (d, _) in VIEWS.items()},
    "dw15": (["trips_e"], demand_sql("trips_e", 300_000, 900_000)),
    "dw": (["trips_e"], demand_sql("trips_e", SLIDE, WIDTH)),
    "fl15": (["trips_e"], flow_sql("trips_e", 300_000, 900_000)),
    "fl": (["trips_e"], flow_sql("trips_e", SLIDE, WIDTH)),
    "fs": (["trips_s"], flow_sql("trips_s", YEAR, YEAR)),
    "surge": (["dw"], f"""SELECT *, CASE WHEN baseline_demand_per_minute > 0 THEN demand_per_minute/baseline_demand_per_minute ELSE 0 END AS surge_ratio,
        (baseline_demand_per_minute > 0 AND baseline_sample_size >= 4 AND demand_per_minute >= baseline_demand_per_minute*1.75) AS is_surge
        FROM (SELECT *, coalesce(avg(demand_per_minute) {BEFORE.format(n=12)},0) AS baseline_demand_per_minute,
                     count(demand_per_minute) {BEFORE.format(n=12)} AS baseline_sample_size FROM dw)"""),
    "demand_f": (["surge"], f"""SELECT location_id, window_start, window_end, {', '.join(f'{dbl(c)} AS {c}' for c in ZERO if c != 'is_surge')},
        {', '.join(f'{dbl(c)} AS {c}' for c in CARRY)}, CASE WHEN is_surge THEN {dbl(1)} ELSE {dbl(0)} END AS is_surge FROM surge"""),
    "grid": (["demand_f", "zones"], grid_sql("demand_f", 1)),
    "comm": (["zones_x"], """SELECT community_id, CAST(count(*) AS DOUBLE) AS community_size,
        CAST(count(*) FILTER (service_zone = 'Core') AS DOUBLE)/CAST(count(*) AS DOUBLE) AS community_cohesion
        FROM zones_x WHERE community_id IS NOT NULL GROUP BY community_id"""),
    "zone_side": (["zones_x", "comm"], ZONE_SIDE),
    "pred": (["dw"], """SELECT location_id, window_start, CAST(trip_count AS DOUBLE) AS label,
        CAST((trip_count*3 + location_id) % 9 AS DOUBLE)/CAST(2 AS DOUBLE) AS prediction FROM dw"""),
    "vol": (["fs", "zones"], """SELECT origin_id AS src, destination_id AS dst, CAST(sum(trip_count) AS DOUBLE) AS trip_count,
        sum(total_revenue) AS total_revenue, avg(avg_duration_seconds) AS avg_duration_seconds
        FROM fs WHERE trip_count >= 1 AND origin_id <> destination_id GROUP BY ALL"""),
    "und": (["fs", "zones"], """SELECT src, dst, trip_count FROM (
        SELECT origin_id AS src, destination_id AS dst, CAST(sum(trip_count) AS DOUBLE) AS trip_count
        FROM fs WHERE trip_count >= 5 AND origin_id <> destination_id GROUP BY ALL) p
        UNION ALL SELECT dst, src, trip_count FROM (
        SELECT origin_id AS src, destination_id AS dst, CAST(sum(trip_count) AS DOUBLE) AS trip_count
        FROM fs WHERE trip_count >= 5 AND origin_id <> destination_id GROUP BY ALL) p"""),
    "vol15": (["fl15", "zones"], f"""SELECT origin_id AS src, destination_id AS dst, CAST(sum(trip_count) AS DOUBLE) AS trip_count,
        max(avg_duration_seconds) AS longest, CAST(count(trip_count) AS DOUBLE) AS edge_count
        FROM fl15 WHERE origin_id <> destination_id AND window_start >= {MID} AND window_start < {MID + 432_000_000}
        AND origin_id IN (SELECT location_id FROM zones) AND destination_id IN (SELECT location_id FROM zones) GROUP BY ALL"""),
    "shares15": (["vol15"], "SELECT src, dst, trip_count/(sum(trip_count) OVER (PARTITION BY src)) AS share FROM vol15"),
    "shares": (["vol"], "SELECT src, dst, trip_count/(sum(trip_count) OVER (PARTITION BY src)) AS share FROM vol"),
    "fc": (["zones"], ""),
}
CTES.pop("fc")
RAW_BAD = """CASE WHEN event_id % 101 = 0 THEN 'unparseable_pickup_time'
    WHEN event_id % 103 = 0 THEN 'unparseable_dropoff_time'
    WHEN event_id % 109 = 0 THEN 'missing_zone_id'
    WHEN event_id % 127 = 0 THEN 'unparseable_trip_distance'
    WHEN event_id % 137 = 0 THEN 'unparseable_total_amount'
    WHEN event_id % 113 = 0 OR pu > (SELECT n FROM n_zones) THEN 'zone_id_out_of_range'
    WHEN dro > (SELECT n FROM n_zones) THEN 'zone_id_out_of_range'
    WHEN event_id % 107 = 0 THEN 'non_positive_duration'
    WHEN event_id % 131 = 0 THEN 'distance_out_of_range'
    WHEN speed > 120 THEN 'implausible_speed' END"""
CTES["judged"] = (["n_zones"], f"""SELECT *, {RAW_BAD} AS reason,
    lower(substr(h,1,8))||'-'||substr(h,9,4)||'-3'||substr(h,14,3)||'-'||
      substr('89ab', CAST((strpos('0123456789abcdef', substr(h,17,1))-1) % 4 + 1 AS INT), 1)||substr(h,18,3)||'-'||substr(h,21,12) AS uuid
    FROM (SELECT *, md5(concat_ws('|','yellow',CAST(vendor AS VARCHAR),CAST(p_ms AS VARCHAR),CAST(p_ms + secs*1000 AS VARCHAR),CAST(pu AS VARCHAR),CAST(dro AS VARCHAR),printf('%.2f',value))) AS h
    FROM (SELECT *, dist/(CAST(secs AS DOUBLE)/CAST(3600 AS DOUBLE)) AS speed
    FROM (SELECT event_id, CAST(user_id % 3 AS INT) AS vendor, CAST(1 + user_id % n AS INT) AS pu, CAST(1 + (user_id*3 + k) % n AS INT) AS dro,
        (CAST(floor(epoch_us(ts)/1000000) AS BIGINT))*1000 + {EST} AS p_ms,
        CASE WHEN event_id % 107 = 0 THEN 0 ELSE 120 + 30*k END AS secs,
        CASE WHEN event_id % 131 = 0 THEN CAST(-1 AS DOUBLE) ELSE floor(value/20.0) END AS dist, value,
        CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 6 AS INT) END AS pax
      FROM (SELECT *, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k, (SELECT n FROM n_zones) AS n FROM events))))""")


def sql(needs: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    order: list[str] = []

    def walk(name: str) -> None:
        for dep in CTES[name][0]:
            walk(dep)
        if name not in order:
            order.append(name)

    for name in needs:
        walk(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in order] + [f"{n} AS {s}" for n, s in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def pick(cols: list[str], frm: str, doubles: set[str] | None = None) -> str:
    """SELECT with every double column rounded to 6 places."""
    known = doubles if doubles is not None else set(cols) - WHOLE
    return f"SELECT {', '.join(f'{r6(c)} AS {c}' if c in known else c for c in cols)} FROM {frm}"


def pagerank_sql(rounds: int, seeds: str | None, final: str, shares: str = "shares") -> str:
    base = "CAST(0.15 AS DOUBLE)" if seeds is None else f"(CASE WHEN location_id IN ({seeds}) THEN CAST(0.15 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"
    extra = {"r0": f"MATERIALIZED (SELECT location_id AS id, {base} AS base, {base} AS score FROM zones)"}
    for k in range(1, rounds + 1):
        extra[f"r{k}"] = (f"MATERIALIZED (SELECT r.id, r.base, r.base + CAST(0.85 AS DOUBLE)*coalesce(c.s,0) AS score FROM r{k-1} r LEFT JOIN "
                          f"(SELECT dst, sum(share*score) AS s FROM {shares} JOIN r{k-1} ON src = id GROUP BY dst) c ON c.dst = r.id)")
    return sql([shares, "zones"], final.format(r=f"r{rounds}"), extra)


def weighted_betweenness_sql(rounds: int, hops: int) -> str:
    """Least costs by ``rounds`` of relaxation, then walks of up to ``hops`` links along links that lie on least-cost paths."""
    extra = {"e": f"MATERIALIZED (SELECT origin_id AS src, destination_id AS dst, {dbl('avg(avg_duration_seconds)')} AS w FROM fs WHERE trip_count >= 3 AND origin_id <> destination_id GROUP BY ALL)",
             "c0": "MATERIALIZED (SELECT location_id AS s, location_id AS v, CAST(0 AS DOUBLE) AS cost FROM zones)"}
    for k in range(1, rounds + 1):
        extra[f"c{k}"] = f"MATERIALIZED (SELECT s, v, min(cost) AS cost FROM (SELECT * FROM c{k-1} UNION ALL SELECT s, dst, cost + w FROM c{k-1} JOIN e ON src = v) GROUP BY s, v)"
    c = f"c{rounds}"
    extra["tight"] = f"MATERIALIZED (SELECT a.s, src, dst FROM {c} a JOIN e ON src = a.v JOIN {c} b ON b.s = a.s AND b.v = dst WHERE a.cost + w = b.cost)"
    extra["q0"] = f"MATERIALIZED (SELECT s, v, v AS t, CAST(1 AS DOUBLE) AS n FROM {c})"
    for k in range(1, hops + 1):
        extra[f"q{k}"] = f"MATERIALIZED (SELECT q.s, src AS v, t, sum(n) AS n FROM tight x JOIN q{k-1} q ON q.s = x.s AND q.v = dst GROUP BY q.s, src, t)"
    extra["walks"] = "MATERIALIZED (SELECT s, v, t, sum(n) AS n FROM (" + " UNION ALL ".join(f"SELECT * FROM q{k}" for k in range(hops + 1)) + ") GROUP BY ALL)"
    return sql(["fs", "zones"], f"""SELECT z.location_id AS id, {r6('coalesce(b.score,0)')} AS score FROM zones z LEFT JOIN (
        SELECT b.v AS id, sum(a.n*b.n/c.n) AS score FROM walks b JOIN walks a ON a.s = b.s AND a.v = b.s AND a.t = b.v
        JOIN walks c ON c.s = b.s AND c.v = b.s AND c.t = b.t WHERE b.v <> b.s AND b.t <> b.v GROUP BY b.v) b ON b.id = z.location_id""", extra)


def betweenness_sql(levels: int) -> str:
    extra = {"l0": "MATERIALIZED (SELECT location_id AS s, location_id AS v, CAST(1 AS DOUBLE) AS paths FROM zones)",
             "e": "MATERIALIZED (SELECT DISTINCT src, dst FROM vol)"}
    for k in range(1, levels + 1):
        seen = " UNION ALL ".join(f"SELECT s, v FROM l{j}" for j in range(k))
        extra[f"l{k}"] = (f"MATERIALIZED (SELECT s, dst AS v, sum(paths) AS paths FROM l{k-1} JOIN e ON src = v "
                          f"WHERE (s, dst) NOT IN (SELECT (s, v) FROM ({seen})) GROUP BY s, dst)")
    extra["p"] = "MATERIALIZED (" + " UNION ALL ".join(f"SELECT s, v, {k} AS d, paths FROM l{k}" for k in range(levels + 1)) + ")"
    return sql(["vol", "zones"], f"""SELECT z.location_id AS id, {r6('coalesce(b.score,0)')} AS score FROM zones z LEFT JOIN (
        SELECT a.v AS id, sum(a.paths*b.paths/c.paths) AS score FROM p a JOIN p b ON b.s = a.v JOIN p c ON c.s = a.s AND c.v = b.v
        WHERE a.d + b.d = c.d AND a.d > 0 AND b.d > 0 GROUP BY a.v) b ON b.id = z.location_id""", extra)


def spread_figures(x: str) -> str:
    p = "".join(f"{r6(f'quantile_cont({x},{q})')} AS {n}, " for n, q in
                (("p50", .5), ("p75", .75), ("p90", .9), ("p95", .95), ("p99", .99), ("p999", .999)))
    return f"{r6(f'min({x})')} AS min, {r6(f'avg({x})')} AS mean, {r6(f'max({x})')} AS max, {p}{r6(f'stddev_pop({x})')} AS std_dev"


def metrics_cols(y: str, p: str) -> str:
    q = f"greatest({p}, CAST(1e-9 AS DOUBLE))"
    rmse, ml, mp = f"sqrt(avg(({p}-{y})*({p}-{y})))", f"avg({y})", f"avg({p})"
    tss = f"(sum({y}*{y}) - sum({y})*sum({y})/count(*))"
    return (f"count(*) AS row_count, {r6(rmse)} AS rmse, {r6(f'avg(abs({p}-{y}))')} AS mae, "
            f"{r6(f'CASE WHEN {tss} > 0 THEN 1 - sum(({p}-{y})*({p}-{y}))/{tss} ELSE 0 END')} AS r2, "
            f"{r6(f'200*avg(CASE WHEN abs({y})+abs({p}) > 0 THEN abs({p}-{y})/(abs({y})+abs({p})) ELSE 0 END)')} AS smape, "
            f"{r6(f'avg(2*((CASE WHEN {y} > 0 THEN {y}*ln({y}/{q}) ELSE 0 END) - ({y}-{q})))')} AS poisson_deviance, "
            f"{r6(ml)} AS mean_label, {r6(mp)} AS mean_prediction, {r6(f'({mp}-{ml})')} AS bias, "
            f"{r6(f'CASE WHEN {ml} > 0 THEN {rmse}/{ml} ELSE 0 END')} AS normalised_rmse")


def profile_sql(having: str, cols: str) -> str:
    names = ZERO + CARRY + LAG_COLS + ["span_ms", "busy_trips"]
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS null_count, coalesce(stddev_samp({c}),0) AS stddev FROM lagged" for c in names)
    return sql(["grid"], f"SELECT {cols} FROM ({rows}) {having}", {"lagged": f"(SELECT *, {lag_cols()}, {dbl('window_end - window_start')} AS span_ms, CASE WHEN trip_count > 0 THEN trip_count END AS busy_trips FROM grid)"})


PROFILES = f"""SELECT community_id, size, array_to_string(top_zones, ',') AS top_zones,
    dominant_borough, {r6('dominant_borough_share')} AS dominant_borough_share, borough_spread, internal_trip_count, external_trip_count,
    {r6('cohesion')} AS cohesion FROM prof"""
PROF = """(SELECT s.community_id, size, top_zones, coalesce(b.dominant,'') AS dominant_borough,
    coalesce(CAST(b.n AS DOUBLE)/CAST(b.known AS DOUBLE),0) AS dominant_borough_share, coalesce(b.spread,0) AS borough_spread,
    coalesce(i,0) AS internal_trip_count, coalesce(x,0) AS external_trip_count,
    CASE WHEN coalesce(i,0)+coalesce(x,0) > 0 THEN CAST(i AS DOUBLE)/CAST(i+x AS DOUBLE) ELSE 0 END AS cohesion
    FROM (SELECT community_id, count(*) AS size,
            (list(zone_name ORDER BY importance_score DESC, location_id))[1:5] AS top_zones FROM zones_x WHERE community_id IS NOT NULL GROUP BY 1) s
    LEFT JOIN (SELECT community_id, max(n) AS n, arg_max(borough, {'n': n, 'b': borough}) AS dominant, CAST(sum(n) AS BIGINT) AS known, count(*) AS spread
               FROM (SELECT community_id, borough, count(*) AS n FROM zones_x WHERE community_id IS NOT NULL AND borough <> '' GROUP BY ALL) GROUP BY 1) b
      ON b.community_id = s.community_id
    LEFT JOIN volume v ON v.community_id = s.community_id)"""
VOLUME = """(SELECT o.community_id, CAST(sum(CASE WHEN o.community_id = d.community_id THEN trip_count ELSE 0 END) AS BIGINT) AS i,
    CAST(sum(CASE WHEN o.community_id <> d.community_id THEN trip_count ELSE 0 END) AS BIGINT) AS x
    FROM fs JOIN zones_x o ON o.location_id = origin_id JOIN zones_x d ON d.location_id = destination_id
    WHERE o.community_id IS NOT NULL AND d.community_id IS NOT NULL GROUP BY 1)"""
SURGE_COLS = DEMAND_COLS + ["baseline_demand_per_minute", "baseline_sample_size", "surge_ratio", "is_surge"]
FORECASTS = f"""(SELECT location_id, window_start AS origin_window_start, window_start + {HORIZON * SLIDE} AS target_window_start,
    prediction AS forecast_trip_count, greatest(prediction - 2, 0) AS lower_bound, greatest(prediction + 1.5, 0) AS upper_bound,
    'v1' AS model_version, {HORIZON} AS horizon_slots FROM pred)"""
MAP_COLS = ["location_id", "zone_name", "borough", "latitude", "longitude", "trip_count", "demand_per_minute", "total_revenue",
            "surge_ratio", "is_surge", "importance", "community_id", "forecast_trip_count", "forecast_delta"]
MAP = """(SELECT s.location_id, zone_name, borough, latitude, longitude, trip_count, demand_per_minute, total_revenue, surge_ratio, is_surge,
    importance_score AS importance, coalesce(community_id,-1) AS community_id, coalesce(f.forecast_trip_count,0) AS forecast_trip_count,
    coalesce(f.forecast_trip_count,0) - trip_count AS forecast_delta
    FROM surge s JOIN zones_x z ON z.location_id = s.location_id
    LEFT JOIN fcst f ON f.location_id = s.location_id AND f.origin_window_start = s.window_start
    WHERE s.window_start = (SELECT max(window_start) FROM surge) AND latitude IS NOT NULL AND longitude IS NOT NULL)"""
MAP_DOUBLES = {"latitude", "longitude", "demand_per_minute", "total_revenue", "surge_ratio", "importance",
               "forecast_trip_count", "forecast_delta"}
NOW = "WHERE window_start = (SELECT max(window_start) FROM surge)"
IMPORTANCE = """(SELECT id AS location_id, page_rank AS page_rank_score, betweenness AS betweenness_score, pn AS page_rank_normalised, bn AS betweenness_normalised,
    pn*CAST(0.65 AS DOUBLE) + bn*CAST(0.35 AS DOUBLE) AS importance_score, bn - pn AS corridor_bias,
    CAST(row_number() OVER (ORDER BY round(pn*CAST(0.65 AS DOUBLE) + bn*CAST(0.35 AS DOUBLE),9) DESC, id) AS INT) AS importance_rank
    FROM (SELECT *, (page_rank - min(page_rank) OVER ())/(max(page_rank) OVER () - min(page_rank) OVER ()) AS pn,
            (betweenness - min(betweenness) OVER ())/(max(betweenness) OVER () - min(betweenness) OVER ()) AS bn FROM scores_f))"""
IMP_COLS = ["location_id", "page_rank_score", "betweenness_score", "page_rank_normalised", "betweenness_normalised",
            "importance_score", "corridor_bias", "importance_rank"]
IMP_DOUBLES = set(IMP_COLS) - {"location_id", "importance_rank"}
ZX = ["location_id", "zone_name", "borough", "service_zone"]


def oracle_sql() -> dict[str, str]:
    demand15 = sql(["dw15"], pick(DEMAND_COLS, "dw15", DOUBLES))
    demand = sql(["dw"], pick(DEMAND_COLS, "dw", DOUBLES))
    flows15 = sql(["fl15"], pick(FLOW_COLS, "fl15", DOUBLES))
    streamed = [c for c in DEMAND_COLS if c != "distinct_destinations"]
    grid_cols = ["location_id", "window_start", "window_end"] + ZERO + CARRY
    graph_cols = SCORES + ["community_id", "community_size", "community_cohesion"]
    in_zones = "origin_id IN (SELECT location_id FROM zones) AND destination_id IN (SELECT location_id FROM zones)"
    core = "origin_id IN (SELECT location_id FROM zones_x WHERE service_zone='Core') AND destination_id IN (SELECT location_id FROM zones_x WHERE service_zone='Core')"
    q: dict[str, str] = {}

    # ingest and events
    ok = "FROM judged WHERE reason IS NULL"
    q["parse_trips"] = sql(["judged"], f"""SELECT uuid AS event_id, vendor AS vendor_id, p_ms AS pickup_epoch_millis, p_ms + secs*1000 AS dropoff_epoch_millis,
        secs AS trip_duration_seconds, pax AS passenger_count, dist AS trip_distance_miles, round_even(speed*100, 0)/100 AS average_speed_mph,
        pu AS pickup_location_id, dro AS dropoff_location_id, 'N' AS store_and_forward_flag, value AS total_amount, event_id AS source_line {ok}""")
    q["event_ids"] = sql(["judged"], f"SELECT event_id AS source_line, uuid AS event_id {ok}")
    q["trip_rejects"] = sql(["judged"], """SELECT event_id AS source_line, reason, CASE reason
        WHEN 'unparseable_pickup_time' THEN 'not a time' WHEN 'unparseable_dropoff_time' THEN '<empty>'
        WHEN 'missing_zone_id' THEN concat('pickup=<empty> dropoff=', dro, '.0') WHEN 'unparseable_trip_distance' THEN 'NaN'
        WHEN 'unparseable_total_amount' THEN 'abc'
        WHEN 'zone_id_out_of_range' THEN CASE WHEN event_id % 113 = 0 THEN 'pickup=900000' WHEN pu > (SELECT n FROM n_zones) THEN concat('pickup=', pu) ELSE concat('dropoff=', dro) END
        WHEN 'non_positive_duration' THEN 'duration_seconds=0' WHEN 'distance_out_of_range' THEN 'trip_distance=-1.0'
        ELSE concat('speed_mph=', CAST(speed AS VARCHAR)) END AS detail FROM judged WHERE reason IS NOT NULL""")
    q["reject_breakdown"] = sql(["judged"], "SELECT reason, count(*) AS row_count FROM judged WHERE reason IS NOT NULL GROUP BY reason")
    q["ingest_summary"] = sql(["judged"], "SELECT count(*) AS rows_read, count(*) FILTER (reason IS NULL) AS rows_accepted, count(*) FILTER (reason IS NOT NULL) AS rows_rejected FROM judged")
    q["publish_events"] = sql(["judged"], f"""SELECT CAST(pu AS VARCHAR) AS key, uuid AS event_id, 'yellow' AS service_type, p_ms AS event_millis,
        strftime(make_timestamp(p_ms*1000), '%Y-%m-%dT%H:%M:%SZ') AS pickup_time, dro AS dropoff_location_id, value AS total_amount {ok}""")
    good = "event_id % 11 <> 0 AND event_id % 13 <> 0"
    q["decode_events"] = sql(["trips_e"], f"""SELECT CAST(event_id AS VARCHAR) AS event_id, pickup_location_id, dropoff_location_id, pickup_epoch_millis,
        passenger_count, {r6('total_amount')} AS total_amount FROM trips_e WHERE {good}""")
    q["payload_quality"] = sql(["trips_e"], f"SELECT count(*) AS payloads_seen, count(*) FILTER (NOT ({good})) AS payloads_malformed FROM trips_e")
    q["dedup_events"] = sql(["trips_e"], f"SELECT event_id, pickup_location_id, pickup_epoch_millis, {r6('total_amount')} AS total_amount FROM trips_e")

    # windows, tables and streams
    q["demand_windows"] = q["replay_idempotent"] = demand15
    q["upsert_demand_windows"] = demand15
    q["zone_flows"] = q["upsert_zone_flows"] = flows15
    q["tumbling_demand"] = sql(["trips_e"], pick(DEMAND_COLS, f"({demand_sql('trips_e', 3_600_000, 3_600_000)})", DOUBLES))
    q["stream_demand"] = sql(["dw15"], pick(streamed, "dw15", DOUBLES))
    q["stream_flows"] = flows15
    in_time = f"event_id % 10 <> 0 AND pickup_epoch_millis < {MID + 432_000_000}"
    late = (f"(event_id % 10 = 0 AND pickup_epoch_millis < {MID + 432_000_000} AND pickup_epoch_millis <= "
            f"(SELECT max(pickup_epoch_millis) - 600000 FROM trips_e WHERE {in_time}))")
    q["stream_late_data"] = sql(["trips_e"], f"""SELECT location_id, window_start, trip_count, {r6('total_revenue')} AS total_revenue,
        (SELECT count(*) FROM trips_e WHERE {late}) AS rows_dropped FROM ({demand_sql('kept', 300_000, 900_000)})""",
        {"kept": f"(SELECT * FROM trips_e WHERE NOT {late})"})
    q["stream_restart"] = sql(["dw15", "fl15"], f"""SELECT 'demand' AS kind, location_id AS origin_id, CAST(0 AS INT) AS destination_id, window_start, trip_count, {r6('total_revenue')} AS total_revenue FROM dw15
        UNION ALL SELECT 'flow', origin_id, destination_id, window_start, trip_count, {r6('total_revenue')} FROM fl15""")
    q["stream_progress"] = sql(["trips_e"], "SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS payloads_malformed, CAST(0 AS BIGINT) AS rows_dropped, CAST(4 AS BIGINT) AS filled_batches, true AS each_once FROM trips_e")
    q["scan_trip_files"] = sql(["raw_trips"], """SELECT """ + ", ".join(f"coalesce({c}, '') AS {c}" for c in (
        "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "pickup_location_id", "dropoff_location_id", "total_amount"))
        + """, row_number() OVER (PARTITION BY source_line // 2000, source_line % 3 ORDER BY source_line) + 1 AS source_line FROM raw_trips""")
    q["load_demand_windows"] = sql(["demand_f"], pick(["location_id", "window_start", "window_end"] + ZERO + CARRY, f"demand_f WHERE window_start >= {MID} AND window_start < {MID + 432_000_000}"))
    q["feature_store_roundtrip"] = sql(["demand_f"], pick(
        ["location_id", "window_start", "window_end"] + ZERO + CARRY + ["window_day"],
        f"(SELECT *, CAST(floor(window_start/86400000) AS BIGINT) AS window_day FROM demand_f) WHERE window_day >= {MID // 86_400_000} AND window_day < {MID // 86_400_000 + 5}"))
    q["upsert_outcome"] = sql(["dw15"], f"""SELECT count(*) FILTER (n) AS rows_written, count(*) FILTER (n AND NOT o) AS rows_created,
        count(*) FILTER (n AND o AND ch) AS rows_updated, count(*) FILTER (n AND o AND NOT ch) AS rows_unchanged, count(*) FILTER (o AND NOT n) AS rows_untouched
        FROM (SELECT window_start >= {MID} AS n, window_start < {MID + 86_400_000} AS o, location_id % 2 = 0 AS ch FROM dw15)""")
    q["zone_graph_features"] = sql(["zone_side"], pick(["location_id"] + SCORES + ["community_id"], "zone_side"))
    q["graph_snapshot"] = sql(["zone_side"], pick(["location_id"] + graph_cols + ["snapshot_start"], f"(SELECT *, CAST({SNAPSHOT_AT} AS BIGINT) AS snapshot_start FROM zone_side)", set(graph_cols) - {"community_id"}))
    imp = {"imp": IMPORTANCE}
    upd = ["page_rank_score", "betweenness_score", "importance_score", "importance_rank", "corridor_bias"]
    fresh = "i.location_id IS NOT NULL AND i.location_id % 5 <> 0"
    q["persist_importance"] = sql(["zones_x", "scores_f"], "SELECT z.location_id, z.zone_name, "
        + ", ".join(f"CAST({r6(f'CASE WHEN {fresh} THEN i.{c} ELSE z.{c} END')} AS DOUBLE) AS {c}" for c in upd)
        + " FROM zones_x z LEFT JOIN imp i ON i.location_id = z.location_id", imp)
    q["persist_communities"] = sql(["zones_x", "parts_a"], """SELECT z.location_id, CASE WHEN z.location_id % 5 <> 0 THEN current_community ELSE community_id END AS community_id,
        CASE WHEN z.location_id % 5 <> 0 THEN 2 END AS community_levels FROM zones_x z JOIN parts_a p ON p.location_id = z.location_id""")
    q["prune_empty_communities"] = sql(["parts_a"], """SELECT community_id FROM (SELECT DISTINCT previous_community AS community_id FROM parts_a UNION SELECT DISTINCT current_community FROM parts_a)
        WHERE community_id IN (SELECT current_community FROM parts_a)""")
    fcols = ["location_id", "origin_window_start", "target_window_start", "forecast_trip_count", "lower_bound", "upper_bound", "model_version", "horizon_slots"]
    q["publish_forecasts"] = sql(["pred"], pick(fcols, "fcst", {"forecast_trip_count", "lower_bound", "upper_bound"}), {"fcst": FORECASTS})
    q["dq_unique"] = sql(["fl15"], "SELECT origin_id, window_start, count(*) AS row_count FROM fl15 GROUP BY ALL HAVING count(*) > 1")
    q["dq_not_null"] = sql(["zones_x"], "SELECT unnest(['betweenness_score','community_id','latitude','zone_name']) AS column_name, unnest([count(*) FILTER (betweenness_score IS NULL), count(*) FILTER (community_id IS NULL), count(*) FILTER (latitude IS NULL), count(*) FILTER (zone_name IS NULL)]) AS null_count FROM zones_x")

    # rules
    q["derive_window_end"] = sql(["dw15"], "SELECT location_id, window_start, window_start + window_seconds*1000 AS window_end FROM dw15")
    q["complete_zone_dim"] = sql(["zones", "dw15"], "SELECT location_id, zone_name, borough FROM zones WHERE location_id % 4 <> 1 UNION ALL SELECT DISTINCT location_id, NULL, NULL FROM dw15 WHERE location_id % 4 = 1")
    q["window_chain"] = sql(["dw15"], f"SELECT location_id, window_start, lag(window_start) {ORDERED} AS previous_window_start, lead(window_start) {ORDERED} AS next_window_start FROM dw15")
    q["zone_rollup"] = sql(["dw"], f"""SELECT location_id, max(window_start) AS latest_window_start, arg_max(trip_count, window_start) AS latest_trip_count,
        {r6('arg_max(demand_per_minute, window_start)')} AS latest_demand_per_minute, max(trip_count) AS peak_trip_count, count(*) AS observed_window_count FROM dw GROUP BY 1""")
    q["surge_score"] = sql(["surge"], pick(SURGE_COLS, "surge", DOUBLES))
    q["borough_dim"] = sql(["zones_x"], "SELECT DISTINCT borough FROM zones_x WHERE trim(borough) <> ''")
    q["classify_flows"] = sql(["fl15"], "SELECT origin_id, destination_id, window_start, origin_id = destination_id AS is_internal, CAST(900 AS BIGINT) AS window_span_seconds FROM fl15")
    q["quarantine_zones"] = sql(["zones"], "SELECT location_id, zone_name, location_id > 80 AS is_quarantined, CASE WHEN location_id > 80 THEN 'location_id_out_of_tlc_range' END AS quarantine_reason FROM zones")

    # graph
    q["graph_projection"] = sql(["fs", "zones_x"], f"""SELECT src, dst, trip_count, {r6('total_revenue')} AS total_revenue, {r6('longest')} AS longest, edge_count FROM (
        SELECT origin_id AS src, destination_id AS dst, CAST(sum(trip_count) AS DOUBLE) AS trip_count, avg(total_revenue) AS total_revenue,
        max(avg_duration_seconds) AS longest, CAST(count(trip_count) AS DOUBLE) AS edge_count FROM fs
        WHERE trip_count >= 2 AND window_start >= {27 * YEAR} AND window_start < {30 * YEAR} AND {core} GROUP BY ALL)""")
    q["graph_projection_undirected"] = q["projection_community"] = sql(["und"], "SELECT * FROM und")
    q["projection_volume"] = sql(["vol"], pick(["src", "dst", "trip_count", "total_revenue", "avg_duration_seconds"], "vol", {"total_revenue", "avg_duration_seconds", "trip_count"}))
    q["projection_inbound"] = sql(["fs"], "SELECT destination_id AS src, origin_id AS dst, CAST(sum(trip_count) AS DOUBLE) AS trip_count, CAST(count(trip_count) AS DOUBLE) AS flow_share FROM fs WHERE trip_count >= 1 AND origin_id <> destination_id GROUP BY ALL")
    q["projection_travel_time"] = sql(["fs"], f"SELECT origin_id AS src, destination_id AS dst, {r6('avg(avg_duration_seconds)')} AS avg_duration_seconds, {r6('avg(avg_trip_distance_miles)')} AS avg_trip_distance_miles, CAST(sum(trip_count) AS DOUBLE) AS trip_count FROM fs WHERE trip_count >= 3 AND origin_id <> destination_id GROUP BY ALL")
    q["projection_cardinality"] = sql(["fs", "zones"], f"SELECT (SELECT count(*) FROM zones) AS node_count, count(*) AS relationship_count, count(DISTINCT (origin_id, destination_id)) AS pair_count FROM fs WHERE trip_count >= 1 AND origin_id <> destination_id AND {in_zones}")
    q["projection_summary"] = sql(["vol", "zones"], f"""SELECT count(*) AS node_count, CAST(sum(degree) AS BIGINT) AS relationship_count, {r6('CAST(sum(degree) AS DOUBLE)/(CAST(count(*) AS DOUBLE)*(count(*)-1))')} AS density,
        false AS is_empty, {r6('min(degree)')} AS degree_min, {r6('avg(degree)')} AS degree_mean, {r6('max(degree)')} AS degree_max, {r6('quantile_cont(degree,0.5)')} AS degree_p50,
        {r6('quantile_cont(degree,0.9)')} AS degree_p90, {r6('quantile_cont(degree,0.99)')} AS degree_p99
        FROM (SELECT z.location_id, CAST(count(v.src) AS DOUBLE) AS degree FROM zones z LEFT JOIN vol v ON v.src = z.location_id GROUP BY 1)""")
    q["pagerank"] = pagerank_sql(20, None, f"SELECT id, {r6('score')} AS score FROM {{r}}")
    q["pagerank_personalised"] = pagerank_sql(10, "1,4,7", f"SELECT id, {r6('score')} AS score FROM {{r}}")
    q["pagerank_topk"] = pagerank_sql(10, None, f"SELECT id, {r6('score')} AS score FROM {{r}} ORDER BY round(score,9) DESC, id LIMIT 10")
    q["pagerank_scaled"] = pagerank_sql(10, None, f"SELECT id, {r6('(score - lo)/(hi - lo)')} AS score FROM {{r}}, (SELECT min(score) AS lo, max(score) AS hi FROM {{r}})")
    q["betweenness"] = betweenness_sql(9)
    q["betweenness_sampled"] = f"SELECT id, score, true AS within_bound FROM ({q['betweenness']})"
    q["betweenness_weighted"] = weighted_betweenness_sql(14, 14)
    graph_imp = {"scores_g": f"(SELECT p.id, p.score AS page_rank, b.score AS betweenness FROM ({pagerank_sql(20, None, 'SELECT id, score FROM {r}')}) p JOIN ({q['betweenness']}) b ON b.id = p.id)",
                 "imp": IMPORTANCE.replace("scores_f", "scores_g")}
    q["zone_importance_graph"] = sql(["zones"], pick(IMP_COLS, "imp", IMP_DOUBLES), graph_imp)
    q["projection_windows"] = sql(["vol15"], pick(["src", "dst", "trip_count", "longest", "edge_count"], "vol15", {"longest"}))
    q["pagerank_windows"] = pagerank_sql(10, None, f"SELECT id, {r6('score')} AS score FROM {{r}}", "shares15")
    q["zone_importance"] = sql(["scores_f"], pick(IMP_COLS, "imp", IMP_DOUBLES), imp)
    q["corridor_zones"] = sql(["scores_f"], pick(IMP_COLS, "imp WHERE corridor_bias >= 0.1", IMP_DOUBLES), imp)
    q["score_distribution"] = sql(["scores_f"], f"SELECT {spread_figures('page_rank')} FROM scores_f")
    q["event_value_distribution"] = f"SELECT {spread_figures('value')} FROM events"
    member = {"m": "(SELECT location_id AS id, location_id % 4 AS c FROM zones)"}
    q["louvain_check"] = sql(["zones_x"], "SELECT count(*) AS nodes, true AS each_once, true AS gains FROM zones_x")
    q["demand_windows_approx_check"] = sql(["dw15"], "SELECT count(*) AS windows, true AS all_close FROM dw15")
    q["modularity"] = sql(["und", "zones"], f"""SELECT {r6('sum(inside)/sum(total) - sum(total*total)/(sum(total)*sum(total))')} AS modularity FROM (
        SELECT a.c, sum(CASE WHEN a.c = b.c THEN trip_count ELSE 0 END) AS inside, sum(trip_count) AS total FROM und JOIN m a ON a.id = src JOIN m b ON b.id = dst GROUP BY a.c)""", member)
    q["rand_index"] = sql(["parts_a"], f"""SELECT n AS shared_zones, agree AS agreeing_pairs, tot - agree AS disagreeing_pairs, {r6('CAST(agree AS DOUBLE)/tot')} AS rand_index, CAST(agree AS DOUBLE)/tot >= 0.9 AS is_stable
        FROM (SELECT (SELECT count(*) FROM parts_a) AS n, count(*) AS tot, count(*) FILTER ((a.previous_community = b.previous_community) = (a.current_community = b.current_community)) AS agree
        FROM parts_a a JOIN parts_a b ON a.location_id < b.location_id)""")
    q["shared_zones"] = sql(["dw15", "zones"], "SELECT DISTINCT location_id FROM dw15 WHERE location_id IN (SELECT location_id FROM zones WHERE location_id % 3 <> 0)")
    vol, prof = {"volume": VOLUME}, {"volume": VOLUME, "prof": PROF}
    q["community_volume"] = sql(["fs", "zones_x"], "SELECT community_id, i AS internal_trip_count, x AS external_trip_count FROM volume", vol)
    q["community_members"] = sql(["zones_x"], "SELECT community_id, location_id FROM zones_x WHERE community_id IS NOT NULL")
    q["community_profiles"] = sql(["fs", "zones_x"], PROFILES, prof)
    q["cross_borough_communities"] = sql(["fs", "zones_x"], PROFILES + " WHERE borough_spread > 1", prof)
    q["weak_communities"] = sql(["fs", "zones_x"], PROFILES + " WHERE cohesion < 0.5", prof)
    q["communities_view"] = sql(["fs", "zones_x"], f"""SELECT community_id, size, {r6('cohesion')} AS cohesion, dominant_borough, {r6('dominant_borough_share')} AS dominant_borough_share,
        borough_spread, internal_trip_count, external_trip_count, borough_spread > 1 AS crosses_boroughs FROM prof""", prof)

    # features
    parts = ZERO + CARRY + LAG_COLS
    figures = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(parts))
    norm = " + ".join(f"CASE WHEN s{i} > 0 THEN pow(({c} - m{i}) / s{i}, 2) ELSE 0 END" for i, c in enumerate(parts))
    q["assemble_vector"] = sql(["grid"], f"""SELECT location_id, window_start, {len(parts)} AS width, round({norm}, 2) AS norm
        FROM lagged, (SELECT {figures} FROM lagged)""", {"lagged": f"MATERIALIZED (SELECT *, {lag_cols()} FROM grid)"})
    q["complete_grid"] = sql(["grid"], pick(grid_cols, "grid"))
    q["calendar_features"] = sql(["dw"], pick(["location_id", "window_start"] + CALENDAR, f"(SELECT *, {calendar_cols()} FROM dw)"))
    q["lag_features"] = sql(["grid"], pick(["location_id", "window_start"] + LAG_COLS, f"(SELECT *, {lag_cols()} FROM grid)"))
    q["seasonal_lags"] = sql(["grid"], pick(["location_id", "window_start"] + SEASON_COLS, f"(SELECT *, {season_cols()} FROM grid)"))
    q["rolling_features"] = sql(["grid"], pick(["location_id", "window_start"] + ROLL_COLS, f"(SELECT *, {roll_cols()} FROM grid)"))
    q["target_label"] = sql(["grid"], pick(["location_id", "window_start"] + TARGET_COLS, f"(SELECT *, {target_cols()} FROM grid) WHERE target_trip_count IS NOT NULL"))
    q["flow_features"] = sql(["grid", "fl"], pick(["location_id", "window_start"] + FLOWS, "(SELECT g.location_id, g.window_start, "
        + ", ".join(f"coalesce(p.{c},0) AS {c}" for c in FLOWS) + f" FROM grid g LEFT JOIN ({PRESSURE.format(f='fl')}) p ON p.location_id = g.location_id AND p.window_start = g.window_start)"))
    q["graph_features_current"] = sql(["dw", "zone_side"], pick(["location_id", "window_start"] + graph_cols, "(SELECT d.location_id, d.window_start, "
        + ", ".join("s." + c for c in graph_cols) + " FROM dw d JOIN zone_side s ON s.location_id = d.location_id)"))
    q["asof_snapshots"] = sql(["dw", "snapshots_f"], f"""SELECT d.location_id, d.window_start, d.trip_count, {r6('coalesce(page_rank_score,0)')} AS page_rank_score,
        {r6('coalesce(betweenness_score,0)')} AS betweenness_score, coalesce(community_id,-1) AS community_id
        FROM dw d ASOF LEFT JOIN snapshots_f s ON d.location_id = s.location_id AND d.window_start >= s.snapshot_start""")
    q["community_peers"] = sql(["dw", "zone_side"], pick(["location_id", "window_start", "community_id", "community_peer_mean_demand", "community_demand_share"], """(
        SELECT d.location_id, d.window_start, community_id, CASE WHEN count(*) OVER w > 1 THEN CAST(sum(trip_count) OVER w - trip_count AS DOUBLE)/(count(*) OVER w - 1) ELSE 0 END AS community_peer_mean_demand,
        CAST(trip_count AS DOUBLE)/CAST(sum(trip_count) OVER w AS DOUBLE) AS community_demand_share
        FROM dw d JOIN zone_side s ON s.location_id = d.location_id WINDOW w AS (PARTITION BY community_id, d.window_start))"""))
    q["trim_warm_up"] = sql(["dw"], f"SELECT location_id, window_start, trip_count FROM dw WHERE window_start >= (SELECT min(window_start) FROM dw) + {LOOKBACK * SLIDE}")
    q["chronological_split"] = sql(["dw"], f"""SELECT CASE WHEN window_start < cut THEN 'train' ELSE 'holdout' END AS part, location_id, window_start FROM dw,
        (SELECT min(window_start) + CAST(floor((max(window_start)-min(window_start))*0.8) AS BIGINT) AS cut FROM dw) WHERE window_start < cut OR window_start >= cut + {HORIZON * SLIDE}""")
    q["feature_profile"] = profile_sql("", f"feature, null_count, {r6('stddev')} AS stddev")
    q["feature_health"] = profile_sql("WHERE null_count > 0 OR stddev = 0", "feature, null_count, stddev = 0 AS is_constant")
    q["training_matrix"] = sql(["demand_f", "fl", "zones", "zone_side"], pick(MATRIX_COLS + TARGET_COLS,
        f"({matrix_sql('demand_f', 'fl', True)}) WHERE target_trip_count IS NOT NULL AND window_start >= (SELECT min(window_start) FROM demand_f) + {LOOKBACK * SLIDE}"))
    snaps = " UNION ALL ".join(
        ZONE_SIDE.replace("SELECT z.location_id,", f"SELECT CAST({at} AS BIGINT) AS snapshot_start, z.location_id,", 1).replace("zones_x z", f"zx{i} z").replace("JOIN comm c", f"JOIN comm{i} c")
        for i, at in enumerate(CYCLES))
    cycles = {}
    for i in range(len(CYCLES)):
        cycles[f"zx{i}"] = f"(SELECT * REPLACE (page_rank_score + CAST({i / 8} AS DOUBLE) AS page_rank_score, (community_id + {i}) % 4 AS community_id) FROM zones_x)"
        cycles[f"comm{i}"] = "(" + CTES["comm"][1].replace("FROM zones_x", f"FROM zx{i}") + ")"
    past_warm_up = f"target_trip_count IS NOT NULL AND window_start >= (SELECT min(window_start) FROM demand_f) + {LOOKBACK * SLIDE}"
    q["training_matrix_snapshots"] = sql(["demand_f", "fl", "zones", "zones_x"], pick(MATRIX_COLS + TARGET_COLS,
        f"({matrix_sql('demand_f', 'fl', True, AS_OF)}) WHERE {past_warm_up}"), {**cycles, "snaps": f"({snaps})"})
    trained = {"tm": f"MATERIALIZED (SELECT window_start, target_trip_count, trip_count_lag_day FROM ({matrix_sql('demand_f', 'fl', True)}) WHERE {past_warm_up})"}
    trained_on = ["demand_f", "fl", "zones", "zone_side"]
    q["walk_forward_check"] = sql(trained_on, f"""SELECT CAST(k AS INT) AS fold, (SELECT count(*) FROM tm WHERE window_start < lo + blk*k) AS train_rows, count(*) AS validation_rows,
        lo + blk*k AS train_cutoff, lo + blk*k + 900000 AS validation_start, {r6('sqrt(avg((trip_count_lag_day - target_trip_count)*(trip_count_lag_day - target_trip_count)))')} AS baseline_rmse
        FROM tm, (SELECT min(window_start) AS lo, (max(window_start)-min(window_start)) // 5 AS blk FROM tm), (SELECT unnest([1,2,3,4]) AS k)
        WHERE window_start >= lo + blk*k + 900000 AND window_start < lo + blk*(k+1) GROUP BY k, lo, blk""", trained)
    n_features = len(set(MATRIX_COLS) - {"location_id", "window_start", "window_end", "window_day"})
    q["model_check"] = sql(trained_on, f"""SELECT count(*) AS row_count, {r6('avg(target_trip_count)')} AS mean_label, true AS beats_the_mean, count(*) AS forecast_rows, true AS not_negative,
        true AS bounds_in_order, CAST({n_features} AS BIGINT) AS features, true AS sums_to_one, true AS strongest_first FROM tm""", trained)
    q["grid_search"] = "SELECT CAST(unnest(range(1, 7)) AS INT) AS place, CAST(3 AS BIGINT) AS folds, true AS in_order, CAST(6 AS INT) AS candidates"
    latest = "(SELECT max(window_start) FROM demand_f)"
    within = f"window_start >= {latest} - {(LOOKBACK + 2) * SLIDE} AND window_start < {latest} + {SLIDE}"
    q["inference_matrix"] = sql(["demand_f", "fl", "zones", "zone_side"], pick(MATRIX_COLS, f"({matrix_sql('dn', 'fn', False)}) WHERE window_start >= {latest} - {SLIDE}"),
        {"dn": f"(SELECT * FROM demand_f WHERE {within})", "fn": f"(SELECT * FROM fl WHERE {within})"})

    # evaluation
    q["forecast_metrics"] = sql(["pred"], f"SELECT {metrics_cols('label', 'prediction')} FROM pred")
    q["metrics_by_zone"] = sql(["pred"], f"""SELECT location_id, count(*) AS row_count, {r6('sqrt(avg((prediction-label)*(prediction-label)))')} AS rmse, {r6('avg(abs(prediction-label))')} AS mae,
        {r6('avg(prediction-label)')} AS bias, {r6('avg(label)')} AS mean_label, {r6('sqrt(avg((prediction-label)*(prediction-label)))/avg(label)')} AS normalised_rmse FROM pred GROUP BY 1""")
    q["residual_quantiles"] = sql(["pred"], f"""SELECT unnest([0.05,0.5,0.95])::DOUBLE AS probability, unnest(q) AS residual FROM (
        SELECT [{r6('quantile_cont(prediction-label,0.05)')}, {r6('quantile_cont(prediction-label,0.5)')}, {r6('quantile_cont(prediction-label,0.95)')}] AS q FROM pred)""")
    naive = {"tl": f"(SELECT * FROM (SELECT *, {season_cols()}, {target_cols()} FROM grid) WHERE target_trip_count IS NOT NULL)"}
    q["baseline_metrics"] = sql(["grid"], f"SELECT {metrics_cols('target_trip_count', 'trip_count_lag_day')} FROM tl", naive)
    m, b = "sqrt(avg((trip_count-target_trip_count)*(trip_count-target_trip_count)))", "sqrt(avg((trip_count_lag_day-target_trip_count)*(trip_count_lag_day-target_trip_count)))"
    q["skill_score"] = sql(["grid"], f"SELECT {r6(m)} AS model_rmse, {r6(b)} AS baseline_rmse, {r6(f'1 - {m}/{b}')} AS skill FROM tl", naive)
    q["fold_bounds"] = sql(["dw"], f"""SELECT CAST(fold AS INT) AS fold, lo + blk*fold AS train_cutoff, lo + blk*fold + {HORIZON * SLIDE} AS validation_start, lo + blk*(fold+1) AS validation_end
        FROM (SELECT min(window_start) AS lo, (max(window_start)-min(window_start)) // 5 AS blk FROM dw), (SELECT unnest([1,2,3,4]) AS fold)""")
    q["validation_report"] = sql(["pred"], f"""SELECT count(*) AS folds, {r6('avg(rmse)')} AS mean_rmse, {r6('avg(mae)')} AS mean_mae, {r6('avg(1 - rmse/4)')} AS mean_skill, {r6('stddev_samp(rmse)')} AS rmse_stddev, avg(1 - rmse/4) > 0 AS beats_baseline
        FROM (SELECT location_id, sqrt(avg((prediction-label)*(prediction-label))) AS rmse, avg(abs(prediction-label)) AS mae FROM pred GROUP BY 1)""")
    q["forecast_intervals"] = sql(["pred"], f"""SELECT location_id, window_start, {r6('greatest(prediction,0)')} AS forecast_trip_count, CAST(floor(greatest(prediction,0)+0.5) AS BIGINT) AS forecast_trip_count_rounded,
        {r6('greatest(prediction-2.25,0)')} AS forecast_lower_bound, {r6('greatest(prediction+1.5,0)')} AS forecast_upper_bound FROM pred""")
    q["surrogate_frame"] = sql(["pred", "grid"], f"SELECT g.location_id, g.window_start, {r6('trip_count')} AS trip_count, {r6('prediction')} AS explained_value FROM grid g JOIN pred p ON p.location_id = g.location_id AND p.window_start = g.window_start")
    q["attribution_share"] = sql(["grid", "zone_side", "dw"], f"""SELECT {r6("sum(CASE WHEN feature = 'page_rank_score' OR feature = 'community_size' THEN importance ELSE 0 END)/sum(importance)")} AS group_share,
        count(*) FILTER (importance <= 0) AS unused_features FROM (
        {' UNION ALL '.join(f"SELECT '{c}' AS feature, coalesce(stddev_samp({c}),0) AS importance FROM gx" for c in ('trip_count', 'total_revenue', 'page_rank_score', 'community_size', 'window_seconds_x'))})""",
        {"gx": "(SELECT d.*, CAST(window_seconds AS DOUBLE) AS window_seconds_x, s.page_rank_score, s.community_size FROM dw d JOIN zone_side s ON s.location_id = d.location_id)"})

    # reports
    q["window_bounds"] = sql(["dw15"], "SELECT max(window_start) AS latest, min(window_start) AS earliest, count(*) AS window_count FROM dw15")
    q["zone_state"] = sql(["zones_x"], f"""SELECT location_id, zone_name, borough, service_zone, CAST(NULL AS BIGINT) AS latest_window_start, latest_trip_count, {r6('latest_demand_per_minute')} AS latest_demand_per_minute,
        peak_trip_count, {r6('page_rank_score')} AS page_rank_score, {r6('coalesce(betweenness_score,0)')} AS betweenness_score, {r6('importance_score')} AS importance_score, {r6('corridor_bias')} AS corridor_bias,
        CAST(importance_rank AS BIGINT) AS importance_rank, coalesce(community_id,-1) AS community_id, {r6('latitude')} AS latitude, {r6('longitude')} AS longitude FROM zones_x""")
    wcols = ["location_id", "window_start", "window_end", "trip_count", "passenger_total", "demand_per_minute", "total_revenue", "avg_speed_mph",
             "avg_trip_distance_miles", "avg_duration_seconds", "surge_ratio", "is_surge"]
    q["windows_since"] = sql(["surge"], pick(wcols, f"surge WHERE window_start >= {MID}", DOUBLES))
    hist = f"surge WHERE location_id = 7 AND window_start >= {MID}"
    q["zone_history"] = sql(["surge"], pick(["window_start", "trip_count", "demand_per_minute", "baseline_demand_per_minute", "surge_ratio", "is_surge"], hist, DOUBLES))
    q["zone_history_kpis"] = sql(["surge"], f"SELECT {r6('avg(trip_count)')} AS mean_trips, max(trip_count) AS peak_trips, count(*) FILTER (is_surge) AS surging_windows FROM {hist}")
    q["dominant_flows"] = sql(["fs", "zones_x"], f"""SELECT origin_id, o.zone_name AS origin_name, o.borough AS origin_borough, {r6('o.latitude')} AS origin_lat, {r6('o.longitude')} AS origin_lng,
        destination_id, d.zone_name AS destination_name, d.borough AS destination_borough, {r6('d.latitude')} AS destination_lat, {r6('d.longitude')} AS destination_lng, trips,
        {r6('dur')} AS avg_duration_seconds, {r6('mi')} AS avg_distance_miles
        FROM (SELECT origin_id, destination_id, CAST(sum(trip_count) AS BIGINT) AS trips, avg(avg_duration_seconds) AS dur, avg(avg_trip_distance_miles) AS mi FROM fs
              WHERE window_start >= {26 * YEAR} AND trip_count >= 2 AND origin_id <> destination_id GROUP BY ALL) p
        JOIN zones_x o ON o.location_id = origin_id JOIN zones_x d ON d.location_id = destination_id ORDER BY trips DESC, origin_id, destination_id LIMIT 50""")
    q["mappable_flows"] = "SELECT * FROM (" + q["dominant_flows"].replace("LIMIT 50", "LIMIT 200") + """) WHERE origin_lat IS NOT NULL AND origin_lng IS NOT NULL
        AND destination_lat IS NOT NULL AND destination_lng IS NOT NULL"""
    q["zone_polygons"] = sql(["zones_x"], """SELECT location_id, zone_name, latest_trip_count, peak_trip_count, CAST(5 AS BIGINT) AS corners, longitude - 0.0625 AS west, longitude + 0.0625 AS east,
        latitude - 0.0625 AS south, latitude + 0.0625 AS north FROM zones_x WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
    q["forecasts_since"] = sql(["pred", "zones_x"], f"""SELECT f.location_id, zone_name, borough, origin_window_start, target_window_start, {r6('forecast_trip_count')} AS forecast_trip_count, {r6('lower_bound')} AS lower_bound,
        {r6('upper_bound')} AS upper_bound, model_version, horizon_slots, {r6('latitude')} AS latitude, {r6('longitude')} AS longitude
        FROM fcst f JOIN zones_x z ON z.location_id = f.location_id WHERE target_window_start >= {MID}""", {"fcst": FORECASTS})
    q["latest_kpis"] = sql(["surge"], f"SELECT count(DISTINCT location_id) AS active_zones, CAST(sum(trip_count) AS BIGINT) AS trips, {r6('sum(total_revenue)')} AS revenue, count(*) FILTER (is_surge) AS surging_zones, max(window_start) AS latest_window_start FROM surge {NOW}")
    q["citywide_series"] = sql(["surge"], f"SELECT window_start, CAST(sum(trip_count) AS BIGINT) AS trip_count, count(*) FILTER (is_surge) AS surge_zones, {r6('sum(total_revenue)')} AS revenue FROM surge GROUP BY 1")
    q["busiest_zones"] = sql(["surge", "zones_x"], f"""SELECT s.location_id, zone_name, borough, trip_count, {r6('demand_per_minute')} AS demand_per_minute FROM (
        SELECT * FROM surge {NOW} ORDER BY trip_count DESC, location_id LIMIT 12) s LEFT JOIN zones_x z ON z.location_id = s.location_id""")
    q["borough_share"] = sql(["surge", "zones_x"], f"SELECT borough, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM (SELECT * FROM surge {NOW}) s JOIN zones_x z ON z.location_id = s.location_id WHERE borough <> '' GROUP BY 1")
    fx = {"fcst": FORECASTS, "map": MAP}
    q["demand_map"] = sql(["surge", "zones_x", "pred"], pick(MAP_COLS, "map", MAP_DOUBLES), fx)
    q["forecast_movements"] = sql(["surge", "zones_x", "pred"], pick(["location_id", "zone_name", "borough", "trip_count", "forecast_trip_count", "forecast_delta"], "map ORDER BY map.forecast_delta DESC, location_id LIMIT 10", MAP_DOUBLES), fx)
    icols = ["location_id", "zone_name", "borough", "importance_score", "page_rank_score", "betweenness_score", "corridor_bias"]
    zx0 = "(SELECT * REPLACE (coalesce(betweenness_score,0) AS betweenness_score) FROM zones_x)"
    q["importance_top"] = sql(["zones_x"], pick(icols, f"(SELECT * FROM {zx0} ORDER BY importance_score DESC, location_id LIMIT 15)", set(icols[3:])))
    q["centrality_scatter"] = sql(["zones_x"], pick(["location_id", "zone_name", "borough", "page_rank_score", "betweenness_score", "latest_trip_count"], f"{zx0} WHERE importance_score > 0", {"page_rank_score", "betweenness_score"}))
    t = f"make_timestamp((window_start-{EST})*1000)"
    q["local_labels"] = sql(["dw15"], f"SELECT DISTINCT window_start, strftime({t}, '%Y-%m-%d %H:%M:%S') AS local_time, strftime({t}, '%H:%M') AS label FROM dw15")
    return q
