"""The registered queries as plain SQL over the same tables (DuckDB dialect)."""

from __future__ import annotations

from fleetlens.functions.geo import EARTH_RADIUS_M, GRID_DEGREES
from fleetlens.functions.timing import LATENESS, millis
from fleetlens.plans import catalog as c
from fleetlens.plans import tables
from fleetlens.schemas import LOCATION_TOPIC, REQUEST_TOPIC

_HOT, _SIZE, _SLIDE = (millis(x) for x in (c.HOT_WINDOW, c.SURGE_SIZE, c.SURGE_SLIDE))
_GAP, _GHOST, _TTL = (millis(x) for x in (c.IDLE_GAP, c.GHOST_GAP, c.ZONE_TTL))
_BEFORE, _AFTER, _SKEW = (millis(x) for x in (c.MATCH_BEFORE, c.MATCH_AFTER, c.SKEW))
_LATE = millis(LATENESS)

# Event times are cut to milliseconds; DuckDB's own epoch_ms would round them.
_WITH = r"""
WITH base AS (
  SELECT event_id AS n, user_id, event_type, epoch_us(ts) // 1000 AS t,
         CAST(regexp_extract(props, '"k": (\d+)', 1) AS BIGINT) AS k,
         CAST(event_id AS VARCHAR) AS event_id,
         37.7e0 + (event_id * 7919 % 1200) / 10000e0 AS lat,
         -122.52e0 + (event_id * 104729 % 1500) / 10000e0 AS lon
  FROM events),
pings AS (
  SELECT *, printf('drv-%04d', user_id) AS driver_id, printf('c%02d', k % 16) AS h3_cell
  FROM base),
requests AS (
  SELECT *, event_id AS ride_id, printf('rdr-%05d', user_id) AS rider_id
  FROM pings WHERE event_type = 'purchase'),
drivers AS (
  SELECT printf('drv-%04d', c_custkey * 2) AS driver_id, c_name AS name,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'economy' WHEN 'BUILDING' THEN 'economy'
              WHEN 'FURNITURE' THEN 'comfort' WHEN 'HOUSEHOLD' THEN 'premium'
              WHEN 'MACHINERY' THEN 'comfort' END AS vehicle_type,
         printf('%.2f', (c_custkey % 401 + 100) / 100e0) AS rating,
         c_acctbal > 0 AS active
  FROM customer),
driver_log AS (
  SELECT printf('drv-%04d', o_custkey) AS driver_id, o_orderpriority AS name,
         printf('%.2f', (o_orderkey % 401 + 100) / 100e0) AS rating,
         o_totalprice > 200000 AS active,
         CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' WHEN 'F' THEN 'd' END AS op,
         epoch_us(o_orderdate) // 1000 AS ts_ms, o_orderkey AS seq
  FROM orders),
driver_state AS (
  SELECT * EXCLUDE (op, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY ts_ms DESC, seq DESC) AS rn
    FROM driver_log) WHERE rn = 1 AND op <> 'd'),
"""


def _with(*ctes: str) -> str:
    return _WITH + ",\n".join(ctes) + "\n" if ctes else _WITH.rstrip().rstrip(",") + "\n"


_ZONES = f"""hot AS (
  SELECT h3_cell, (t // {_HOT} + 1) * {_HOT} AS window_end_ms,
         count(DISTINCT driver_id) AS driver_count
  FROM pings GROUP BY ALL)"""
_SURGE = f"""surge AS (
  SELECT h3_cell, (t // {_SLIDE} + 1 + i) * {_SLIDE} AS window_end_ms,
         count(*) AS request_count
  FROM requests, range(0, {_SIZE // _SLIDE}) AS hop(i) GROUP BY ALL)"""
_SESSIONS = f"""marked AS (
  SELECT *, CASE WHEN t - lag(t) OVER w <= {_GAP} THEN 0 ELSE 1 END AS opens
  FROM pings WINDOW w AS (PARTITION BY driver_id ORDER BY t)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY driver_id ORDER BY t) AS session FROM marked),
sessions AS (
  SELECT driver_id, max(t) + {_GAP} AS session_end_ms, count(*) AS ping_count,
         max(h3_cell) AS last_h3_cell, arg_max(h3_cell, t) AS exact_cell
  FROM numbered GROUP BY driver_id, session)"""
_MATCHES = f"""matches AS (
  SELECT r.ride_id, p.driver_id, p.t AS match_time_ms, r.h3_cell
  FROM requests r JOIN pings p ON r.h3_cell = p.h3_cell
   AND p.t BETWEEN r.t - {_BEFORE} AND r.t + {_AFTER}),
candidates AS (
  SELECT ride_id, driver_id, arg_max(h3_cell, (match_time_ms, h3_cell)) AS h3_cell,
         max(match_time_ms) AS match_time_ms
  FROM matches GROUP BY ride_id, driver_id)"""
# A rider's requests as retries of one ride.
_RETRIED = _MATCHES.replace("r.ride_id, p.driver_id", "r.rider_id AS ride_id, p.driver_id")


def _enriched(source: str, vehicle: str = "d.vehicle_type") -> str:
    return f"""enriched AS (
  SELECT r.ride_id, r.rider_id, r.h3_cell AS pickup_h3, r.t AS request_ms,
         'drv-' || substr(r.rider_id, 5, 4) AS driver_id, d.name,
         {vehicle} AS vehicle_type, d.rating, d.active, d.driver_id IS NOT NULL AS enriched
  FROM requests r LEFT JOIN {source} d ON d.driver_id = 'drv-' || substr(r.rider_id, 5, 4))"""


def _distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"""{2 * EARTH_RADIUS_M} * asin(least(1e0, sqrt(
      pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))
      * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""


def _anomaly_id(kind: str, at: str) -> str:
    digest = f"md5('{kind}|' || driver_id || '|' || {at})"
    parts = " || '-' || ".join(
        f"substr({digest}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    )
    return parts


_ANOMALIES = f"""track AS (
  SELECT driver_id, t, lat, lon, lag(t) OVER w AS pt, lag(lat) OVER w AS plat,
         lag(lon) OVER w AS plon, lead(t) OVER w AS nt
  FROM pings WINDOW w AS (PARTITION BY driver_id ORDER BY t, event_id)),
moved AS (
  SELECT *, CASE WHEN t > pt THEN {_distance("plat", "plon", "lat", "lon")}
                 / ((t - pt) / 1000e0) END AS speed FROM track),
speeding AS (
  SELECT {_anomaly_id("speed_violation", "t")} AS anomaly_id,
         'speed_violation' AS anomaly_type, driver_id,
         CASE WHEN speed > {2 * c.SPEED_MPS} THEN 'critical' ELSE 'high' END AS severity,
         t AS detected_at_ms, speed AS observed_speed_mps, plat AS prev_lat,
         plon AS prev_lon, lat AS curr_lat, lon AS curr_lon, t - pt AS gap_ms
  FROM moved WHERE speed > {c.SPEED_MPS}),
ghosts AS (
  SELECT {_anomaly_id("ghost_driver", f"(t + {_GHOST})")} AS anomaly_id,
         'ghost_driver' AS anomaly_type, driver_id, 'medium' AS severity,
         t + {_GHOST} AS detected_at_ms, 0e0 AS observed_speed_mps, lat AS prev_lat,
         lon AS prev_lon, lat AS curr_lat, lon AS curr_lon, CAST({_GHOST} AS BIGINT) AS gap_ms
  FROM moved WHERE nt IS NULL OR nt > t + {_GHOST}),
found AS (SELECT * FROM speeding UNION ALL SELECT * FROM ghosts)"""
_ROUNDED = "SELECT * REPLACE (round(observed_speed_mps, 3) AS observed_speed_mps) FROM"
_TEXTS = """printf('%.3f', observed_speed_mps) AS observed_speed_mps,
  printf('%.6f', prev_lat) AS prev_lat, printf('%.6f', prev_lon) AS prev_lon,
  printf('%.6f', curr_lat) AS curr_lat, printf('%.6f', curr_lon) AS curr_lon,
  CAST(gap_ms AS VARCHAR) AS gap_ms"""
_GRID = (
    f"'g' || CAST(CAST(floor(lat / {GRID_DEGREES}e0) AS BIGINT) AS VARCHAR) || '_' || "
    f"CAST(CAST(floor(lon / {GRID_DEGREES}e0) AS BIGINT) AS VARCHAR)"
)


def _letters(topic: str, checks: str, stage: str) -> str:
    return _with() + f"""SELECT '{topic}' AS original_topic, event_id AS original_key,
  {checks} AS failure_reason, {stage} AS failure_stage,
  CAST({c.NOW_MS} AS BIGINT) AS failed_at_ms FROM pings WHERE """


_PING_FAULTS = """CASE k % 10 WHEN 3 THEN 'lat: missing' WHEN 4 THEN 'lat: out of range'
  WHEN 5 THEN 'driver_id: empty' WHEN 7 THEN 'lon: out of range' END"""
_REQUEST_FAULTS = """CASE k % 10 WHEN 1 THEN 'product_tier: unknown' WHEN 3 THEN 'ride_id: empty'
  WHEN 4 THEN 'rider_id: missing' WHEN 5 THEN 'pickup.lat: out of range'
  WHEN 7 THEN 'dropoff.lat: missing; dropoff.lon: missing'
  WHEN 8 THEN 'value: not a JSON object' END"""
_MISTYPED_PINGS = """CASE k % 10 WHEN 0 THEN 'driver_id: not text' WHEN 1 THEN 'driver_id: not text'
  WHEN 2 THEN 'h3_cell: not text' WHEN 3 THEN 'value: not a JSON object'
  WHEN 4 THEN 'value: not a JSON object' WHEN 5 THEN 'value: not a JSON object'
  WHEN 7 THEN 'speed_mps: not a number' END"""
_MISTYPED_REQUESTS = """CASE k % 10 WHEN 0 THEN 'ride_id: not text' WHEN 1 THEN 'rider_id: not text'
  WHEN 2 THEN 'pickup.h3_cell: not text; dropoff.h3_cell: not text' WHEN 3 THEN 'value: not a JSON object'
  WHEN 4 THEN 'product_tier: unknown' WHEN 5 THEN 'product_tier: unknown' END"""
_MISTYPED_STAGE = "CASE WHEN k % 10 IN (3, 4, 5) THEN 'deserialize' ELSE 'validate' END"
_MISTYPED_REQUEST_STAGE = "CASE WHEN k % 10 = 3 THEN 'deserialize' ELSE 'validate' END"
_CLOSED = f"(SELECT max(t) FROM pings) - {_LATE}"
_CLOSED_ANOMALIES = (
    _with(_ANOMALIES)
    + f"""{_ROUNDED} found
WHERE anomaly_type = 'speed_violation' OR detected_at_ms <= {_CLOSED}"""
)
# The pings, every third of them given to one driver in one hour.
_BUSY = f"""busy AS (
  SELECT * REPLACE (
    CASE WHEN n % 3 = 0 THEN '{tables.BUSY_DRIVER}' ELSE driver_id END AS driver_id,
    CASE WHEN n % 3 = 0 THEN {tables.BUSY_FROM_MS} + n * 7919 % {tables.BUSY_SPAN_MS} ELSE t END AS t)
  FROM pings)"""
_BUSY_ANOMALIES = _with(_BUSY, _ANOMALIES.replace("FROM pings WINDOW", "FROM busy WINDOW"))
_SLICE = millis(c.SLICE)
# An anomaly is reported once the slice of its time is closed.
_SLICED_ANOMALIES = (
    _BUSY_ANOMALIES
    + f"""{_ROUNDED} found
WHERE (detected_at_ms // {_SLICE} + 1) * {_SLICE}
      <= (SELECT max(t) FROM busy) - {millis(c.BATCH_LATENESS)}"""
)
_CLOSED_REQUESTS = f"(SELECT max(t) FROM requests) - {_LATE}"
_CANDIDATES = _with(_MATCHES) + "SELECT * FROM candidates"
_STATE = _with() + "SELECT * FROM driver_state"
_ENRICHED_ROWS = _with(_enriched("drivers")) + "SELECT * FROM enriched"

_CHANGED_ROWS = (
    _with(_enriched("driver_state", "CASE WHEN d.driver_id IS NOT NULL THEN 'economy' END"))
    + "SELECT * FROM enriched"
)

_PANE, _WIDE, _HORIZON = (millis(x) for x in (c.PANE, c.WIDE_WINDOW, c.HORIZON))
_BATCHES_CLOSED = f"(SELECT max(t) FROM pings) - {millis(c.BATCH_LATENESS)}"
# Driver changes with what is wrong with their value in the topic.
_LOG = """topic AS (
  SELECT *, CASE WHEN seq % 23 = 0 THEN 'value: not a JSON object'
    WHEN seq % 23 = 2 THEN 'value: a field of another type'
    WHEN seq % 23 = 1 OR (op IS NULL AND seq % 23 <> 3) THEN '__op: missing'
    WHEN seq % 23 = 3 THEN '__op: unknown' WHEN seq % 23 = 4 THEN 'driver_id: missing' END AS reason
  FROM driver_log)"""
_LOG_STATE = _with(_LOG) + f"""SELECT driver_id, name, rating, active, ts_ms,
  CAST(CAST(substr(driver_id, 5) AS BIGINT) % {tables.LOG_PARTITIONS} AS INTEGER) AS log_partition, 2 * seq AS seq
FROM (SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY seq DESC) AS rn FROM topic
      WHERE reason IS NULL) WHERE rn = 1 AND op <> 'd'"""
_BODY = """'{"event_id":"' || event_id || '","driver_id":"' || driver_id || '"}'"""
_FRAMES = f"""frames AS (
  SELECT *, hex({_BODY}) AS body, printf('00%08X', {tables.FRAME_ID}) || hex({_BODY}) AS good FROM pings)"""


def _fault(kind: str, gap: str, kept: str) -> str:
    digest = _anomaly_id(kind, "t").replace("driver_id", "event_id")
    return f"""SELECT {digest} AS anomaly_id, '{kind}' AS anomaly_type, driver_id, 'low' AS severity,
  t AS detected_at_ms, 0e0 AS observed_speed_mps, lat AS prev_lat, lon AS prev_lon, lat AS curr_lat,
  lon AS curr_lon, CAST({gap} AS BIGINT) AS gap_ms FROM pings WHERE {kept}"""


_WORST = f"((n * 37 % 240 - 120) * 1000 + CASE WHEN n % 5 = 0 THEN {tables.RESENT_MS} ELSE 0 END)"
_FAULTS = _with(
    "faults AS (" + _fault("dup_event", str(tables.RESENT_MS), "n % 5 = 0")
    + " UNION ALL " + _fault("clock_skew", _WORST, f"abs({_WORST}) > {_SKEW}") + ")"
) + "SELECT * FROM faults"

ORACLE: dict[str, str] = {
    "pings": _with() + "SELECT event_id, driver_id, lat, lon, h3_cell, t AS event_ms FROM pings",
    "ride_requests": _with()
    + "SELECT ride_id, rider_id, h3_cell, t AS event_ms FROM requests",
    "driver_changes": _with() + "SELECT * FROM driver_log",
    "driver_table": _with() + "SELECT * FROM drivers",
    "framed_values": _with()
    + """SELECT event_id, CAST(length(driver_id) + 5 AS BIGINT) AS framed_length,
  CAST(258 AS BIGINT) AS schema_id, driver_id AS body FROM pings""",
    "centre_distance": _with()
    + f"""SELECT event_id, round({_distance("lat", "lon", f"{c.CENTRE[0]}e0", f"{c.CENTRE[1]}e0")}, 3)
  AS metres FROM pings""",
    "grid_cells": _with()
    + f"SELECT event_id, CASE WHEN n % 3 <> 0 THEN h3_cell ELSE {_GRID} END AS h3_cell FROM pings",
    "valid_pings": _with()
    + f"""SELECT event_id, 'DriverLocationPinged' AS event_type,
  CASE WHEN k % 10 = 9 THEN {c.NOW_MS} ELSE t END AS occurred_ms,
  CAST({c.NOW_MS} AS BIGINT) AS ingested_ms, driver_id, lat,
  CASE WHEN k % 10 = 6 THEN -180e0 ELSE lon END AS lon,
  CASE WHEN k % 10 = 8 THEN {_GRID} ELSE h3_cell END AS h3_cell
FROM pings WHERE {_PING_FAULTS} IS NULL""",
    "ping_dead_letters": _letters(LOCATION_TOPIC, _PING_FAULTS, "'validate'")
    + f"{_PING_FAULTS} IS NOT NULL",
    "mistyped_ping_letters": _letters(LOCATION_TOPIC, _MISTYPED_PINGS, _MISTYPED_STAGE)
    + f"{_MISTYPED_PINGS} IS NOT NULL",
    "mistyped_request_letters": _letters(REQUEST_TOPIC, _MISTYPED_REQUESTS, _MISTYPED_REQUEST_STAGE)
    + f"{_MISTYPED_REQUESTS} IS NOT NULL",
    "valid_requests": _with()
    + f"""SELECT event_id, t AS occurred_ms, event_id AS ride_id,
  printf('rdr-%05d', user_id) AS rider_id,
  CASE WHEN k % 10 = 6 THEN -90e0 ELSE lat END AS pickup_lat, h3_cell AS pickup_cell,
  lon AS dropoff_lon, CASE WHEN k % 10 = 2 THEN 'premium' ELSE 'economy' END AS product_tier,
  CAST({c.NOW_MS} AS BIGINT) AS requested_ms
FROM pings WHERE {_REQUEST_FAULTS} IS NULL""",
    "request_dead_letters": _letters(
        REQUEST_TOPIC,
        _REQUEST_FAULTS,
        "CASE WHEN k % 10 = 8 THEN 'deserialize' ELSE 'validate' END",
    )
    + f"{_REQUEST_FAULTS} IS NOT NULL",
    "hot_zones": _with(_ZONES) + "SELECT * FROM hot",
    "surge_zones": _with(_SURGE) + "SELECT * FROM surge",
    "idle_sessions": _with(_SESSIONS) + "SELECT * EXCLUDE (exact_cell) FROM sessions",
    "idle_sessions_exact_last": _with(_SESSIONS)
    + "SELECT * EXCLUDE (exact_cell) REPLACE (exact_cell AS last_h3_cell) FROM sessions",
    "ride_matches": _with(_MATCHES) + "SELECT * FROM matches",
    "match_candidates": _CANDIDATES,
    "match_candidates_from_matches": _CANDIDATES,
    "repeated_ride_candidates": _with(_RETRIED)
    + "SELECT ride_id, driver_id, h3_cell, match_time_ms FROM candidates",
    "repeated_ride_last_match": _with(_RETRIED)
    + """SELECT ride_id, arg_max(h3_cell, (match_time_ms, h3_cell)) AS h3_cell,
         max(match_time_ms) AS last_match_ms FROM candidates GROUP BY ride_id""",
    "last_match": _with(_MATCHES)
    + """SELECT ride_id, h3_cell, max(match_time_ms) AS last_match_ms
FROM candidates GROUP BY ALL""",
    "driver_state": _STATE,
    "ride_state": """SELECT * EXCLUDE (op, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY ts_ms DESC, seq DESC) AS rn FROM (
    SELECT printf('ride-%04d', l_orderkey) AS ride_id, printf('rdr-%05d', l_suppkey) AS rider_id,
           printf('drv-%04d', l_partkey) AS driver_id,
           CASE WHEN l_linestatus = 'O' THEN 'matched' ELSE 'completed' END AS state,
           printf('%.2f', l_extendedprice) AS fare,
           CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'u' END AS op,
           epoch_us(l_shipdate) // 1000 AS ts_ms, l_linenumber * 100000000::BIGINT + l_partkey AS seq
    FROM lineitem)) WHERE rn = 1 AND op <> 'd'""",
    "enriched_rides": _ENRICHED_ROWS,
    "enriched_rides_from_changes": _CHANGED_ROWS,
    "enriched_fields": _with(_enriched("drivers"))
    + """SELECT ride_id, field, text FROM (
  SELECT ride_id, rider_id, pickup_h3, CAST(request_ms AS VARCHAR) AS request_ms, driver_id,
         name AS driver_name, vehicle_type, rating, CAST(active AS VARCHAR) AS active,
         CAST(enriched AS VARCHAR) AS enriched FROM enriched)
UNPIVOT (text FOR field IN (rider_id, pickup_h3, request_ms, driver_id, driver_name,
  vehicle_type, rating, active, enriched)) WHERE text <> ''""",
    "speed_violations": _with(_ANOMALIES) + f"{_ROUNDED} speeding",
    "ghost_drivers": _with(_ANOMALIES) + "SELECT * FROM ghosts",
    "anomalies": _with(_ANOMALIES) + f"{_ROUNDED} found",
    "busy_anomalies": _BUSY_ANOMALIES + f"{_ROUNDED} found",
    "anomaly_records": _with(_ANOMALIES)
    + f"""SELECT anomaly_id AS event_id, 'AnomalyDetected' AS event_type,
  detected_at_ms AS occurred_ms, anomaly_type, 'driver' AS entity_type,
  driver_id AS entity_id, severity, driver_id AS topic_key, {_TEXTS} FROM found""",
    "latest_hot_window": _with(_ZONES)
    + "SELECT * FROM hot WHERE window_end_ms = (SELECT max(window_end_ms) FROM hot)",
    "top_hot_zones": _with(_ZONES)
    + """SELECT * FROM hot WHERE window_end_ms = (SELECT max(window_end_ms) FROM hot)
ORDER BY driver_count DESC, h3_cell DESC LIMIT 10""",
    "top_surge_zones": _with(_SURGE)
    + """SELECT * FROM surge WHERE window_end_ms = (SELECT max(window_end_ms) FROM surge)
ORDER BY request_count DESC, h3_cell DESC LIMIT 10""",
    "recently_idle_drivers": _with(_SESSIONS)
    + """SELECT * EXCLUDE (exact_cell, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY session_end_ms DESC) AS rn
  FROM sessions) WHERE rn = 1 ORDER BY session_end_ms DESC, driver_id DESC LIMIT 10""",
    "recent_matches": _with(_MATCHES)
    + """SELECT ride_id, driver_id, match_time_ms FROM candidates
ORDER BY match_time_ms DESC, ride_id || ':' || driver_id DESC LIMIT 10""",
    "matches_for_last_ride": _with(_MATCHES)
    + """SELECT ride_id, h3_cell, driver_id, match_time_ms FROM candidates
WHERE ride_id = (SELECT max(ride_id) FROM requests)
ORDER BY match_time_ms DESC, driver_id DESC LIMIT 10""",
    "recent_anomalies": _with(_ANOMALIES)
    + f"""SELECT anomaly_id, detected_at_ms, anomaly_type, driver_id, severity, {_TEXTS}
FROM found ORDER BY detected_at_ms DESC, anomaly_id DESC LIMIT 20""",
    "last_enriched_ride": _ENRICHED_ROWS
    + " WHERE ride_id = (SELECT max(ride_id) FROM requests)",
    "retained_hot_zones": _with(_ZONES)
    + f"""SELECT *, window_end_ms AS written_at_ms FROM hot
WHERE window_end_ms > (SELECT max(window_end_ms) FROM hot) - {_TTL}""",
    "first_requests": _with()
    + """SELECT CAST(n // 3 AS VARCHAR) AS ride_id, arg_min(event_id, t) AS event_id,
  min(t) AS event_ms FROM requests GROUP BY n // 3""",
    "ride_lifecycle": _with()
    + """SELECT printf('ride-%04d', user_id) AS ride_id,
  arg_max(CASE event_type WHEN 'view' THEN 'requested' WHEN 'click' THEN 'matched'
    WHEN 'signup' THEN 'started' WHEN 'purchase' THEN 'completed'
    WHEN 'error' THEN 'cancelled' END, t) AS state,
  max(t) AS changed_at_ms, count(*) AS transitions FROM base GROUP BY user_id""",
    "duplicate_events": _with()
    + """SELECT driver_id || '-' || strftime(make_timestamp(t * 1000), '%Y%m%d%H') AS event_id,
  count(*) AS copies FROM pings GROUP BY 1 HAVING count(*) > 1""",
    "clock_skew": _with()
    + f"""SELECT event_id, (n * 37 % 240 - 120) * 1000 AS skew_ms FROM base
WHERE abs((n * 37 % 240 - 120) * 1000) > {_SKEW}""",
    # Streams emit what the final watermark (last event time less the lateness) has closed.
    "hot_zones_stream": _with(_ZONES) + f"SELECT * FROM hot WHERE window_end_ms <= {_CLOSED}",
    "surge_zones_stream": _with(_SURGE)
    + f"SELECT * FROM surge WHERE window_end_ms <= {_CLOSED_REQUESTS}",
    "idle_drivers_stream": _with(_SESSIONS)
    + f"""SELECT * EXCLUDE (exact_cell, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY session_end_ms DESC) AS rn
  FROM sessions WHERE session_end_ms <= {_CLOSED}) WHERE rn = 1""",
    "match_candidates_stream": _CANDIDATES,
    "match_candidates_batches_stream": _CANDIDATES,
    "anomalies_stream": _CLOSED_ANOMALIES,
    "anomalies_table_stream": _CLOSED_ANOMALIES,
    "anomalies_sliced_stream": _SLICED_ANOMALIES,
    "enriched_rides_stream": _ENRICHED_ROWS,
    "enriched_rides_latest_stream": _CHANGED_ROWS,
    "enriched_rides_changed_stream": _CHANGED_ROWS,
    "driver_state_stream": _STATE,
    "driver_state_batches_stream": _STATE,
    "driver_state_buckets_stream": _STATE,
    # Pings without a time count as of now; they close every earlier window.
    "ingested_zones_stream": _with()
    + f"""SELECT CASE WHEN k % 10 = 8 THEN {_GRID} ELSE h3_cell END AS h3_cell,
  (t // {_HOT} + 1) * {_HOT} AS window_end_ms, count(DISTINCT driver_id) AS driver_count
FROM pings WHERE {_PING_FAULTS} IS NULL AND k % 10 <> 9 GROUP BY ALL""",
    "framed_events": _with() + "SELECT event_id, driver_id FROM pings WHERE k % 10 > 4",
    "frame_letters": _with(_FRAMES)
    + f"""SELECT CASE k % 10 WHEN 0 THEN body WHEN 1 THEN left(good, 8)
    WHEN 2 THEN printf('00%08X', {tables.FRAME_ID + 1}) || body WHEN 3 THEN left(good, 24) ELSE '' END AS bytes,
  '{LOCATION_TOPIC}' AS original_topic, driver_id AS original_key,
  CASE k % 10 WHEN 2 THEN 'value: unknown schema id {tables.FRAME_ID + 1}' WHEN 3 THEN 'value: not of its schema'
    WHEN 4 THEN 'value: missing' ELSE 'value: not a frame' END AS failure_reason,
  'deserialize' AS failure_stage, CAST({c.NOW_MS} AS BIGINT) AS failed_at_ms FROM frames WHERE k % 10 <= 4""",
    "topic_driver_state": _LOG_STATE,
    "topic_driver_state_stream": _LOG_STATE,
    "topic_change_letters": _with(_LOG)
    + f"""SELECT '{tables.DRIVER_TOPIC}' AS original_topic, driver_id AS original_key, reason AS failure_reason,
  'deserialize' AS failure_stage, CAST({c.NOW_MS} AS BIGINT) AS failed_at_ms FROM topic WHERE reason IS NOT NULL""",
    "topic_ride_state": f"""SELECT * EXCLUDE (op, rn) REPLACE (2 * seq AS seq),
  CAST(CAST(substr(ride_id, 6) AS BIGINT) % {tables.LOG_PARTITIONS} AS INTEGER) AS log_partition FROM (
  SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY seq DESC) AS rn FROM (
    SELECT printf('ride-%04d', l_orderkey) AS ride_id, printf('rdr-%05d', l_suppkey) AS rider_id,
           printf('drv-%04d', l_partkey) AS driver_id,
           CASE WHEN l_linestatus = 'O' THEN 'matched' ELSE 'completed' END AS state,
           printf('%.2f', l_extendedprice) AS fare,
           CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'u' END AS op,
           epoch_us(l_shipdate) // 1000 AS ts_ms,
           epoch_us(l_shipdate) // 86400000000 * 10000000000 + l_linenumber * 100000000::BIGINT + l_partkey AS seq
    FROM lineitem)) WHERE rn = 1 AND op <> 'd'""",
    "hot_zones_from_sketches": _with(_ZONES) + "SELECT * FROM hot",
    "wide_zone_bounds": _with(_ZONES.replace(str(_HOT), str(_WIDE))) + "SELECT *, true AS within FROM hot",
    "zone_sketches_stream": _with()
    + f"""SELECT h3_cell, (t // {_WIDE} + 1) * {_WIDE} AS window_end_ms, count(DISTINCT driver_id) AS driver_count
FROM pings WHERE (t // {_PANE} + 1) * {_PANE} <= {_BATCHES_CLOSED} GROUP BY ALL""",
    "event_faults": _FAULTS,
    "event_faults_stream": f"{_FAULTS} WHERE detected_at_ms + {_HORIZON} <= {_BATCHES_CLOSED}",
    "anomaly_frames_stream": _with(_ANOMALIES)
    + f"""SELECT driver_id AS topic_key, 'envelope,payload' AS fields, anomaly_id AS event_id,
  'AnomalyDetected' AS event_type, anomaly_type, severity FROM found
WHERE anomaly_type = 'speed_violation' OR detected_at_ms <= {_CLOSED}""",
    "ping_frames_stream": _with()
    + f"""SELECT driver_id AS topic_key, 'envelope,payload' AS fields, event_id,
  'DriverLocationPinged' AS event_type, driver_id, CASE WHEN k % 10 = 6 THEN -180e0 ELSE lon END AS lon
FROM pings WHERE {_PING_FAULTS} IS NULL""",
    "request_frames_stream": _with()
    + f"""SELECT printf('rdr-%05d', user_id) AS topic_key, 'envelope,payload' AS fields, event_id,
  'RideRequested' AS event_type, event_id AS ride_id,
  CASE WHEN k % 10 = 2 THEN 'premium' ELSE 'economy' END AS product_tier
FROM pings WHERE {_REQUEST_FAULTS} IS NULL""",
    "expiring_hot_zones_stream": _with(_ZONES, f"closed AS (SELECT * FROM hot WHERE window_end_ms <= {_BATCHES_CLOSED})")
    + f"SELECT * FROM closed WHERE window_end_ms > (SELECT max(window_end_ms) FROM closed) - {_TTL}",
    "expiring_idle_drivers_stream": _with(
        _SESSIONS, f"closed AS (SELECT * FROM sessions WHERE session_end_ms <= {_BATCHES_CLOSED})")
    + f"""SELECT * EXCLUDE (exact_cell, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY session_end_ms DESC) AS rn FROM closed)
WHERE rn = 1 AND session_end_ms > (SELECT max(session_end_ms) FROM closed) - {_TTL}""",
}
