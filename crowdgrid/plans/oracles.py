"""The registered queries as SQL over the same tables, for checking results."""

from __future__ import annotations

from decimal import Decimal

from crowdgrid.plans.queries import (
    CENTERS,
    COARSE,
    DEVICE,
    END,
    POINTS_PER_ROW,
    SPLIT,
    START,
    SUBSTITUTION,
    THRESHOLD,
)


def _double(value: float) -> str:
    """A literal that SQL reads as DOUBLE, not as DECIMAL."""
    return f"({value!r}::DOUBLE)" if "e" in repr(value) else f"{value!r}e0"


PINGS = """pings AS (
  SELECT event_id, ts, user_id,
    '+447' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS device_id,
    epoch_us(ts)::DOUBLE / 1000000.0::DOUBLE AS time_stamp,
    53.55::DOUBLE + ((user_id % 20) - 10) * 0.001::DOUBLE AS lat_visit,
    -2.4333::DOUBLE + ((event_id % 7) - 3) * 0.0017::DOUBLE AS lon_visit
  FROM events)"""

VISITS = f"""{PINGS}, visits AS (
  SELECT sha256(device_id) AS device_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_visit,
    lat_visit, lon_visit, user_id,
    CAST(user_id % 5 AS INTEGER) AS cluster_pred,
    CAST(ts AS DATE) AS visit_date,
    CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour
  FROM pings)"""


# Fixed values of the grid: earth radius in metres, standard parallel in degrees, area of a
# cell at resolution 10 in square metres, bits of an axis.
RADIUS, PARALLEL, AREA = "6371007.2e0", "cos(radians(53.55e0))", "15047.5e0"


def _edge(resolution: int) -> str:
    return f"sqrt(2 * {AREA} * pow(7e0, {10 - resolution}) / (3 * sqrt(3e0)))"


def _cells(resolution: int = 10) -> str:
    return f"""{VISITS}, plane AS (
  SELECT *, {RADIUS} * radians(lon_visit) * {PARALLEL} AS px,
    {RADIUS} * sin(radians(lat_visit)) / {PARALLEL} AS py, {_edge(resolution)} AS edge FROM visits),
axes AS (
  SELECT * EXCLUDE (px, py, edge), (px * sqrt(3e0) / 3 - py / 3) / edge AS qf,
    2 * py / (3 * edge) AS rf FROM plane),
near AS (
  SELECT *, CAST(floor(qf + 0.5e0) AS BIGINT) AS q0, CAST(floor(rf + 0.5e0) AS BIGINT) AS r0,
    CAST(floor(0.5e0 - qf - rf) AS BIGINT) AS s0 FROM axes),
off AS (SELECT *, abs(q0 - qf) AS dq, abs(r0 - rf) AS dr, abs(s0 + qf + rf) AS ds FROM near),
moved AS (
  SELECT *, CASE WHEN dq > dr AND dq > ds THEN -r0 - s0 ELSE q0 END AS q,
    CASE WHEN dq > dr AND dq > ds THEN r0 WHEN dr > ds THEN -q0 - s0 ELSE r0 END AS r FROM off),
placed AS (
  SELECT *, ({resolution}::BIGINT << 56) + ((q + 134217728) << 28) + (r + 134217728) AS cell
  FROM moved)"""


COUNTS = f"""{_cells()}, counts AS (
  SELECT cell, hour, date, count(*) AS pings FROM placed GROUP BY cell, hour, date)"""


def _flags(sigma: str = "2") -> str:
    square = Decimal(sigma) ** 2
    return f"""{COUNTS}, sums AS (
  SELECT cell, hour, count(*) AS n, sum(pings) AS s, sum(pings * pings) AS q,
    avg(pings) AS mean, stddev_samp(pings) AS std FROM counts GROUP BY cell, hour),
report AS (
  SELECT c.cell, c.hour, c.date, c.pings, m.mean, m.std,
    m.n * c.pings > m.s AND
      (m.n * c.pings - m.s) * (m.n * c.pings - m.s) * (m.n - 1)
        > {square} * m.n * (m.n * m.q - m.s * m.s) AS alert,
    c.pings > {THRESHOLD} AS red_wave
  FROM counts c JOIN sums m ON c.cell = m.cell AND c.hour = m.hour)"""


def _center() -> str:
    return f"""round(degrees(asin(1.5e0 * r * {_edge(10)} * {PARALLEL} / {RADIUS})), 6) AS lat,
    round(degrees((q + r * 0.5e0) * sqrt(3e0) * {_edge(10)} / ({RADIUS} * {PARALLEL})), 6) AS lon"""


AXES_OF_CELL = """axes_of AS (
  SELECT *, ((cell >> 28) & 268435455) - 134217728 AS q,
    (cell & 268435455) - 134217728 AS r FROM report)"""

POPUP = """CASE WHEN red_wave
      THEN 'ALERT! Red Wave - ' || pings || ' pings at this location, Date: ' || date
        || ', Hour: ' || hour
      ELSE 'Ping Count: ' || pings || ', Date: ' || date || ', Hour: ' || hour END AS popup"""

ORDERED = f"""{VISITS}, points AS (
  SELECT device_id, date_visit, lat_visit, lon_visit, count(*) AS pings FROM visits
  GROUP BY device_id, date_visit, lat_visit, lon_visit),
ordered AS (
  SELECT *, row_number() OVER w AS pos, lead(date_visit) OVER w AS to_date,
    lead(lat_visit) OVER w AS to_lat, lead(lon_visit) OVER w AS to_lon
  FROM points
  WINDOW w AS (PARTITION BY device_id ORDER BY date_visit, lat_visit, lon_visit))"""

SEGMENTS = f"""WITH {ORDERED}
SELECT device_id, pos, date_visit AS from_date, lat_visit AS from_lat, lon_visit AS from_lon,
  pings AS from_pings, to_date, to_lat, to_lon
FROM ordered WHERE to_date IS NOT NULL"""

VISIT_COLUMNS = "device_id, date_visit, lat_visit, lon_visit"
CLEAN = f"WITH {VISITS} SELECT {VISIT_COLUMNS} FROM visits"
IN_RANGE = f"visit_date BETWEEN DATE '{START}' AND DATE '{END}'"
RANGE = f"WITH {VISITS} SELECT {VISIT_COLUMNS}, cluster_pred FROM visits WHERE {IN_RANGE}"
HOURS = f"""WITH {VISITS}
SELECT date, hour, count(*) AS pings FROM visits GROUP BY date, hour"""
# The five separated places of the clustering checks, with the number of each.
PLACED = """placed AS (
  SELECT sha256('+447' || lpad(CAST(user_id AS VARCHAR), 9, '0')) AS device_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_visit,
    50.0::DOUBLE + (user_id % 5) * 1.0::DOUBLE + (event_id % 7) * 0.001::DOUBLE AS lat_visit,
    (-3.0)::DOUBLE + (user_id % 5) * 0.75::DOUBLE + (event_id % 11) * 0.001::DOUBLE AS lon_visit,
    CAST(ts AS DATE) AS visit_date, CAST(user_id % 5 AS INTEGER) AS place FROM events)"""
PLACES = f"WITH {PLACED} SELECT {VISIT_COLUMNS}, place FROM placed"

SILHOUETTE = f"""{VISITS}, points AS (
  SELECT own, x, y, x * x + y * y AS norm FROM (
    SELECT cluster_pred AS own, lat_visit - avg(lat_visit) OVER () AS x,
      lon_visit - avg(lon_visit) OVER () AS y FROM visits)),
sums AS (
  SELECT own AS other, count(*) AS n, sum(norm) AS psi, sum(x) AS sx, sum(y) AS sy
  FROM points GROUP BY own),
away AS (
  SELECT p.own, s.other, s.n, p.norm + s.psi / s.n - 2 * (p.x * s.sx + p.y * s.sy) / s.n AS d,
    p.x, p.y FROM points p JOIN sums s ON true),
pos AS (
  SELECT own, x, y, d * n / (n - 1) AS a FROM away WHERE own = other),
neg AS (
  SELECT own, x, y, min(d) AS b FROM away WHERE own <> other GROUP BY own, x, y),
scores AS (
  SELECT (b - a) / greatest(a, b) AS score FROM pos JOIN neg USING (own, x, y))"""


def _globe() -> str:
    """Cells of the globe at resolution 10 and their centres, zone by zone."""
    edge = _edge(10)
    return f"""points AS (
  SELECT event_id, (event_id * 7919) % 180001 / 1000e0 - 90 AS lat,
    (event_id * 104729) % 360001 / 1000e0 - 180 AS lon FROM events),
turned AS (
  SELECT event_id, lat, CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END AS lon,
    CASE WHEN lat >= 75 THEN 180 WHEN lat < -75 THEN 181 ELSE CAST(floor(lat) AS BIGINT) + 90 END AS zone
  FROM points),
zones AS (
  SELECT z AS zone, sin(radians(z - 90)) AS foot, cos(radians(z - 89.5e0)) AS mid,
    cos(radians(z - 90 - degrees({edge} / {RADIUS}))) AS low,
    cos(radians(z - 89 + degrees({edge} / {RADIUS}))) AS high,
    CASE WHEN z IN (89, 90) THEN 1e0 ELSE cos(radians(z - 89.5e0)) END AS most
  FROM generate_series(15, 164) AS t(z)),
sized AS (
  SELECT zone, foot, {RADIUS} / mid * greatest(mid / low, low / mid, mid / high, high / mid, most / mid)
      / (1.5e0 * {edge}) AS rows,
    ceil(2 * pi() * {RADIUS} * mid * greatest(mid / low, low / mid, mid / high, high / mid, most / mid)
      / (sqrt(3e0) * {edge})) AS columns FROM zones),
cap AS (SELECT {edge} * cos((radians(15e0) + {edge} / {RADIUS}) / 2) AS cap_edge),
flat AS (
  SELECT *, 2 * {RADIUS} / cap_edge * sin((pi() / 2 - abs(radians(lat))) / 2) AS rho
  FROM turned LEFT JOIN sized USING (zone), cap),
axes AS (
  SELECT *, CASE WHEN zone >= 180 THEN rho * cos(radians(lon)) * 2 / 3
      ELSE (sin(radians(lat)) - foot) * rows END AS rf,
    CASE WHEN zone >= 180 THEN rho * sin(radians(lon)) / sqrt(3e0) ELSE lon * columns / 360 END AS uf
  FROM flat),
near AS (
  SELECT *, uf - rf / 2 AS qf, CAST(floor(uf - rf / 2 + 0.5e0) AS BIGINT) AS q0,
    CAST(floor(rf + 0.5e0) AS BIGINT) AS r0, CAST(floor(0.5e0 - uf - rf / 2) AS BIGINT) AS s0 FROM axes),
off AS (SELECT *, abs(q0 - qf) AS dq, abs(r0 - rf) AS dr, abs(s0 + qf + rf) AS ds FROM near),
moved AS (
  SELECT *, CASE WHEN dq > dr AND dq > ds THEN -r0 - s0 ELSE q0 END AS q,
    CASE WHEN dq > dr AND dq > ds THEN r0 WHEN dr > ds THEN -q0 - s0 ELSE r0 END AS r FROM off),
wrapped AS (
  SELECT *, CASE WHEN zone >= 180 THEN q
    ELSE ((q % columns::BIGINT) + columns::BIGINT) % columns::BIGINT END AS place FROM moved),
globe AS (
  SELECT event_id, (10::BIGINT << 59) + (zone::BIGINT << 50) + (r + 8388608)
      + ((CASE WHEN zone >= 180 THEN place + 33554432 ELSE place END) << 24) AS cell,
    CASE WHEN zone >= 180 THEN (CASE WHEN zone = 180 THEN 1 ELSE -1 END) * (90 - 2 * degrees(asin(
        cap_edge * sqrt(3 * (q + r / 2e0) * (q + r / 2e0) + 2.25e0 * r * r) / (2 * {RADIUS}))))
      ELSE degrees(asin(greatest(-1e0, least(1e0, foot + r / rows)))) END AS lat,
    CASE WHEN zone >= 180 THEN degrees(atan2(sqrt(3e0) * (q + r / 2e0), 1.5e0 * r))
      ELSE ((place + r / 2e0) / columns + 0.5e0 - floor((place + r / 2e0) / columns + 0.5e0) - 0.5e0) * 360
      END AS lon FROM wrapped)"""


def _argmin_silhouette() -> str:
    names = ", ".join(f"round(max(score) FILTER (k = {k}), 6) AS k{k}" for k in range(2, 11))
    return f"""WITH {VISITS}, centred AS (
  SELECT user_id, lat_visit - avg(lat_visit) OVER () AS x, lon_visit - avg(lon_visit) OVER () AS y
  FROM visits),
points AS (
  SELECT k, user_id % k AS own, x, y, x * x + y * y AS norm, count(*) AS copies
  FROM centred, generate_series(2, 10) AS t(k) GROUP BY ALL),
sums AS (
  SELECT k, own AS other, sum(copies) AS n, sum(copies * norm) AS psi, sum(copies * x) AS sx,
    sum(copies * y) AS sy FROM points GROUP BY k, own),
away AS (
  SELECT p.*, s.other, s.n, norm + psi / n - 2 * (x * sx + y * sy) / n AS d
  FROM points p JOIN sums s USING (k)),
sides AS (
  SELECT k, own, x, y, copies, max(CASE WHEN own = other THEN d * n / nullif(n - 1, 0) END) AS a,
    min(CASE WHEN own <> other THEN d END) AS b FROM away GROUP BY k, own, x, y, copies),
scores AS (
  SELECT k, sum(copies * CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)
    / sum(copies) AS score FROM sides GROUP BY k)
SELECT (SELECT count(*) FROM events) AS total,
  CAST(arg_min(k, score) AS INTEGER) AS argmin_silhouette, {names} FROM scores"""


def _nearest_label() -> str:
    away = [
        f"(lat_visit - {_double(la)}) * (lat_visit - {_double(la)}) + "
        f"(lon_visit - {_double(lo)}) * (lon_visit - {_double(lo)}) AS d{i}"
        for i, (la, lo) in enumerate(CENTERS)
    ]
    least = f"least({', '.join(f'd{i}' for i in range(len(CENTERS)))})"
    cases = " ".join(f"WHEN d{i} = near THEN {i}" for i in range(len(CENTERS)))
    return f"""WITH {VISITS},
away AS (SELECT {VISIT_COLUMNS}, {', '.join(away)} FROM visits),
nearest AS (SELECT *, {least} AS near FROM away)
SELECT {VISIT_COLUMNS}, CAST(CASE {cases} END AS INTEGER) AS cluster_pred FROM nearest"""


ORACLES: dict[str, str] = {
    "s1_publish_and_stream": CLEAN,
    "s2_decode_messages": f"""WITH {PINGS}
SELECT device_id, 'UTC+0' AS timezone_visit, dayname(ts) AS day_of_week_visit, time_stamp,
  lat_visit, 'absent' AS date_visit, strftime(ts, '%H:%M:%S') AS time_visit, lon_visit
FROM pings""",
    "s2_malformed_messages": "SELECT count(*) AS messages, 0::BIGINT AS visits FROM documents",
    "s3_append_table": f"""WITH {VISITS}
SELECT {VISIT_COLUMNS}, cluster_pred, visit_date FROM visits""",
    "s4_micro_batches": f"WITH {VISITS} SELECT {VISIT_COLUMNS}, visit_date FROM visits",
    "s4_connector_replays": f"""WITH {VISITS}
SELECT connector, {VISIT_COLUMNS}, visit_date, 4::BIGINT AS batches
FROM visits, (VALUES ('json'), ('csv')) AS c(connector)""",
    "s4_compacted_batches": f"WITH {VISITS} SELECT {VISIT_COLUMNS}, visit_date FROM visits",
    "s5_encode_round_trip": CLEAN,
    "s6_view_scan": f"""WITH {VISITS}
SELECT lat_visit, lon_visit, date_visit, cluster_pred FROM visits WHERE {IN_RANGE}""",
    "s6_connector_round_trip": f"""WITH {VISITS}
SELECT {VISIT_COLUMNS}, cluster_pred, visit_date FROM visits""",
    "p1_masked_ids": f"WITH {PINGS} SELECT time_stamp, sha256(device_id) AS device_id FROM pings",
    "p2_substituted_ids": f"""WITH {PINGS}
SELECT time_stamp, sha256(translate(device_id, '{SUBSTITUTION[0]}', '{SUBSTITUTION[1]}'))
  AS device_id FROM pings""",
    "p3_epoch_texts": f"""WITH {PINGS}
SELECT time_stamp,
  strftime(make_timestamp(CAST(floor(time_stamp) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')
    AS date_visit FROM pings""",
    "p4_numbers_from_text": """SELECT event_id, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value,
  TRY_CAST(props AS DOUBLE) IS NULL AS props_is_bad,
  TRY_CAST(event_type AS DOUBLE) IS NULL AS type_is_bad FROM events""",
    "p5_usable_positions": """SELECT event_id, value AS lat, CAST(user_id AS DOUBLE) AS lon
FROM events WHERE value BETWEEN -90 AND 90 AND user_id BETWEEN -180 AND 180
  AND NOT isnan(value)""",
    "p6_stored_columns": f"WITH {VISITS} SELECT {VISIT_COLUMNS}, cluster_pred FROM visits",
    "p7_feature_vectors": f"""WITH {VISITS}
SELECT date_visit, lat_visit AS lat, lon_visit AS lon FROM visits""",
    "p8_calendar": f"""WITH {VISITS}, parsed AS (
  SELECT device_id, date_visit, strptime(date_visit, '%Y-%m-%d %H:%M:%S') AS moment FROM visits)
SELECT device_id, date_visit, CAST(moment AS DATE) AS date, CAST(hour(moment) AS INTEGER) AS hour
FROM parsed""",
    "p9_dates_between": RANGE,
    "p9_dates_between_text": RANGE,
    "p10_one_device": f"""WITH {VISITS}
SELECT {VISIT_COLUMNS}, cluster_pred FROM visits WHERE device_id = sha256('{DEVICE}')""",
    "p10_device_by_dates": f"""WITH {VISITS}
SELECT {VISIT_COLUMNS}, cluster_pred FROM visits WHERE device_id = sha256('{DEVICE}')""",
    "p11_emptiness": "SELECT count(*) = 0 AS all_empty, true AS never_empty FROM events",
    "p12_alerts": f"WITH {_flags()} SELECT cell, hour, date, alert FROM report",
    "p12_fractional_alerts": f"WITH {_flags('1.5')} SELECT cell, hour, date, alert FROM report",
    "p13_red_waves": f"WITH {_flags()} SELECT cell, hour, date, red_wave FROM report",
    "p14_colors": f"""WITH {_flags()}
SELECT cell, hour, date, CASE WHEN red_wave THEN 'red' ELSE 'blue' END AS color FROM report""",
    "p15_popups": f"WITH {_flags()} SELECT cell, hour, date, {POPUP} FROM report",
    "g1_hex_cells": f"""WITH {_cells()}
SELECT date_visit, cell, 'hx10:' || q || ':' || r AS cell_text FROM placed""",
    "g1_coarse_cells": f"""WITH {_cells(COARSE)}
SELECT cell, count(*) AS pings FROM placed GROUP BY cell""",
    "g1_globe_cells": f"WITH {_globe()} SELECT event_id, cell FROM globe",
    "g2_globe_centers": f"""WITH {_globe()}
SELECT event_id, cell, round(lat, 6) AS lat, round(lon, 6) AS lon FROM globe""",
    "g2_cell_centers": f"""WITH {_cells()}, cells AS (SELECT DISTINCT cell, q, r FROM placed)
SELECT cell, {_center()} FROM cells""",
    "a1_cell_counts": f"WITH {COUNTS} SELECT cell, hour, date, pings FROM counts",
    "a2_spread": f"""WITH {COUNTS}
SELECT cell, hour, round(avg(pings), 6) AS mean, round(stddev_samp(pings), 6) AS std
FROM counts GROUP BY cell, hour""",
    "a3_counts_with_spread": f"""WITH {_flags()}
SELECT cell, hour, date, pings, round(mean, 6) AS mean, round(std, 6) AS std FROM report""",
    "a4_hotspot_report": f"""WITH {_flags()}
SELECT cell, hour, date, pings, round(mean, 6) AS mean, round(std, 6) AS std, alert, red_wave
FROM report""",
    "a4_report_from_stored_counts": f"""WITH {_flags()}
SELECT cell, hour, date, pings, round(mean, 6) AS mean, round(std, 6) AS std, alert, red_wave
FROM report""",
    "a5_pings_by_hour": HOURS,
    "a5_pings_by_hour_from_counts": HOURS,
    "a6_cluster_sizes": f"""WITH {VISITS}
SELECT cluster_pred, count(*) AS count FROM visits WHERE cluster_pred IS NOT NULL
GROUP BY cluster_pred ORDER BY count DESC, cluster_pred""",
    "a7_cluster_number": f"""WITH {VISITS}
SELECT count(DISTINCT cluster_pred) AS clusters FROM visits""",
    "a8_visit_total": "SELECT count(*) AS total FROM events",
    "a9_map_center": f"""WITH {VISITS}
SELECT round(avg(lat_visit), 6) AS mean_lat, round(avg(lon_visit), 6) AS mean_lon FROM visits""",
    "a9_overview": f"""WITH {VISITS}
SELECT count(*) AS total, count(DISTINCT cluster_pred) AS clusters,
  round(avg(lat_visit), 6) AS mean_lat, round(avg(lon_visit), 6) AS mean_lon FROM visits""",
    "a10_device_journey": f"""WITH {VISITS}
SELECT device_id, lat_visit, lon_visit, date_visit, cluster_pred FROM visits
WHERE device_id = sha256('{DEVICE}') ORDER BY date_visit, lat_visit, lon_visit""",
    "a11_first_visits": f"""WITH {ORDERED}
SELECT {VISIT_COLUMNS} FROM ordered WHERE pos = 1""",
    "a12_journey_segments": SEGMENTS,
    "a12_journey_segments_by_block": SEGMENTS,
    "a12_journey_paths": f"""WITH {ORDERED}
SELECT device_id, CAST((pos - 1) // {POINTS_PER_ROW} AS BIGINT) AS part,
  string_agg(CAST(CAST(lat_visit AS DECIMAL(9,6)) AS VARCHAR) || ' ' ||
    CAST(CAST(lon_visit AS DECIMAL(9,6)) AS VARCHAR), ';' ORDER BY pos) AS path
FROM ordered GROUP BY 1, 2""",
    "m1_kmeans_labels": PLACES,
    "m2_fixed_centers": _nearest_label(),
    "m3_silhouette_visits": f"""WITH {SILHOUETTE}
SELECT round(avg(score), 6) AS silhouette FROM scores""",
    "m3_silhouette_library": f"""WITH {SILHOUETTE}
SELECT count(*) AS total, round(avg(score), 6) AS silhouette FROM scores""",
    "m3_silhouette_embeddings": """WITH vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sizes AS (SELECT label, count(*) AS n FROM vectors GROUP BY label),
away AS (
  SELECT a.vec_id, a.label AS own, b.label AS other,
    sum(list_distance(a.v, b.v) * list_distance(a.v, b.v)) AS d
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id GROUP BY a.vec_id, a.label, b.label),
means AS (
  SELECT vec_id, own, other, d / (CASE WHEN own = other THEN n - 1 ELSE n END) AS d
  FROM away JOIN sizes ON other = label),
sides AS (
  SELECT vec_id, max(CASE WHEN own = other THEN d END) AS a,
    min(CASE WHEN own <> other THEN d END) AS b FROM means GROUP BY vec_id)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM sides""",
    "m5_degenerate_tables": """SELECT 'one_position' AS rows, 0 AS label, count(*) AS visits
FROM events UNION ALL SELECT 'one_row', -1, 1::BIGINT""",
    "m4_chosen_k": """SELECT count(*) AS total,
  CAST(count(DISTINCT user_id % 5) AS INTEGER) AS silhouette_max,
  CAST(count(DISTINCT user_id % 5) AS INTEGER) AS elbow FROM events""",
    "m4_argmin_silhouette": _argmin_silhouette(),
    "m6_clustered_batches": f"""WITH {PLACED}
SELECT {VISIT_COLUMNS}, visit_date, place, 4::BIGINT AS batches FROM placed""",
    "m7_saved_model_scores": PLACES,
    "w1_batch_visits": CLEAN,
    "w2_closed_hours": f"""WITH {COUNTS}, latest AS (SELECT max(date_visit) AS last FROM visits)
SELECT cell, hour, date, pings FROM counts, latest
WHERE CAST(date AS TIMESTAMP) + to_hours(CAST(hour + 1 AS INTEGER))
  <= CAST(last AS TIMESTAMP) - INTERVAL 1 HOUR""",
    "w2_late_hours": f"""WITH {_cells()}, timed AS (
  SELECT *, CAST(date AS TIMESTAMP) + to_hours(CAST(hour + 1 AS INTEGER)) AS closes,
    date_visit < '{SPLIT}' AS early, user_id % 2 = 1 AS odd FROM placed),
marks AS (
  SELECT max(CAST(date_visit AS TIMESTAMP)) FILTER (early AND NOT odd) - INTERVAL 1 HOUR AS first,
    max(CAST(date_visit AS TIMESTAMP)) - INTERVAL 1 HOUR AS last FROM timed)
SELECT cell, hour, date, count(*) AS pings FROM timed, marks
WHERE closes <= last AND (NOT (early AND odd) OR first IS NULL OR closes > first)
GROUP BY cell, hour, date""",
    "w2_open_hours": f"WITH {COUNTS} SELECT cell, hour, date, pings FROM counts",
    "v1_heat_markers": f"""WITH {_flags()}, {AXES_OF_CELL}
SELECT cell, hour, date, {_center()},
  CASE WHEN red_wave THEN 'red' ELSE 'blue' END AS color, {POPUP} FROM axes_of""",
    "v2_journey_markers": f"""WITH {VISITS}
SELECT device_id, date_visit, lat_visit AS lat, lon_visit AS lon,
  '<b>Device ID:</b> ' || device_id || '<br><b>Date:</b> ' || date_visit || '<br>' AS popup
FROM visits""",
}
