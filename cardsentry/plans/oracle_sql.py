"""Independent DuckDB formulations of every registered query (the oracle).

They are written the *direct* way, not the way the Spark plans run: D2 by
sorting each group and reading index floor(0.05 n); D1 by ``row_number``;
D3 by a recursive CTE that carries the list of centres through each group
row by row; the nearest match by ranking all (suspect, main) pairs of a
group; W1 by a correlated count.  Only the fixture mapping and the fixed
text formats are shared.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Expression helpers (SQL text)
# ---------------------------------------------------------------------------


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"least(pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin(radians(({lon2}) - ({lon1})) / 2), 2), 1.0)")
    return f"(6371.0 * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


def fmt2(x: str) -> str:
    """Java ``String.format("%.2f")``: HALF_UP on the shortest decimal text."""
    return (f"(CASE WHEN isnan({x}) THEN 'NaN' WHEN isinf({x}) AND {x} > 0 THEN 'Infinity' "
            f"WHEN isinf({x}) THEN '-Infinity' ELSE CAST(CAST(round(CAST(CAST({x} AS VARCHAR) "
            f"AS DECIMAL(38,10)), 2) AS DECIMAL(38,2)) AS VARCHAR) END)")


def ldt(ts: str) -> str:
    """``LocalDateTime.toString()``."""
    us = f"(epoch_us({ts}) % 1000000)"
    sec = f"((epoch_us({ts}) // 1000000) % 60)"
    return (f"(CASE WHEN {sec} = 0 AND {us} = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M') "
            f"WHEN {us} = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
            f"WHEN {us} % 1000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '.' || "
            f"lpad(CAST({us} // 1000 AS VARCHAR), 3, '0') "
            f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST({us} AS VARCHAR), 6, '0') END)")


def iso(ts: str) -> str:
    """``ISO_LOCAL_DATE_TIME`` text: fraction only when non-zero, no trailing zeros."""
    us = f"(epoch_us({ts}) % 1000000)"
    return (f"(CASE WHEN {us} = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') ELSE "
            f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '.' || "
            f"rtrim(lpad(CAST({us} AS VARCHAR), 6, '0'), '0') END)")


def bucket(interval: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL {interval}, {ts}, TIMESTAMP '1970-01-01')"


def windowed_tx(length: str, slide: str, copies: int) -> str:
    """``tx`` with one row per window (length, slide) containing ``ts``;
    ``copies`` = length / slide.  Windows align to 1970-01-01."""
    b = bucket(slide)
    starts = ", ".join([b] + [f"{b} - {i} * INTERVAL {slide}" for i in range(1, copies)])
    return (f"(SELECT tx.*, s AS window_start, s + INTERVAL {length} AS window_end "
            f"FROM tx, unnest([{starts}]) AS u(s))")


# ---------------------------------------------------------------------------
# CTE building blocks
# ---------------------------------------------------------------------------
TX = """tx AS (
  SELECT event_id AS seq,
         CAST(user_id + CASE WHEN k % 10 = 0 THEN 7000 ELSE 0 END AS INTEGER) AS card_id,
         ts,
         CAST(value AS DECIMAL(18,2)) AS value,
         CAST(user_id AS INTEGER) AS user_id,
         CAST(20 + user_id % 21 AS INTEGER) AS lim,
         -60.0::DOUBLE + CAST((user_id * 37) % 120 AS DOUBLE)
           + CASE WHEN k >= 85 THEN 2 + (k - 85) * 0.1::DOUBLE ELSE (k - 42) * 0.003::DOUBLE END AS lat,
         -170.0::DOUBLE + CAST((user_id * 73) % 340 AS DOUBLE) + (k % 7 - 3) * 0.01::DOUBLE AS lon
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

ALERT_SELECT = ("seq, card_id, ts, CAST(value AS DOUBLE) AS value, user_id, lim, lat, lon, "
                "value > lim AS above_limit, fraud_reason")
WALERT_SELECT = ALERT_SELECT + ", window_start, window_end"

D1 = f"""d1_above AS (
  SELECT *, {bucket('24 HOURS')} AS window_start, {bucket('24 HOURS')} + INTERVAL 24 HOURS AS window_end
  FROM tx WHERE value > lim
),
d1_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, window_start ORDER BY ts, seq) AS rn,
            count(*) OVER (PARTITION BY user_id, window_start) AS n
  FROM d1_above
),
d1 AS (
  SELECT *, 'Transaction above limit repeated within 24 hours' AS fraud_reason
  FROM d1_ranked WHERE n > 1 AND rn > 3
)"""

D1_SLIDING = f"""d1s_above AS (
  SELECT tx.*, s AS window_start, s + INTERVAL 24 HOURS AS window_end
  FROM tx, unnest([{bucket('12 HOURS')}, {bucket('12 HOURS')} - INTERVAL 12 HOURS]) AS u(s)
  WHERE value > lim
),
d1s_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, window_start ORDER BY ts, seq) AS rn,
            count(*) OVER (PARTITION BY user_id, window_start) AS n
  FROM d1s_above
),
d1s AS (
  SELECT *, 'Transaction above limit repeated within 24 hours' AS fraud_reason
  FROM d1s_ranked WHERE n > 1 AND rn > 3
)"""

def d2_ctes(p: str = "d2", length: str = "7 DAYS", slide: str = "7 DAYS", copies: int = 1) -> str:
    return f"""{p}_w AS (SELECT * FROM {windowed_tx(length, slide, copies)}),
{p}_sorted AS (
  SELECT card_id, window_start, value,
         row_number() OVER (PARTITION BY card_id, window_start ORDER BY value, seq) - 1 AS idx,
         count(*) OVER (PARTITION BY card_id, window_start) AS n
  FROM {p}_w
),
{p}_p05 AS (
  SELECT card_id, window_start, any_value(n) AS n,
         CAST(floor(any_value(n) * 0.05::DOUBLE) AS BIGINT) AS p05_index,
         max(value) FILTER (WHERE idx = CAST(floor(n * 0.05::DOUBLE) AS BIGINT)) AS p05_value
  FROM {p}_sorted GROUP BY card_id, window_start
),
{p} AS (
  SELECT w.*, '5th percentile lower than 1.0' AS fraud_reason
  FROM {p}_w w JOIN {p}_p05 q USING (card_id, window_start)
  WHERE q.p05_value < 1.0 AND w.value < 1.0
)"""


D2 = d2_ctes()
D2_SLIDING = d2_ctes("d2s", "7 DAYS", "84 HOURS", 2)

# D3 -------------------------------------------------------------------------
_HIT = ("list_position(list_transform(f.cs, lambda c: "
        + hav("c.lat", "c.lon", "p.lat", "p.lon") + " < 100), true)")

def d3_ctes(p: str = "d3", length: str = "1 DAY", slide: str = "1 DAY", copies: int = 1, moving: bool = True) -> str:
    lat, lon = (("(c.lat * c.n + p.lat) / (c.n + 1)", "(c.lon * c.n + p.lon) / (c.n + 1)") if moving else ("c.lat", "c.lon"))
    return f"""{p}_pts AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, window_start ORDER BY ts, seq) AS rn
  FROM {windowed_tx(length, slide, copies)}
),
{p}_fold AS (
  SELECT user_id, window_start, rn, seq,
         [{{'lat': lat, 'lon': lon, 'n': 1}}] AS cs, 1 AS cid
  FROM {p}_pts WHERE rn = 1
  UNION ALL
  SELECT p.user_id, p.window_start, p.rn, p.seq,
         CASE WHEN {_HIT} IS NULL
              THEN list_append(f.cs, {{'lat': p.lat, 'lon': p.lon, 'n': 1}})
              ELSE list_transform(f.cs, lambda c, i: CASE WHEN i = {_HIT.replace('lambda c:', 'lambda c2:').replace('c.lat', 'c2.lat').replace('c.lon', 'c2.lon')}
                   THEN {{'lat': {lat}, 'lon': {lon}, 'n': c.n + 1}}
                   ELSE c END) END,
         coalesce({_HIT}, len(f.cs) + 1)
  FROM {p}_fold f JOIN {p}_pts p
    ON p.user_id = f.user_id AND p.window_start = f.window_start AND p.rn = f.rn + 1
),
{p}_final AS (
  SELECT user_id, window_start, arg_max(cs, rn) AS cs FROM {p}_fold GROUP BY user_id, window_start
),
{p}_groups AS (
  SELECT user_id, window_start, cs, len(cs) AS n_clusters,
         list_position(list_transform(cs, lambda c: c.n), list_max(list_transform(cs, lambda c: c.n))) AS main_cid,
         list_max(list_transform(cs, lambda c: c.n)) AS main_n
  FROM {p}_final
),
{p}_rows AS (
  SELECT p.*, f.cid, g.main_cid, g.main_n, g.n_clusters, f.cid = g.main_cid AS is_main
  FROM {p}_pts p JOIN {p}_fold f USING (user_id, window_start, rn)
  JOIN {p}_groups g USING (user_id, window_start)
  WHERE g.n_clusters > 1
),
{p}_pairs AS (
  SELECT s.*, m.seq AS near_seq, m.ts AS near_ts, m.lat AS near_lat, m.lon AS near_lon,
         abs(epoch_us(s.ts) - epoch_us(m.ts)) // 1000000 AS near_key,
         row_number() OVER (PARTITION BY s.seq, s.window_start ORDER BY abs(epoch_us(s.ts) - epoch_us(m.ts)) // 1000000,
                            m.ts, m.seq) AS pick
  FROM {p}_rows s JOIN {p}_rows m
    ON m.user_id = s.user_id AND m.window_start = s.window_start AND m.is_main AND NOT s.is_main
),
{p}_near AS (SELECT * EXCLUDE (pick) FROM {p}_pairs WHERE pick = 1),
{p}_v AS (
  SELECT *, {hav('lat', 'lon', 'near_lat', 'near_lon')} AS distance_km,
         CAST(abs(epoch_us(ts) - epoch_us(near_ts)) // 1000 AS DOUBLE) / 3600000.0 AS hours
  FROM {p}_near
),
{p}_v2 AS (
  SELECT *, CASE WHEN hours = 0 THEN (CASE WHEN distance_km > 0 THEN 'inf'::DOUBLE ELSE 'nan'::DOUBLE END)
                 ELSE distance_km / hours END AS velocity
  FROM {p}_v
),
{p}_checks AS (
  SELECT *, NOT isnan(velocity) AND CASE WHEN distance_km < 300 THEN velocity > 150 ELSE velocity > 900 END
            AS is_fraud
  FROM {p}_v2
),
{p} AS (
  SELECT *, 'Localization changed too fast. Time between is ' || {fmt2('hours')} ||
            'hours. Computed velocity is: ' || {fmt2('velocity')} || ' for distance ' ||
            {fmt2('distance_km')} || '. One transaction timestamp is ' || {ldt('near_ts')} ||
            ' the second is ' || {ldt('ts')} AS fraud_reason
  FROM {p}_checks WHERE is_fraud
)"""


D3 = d3_ctes()
D3_FIXED = d3_ctes("d3f", moving=False)
D3_SLIDING = d3_ctes("d3s", "1 DAY", "12 HOURS", 2)

D4 = f"""d4 AS (
  SELECT {ALERT_SELECT} FROM d1
  UNION ALL SELECT {ALERT_SELECT} FROM d2
  UNION ALL SELECT {ALERT_SELECT} FROM d3
)"""

W1 = """w1_above AS (SELECT * FROM tx WHERE value > lim),
w1 AS (
  SELECT a.*, 'Użytkownik ' || CAST(a.user_id AS VARCHAR) ||
              ' przekroczył limit co najmniej drugi raz w ciągu 24 godzin.' AS fraud_reason
  FROM w1_above a
  WHERE (SELECT count(*) FROM w1_above b
         WHERE b.user_id = a.user_id AND b.ts >= a.ts - INTERVAL 24 HOURS
           AND (b.ts < a.ts OR (b.ts = a.ts AND b.seq <= a.seq))) >= 2
)"""

HOME = """home AS (
  SELECT card_id, arg_min(lat, (ts, seq)) AS home_lat, arg_min(lon, (ts, seq)) AS home_lon
  FROM tx GROUP BY card_id
),
tx_home AS (SELECT tx.*, home_lat, home_lon FROM tx JOIN home USING (card_id))"""


def with_ctes(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


_BEARING = ("(((degrees(atan2(sin(radians(lon - home_lon)) * cos(radians(lat)), "
            "cos(radians(home_lat)) * sin(radians(lat)) - sin(radians(home_lat)) * cos(radians(lat)) * "
            "cos(radians(lon - home_lon)))) + 360.0) % 360.0))")
_DIST = hav("home_lat", "home_lon", "lat", "lon")
_D_ANG = f"({_DIST} / 6371.0)"
_DEST_LAT_RAD = (f"asin(sin(radians(home_lat)) * cos({_D_ANG}) + cos(radians(home_lat)) * "
                 f"sin({_D_ANG}) * cos(radians({_BEARING})))")
_DEST_LON_RAD = (f"(radians(home_lon) + atan2(sin(radians({_BEARING})) * sin({_D_ANG}) * "
                 f"cos(radians(home_lat)), cos({_D_ANG}) - sin(radians(home_lat)) * sin({_DEST_LAT_RAD})))")

_JSON_ALERT = ("'{\"transaction\":{\"cardId\":' || card_id || ',\"timestamp\":\"' || " + iso("ts")
               + " || '\",\"value\":' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ',\"userId\":' || user_id"
               " || ',\"limit\":' || lim || ',\"localization\":{\"latitude\":' || CAST(lat AS VARCHAR)"
               " || ',\"longitude\":' || CAST(lon AS VARCHAR) || '},\"aboveLimit\":' || "
               "CASE WHEN value > lim THEN 'true' ELSE 'false' END || '},\"fraudReason\":\"' || "
               "fraud_reason || '\"}'")

ORACLE: dict[str, str] = {
    "detect_low_values": with_ctes(TX, D2) + f"SELECT {WALERT_SELECT} FROM d2",
    "detect_above_limit": with_ctes(TX, D1) + f"SELECT {WALERT_SELECT} FROM d1",
    "above_limit_sliding_12h": with_ctes(TX, D1_SLIDING) + f"SELECT {WALERT_SELECT} FROM d1s",
    "detect_location_jump": with_ctes(TX, D3) + f"SELECT {WALERT_SELECT} FROM d3",
    "low_values_sliding_84h": with_ctes(TX, D2_SLIDING) + f"SELECT {WALERT_SELECT} FROM d2s",
    "location_sliding_12h": with_ctes(TX, D3_SLIDING) + f"SELECT {WALERT_SELECT} FROM d3s",
    "fraud_alerts": with_ctes(TX, D1, D2, D3, D4) + "SELECT * FROM d4",
    "stream_fraud_alerts": with_ctes(TX, D1, D2, D3) + (
        f"SELECT * FROM (SELECT {WALERT_SELECT} FROM d1 UNION ALL SELECT {WALERT_SELECT} FROM d2 "
        f"UNION ALL SELECT {WALERT_SELECT} FROM d3) WHERE window_end <= (SELECT max(ts) FROM tx)"),
    "trailing_24h_repeat": with_ctes(TX, W1) + f"SELECT {ALERT_SELECT} FROM w1",
    "stream_trailing_24h_repeat": with_ctes(TX, W1) + f"SELECT {ALERT_SELECT} FROM w1",
    "above_limit_after_k": with_ctes(TX, D1) + "SELECT user_id, window_start, window_end, seq, ts, "
                                               "CAST(n AS BIGINT) AS n FROM d1",
    "p05_by_card_week": with_ctes(TX, D2) + "SELECT card_id, window_start, window_start + INTERVAL 7 DAYS "
                                            "AS window_end, CAST(n AS BIGINT) AS n, p05_index, "
                                            "CAST(p05_value AS DOUBLE) AS p05_value, p05_value < 1.0 AS flagged "
                                            "FROM d2_p05",
    "geo_clusters": with_ctes(TX, D3) + "SELECT user_id, window_start, CAST(i AS INTEGER) AS cid, "
                                        "CAST(cs[i].n AS INTEGER) AS n, (round(cs[i].lat, 6) + 0.0) AS centre_lat, "
                                        "(round(cs[i].lon, 6) + 0.0) AS centre_lon "
                                        "FROM d3_final, range(1, len(cs) + 1) AS r(i)",
    "main_cluster": with_ctes(TX, D3) + "SELECT user_id, window_start, CAST(main_cid AS INTEGER) AS main_cid, "
                                        "CAST(main_n AS INTEGER) AS main_n, CAST(n_clusters AS INTEGER) "
                                        "AS n_clusters FROM d3_groups",
    "nearest_in_time": with_ctes(TX, D3) + "SELECT user_id, window_start, seq, ts, near_seq, near_ts, "
                                           "CAST(near_key AS BIGINT) AS near_key FROM d3_near",
    "velocity_checks": with_ctes(TX, D3) + "SELECT seq, near_seq, (round(distance_km, 6) + 0.0) AS distance_km, "
                                           "hours, (round(velocity, 6) + 0.0) AS velocity, "
                                           "is_fraud FROM d3_checks",
    "reason_text": with_ctes(TX, D3) + f"SELECT seq, {fmt2('hours')} AS hours_text, "
                                       f"{fmt2('velocity')} AS velocity_text, "
                                       f"{fmt2('distance_km')} AS distance_text, "
                                       f"{ldt('near_ts')} AS main_ts_text, {ldt('ts')} AS suspect_ts_text "
                                       "FROM d3_checks",
    "haversine_km": with_ctes(TX, HOME) + f"SELECT seq, card_id, {_r6(_DIST)} AS km_from_first FROM tx_home",
    "destination_point": with_ctes(TX, HOME) + f"SELECT seq, {_r6('degrees(' + _DEST_LAT_RAD + ')')} "
                                               f"AS dest_lat, {_r6('degrees(' + _DEST_LON_RAD + ')')} "
                                               "AS dest_lon FROM tx_home",
    "filter_above_limit": with_ctes(TX) + "SELECT seq, card_id, ts, CAST(value AS DOUBLE) AS value, lim "
                                          "FROM tx WHERE value > lim",
    "filter_low_value": with_ctes(TX) + "SELECT seq, card_id, ts, CAST(value AS DOUBLE) AS value "
                                        "FROM tx WHERE value < 1.0",
    "above_limit_flag": with_ctes(TX) + "SELECT seq, CAST(value AS DOUBLE) AS value, lim, "
                                        "value > lim AS above_limit FROM tx",
    "json_roundtrip": with_ctes(TX) + "SELECT seq, card_id, ts, CAST(value AS DOUBLE) AS value, user_id, "
                                      "lim, lat, lon FROM tx",
    "tx_flat": with_ctes(TX) + "SELECT seq, card_id AS tx_card_id, ts AS tx_ts, CAST(value AS DOUBLE) AS "
                               "tx_value, user_id AS tx_user_id, lim AS tx_lim, lat AS tx_localization_latitude, "
                               "lon AS tx_localization_longitude FROM tx",
    "alert_json": with_ctes(TX, D1, D2, D3) + "SELECT seq, " + _JSON_ALERT + " AS value FROM ("
                  f"SELECT {ALERT_SELECT.replace('CAST(value AS DOUBLE) AS value', 'value')} FROM d1 "
                  f"UNION ALL SELECT {ALERT_SELECT.replace('CAST(value AS DOUBLE) AS value', 'value')} FROM d2 "
                  f"UNION ALL SELECT {ALERT_SELECT.replace('CAST(value AS DOUBLE) AS value', 'value')} FROM d3)",
    "alerts_flat": with_ctes(TX, D1, D2, D3, D4) + (
        'SELECT card_id AS "transaction_cardId", ts AS "transaction_timestamp", value AS "transaction_value", '
        'user_id AS "transaction_userId", lim AS "transaction_limit", '
        'lat AS "transaction_localization_latitude", lon AS "transaction_localization_longitude", '
        'above_limit AS "isAboveLimit", fraud_reason AS "fraudReason" FROM d4'),
    "alerts_by_reason": with_ctes(TX, D1, D2, D3, D4) + "SELECT * FROM d4 WHERE regexp_matches("
                                                        "fraud_reason, 'Localization changed too fast.*')",
    "feed_above_limit": with_ctes(TX) + (
        "SELECT card_id, seq, ts, CAST(value AS DOUBLE) AS value, limit0, value > limit0 AS above_limit0 "
        "FROM tx JOIN (SELECT card_id, arg_min(lim, (ts, seq)) AS limit0 FROM tx GROUP BY card_id) "
        "USING (card_id)"),
    "feed_low_values": with_ctes(TX) + "SELECT card_id, seq, ts, CAST(value AS DOUBLE) AS value, "
                                       "value < 0.5 AS is_low FROM tx",
    "feed_positions": with_ctes(TX) + "SELECT card_id, seq, lon, lat, CAST(epoch_us(ts) AS DOUBLE) / "
                                      "86400000000.0 AS days FROM tx",
    "feed_location_alerts": with_ctes(TX, D1, D2, D3, D4) + (
        "SELECT card_id, seq, lon, lat, CAST(epoch_us(ts) AS DOUBLE) / 86400000000.0 AS days, fraud_reason "
        "FROM d4 WHERE regexp_matches(fraud_reason, 'Localization changed too fast.*')"),
    "alert_decode": with_ctes(TX, D1, D2, D3, D4) + "SELECT * FROM d4",
    "csv_roundtrip": with_ctes(TX) + "SELECT seq, card_id, ts, CAST(value AS DOUBLE) AS value, user_id, "
                                     "lim, lat, lon FROM tx",
    "csv_mixed_times": with_ctes(TX) + (
        "SELECT seq, card_id, CASE seq % 7 WHEN 0 THEN ts WHEN 2 THEN date_trunc('minute', ts) "
        "WHEN 4 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) ELSE date_trunc('second', ts) END AS ts, "
        "CAST(value AS DOUBLE) AS value, user_id, lim, lat, lon FROM tx"),
    "producer_time": with_ctes(TX) + "SELECT seq, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, "
                                     "date_trunc('second', ts) AS ts_parsed FROM tx",
    "fixed_centre_clusters": with_ctes(TX, D3_FIXED) + "SELECT user_id, window_start, CAST(i AS INTEGER) AS cid, "
                             "CAST(cs[i].n AS INTEGER) AS n, (round(cs[i].lat, 6) + 0.0) AS centre_lat, "
                             "(round(cs[i].lon, 6) + 0.0) AS centre_lon FROM d3f_final, range(1, len(cs) + 1) AS r(i)",
    "feed_busiest_card": with_ctes(TX) + (
        "SELECT card_id, seq, ts, CAST(value AS DOUBLE) AS value, value < 0.5 AS is_low FROM tx WHERE card_id = "
        "(SELECT card_id FROM tx GROUP BY card_id ORDER BY count(*) DESC, card_id LIMIT 1)"),
}
