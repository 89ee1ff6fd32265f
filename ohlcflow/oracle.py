"""DuckDB SQL for every registered query, written from the base tables.

Column names equal the Spark query's. Views ``events orders nation
documents ...`` are the driver's parquet tables.
"""

from __future__ import annotations

_TS = "'%Y-%m-%d %H:%M:%S'"

_BAR_FROM_TICKS = """
SELECT event_type AS symbol,
       strftime(time_bucket(INTERVAL '{every}', ts, TIMESTAMP '1970-01-01'), {ts}) AS time,
       max(value) AS high, min(value) AS low,
       arg_min(value, (ts, event_id)) AS open, arg_max(value, (ts, event_id)) AS close,
       CAST(count(*) AS DOUBLE) AS volumefrom, round(sum(value), 2) AS volumeto
FROM events GROUP BY 1, 2
"""


def _bars(every: str) -> str:
    return _BAR_FROM_TICKS.format(every=every, ts=_TS)


_TIERS = f"""
SELECT *, 'daily' AS batch_unit FROM ({_bars('1 day')})
UNION ALL SELECT *, 'hourly' AS batch_unit FROM ({_bars('1 hour')})
UNION ALL SELECT *, 'minutely' AS batch_unit FROM ({_bars('1 minute')})
"""

_BAR_COLUMNS = f"""
       strftime(TIMESTAMP '2024-01-01' + event_id * INTERVAL 1 MINUTE, {_TS}) AS time,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS high, value AS low, value AS open, value AS close,
       CAST(user_id AS DOUBLE) AS volumefrom, value * user_id AS volumeto, event_type AS symbol
"""

_BARS_FROM_PAYLOAD = f"SELECT {_BAR_COLUMNS}, 'minutely' AS batch_unit FROM events WHERE event_type <> 'error'"

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

_SERVED_TICKS = f"""
SELECT CAST(0 AS DOUBLE) AS high, CAST(0 AS DOUBLE) AS low, CAST(0 AS DOUBLE) AS open,
       CASE WHEN {_K} % 10 IN (0, 1, 2) THEN NULL ELSE value END AS close,
       CAST(0 AS DOUBLE) AS volumefrom, CAST(0 AS DOUBLE) AS volumeto,
       CASE WHEN {_K} % 10 = 0 THEN NULL ELSE event_type END AS symbol
FROM events
"""

_LATEST = """
SELECT user_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY user_id
"""

_DIMENSION = """
SELECT CAST(row_number() OVER (ORDER BY total DESC, o_custkey ASC) AS BIGINT) AS rank,
       'C' || CAST(o_custkey AS VARCHAR) AS symbol, total
FROM (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey)
"""

_PLAN = """
WITH p AS (SELECT DATE '2022-03-20' AS e),
day_tiers AS (
  SELECT 'daily' AS batch_unit, 'histoday' AS endpoint, DATE '2010-07-17' AS s,
         CAST(e - INTERVAL 84 MONTH AS DATE) AS en, 2000 AS w, 1 AS per_day FROM p
  UNION ALL
  SELECT 'hourly', 'histohour', CAST(e - INTERVAL 84 MONTH AS DATE) + 1, e - 7, 83, 24 FROM p
),
day_chunks AS (
  SELECT batch_unit, endpoint, k, s + CAST(k * w AS INTEGER) AS cs,
         least(s + CAST((k + 1) * w - 1 AS INTEGER), en) AS ce, per_day
  FROM day_tiers,
       generate_series(0, CAST(greatest(1, ceil((en - s + 1) / w)) AS BIGINT) - 1) AS g(k)
),
minute_tier AS (
  SELECT CAST(epoch(CAST(e - 6 AS TIMESTAMP)) AS BIGINT) AS s,
         CAST(epoch(CAST(e AS TIMESTAMP)) AS BIGINT) AS en FROM p
),
minute_chunks AS (
  SELECT k, s + k * 120000 AS cs FROM minute_tier,
         generate_series(0, CAST(greatest(1, ceil((en - s + 1) / 120000)) AS BIGINT) - 1) AS g(k)
),
chunks AS (
  SELECT batch_unit, endpoint, CAST(epoch(CAST(ce AS TIMESTAMP)) AS BIGINT) AS toTs,
         CAST((ce - cs) * per_day AS INTEGER) AS "limit", k FROM day_chunks
  UNION ALL
  SELECT 'minutely', 'histominute', cs, 2000, k FROM minute_chunks
)
SELECT n_name AS symbol, batch_unit, endpoint, toTs, "limit", CAST(1 AS INTEGER) AS aggregate,
       'USD' AS tsym, CAST(k AS INTEGER) AS chunk_no
FROM nation CROSS JOIN chunks
"""

# Every bar that a plan of the rerun asks for, what is missing of them, and the runs of
# missing bars: a grid instead of ranges.
_REMAINING = _PLAN.replace("2022-03-20", "2024-02-02").split("SELECT n_name")[0] + """,
symbols AS (SELECT n_name AS symbol FROM nation UNION ALL SELECT DISTINCT event_type FROM events),
spans AS (
  SELECT batch_unit, endpoint, k, CAST(epoch(CAST(ce AS TIMESTAMP)) AS BIGINT) AS toTs,
         CAST((ce - cs) * per_day AS INTEGER) AS "limit", CAST(epoch(CAST(cs AS TIMESTAMP)) AS BIGINT) AS s,
         CAST(epoch(CAST(ce AS TIMESTAMP)) AS BIGINT) + 86399 AS e, 86400 // per_day AS w
  FROM day_chunks
  UNION ALL
  SELECT 'minutely', 'histominute', k, cs, 2000, cs, least(cs + 119999, en), 60 FROM minute_chunks, minute_tier
),
have AS (
  SELECT DISTINCT event_type AS symbol, 'hourly' AS batch_unit, CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS t FROM events
  UNION
  SELECT DISTINCT event_type, 'minutely', CAST(floor(epoch(ts) / 60) AS BIGINT) * 60 FROM events
  UNION
  SELECT symbol, 'hourly', unnest(generate_series(lo, hi, 3600)) FROM (
    SELECT event_type AS symbol, min(CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600) AS lo,
           max(CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600) AS hi
    FROM events WHERE dayofyear(ts) % 3 = 0 GROUP BY event_type, CAST(ts AS DATE))
),
grid AS (SELECT symbol, batch_unit, k, w, unnest(generate_series(s, e - w + 1, w)) AS t FROM spans, symbols),
missing AS (SELECT * FROM grid ANTI JOIN have USING (symbol, batch_unit, t)),
runs AS (
  SELECT symbol, batch_unit, k, w, min(t) AS a, max(t) AS b, count(*) AS n
  FROM (SELECT *, t - w * row_number() OVER (PARTITION BY symbol, batch_unit, k ORDER BY t) AS g FROM missing)
  GROUP BY symbol, batch_unit, k, w, g
)
SELECT symbol, batch_unit, endpoint, CASE WHEN a = s AND b + 2 * w - 1 > e THEN toTs ELSE b END AS toTs,
       CASE WHEN a = s AND b + 2 * w - 1 > e THEN "limit" ELSE CAST(n AS INTEGER) END AS "limit",
       CAST(1 AS INTEGER) AS aggregate, 'USD' AS tsym, CAST(k AS INTEGER) AS chunk_no,
       CAST(row_number() OVER (PARTITION BY symbol, batch_unit, k ORDER BY a) - 1 AS INTEGER) AS part_no
FROM runs JOIN spans USING (batch_unit, k, w)
"""

_TIER_CASE = """
CASE WHEN CAST(time AS DATE) < DATE '2010-07-17' THEN NULL
     WHEN CAST(time AS DATE) <= DATE '2017-01-28' THEN 'daily'
     WHEN CAST(time AS DATE) <= DATE '2024-01-21' THEN 'hourly'
     WHEN CAST(time AS TIMESTAMP) <= TIMESTAMP '2024-01-28 00:00:00' THEN 'minutely' END
"""


def oracle_sql() -> dict[str, str]:
    return {
        "bars_from_payload": _BARS_FROM_PAYLOAD,
        "response_quarantine": """
SELECT symbol,
       CASE WHEN symbol <> 'error' THEN 'accepted'
            WHEN chunk_no % 2 = 0 THEN 'rate_limited' ELSE 'other' END AS status,
       count(*) AS n_payloads
FROM (SELECT DISTINCT event_type AS symbol, event_id // 2000 AS chunk_no FROM events)
GROUP BY 1, 2
""",
        "ohlcv_1h": _bars("1 hour"),
        "ohlcv_3h": _bars("3 hours"),
        "bars_resample_1d": _bars("1 day"),
        "latest_price": f"""
SELECT user_id, arg_max(value, (ts, event_id)) AS close, strftime(max(ts), {_TS}) AS time
FROM events GROUP BY user_id
""",
        "latest_price_listed": f"""
SELECT user_id, arg_max(value, (ts, event_id)) AS close, strftime(max(ts), {_TS}) AS time
FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')
GROUP BY user_id
""",
        "last_n_bars": f"""
SELECT * FROM ({_bars('1 hour')}) WHERE time <= '2024-01-20 00:00:00'
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) <= 24
""",
        "quote_unpivot": f"""
SELECT CAST(user_id // 10 AS BIGINT) AS chunk_no, CAST(user_id AS VARCHAR) AS symbol,
       CASE WHEN event_type = 'error' OR user_id % 19 = 0 THEN NULL
            WHEN event_type = 'signup' THEN CAST(floor(value) AS DOUBLE) ELSE value END AS close
FROM ({_LATEST})
""",
        "stream_quote_producer": f"""
SELECT CAST(user_id AS VARCHAR) AS symbol,
       CASE WHEN event_type = 'error' OR user_id % 19 = 0 THEN NULL
            WHEN event_type = 'signup' THEN CAST(floor(value) AS DOUBLE) ELSE value END AS close
FROM ({_LATEST})
""",
        "quote_quarantine": """
WITH u AS (
  SELECT user_id, arg_max(value, (ts, event_id)) AS v, arg_max(event_type, (ts, event_id)) AS et,
         max((ts, event_id)) AS o
  FROM events GROUP BY user_id
),
c AS (SELECT user_id // 10 AS chunk_no, arg_max(et, o) AS et, arg_max(v, o) AS v FROM u GROUP BY 1)
SELECT CASE WHEN et <> 'error' THEN 'accepted' WHEN v >= 50 THEN 'rate_limited' ELSE 'other' END AS status,
       count(*) AS n_docs
FROM c GROUP BY 1
""",
        "symbol_dimension": _DIMENSION,
        "symbol_chunks": f"""
SELECT CAST((rank - 1) // 10 AS BIGINT) AS chunk_no,
       string_agg(symbol, ',' ORDER BY rank) AS symbols, CAST(count(*) AS INTEGER) AS n_symbols
FROM ({_DIMENSION}) GROUP BY 1
""",
        "kst_date": "SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS kst_date FROM events",
        "backfill_plan": _PLAN,
        "remaining_backfill": _REMAINING,
        "fill_schema": f"""
SELECT strftime(ts, {_TS}) AS time, CAST(0 AS DOUBLE) AS high, CAST(0 AS DOUBLE) AS low,
       CAST(0 AS DOUBLE) AS open, value AS close, CAST(0 AS DOUBLE) AS volumefrom,
       CAST(0 AS DOUBLE) AS volumeto, event_type AS symbol
FROM events
""",
        "tick_json_roundtrip": f"""
SELECT CASE WHEN {_K} % 10 = 0 THEN NULL ELSE event_type END AS symbol,
       CASE WHEN {_K} % 10 IN (0, 1, 2) THEN NULL ELSE value END AS close
FROM events
""",
        "multiset_except": """
SELECT user_id, event_type FROM events
EXCEPT ALL
SELECT user_id, event_type FROM events WHERE value < 10
""",
        "tier_union": _TIERS,
        "tier_select": f"SELECT * FROM ({_TIERS}) WHERE batch_unit = {_TIER_CASE}",
        "tier_select_ranges": f"""
WITH f AS (SELECT event_type AS symbol, CAST(min(ts) AS DATE) AS s, length(event_type) AS k FROM events GROUP BY event_type),
r AS (
  SELECT symbol, 1 AS tier, CAST(s AS TIMESTAMP) AS a, CAST(s + 20 AS TIMESTAMP) - INTERVAL 1 SECOND AS b FROM f
  UNION ALL SELECT symbol, 2, CAST(s + CAST(k AS INTEGER) AS TIMESTAMP), CAST(s + CAST(k + 10 AS INTEGER) AS TIMESTAMP) + INTERVAL 1799 SECOND FROM f
  UNION ALL SELECT symbol, 2, CAST(s + 18 AS TIMESTAMP), CAST(s + 26 AS TIMESTAMP) FROM f
  UNION ALL SELECT symbol, 3, CAST(s + 20 + CAST(k % 3 AS INTEGER) AS TIMESTAMP), CAST(s + 25 AS TIMESTAMP) - INTERVAL 1 SECOND FROM f
  UNION ALL SELECT symbol, 3, CAST(s + 24 AS TIMESTAMP), CAST(s + 28 AS TIMESTAMP) FROM f
),
t AS ({_TIERS})
SELECT * FROM t
WHERE (SELECT max(tier) FROM r WHERE r.symbol = t.symbol AND CAST(t.time AS TIMESTAMP) BETWEEN a AND b)
      = CASE batch_unit WHEN 'daily' THEN 1 WHEN 'hourly' THEN 2 ELSE 3 END
""",
        "latest_price_as_of": f"""
WITH p AS (SELECT event_id, user_id, ts AS at FROM events WHERE event_type = 'purchase'),
m AS (
  SELECT p.event_id, arg_max(o.value, (o.ts, o.event_id)) AS close, max(o.ts) AS as_of
  FROM p JOIN events o ON o.user_id = p.user_id AND o.event_type <> 'purchase' AND o.ts <= p.at
  GROUP BY p.event_id
)
SELECT p.event_id, p.user_id, strftime(p.at, {_TS}) AS at, close, strftime(as_of, {_TS}) AS as_of
FROM p LEFT JOIN m USING (event_id)
""",
        "last_n_bars_as_of": f"""
WITH b AS ({_bars('1 hour').replace('event_type AS symbol', 'user_id')})
SELECT event_id, user_id, time, high, low, open, close, volumefrom, volumeto
FROM (SELECT event_id, user_id, ts AS to_ts FROM events WHERE event_type = 'purchase') q JOIN b USING (user_id)
WHERE CAST(time AS TIMESTAMP) <= to_ts
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY time DESC) <= 3
""",
        "top_symbols": """
SELECT CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS name,
       round(sum(o_totalprice), 2) AS mktcap
FROM orders GROUP BY o_custkey ORDER BY mktcap DESC, o_custkey ASC LIMIT 100
""",
        "calendar_functions": """
SELECT o_orderkey,
       strftime(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH, '%Y-%m-%d') AS month_before,
       strftime(CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH, '%Y-%m-%d') AS months_before_3,
       strftime(CAST(o_orderdate AS DATE) - INTERVAL 84 MONTH, '%Y-%m-%d') AS years_before_7,
       strftime(CAST(o_orderdate AS DATE) - 7, '%Y-%m-%d') AS days_before_7,
       strftime(CAST(CAST(o_orderdate AS DATE) - 7 AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS midnight_before_7,
       strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS hours_before_5,
       strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS midnight,
       CAST(epoch(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS BIGINT) AS epoch,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS parsed
FROM orders
""",
        # The text is made here as well; the date is that of the order, nine hours
        # earlier where the text carries the offset of Seoul.
        "parse_dates": """
WITH t AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'n/a ' ELSE '' END ||
         CASE o_orderpriority
           WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
           WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
           WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y/%m/%d')
           WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y%m%d')
           ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g+09:00') END AS text,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL
              WHEN o_orderpriority = '5-LOW' THEN CAST(o_orderdate - INTERVAL 9 HOUR AS DATE)
              ELSE CAST(o_orderdate AS DATE) END AS d
  FROM orders
)
SELECT o_orderkey, text, strftime(d, '%Y-%m-%d') AS order_date,
       strftime(CAST(d AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS midnight
FROM t
""",
        # A number up to 12 before another one is the month.
        "parse_free_dates": f"""
WITH t AS (SELECT o_orderkey, o_orderkey % 16 AS k, o_orderdate + (o_orderkey % 86400) * INTERVAL 1 SECOND AS tm FROM orders),
p AS (
  SELECT *, date_trunc('minute', tm) AS m, CAST(CAST(tm AS DATE) AS TIMESTAMP) AS d,
         CASE WHEN day(tm) <= 12 THEN make_timestamp(year(tm), day(tm), month(tm), hour(tm), minute(tm), 0.0)
              ELSE date_trunc('minute', tm) END AS swapped
  FROM t
)
SELECT o_orderkey,
       CASE k WHEN 0 THEN strftime(tm, '%b %-d, %Y %-I:%M %p') WHEN 1 THEN strftime(tm, '%-d %B %Y')
              WHEN 2 THEN strftime(tm, '%a, %d %b %Y %H:%M:%S GMT') WHEN 3 THEN strftime(tm, '%a %b %-d %H:%M:%S %Y')
              WHEN 4 THEN strftime(tm, '%m/%d/%Y') WHEN 5 THEN strftime(tm, '%d.%m.%Y %H:%M')
              WHEN 6 THEN strftime(tm, '%Y%m%d%H%M%S') WHEN 7 THEN strftime(tm, '%d-%b-%y')
              WHEN 8 THEN strftime(tm, '%Y %b %d') WHEN 9 THEN strftime(tm, '%B %-dth, %Y')
              WHEN 10 THEN strftime(tm, '%-d %b %Y %H:%M:%S KST') WHEN 11 THEN strftime(tm, '%Y.%m.%d')
              WHEN 12 THEN strftime(tm, '%-m/%-d/%y %-I:%M:%S %p') WHEN 13 THEN strftime(tm, '%-I:%M %p at %-d %b %Y')
              WHEN 14 THEN strftime(tm, 'Feb 30, %Y') ELSE strftime(tm, '%-d %b %Y %H:%M XYZ') END AS text,
       strftime(CASE WHEN k IN (0, 13) THEN m WHEN k IN (1, 4, 7, 8, 9, 11) THEN d WHEN k IN (2, 3, 6, 12) THEN tm
                     WHEN k = 5 THEN swapped WHEN k = 10 THEN tm - INTERVAL 9 HOUR END, {_TS}) AS parsed
FROM p
""",
        # Characters outside printable ASCII become their UTF-8 bytes, one \\xNN each.
        "text_repair": r"""
WITH c AS (
  SELECT doc_id, text, array_to_string(list_transform(string_split(text, ''), lambda ch:
           CASE WHEN ch = chr(92) THEN chr(92) || chr(92)
                WHEN ch = chr(39) THEN chr(92) || chr(39)
                WHEN ch = chr(9) THEN chr(92) || 't'
                WHEN ch = chr(10) THEN chr(92) || 'n'
                WHEN ch = chr(13) THEN chr(92) || 'r'
                WHEN unicode(ch) BETWEEN 32 AND 126 THEN ch
                ELSE regexp_replace(lower(hex(encode(ch))), '(..)', chr(92) || chr(92) || 'x\1', 'g') END), '') AS body
  FROM documents
)
SELECT doc_id, 'b' || chr(39) || body || CASE WHEN doc_id % 11 = 0 THEN chr(92) || 'xff' ELSE '' END || chr(39) AS escaped,
       CASE WHEN doc_id % 11 = 0 THEN NULL ELSE text END AS text, doc_id % 11 = 0 AS broken
FROM c
""",
        "nested_field_project": f"SELECT event_id, {_K} AS k FROM events",
        "stream_ticks_parity": f"""
SELECT CAST(0 AS DOUBLE) AS high, CAST(0 AS DOUBLE) AS low, CAST(0 AS DOUBLE) AS open,
       CASE WHEN {_K} % 10 IN (0, 1, 2) THEN NULL ELSE value END AS close,
       CAST(0 AS DOUBLE) AS volumefrom, CAST(0 AS DOUBLE) AS volumeto,
       CASE WHEN {_K} % 10 = 0 THEN NULL ELSE event_type END AS symbol, true AS time_in_run
FROM events
""",
        "stream_dedupe_parity": f"SELECT *, CAST(0 AS BIGINT) AS dropped_as_late FROM ({_SERVED_TICKS})",
        "stream_dedupe_expiry": f"""
SELECT *, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(min(ts) AS DATE) FROM events)) AS dropped_as_late
FROM ({_SERVED_TICKS})
""",
        "sink_new_checkpoint": _SERVED_TICKS,
        "stream_latest_price": f"""
SELECT CAST(user_id AS VARCHAR) AS symbol, arg_max(value, (ts, event_id)) AS close, strftime(max(ts), {_TS}) AS time,
       max(ts) + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR AS expired
FROM events GROUP BY user_id
""",
        "stream_enriched_ticks": f"""
WITH a AS ({_DIMENSION.replace("FROM orders", "FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'")}), b AS ({_DIMENSION}),
e AS (SELECT event_id, ts, 'C' || CAST(user_id AS VARCHAR) AS symbol, value AS close FROM events)
SELECT event_id, e.symbol, close, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN a.rank ELSE b.rank END AS rank,
       CASE WHEN ts < TIMESTAMP '2024-01-15' THEN a.total ELSE b.total END AS total
FROM e LEFT JOIN a ON a.symbol = e.symbol LEFT JOIN b ON b.symbol = e.symbol
""",
        "stream_tick_quarantine": f"""
WITH t AS (
  SELECT CASE WHEN {_K} % 10 = 0 THEN 'malformed' WHEN {_K} % 10 = 1 THEN 'bad_price' ELSE 'ok' END AS status,
         CASE WHEN {_K} % 10 = 0 THEN NULL ELSE event_type END AS symbol,
         CASE WHEN {_K} % 10 IN (0, 1, 2) THEN NULL ELSE value END AS close,
         CASE {_K} % 10 WHEN 0 THEN length('not json ' || event_id)
              WHEN 1 THEN length('{{"symbol":"' || event_type || '","close":"n/a"}}') ELSE 0 END AS size
  FROM events
)
SELECT status, symbol, count(*) AS n, round(sum(close), 2) AS total, CAST(sum(size) AS BIGINT) AS characters
FROM t GROUP BY 1, 2
""",

        "stream_ohlcv_parity": _bars("1 hour"),
        "compaction_after_expiry": f"SELECT *, 'hourly' AS batch_unit FROM ({_bars('1 hour')})",
        "schema_evolution": f"""
SELECT time, symbol, CASE WHEN time >= '2024-01-15 00:00:00' THEN floor(high) ELSE high END AS high, low, open,
       CASE WHEN time < '2024-01-15 00:00:00' AND symbol = 'view' THEN close + 1 ELSE close END AS close,
       volumefrom, volumeto,
       CASE WHEN time >= '2024-01-15 00:00:00' OR symbol <> 'view' THEN CAST(volumefrom AS BIGINT) END AS trades,
       CASE WHEN time >= '2024-01-15 00:00:00' THEN round(high - low, 2) END AS spread,
       CASE WHEN time >= '2024-01-15 00:00:00' THEN upper(symbol) END AS venue
FROM ({_bars('1 hour')})
""",
        "bar_table_roundtrip": _BARS_FROM_PAYLOAD,
        "collection_append": _BARS_FROM_PAYLOAD,
        "nested_columns": """
SELECT event_type, count(*) AS n, true AS has_k, true AS has_p, false AS has_text, false AS has_value_k, false AS has_q,
       true AS seoul_ahead
FROM events GROUP BY event_type
""",
        "incremental_landing": _BARS_FROM_PAYLOAD,
        "served_documents": _BARS_FROM_PAYLOAD,
        "quarantine_roundtrip": """
WITH c AS (SELECT event_type AS symbol, event_id // 100 AS chunk_no, count(*) AS bars FROM events GROUP BY 1, 2)
SELECT CASE WHEN chunk_no % 7 = 3 THEN 'malformed' WHEN symbol <> 'error' THEN 'bar'
            WHEN chunk_no % 2 = 0 THEN 'rate_limited' ELSE 'other' END AS status, symbol,
       CAST(sum(CASE WHEN chunk_no % 7 <> 3 AND symbol <> 'error' THEN bars ELSE 1 END) AS BIGINT) AS n
FROM c GROUP BY 1, 2
""",
        "symbols_pruned": f"""
SELECT *, 'daily' AS batch_unit FROM ({_bars('1 day').replace('event_type AS symbol', "lpad(CAST(user_id % 10 AS VARCHAR), 3, '0') AS symbol")})
WHERE symbol IN ('003', '007', '009')
""",
        "single_symbol": f"SELECT {_BAR_COLUMNS} FROM events WHERE event_type = 'click'",
        "tick_sink_roundtrip": "SELECT event_type AS symbol, value AS close FROM events",
        "coin_info_table": """
SELECT CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS name,
       round(sum(o_totalprice), 2) AS mktcap
FROM orders GROUP BY o_custkey
""",
        "bars_dedupe": f"""
SELECT symbol, time, high, low, open,
       CASE WHEN symbol = 'view' THEN close + 1 ELSE close END AS close,
       volumefrom, volumeto, 'hourly' AS batch_unit
FROM ({_bars('1 hour')})
""",
    }
