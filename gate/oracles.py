"""The registered queries once more, as SQL for the checking engine.

The statements start from the plain `events` table and never look at JSON:
which rows carry which fault is known from the event id (see `feed`).
"""

from __future__ import annotations

from .feed import AS_OF

NOW = f"TIMESTAMP '{AS_OF}'"



def _round(x: str, digits: int) -> str:
    """Half-up on the decimal text of a double, as the engine under test rounds."""
    text = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({text}, {digits}) AS DOUBLE)"


def _mean(x: str, digits: int) -> str:
    """A mean without the noise of its summation order."""
    return _round(_round(f"avg({x})", 9), digits)


_WIRE = """
src AS (
  SELECT event_id AS n, ts, event_type, value,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(event_id % 100 AS BIGINT) AS fault
  FROM events
), copies AS (
  SELECT *, 0 AS copy FROM src UNION ALL SELECT *, 1 AS copy FROM src WHERE n % 25 = 1
), wire AS (
  SELECT n, fault, value, ts, k, n * 2 + copy AS kafka_offset, n % 3 AS kafka_partition,
    CASE WHEN fault <> 80 THEN event_type END AS kafka_key,
    'events' AS kafka_topic, ts AS kafka_timestamp,
    CAST(n AS VARCHAR) AS event_id,
    CASE WHEN fault <> 80 THEN event_type END AS symbol,
    upper(event_type[1]) || event_type[2:] || ' Inc.' AS company,
    CASE WHEN fault = 0 THEN -abs(value) WHEN fault = 90 THEN 2000000.0::DOUBLE + value
      WHEN fault <> 60 THEN value END AS price,
    CASE WHEN fault = 70 THEN -k - 1 WHEN fault <> 20 THEN k END AS volume,
    round(value - 50, 4) AS change,
    CASE WHEN fault = 30 THEN 5000.0 ELSE round((value - 50) / 50 * 100, 4) END AS change_percent,
    CASE WHEN fault = 40 THEN 'not-a-real-timestamp'
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS timestamp,
    CASE WHEN fault = 10 THEN 'MARS' WHEN n % 7 = 0 THEN NULL
      WHEN n % 3 = 0 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange,
    CASE WHEN fault <> 40 THEN ts END AS event_ts
  FROM copies
), texts AS (
  SELECT *, CASE WHEN fault = 50 THEN '{not valid json' ELSE
    '{"event_id":"' || event_id || '","symbol":' || coalesce('"' || symbol || '"', 'null')
    || ',"company":"' || company
    || '","price":' || CASE WHEN fault = 60 THEN '"NaN-dollars"' ELSE CAST(price AS VARCHAR) END
    || CASE WHEN fault = 20 THEN '' ELSE ',"volume":' || volume END
    || ',"change":' || change || ',"change_percent":' || change_percent
    || ',"timestamp":"' || timestamp || '","exchange":' || coalesce('"' || exchange || '"', 'null')
    || '}' END AS raw_value
  FROM wire
)"""

_FIELDS = ("event_id", "symbol", "company", "price", "volume", "change", "change_percent",
           "timestamp", "exchange")

# The nine fields as the schema parser leaves them: nothing of unreadable JSON.
_PARSED = _WIRE + ", parsed AS (SELECT raw_value, kafka_key, kafka_topic, kafka_partition, " \
    "kafka_offset, kafka_timestamp, n, fault, " + ", ".join(
        f"CASE WHEN fault <> 50 THEN {f} END AS {f}" for f in (*_FIELDS, "event_ts")
    ) + " FROM texts)"

_TAGGED = _PARSED + """
, tagged AS (
  SELECT *, CASE
    WHEN event_id IS NULL AND symbol IS NULL AND price IS NULL
      THEN 'corrupted_json: payload was not parseable'
    WHEN event_id IS NULL THEN 'missing_or_null: event_id'
    WHEN symbol IS NULL THEN 'missing_or_null: symbol'
    WHEN price IS NULL THEN 'missing_or_null: price'
    WHEN volume IS NULL THEN 'missing_or_null: volume'
    WHEN event_ts IS NULL THEN 'missing_or_null: timestamp'
    WHEN price <= 0 THEN 'invalid_price: price <= min'
    WHEN price > 1e6 THEN 'invalid_price: price > max'
    WHEN volume < 0 THEN 'invalid_volume: volume < min'
    WHEN change_percent < -100 OR change_percent > 1000 THEN 'invalid_change_percent: out of range'
    WHEN exchange NOT IN ('NASDAQ', 'NYSE', 'AMEX', 'BSE', 'NSE')
      THEN 'invalid_exchange: not allowed'
  END AS error_reason FROM parsed
)"""

_BAND = """CASE WHEN price >= 1000 THEN '1000+' WHEN price >= 500 THEN '500-1000'
    WHEN price >= 250 THEN '250-500' WHEN price >= 100 THEN '100-250'
    WHEN price >= 50 THEN '50-100' WHEN price >= 0 THEN '0-50' ELSE 'unknown' END"""

_RAW = _TAGGED + f"""
, clean AS (
  SELECT * FROM tagged WHERE error_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_ts, kafka_offset) = 1
), raw AS (
  SELECT event_id, symbol, company, price, volume, change, change_percent,
    event_ts AS event_timestamp, exchange, CAST(event_ts AS DATE) AS event_date,
    CAST(hour(event_ts) AS BIGINT) AS event_hour, CAST(day(event_ts) AS BIGINT) AS event_day,
    CAST(month(event_ts) AS BIGINT) AS event_month, CAST(year(event_ts) AS BIGINT) AS event_year,
    {_BAND} AS price_bucket, {NOW} AS processing_time
  FROM clean
)"""

_LETTERS = f"""
, letters AS (
  SELECT raw_value AS original_message, error_reason, {NOW} AS processing_timestamp,
    'event-analytics' AS pipeline_name, CAST({NOW} AS DATE) AS event_date,
    coalesce(CAST(event_ts AS DATE), CAST({NOW} AS DATE)) AS letter_date
  FROM tagged WHERE error_reason IS NOT NULL
)"""


def _windows(start: str, length: str, rows: str = "clean", now: str = NOW) -> str:
    return f"""
  SELECT {start} AS window_start, {start} + INTERVAL {length} AS window_end, symbol, exchange,
    {_mean('price', 4)} AS avg_price, {_round('max(price)', 4)} AS max_price,
    {_round('min(price)', 4)} AS min_price, CAST(sum(volume) AS BIGINT) AS total_volume,
    count(*) AS event_count, {_mean('change_percent', 4)} AS avg_change_percent,
    CAST({start} AS DATE) AS event_date, {now} AS processing_time
  FROM {rows} GROUP BY ALL"""


_MINUTE = "time_bucket(INTERVAL 1 minute, event_ts)"
_AGGREGATES = f", aggregates AS ({_windows(_MINUTE, '1 minute')})"

# Every reason of a record, in rule order, from what its fault is known to break.
_JUDGED = _WIRE + f"""
, reasons AS (
  SELECT *, (epoch_us(ts) - epoch_us({NOW})) / 1e6 AS ahead FROM texts
), judged AS (
  SELECT *,
    CASE WHEN fault = 50 THEN 'corrupted_json: payload was not parseable' ELSE concat_ws('; ',
      CASE WHEN fault = 80 THEN 'null_value: ''symbol'' is null' END,
      CASE WHEN fault = 20 THEN 'missing_field: ''volume'' is absent' END,
      CASE WHEN fault = 60
        THEN 'wrong_type: ''price'' must be numeric, got str (''NaN-dollars'')' END,
      CASE WHEN price <= 0 THEN 'invalid_price: ' || price || ' <= min 0.0' END,
      CASE WHEN price > 1e6 THEN 'invalid_price: ' || price || ' > max 1000000.0' END,
      CASE WHEN volume < 0 THEN 'invalid_volume: ' || volume || ' < min 0' END,
      CASE WHEN change_percent < -100 OR change_percent > 1000 THEN
        'invalid_change_percent: ' || change_percent || ' outside [-100.0, 1000.0]' END,
      CASE WHEN fault = 40
        THEN 'invalid_timestamp: ''not-a-real-timestamp'' is not valid ISO-8601' END,
      CASE WHEN fault <> 40 AND ahead > 300 THEN 'future_timestamp: ''' || timestamp || ''' is '
        || CAST(trunc(ahead) AS BIGINT) || 's ahead of now (max 300s)' END,
      CASE WHEN fault = 10
        THEN 'invalid_exchange: ''MARS'' not in [''AMEX'', ''BSE'', ''NASDAQ'', ''NSE'', ''NYSE'']'
      END) END AS error_reason,
    fault NOT IN (20, 50, 80) AS complete,
    fault NOT IN (50, 60) AND price > 0 AND price <= 1e6 AS consistent,
    fault NOT IN (40, 50) AND abs(ahead) <= 86400 AS timely
  FROM reasons
)"""

# Both judgements of the same records in one statement.
_JUDGED_TAGGED = _JUDGED + _TAGGED.removeprefix(_WIRE)

_CODES = """array_to_string(list_transform(
    list_filter(string_split(error_reason, '; '), lambda x: x <> ''), lambda x: split_part(x, ':', 1)), ',')"""


def _card(rows: str) -> str:
    return f"""
, counted AS (
  SELECT count(*) AS total_records,
    count(*) FILTER (complete) AS complete, count(*) FILTER (error_reason = '') AS valid,
    count(*) FILTER (consistent) AS consistent, count(*) FILTER (timely) AS timely,
    count(CASE WHEN fault <> 50 THEN event_id END)
      - count(DISTINCT CASE WHEN fault <> 50 THEN event_id END) AS duplicates
  FROM {rows}
), scored AS (
  SELECT total_records, valid AS valid_records, total_records - valid AS invalid_records,
    duplicates AS duplicate_records,
    round(complete / total_records * 100, 2) AS completeness,
    round(valid / total_records * 100, 2) AS validity,
    round((total_records - duplicates) / total_records * 100, 2) AS uniqueness,
    round(timely / total_records * 100, 2) AS timeliness,
    round(consistent / total_records * 100, 2) AS consistency
  FROM counted
), overall AS (
  SELECT *, round((completeness + validity + uniqueness + timeliness + consistency) / 5, 2)
    AS overall_score FROM scored
)
SELECT *, CASE WHEN overall_score >= 95 THEN 'green' WHEN overall_score >= 80 THEN 'amber'
  ELSE 'red' END AS grade FROM overall"""


def _rate(letter_date: str) -> str:
    return f"""
, good AS (SELECT event_date, count(*) AS valid_count FROM raw GROUP BY 1),
bad AS (SELECT {letter_date} AS event_date, count(*) AS dlq_count FROM letters GROUP BY 1),
rates AS (
  SELECT event_date, coalesce(valid_count, 0) AS valid_count, coalesce(dlq_count, 0) AS dlq_count
  FROM good FULL OUTER JOIN bad USING (event_date)
)"""


_KPIS = """round(avg(avg_price), 6) AS avg_price, max(max_price) AS max_price,
  min(min_price) AS min_price, CAST(sum(total_volume) AS BIGINT) AS total_volume,
  CAST(sum(event_count) AS BIGINT) AS event_count,
  round(sum(avg_price * event_count) / sum(event_count), 6) AS event_weighted_avg_price"""

_LETTER_JSON = """'{"original_message":' || CAST(to_json(original_message) AS VARCHAR)
  || ',"error_reason":' || CAST(to_json(error_reason) AS VARCHAR)
  || ',"processing_timestamp":"' || strftime(processing_timestamp, '%Y-%m-%dT%H:%M:%S.%gZ')
  || '","pipeline_name":"' || pipeline_name || '"}'"""

# An event object with every field there, absent ones as null.
_FULL_JSON = """'{"event_id":' || coalesce('"' || event_id || '"', 'null')
  || ',"symbol":' || coalesce('"' || symbol || '"', 'null')
  || ',"company":' || coalesce('"' || company || '"', 'null')
  || ',"price":' || coalesce(CAST(price AS VARCHAR), 'null')
  || ',"volume":' || coalesce(CAST(volume AS VARCHAR), 'null')
  || ',"change":' || coalesce(CAST(change AS VARCHAR), 'null')
  || ',"change_percent":' || coalesce(CAST(change_percent AS VARCHAR), 'null')
  || ',"timestamp":' || coalesce('"' || timestamp || '"', 'null')
  || ',"exchange":' || coalesce('"' || exchange || '"', 'null') || '}'"""

_TICKS = f"""
SELECT event_id, symbol, price, change,
  {_round('CASE WHEN before = 0 THEN 0 ELSE change / before * 100 END', 4)} AS change_percent
FROM (SELECT *, {_round('price - before', 4)} AS change FROM (
  SELECT event_id, symbol, price,
    coalesce(lag(price) OVER (PARTITION BY symbol ORDER BY event_ts, event_id), price) AS before
  FROM ticks
))"""



def _slow(limit: float) -> str:
    shown = _round("value * 1000 / 1000", 1)
    return f"""SELECT ts AS "at", 'High processing lag' AS title, 'warning' AS severity,
  printf('Query ''%s'' batch took %.1fs (threshold {limit}s)', event_type, {shown}) AS message
FROM events WHERE value * 1000 / 1000 > {limit}"""


_RAW_COLUMNS = """event_id, symbol, company, price, volume, change, change_percent,
  event_timestamp, exchange, event_date, event_hour, event_day, event_month, event_year,
  price_bucket"""


def _sql(prefix: str, body: str) -> str:
    return f"WITH {prefix.strip()} {body.strip()}"


ORACLES: dict[str, str] = {
    "wire_records": _sql(_WIRE, """
        SELECT kafka_key AS key, raw_value AS value, kafka_topic AS topic,
          kafka_partition AS partition, kafka_offset AS "offset", kafka_timestamp AS timestamp
        FROM texts"""),
    "wrap_json_texts": _sql(_PARSED, """
        SELECT kafka_topic, symbol, count(*) AS records, CAST(0 AS BIGINT) AS with_offset,
          count(event_ts) AS with_time
        FROM parsed GROUP BY 1, 2"""),
    "parsed_events": _sql(_PARSED, f"""
        SELECT raw_value, kafka_key, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,
          {', '.join(_FIELDS)}, event_ts FROM parsed"""),
    "event_to_json": _sql(_PARSED, f"SELECT kafka_offset, {_FULL_JSON} AS value FROM parsed"),
    "validate_first_match": _sql(_TAGGED, "SELECT kafka_offset, event_id, error_reason FROM tagged"),
    "validate_timestamp_first": _sql(_TAGGED, """
        SELECT kafka_offset, event_id,
          CASE WHEN timestamp IS NOT NULL AND event_ts IS NULL
            THEN 'invalid_timestamp: not ISO-8601' ELSE error_reason END AS error_reason
        FROM tagged"""),
    "validate_all": _sql(_JUDGED, f"""
        SELECT kafka_offset, error_reason = '' AS is_valid, {_CODES} AS reason_codes, error_reason
        FROM judged"""),
    "validate_strict": _sql(_WIRE, """
        SELECT kafka_offset, CASE WHEN fault = 50 THEN 'not_json' ELSE concat_ws(',',
          CASE WHEN fault = 20 THEN 'required: volume' END,
          CASE WHEN symbol IS NULL THEN 'type: symbol' END,
          CASE WHEN exchange IS NULL THEN 'type: exchange' END,
          CASE WHEN fault = 60 THEN 'type: price' END,
          CASE WHEN price <= 0 THEN 'minimum: price' END,
          CASE WHEN volume < 0 THEN 'minimum: volume' END) END AS errors
        FROM texts"""),
    "valid_events": _sql(_TAGGED, f"""
        SELECT kafka_offset, event_ts, {', '.join(_FIELDS)} FROM tagged
        WHERE error_reason IS NULL"""),
    "dlq_envelope": _sql(_TAGGED + _LETTERS, """
        SELECT original_message, error_reason, processing_timestamp, pipeline_name, event_date
        FROM letters"""),
    "dlq_to_json": _sql(_TAGGED + _LETTERS, f"SELECT {_LETTER_JSON} AS value FROM letters"),
    "letter_origins": _sql(_JUDGED_TAGGED + _LETTERS, """
        SELECT origin, split_part(error_reason, ':', 1) AS code, count(*) AS letters FROM (
          SELECT 'producer_validation_failed' AS origin, error_reason FROM judged
          WHERE error_reason <> ''
          UNION ALL SELECT 'stream_validation', error_reason FROM letters
        ) GROUP BY 1, 2"""),
    "replay_dead_letters": _sql(_JUDGED_TAGGED, f"""
        SELECT error_reason = '' AS is_valid, {_CODES} AS reason_codes, count(*) AS letters
        FROM judged WHERE fault <> 50 AND kafka_offset IN (
          SELECT kafka_offset FROM tagged WHERE error_reason IS NOT NULL)
        GROUP BY 1, 2"""),
    "publish_keyed": _sql(_TAGGED, f"""
        SELECT symbol AS key, {_FULL_JSON} AS value FROM tagged WHERE error_reason IS NULL"""),
    "dedup_events": _sql(_RAW, """
        SELECT event_id, kafka_partition, kafka_offset, symbol, price FROM clean"""),
    "union_replay": _sql(_RAW, """
        SELECT count(*) AS events, CAST(sum(volume) AS BIGINT) AS total_volume FROM raw"""),
    "enrich_events": _sql(_RAW, "SELECT * FROM raw"),
    "price_buckets": _sql(_PARSED, f"""
        SELECT {_BAND} AS price_bucket, count(*) AS events FROM parsed GROUP BY 1"""),
    "agg_tumbling_1m": _sql(_RAW, _windows(_MINUTE, "1 minute")),
    "agg_tumbling_1h": _sql(_RAW, _windows("time_bucket(INTERVAL 1 hour, event_ts)", "1 hour")),
    "agg_sliding_5m_1m": _sql(_RAW, f"""
        , slid AS (
          SELECT *, {_MINUTE} - to_minutes(CAST(i AS INTEGER)) AS slid_start
          FROM clean, range(5) r(i)
        ) {_windows('slid_start', '5 minutes', 'slid')}"""),
    "agg_lineitem_daily": _sql("""items AS (
          SELECT l_shipdate AS event_ts, l_returnflag AS symbol, l_linestatus AS exchange,
            l_extendedprice AS price, CAST(trunc(l_quantity) AS BIGINT) AS volume,
            l_discount * 100 AS change_percent FROM lineitem)""",
        _windows("time_bucket(INTERVAL 1 day, event_ts)", "1 day", "items")),
    "tick_changes": _sql(_RAW + ", ticks AS (SELECT * FROM clean)", _TICKS),
    "tick_changes_orders": _sql("""ticks AS (
          SELECT o_orderstatus AS symbol, o_orderdate AS event_ts, o_orderkey AS event_id,
            o_totalprice AS price FROM orders)""", _TICKS),
    "latest_prices": _sql(_RAW, f"""
        SELECT symbol, company, exchange, price AS latest_price, event_timestamp AS last_seen
        FROM raw WHERE event_date >= CAST({NOW} AS DATE) - 1
        QUALIFY row_number() OVER (
          PARTITION BY symbol ORDER BY event_timestamp DESC, event_id DESC) = 1"""),
    "latest_price_measure": _sql(_RAW, f"""
        , latest AS (
          SELECT exchange, price FROM raw WHERE event_date >= CAST({NOW} AS DATE) - 1
          QUALIFY row_number() OVER (
            PARTITION BY symbol ORDER BY event_timestamp DESC, event_id DESC) = 1
        )
        SELECT exchange, CASE WHEN count(DISTINCT price) = 1 THEN max(price) END AS latest_price
        FROM latest GROUP BY 1"""),
    "hourly_events": _sql(_RAW, f"""
        SELECT event_date, event_hour, symbol, exchange, count(*) AS event_count,
          {_mean('price', 2)} AS avg_price, CAST(sum(volume) AS BIGINT) AS total_volume
        FROM raw GROUP BY 1, 2, 3, 4"""),
    "hourly_heatmap": _sql(_RAW, "SELECT symbol, " + ", ".join(
        f"nullif(count(*) FILTER (event_hour = {h}), 0) AS h{h:02d}" for h in range(24)
    ) + " FROM raw GROUP BY 1"),
    "dlq_rate_daily": _sql(_RAW + _LETTERS + _rate("event_date"), """
        SELECT *, round(dlq_count / (valid_count + dlq_count) * 100, 6) AS dlq_rate_pct
        FROM rates ORDER BY event_date"""),
    "dlq_rate_by_event_date": _sql(_RAW + _LETTERS + _rate("letter_date"), """
        SELECT *, round(dlq_count / (valid_count + dlq_count) * 100, 6) AS dlq_rate_pct
        FROM rates ORDER BY event_date"""),
    "dlq_measures": _sql(_TAGGED, """
        SELECT (SELECT count(DISTINCT event_id) FROM tagged WHERE error_reason IS NULL)
            AS event_count,
          count(*) AS dlq_count,
          round(count(*) / (count(*) + (SELECT count(DISTINCT event_id) FROM tagged
            WHERE error_reason IS NULL)) * 100, 6) AS dlq_rate_pct
        FROM tagged WHERE error_reason IS NOT NULL"""),
    "kpi_measures": _sql(_RAW + _AGGREGATES, f"SELECT {_KPIS} FROM aggregates"),
    "kpi_by_exchange": _sql(_RAW + _AGGREGATES, f"""
        SELECT exchange, {_KPIS} FROM aggregates GROUP BY 1"""),
    "slice_by_dims": _sql(_RAW, """
        SELECT event_date, company, exchange, count(*) AS event_count,
          CAST(sum(volume) AS BIGINT) AS total_volume
        FROM raw
        WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
          AND company IN ('Click Inc.', 'View Inc.') AND exchange IN ('NYSE', 'NASDAQ')
        GROUP BY 1, 2, 3"""),
    "price_over_time": _sql(_RAW + _AGGREGATES, """
        SELECT window_start, symbol, round(avg(avg_price), 6) AS avg_price
        FROM aggregates GROUP BY 1, 2 ORDER BY 1, 2"""),
    "top_symbols_volume": _sql(_RAW + _AGGREGATES, """
        SELECT symbol, CAST(sum(total_volume) AS BIGINT) AS total_volume, count(*) AS windows
        FROM aggregates GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "top_symbols_five": _sql(_RAW + _AGGREGATES, """
        SELECT symbol, CAST(sum(total_volume) AS BIGINT) AS total_volume, count(*) AS windows
        FROM aggregates GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""),
    "market_distribution": _sql(_RAW, """
        SELECT exchange, count(*) AS event_count,
          round(count(*) / (SELECT count(*) FROM raw) * 100, 6) AS share_pct
        FROM raw GROUP BY 1"""),
    "error_reason_counts": _sql(_TAGGED + _LETTERS, """
        SELECT error_reason, count(*) AS dlq_count FROM letters GROUP BY 1"""),
    "top_error_reasons": _sql(_TAGGED + _LETTERS, """
        SELECT trim(split_part(error_reason, ';', 1)) AS reason, count(*) AS count
        FROM letters GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "letter_listing": _sql(_TAGGED + _LETTERS, """
        SELECT processing_timestamp, error_reason, original_message FROM letters"""),
    "table_row_counts": _sql(_RAW + _AGGREGATES + _LETTERS, """
        SELECT 'raw events' AS "table", count(*) AS rows FROM raw
        UNION ALL SELECT 'aggregates', count(*) FROM aggregates
        UNION ALL SELECT 'dead letter', count(*) FROM letters"""),
    "table_round_trip": _sql(_RAW, """
        SELECT event_date, symbol, exchange, count(*) AS events,
          CAST(sum(event_year) AS BIGINT) AS years, count(*) AS window_events,
          CAST(sum(volume) AS BIGINT) AS total_volume
        FROM raw GROUP BY 1, 2, 3"""),
    "latest_events": _sql(_RAW, """
        SELECT event_id, symbol, round(price, 2) AS price, volume, exchange, event_hour
        FROM raw ORDER BY event_timestamp DESC, event_id LIMIT 5"""),
    "calendar": _sql(_RAW, """
        , ends AS (SELECT min(event_date) AS a, max(event_date) AS b FROM raw)
        SELECT CAST(d AS DATE) AS date, CAST(year(d) AS BIGINT) AS year,
          CAST(month(d) AS BIGINT) AS month, CAST(day(d) AS BIGINT) AS day
        FROM ends, unnest(generate_series(a, b, INTERVAL 1 day)) s(d)"""),
    "events_per_day": _sql(_RAW, """
        , ends AS (SELECT min(event_date) AS a, max(event_date) AS b FROM raw),
        days AS (SELECT CAST(d AS DATE) AS date FROM ends,
          unnest(generate_series(a, b, INTERVAL 1 day)) s(d))
        SELECT date, count(event_id) AS event_count,
          CAST(coalesce(sum(volume), 0) AS BIGINT) AS total_volume
        FROM days LEFT JOIN raw ON date = event_date GROUP BY 1"""),
    "symbol_star_join": _sql(_RAW, """
        SELECT company AS dim_company, event_year AS dim_year, event_month AS dim_month,
          count(*) AS event_count,
          CAST(sum(volume) AS BIGINT) AS total_volume
        FROM raw GROUP BY 1, 2, 3"""),
    "standing_views": _sql(_RAW, f"""
        , latest AS (
          SELECT symbol, price FROM raw WHERE event_date >= CAST({NOW} AS DATE) - 1
          QUALIFY row_number() OVER (
            PARTITION BY symbol ORDER BY event_timestamp DESC, event_id DESC) = 1
        )
        SELECT r.symbol, count(*) AS event_count, max(l.price) AS latest_price
        FROM raw r JOIN latest l ON r.symbol = l.symbol GROUP BY 1"""),
    "offset_totals": _sql(_WIRE, """
        , partitions AS (
          SELECT kafka_topic, kafka_partition, count(*) AS records,
            max(kafka_offset) + 1 AS end_offset
          FROM wire GROUP BY 1, 2
        )
        SELECT kafka_topic, CAST(sum(records) AS BIGINT) AS records,
          CAST(sum(end_offset) AS BIGINT) AS end_offsets, count(*) AS partitions
        FROM partitions GROUP BY 1"""),
    "dq_scorecard": _sql(_JUDGED, _card("judged")),
    "dq_top_errors": _sql(_JUDGED, """
        SELECT trim(split_part(error_reason, ';', 1)) AS reason, count(*) AS count
        FROM judged WHERE error_reason <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "dq_top_codes": _sql(_JUDGED, """
        SELECT split_part(error_reason, ':', 1) AS reason, count(*) AS count
        FROM judged WHERE error_reason <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "dq_dead_letters": _sql(_JUDGED_TAGGED + """
        , replayed AS (
          SELECT * FROM judged WHERE fault <> 50 AND kafka_offset IN (
            SELECT kafka_offset FROM tagged WHERE error_reason IS NOT NULL)
        )""", _card("replayed")),
    "duplicate_count": _sql(_PARSED, """
        SELECT count(event_id) - count(DISTINCT event_id) AS duplicates FROM parsed"""),
    "outcome_counts": _sql(_TAGGED, """
        SELECT CASE WHEN error_reason IS NULL THEN 'delivered' ELSE 'dlq' END AS outcome,
          count(*) AS records
        FROM tagged GROUP BY 1"""),
    "alerts_dlq_rate": _sql(_RAW + _LETTERS + _rate("letter_date"), f"""
        SELECT CAST(event_date AS TIMESTAMP) AS "at", 'High DLQ rate' AS title,
          'critical' AS severity,
          printf('%d/%d records dead-lettered (%.1f%%) - exceeds threshold', dlq_count,
            valid_count + dlq_count,
            {_round('dlq_count / (valid_count + dlq_count) * 100', 1)}) AS message
        FROM rates WHERE dlq_count / (valid_count + dlq_count) * 100 >= 9.0"""),
    "alerts_stall": _sql(_RAW, """
        , counts AS (
          SELECT date_trunc('minute', event_ts) AS minute, count(*) AS c FROM clean GROUP BY 1),
        ends AS (SELECT min(minute) AS a, max(minute) AS b FROM counts),
        line AS (SELECT d AS minute FROM ends,
          unnest(generate_series(a, b, INTERVAL 1 minute)) s(d))
        SELECT minute AS "at", 'Throughput stall' AS title, 'warning' AS severity,
          coalesce(c, 0) || ' events in a minute (threshold 5)' AS message
        FROM line LEFT JOIN counts USING (minute) WHERE coalesce(c, 0) < 5"""),
    "alerts_lag": _slow(120.0),
    "alert_cooldown": f"""
        WITH RECURSIVE raised AS ({_slow(60.0)}),
        sent AS (
          SELECT title, min("at") AS "at" FROM raised GROUP BY 1
          UNION ALL
          SELECT r.title, min(r."at") FROM sent s JOIN raised r
            ON r.title = s.title AND r."at" >= s."at" + INTERVAL 1 hour
          GROUP BY 1
        )
        SELECT r."at", r.title, r.severity, r.message
        FROM raised r JOIN sent s ON r.title = s.title AND r."at" = s."at"
        QUALIFY row_number() OVER (PARTITION BY r.title, r."at" ORDER BY r.severity, r.message) = 1""",
    "stream_raw_events": _sql(_RAW, f"SELECT {_RAW_COLUMNS} FROM raw"),
    "stream_dedup": _sql(_RAW, "SELECT event_id, symbol FROM raw"),
    "stream_agg_append": _sql(_RAW + _AGGREGATES, """
        SELECT * EXCLUDE (processing_time) FROM aggregates"""),
    "stream_dlq": _sql(_TAGGED + _LETTERS, """
        SELECT original_message, error_reason, pipeline_name FROM letters"""),
    "metrics_progress": _sql(_WIRE, """
        SELECT 'dead_letters' AS query, count(*) AS input_rows FROM wire"""),
    "stream_commits": _sql(_RAW, "SELECT count(*) AS rows, 1::BIGINT AS files, false AS falls FROM raw"),
    "stream_late_rows": _sql(_TAGGED, """
        , cuts AS (
          SELECT a + (b - a) / 3.0 AS c1, a + (b - a) * 2 / 3.0 AS c2
          FROM (SELECT epoch_us(min(ts)) AS a, epoch_us(max(ts)) AS b FROM wire)
        ), valid AS (
          SELECT n, event_id, event_ts, kafka_offset, epoch_us(kafka_timestamp) AS landed
          FROM tagged WHERE error_reason IS NULL
        ), reached AS (
          SELECT epoch_us(max(event_ts)) // 1000 - 120000 AS w FROM valid, cuts WHERE landed < c2
        ), again AS (
          SELECT event_id, event_ts, kafka_offset FROM valid, cuts WHERE landed < c1 AND n % 100 = 5
        ), came AS (
          SELECT event_id, event_ts FROM again
          UNION ALL (SELECT 'late-' || event_id, event_ts FROM again ORDER BY kafka_offset LIMIT 1)
        )
        SELECT event_id, event_ts, make_timestamp_ms(w) AS watermark FROM came, reached
        WHERE epoch_us(event_ts) <= w * 1000"""),
    "stream_endings": _sql(_TAGGED + _LETTERS, """
        SELECT 'Streaming query terminated' AS title, 'critical' AS severity,
          'raw_events' AS query, true AS reason_given, count(*) AS letters FROM letters"""),
    "staged_tables": _sql(_RAW + _AGGREGATES + _LETTERS, """
        SELECT 'raw events' AS "table", count(*) AS rows FROM raw
        UNION ALL SELECT 'aggregates', count(*) FROM aggregates
        UNION ALL SELECT 'dead letter', count(*) FROM letters
        UNION ALL SELECT 'events in windows', CAST(sum(event_count) AS BIGINT) FROM aggregates"""),
    "stream_dlq_bus": _sql(_TAGGED + _LETTERS, """
        SELECT original_message, error_reason FROM letters"""),
}
ORACLES |= {
    "stream_restart": ORACLES["stream_raw_events"],
    "stream_foreach_batch": ORACLES["stream_raw_events"],
    "compacted_raw_events": ORACLES["stream_raw_events"],
    "compacted_windows": ORACLES["stream_agg_append"],
    "table_rows_raw": ORACLES["stream_raw_events"],
    "table_rows_windows": ORACLES["stream_agg_append"],
    "table_rows_letters": ORACLES["stream_dlq"],
    "overview_page": ORACLES["top_symbols_volume"],
    "quality_page": ORACLES["letter_listing"],
    "report_files": f"""
        SELECT 'market-events' AS pipeline_name, 'test' AS environment, c.*,
          (SELECT string_agg(t.count || ' ' || t.reason, '; ' ORDER BY t.count DESC, t.reason)
           FROM ({ORACLES["dq_top_errors"]}) t) AS top_error_reasons
        FROM ({ORACLES["dq_scorecard"]}) c""",
}
