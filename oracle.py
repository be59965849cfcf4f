"""The registered queries again, as plain SQL for an independent engine."""

from __future__ import annotations

from hoptrail.wire import CHAIN, MARKER_TOPIC, STAGE_TOPICS

INTAKE, ENRICHMENT, FULFILLMENT, SHIPPING = CHAIN
PLACED, ENRICHED, FULFILLED = STAGE_TOPICS

_TRACES = f"""
b AS (
  SELECT event_id, event_type,
         1704067200000 + CAST((ms0 - ms0 % 60) / 60 AS BIGINT)
           + 86400000 * CASE event_id % 41 WHEN 0 THEN 1 WHEN 1 THEN -1 ELSE 0 END AS origin_ms,
         ms0 // 60 >= 11400000 AND ms0 // 60 < 12000000 AND event_id % 700 <> 11 AS down
  FROM (SELECT event_id, event_type,
               CAST((epoch_us(ts) - epoch_us(ts) % 1000) / 1000 AS BIGINT) - 1704067200000 AS ms0
        FROM events) m
), h AS (
  SELECT b.event_id, b.event_type, b.origin_ms, k.k, least(k.k, 3) AS s
  FROM b CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) k
  WHERE k.k = 1
     OR (k.k = 2 AND event_id % 10 <> 9)
     OR (k.k = 3 AND event_id % 10 <> 9 AND event_id % 20 <> 8 AND NOT down)
     OR (k.k = 4 AND event_id % 97 = 0 AND event_id % 10 <> 9 AND event_id % 20 <> 8 AND NOT down)
), p AS (
  SELECT event_id, k, origin_ms, s,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN event_id % 50 = 7 THEN NULL
         ELSE concat(lpad(lower(to_hex(origin_ms)), 12, '0'), '7', lpad(lower(to_hex(event_id)), 19, '0'))
    END AS trace_id,
    CASE WHEN event_id % 500 = 13 THEN 'bad' ELSE CAST(origin_ms AS VARCHAR) END AS origin_ts,
    '{INTAKE}' AS origin_service,
    CASE WHEN event_id % 900 = 17 AND s = 2 THEN 'returns' WHEN event_id % 200 = 5 THEN NULL
         WHEN event_id % 4 = 0 THEN 'location' ELSE 'orders' END AS pipeline,
    CASE s WHEN 1 THEN '{INTAKE}' WHEN 2 THEN '{ENRICHMENT}' ELSE '{FULFILLMENT}' END AS this_service,
    CASE s WHEN 1 THEN '{PLACED}' WHEN 2 THEN '{ENRICHED}' ELSE '{FULFILLED}' END AS this_topic,
    CAST(CASE WHEN event_id % 700 = 11 AND s = 2 THEN NULL WHEN event_id % 1000 = 1 THEN 32 ELSE s END AS INTEGER)
      AS hop_count,
    CASE s WHEN 1 THEN '{ENRICHMENT}' WHEN 2 THEN '{FULFILLMENT}' ELSE '{SHIPPING}' END AS next_service,
    origin_ms + (s - 1) * (200 + (event_id * 7919) % 4000)
      + CASE WHEN event_id % 25 = 3 AND s = 3 THEN 90000 ELSE 0 END
      + CASE WHEN k = 4 THEN 1500 ELSE 0 END AS event_ms
  FROM h
), raw AS (
  SELECT event_id, status, this_topic AS kafka_topic, event_ms, trace_id, origin_ts, origin_service,
         pipeline, this_service, this_topic, hop_count, CAST(NULL AS VARCHAR) AS consumer_service
  FROM p
  UNION ALL
  SELECT event_id, status, '{MARKER_TOPIC}', event_ms + 50 + event_id % 300, trace_id, origin_ts,
         origin_service, pipeline, this_service, this_topic, hop_count, next_service
  FROM p WHERE event_id % 40 <> 2
), sig AS (
  SELECT *, TRY_CAST(origin_ts AS BIGINT) AS origin_ts_ms,
         event_ms - TRY_CAST(origin_ts AS BIGINT) AS latency_ms,
         event_ms - event_ms % 60000 AS window_start, event_ms - event_ms % 60000 + 60000 AS window_end
  FROM raw WHERE trace_id IS NOT NULL
), produce AS (SELECT * FROM sig WHERE consumer_service IS NULL),
consume AS (SELECT * FROM sig WHERE consumer_service IS NOT NULL)"""


def _query(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((_TRACES, *ctes)) + "\n" + body


_STUCK = """stuck AS (
  SELECT trace_id, origin_service, pipeline, this_service AS last_service, this_topic AS last_topic,
         hop_count AS last_hop_count, event_ms AS last_seen_ts_ms, CAST(60000 AS BIGINT) AS stuck_for_ms,
         CAST(event_id % 6 AS INTEGER) AS kafka_partition
  FROM (SELECT *, lead(event_ms) OVER (PARTITION BY trace_id ORDER BY event_ms, hop_count) AS next_ms
        FROM produce) o
  WHERE next_ms IS NULL OR next_ms - event_ms >= 60000
)"""

_LATENCY = """SELECT window_start, window_end, pipeline, origin_service, this_topic,
       count(*) AS sample_count, count(DISTINCT trace_id) AS distinct_traces,
       avg(CAST(latency_ms AS DOUBLE)) AS avg_latency_ms,
       min(latency_ms) AS min_latency_ms, max(latency_ms) AS max_latency_ms
FROM produce GROUP BY 1, 2, 3, 4, 5"""

_PERCENTILES = """SELECT window_start, window_end, pipeline, origin_service, this_topic,
       round(quantile_cont(CAST(latency_ms AS DOUBLE), 0.5), 6) AS p50_ms,
       round(quantile_cont(CAST(latency_ms AS DOUBLE), 0.95), 6) AS p95_ms,
       round(quantile_cont(CAST(latency_ms AS DOUBLE), 0.99), 6) AS p99_ms,
       count(*) AS sample_count
FROM produce WHERE latency_ms IS NOT NULL GROUP BY 1, 2, 3, 4, 5"""


def _near(dims: str) -> str:
    """Sketches are within their stated rank error wherever there are samples."""
    return f"""SELECT {dims}, count(*) AS sample_count, true AS p50_near, true AS p95_near, true AS p99_near
               FROM produce WHERE latency_ms IS NOT NULL GROUP BY ALL"""


def _reports() -> dict[str, str]:
    return {
        "raw_union": _query(
            """SELECT event_ms, kafka_topic, CAST(event_id % 6 AS INTEGER) AS kafka_partition,
               event_id AS kafka_offset,
               CAST((trace_id IS NOT NULL)::INT + 3 + (pipeline IS NOT NULL)::INT + 2
                 + (consumer_service IS NOT NULL)::INT AS INTEGER) AS header_entries
               FROM raw"""
        ),
        "produce_view": _query(
            """SELECT trace_id, origin_ts_ms, origin_service, pipeline, this_service, this_topic,
               hop_count, event_ms, latency_ms FROM produce"""
        ),
        "consume_view": _query(
            """SELECT trace_id, origin_ts_ms, origin_service, pipeline, this_service AS producer_service,
               this_topic AS consumed_topic, consumer_service, hop_count AS hop_count_at_consume, event_ms
               FROM consume"""
        ),
        "latency_1m": _query(_LATENCY),
        "topology_1m": _query(
            """SELECT window_start, window_end, pipeline, origin_service, this_service AS producer_service,
               this_topic AS topic, count(*) AS records, count(DISTINCT trace_id) AS distinct_traces
               FROM produce GROUP BY 1, 2, 3, 4, 5, 6"""
        ),
        "bipartite_topology_1m": _query(
            """SELECT window_start, window_end, pipeline, 'produce' AS edge_type,
               this_service AS producer_service, this_topic AS topic,
               CAST(NULL AS VARCHAR) AS consumer_service, origin_service,
               count(*) AS records, count(DISTINCT trace_id) AS distinct_traces
               FROM produce GROUP BY ALL
               UNION ALL
               SELECT window_start, window_end, pipeline, 'consume', CAST(NULL AS VARCHAR), this_topic,
               consumer_service, origin_service, count(*), count(DISTINCT trace_id)
               FROM consume GROUP BY ALL"""
        ),
        "hop_distribution_1m": _query(
            """SELECT window_start, window_end, pipeline, this_topic, hop_count,
               count(*) AS records, count(DISTINCT trace_id) AS distinct_traces
               FROM produce GROUP BY 1, 2, 3, 4, 5"""
        ),
        "coverage_1m": _query(
            """SELECT window_start, window_end, pipeline, this_topic, origin_service,
               count(DISTINCT trace_id) AS distinct_traces, count(*) AS records
               FROM produce GROUP BY 1, 2, 3, 4, 5"""
        ),
        "topic_fan_in": _query(
            """SELECT kafka_topic, event_ms - event_ms % 3600000 AS hour, count(*) AS records
               FROM raw GROUP BY 1, 2"""
        ),
        "latency_percentiles_1m": _query(_PERCENTILES),
        "latency_percentiles_approx": _query(_near("window_start, pipeline, origin_service, this_topic")),
        "latency_percentiles_kll": _query(_near("window_start, pipeline, origin_service, this_topic")),
        "latency_sketch_rollup": _query(_near("pipeline")),
        "stuck_trace": _query("SELECT * EXCLUDE (kafka_partition) FROM stuck", _STUCK),
        "untagged_rate": _query(
            """SELECT kafka_topic, count(*) AS records,
               count(*) FILTER (WHERE trace_id IS NULL) AS untagged,
               count(*) FILTER (WHERE trace_id IS NULL) / count(*) AS untagged_rate
               FROM raw GROUP BY 1"""
        ),
        "rejected_headers": _query(
            """SELECT kafka_topic, count(*) AS tagged,
               count(*) FILTER (WHERE origin_ts = 'bad') AS bad_origin_ts,
               count(*) FILTER (WHERE event_id % 700 = 11 AND hop_count IS NULL) AS bad_hop_count
               FROM raw WHERE trace_id IS NOT NULL GROUP BY 1"""
        ),
        "trace_age": _query(
            """SELECT trace_id, this_topic, event_ms, 1704110400000 - origin_ts_ms AS age_ms FROM produce"""
        ),
    }


_PROMPT = """'pipeline=' || pipeline || ' trace_id=' || trace_id || ' last_service=' || last_service
      || ' last_topic=' || last_topic || ' hop_count=' || CAST(last_hop_count AS VARCHAR)
      || ' idle_ms=' || CAST(stuck_for_ms AS VARCHAR)"""

_STAGE = f"CASE this_topic WHEN '{PLACED}' THEN 1 WHEN '{ENRICHED}' THEN 2 ELSE 3 END"

# Hops of the JSON trail of each produced record: earlier stages at their
# planned time, the last one when it was really sent.
_HOPS = f"""staged AS (
  SELECT produce.*, {_STAGE} AS stage, b.origin_ms FROM produce JOIN b ON b.event_id = produce.event_id
), hops AS (
  SELECT r.*, j.pos + CASE WHEN r.stage = 1 AND r.event_id % 1000 = 1 THEN 31 ELSE 0 END AS pos,
    CASE WHEN j.pos = 3 AND r.event_id % 1300 = 24 THEN 'other-service' WHEN j.pos = 1 THEN '{INTAKE}'
         WHEN j.pos = 2 THEN '{ENRICHMENT}' ELSE '{FULFILLMENT}' END AS hop_service,
    CASE WHEN j.pos = 3 AND r.event_id % 1300 = 25 THEN 'other.topic' WHEN j.pos = 1 THEN '{PLACED}'
         WHEN j.pos = 2 THEN '{ENRICHED}' ELSE '{FULFILLED}' END AS hop_topic,
    CASE WHEN j.pos = r.stage THEN r.event_ms
         WHEN j.pos = 1 AND r.stage = 3 AND r.event_id % 1300 = 26 THEN r.event_ms + 1000
         ELSE r.origin_ms + (j.pos - 1) * (200 + (r.event_id * 7919) % 4000) END AS hop_ms
  FROM staged r JOIN (SELECT 1 AS pos UNION ALL SELECT 2 UNION ALL SELECT 3) j ON j.pos <= r.stage
  UNION ALL
  SELECT r.*, k.pos, '{INTAKE}', '{PLACED}', r.origin_ms - (32 - k.pos)
  FROM staged r JOIN (SELECT unnest(range(1, 32)) AS pos) k ON r.stage = 1 AND r.event_id % 1000 = 1
)"""

_ALL_STEPS = """steps AS (
  SELECT trace_id, event_ms, CASE WHEN consumer_service IS NULL THEN 'produce' ELSE 'consume' END AS step,
         coalesce(consumer_service, this_service) AS service, this_topic AS topic, hop_count
  FROM sig
)"""

# The five one-minute-step windows a minute belongs to.
_SLIDE = "(SELECT 0 AS back UNION ALL SELECT 60000 UNION ALL SELECT 120000 UNION ALL SELECT 180000 UNION ALL SELECT 240000)"


def _sliding(source: str) -> str:
    return f"""slid AS (SELECT t.* EXCLUDE (window_start, window_end), t.window_start - o.back AS window_start
  FROM {source} t CROSS JOIN {_SLIDE} o)"""


def _path(rows: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY event_ms, {order}) AS pos FROM ({rows})"


def _wrong(remainder: int) -> str:
    return f"count(*) FILTER (WHERE s = 3 AND event_id % 1300 = {remainder})"


def _trails() -> dict[str, str]:
    path = _path(
        """SELECT trace_id, event_ms, this_service AS service, this_topic AS topic, hop_count FROM produce""",
        "hop_count, topic, service",
    )
    relayed = f"""WITH_PLACED AS (
      SELECT *, event_ms + 250 AS sent_ms,
        sha256(concat_ws('|', '{PLACED}', CAST(event_id % 6 AS VARCHAR), CAST(event_id AS VARCHAR))) AS digest
      FROM raw WHERE kafka_topic = '{PLACED}'
    ), fresh AS (
      SELECT p.*, b.origin_ms, concat(lpad(lower(to_hex(sent_ms)), 12, '0'), '7', substr(digest, 1, 3),
             substr('89ab', (strpos('0123456789abcdef', substr(digest, 4, 1)) - 1) % 4 + 1, 1),
             substr(digest, 5, 15)) AS new_id
      FROM WITH_PLACED p JOIN b ON b.event_id = p.event_id
    )"""
    old_hop = f"""concat(CASE WHEN event_id % 1000 = 1 THEN list_aggregate(list_transform(range(2, 32), lambda k:
      concat('{INTAKE}>{PLACED}>', CAST(origin_ms - (32 - k) AS VARCHAR), ',')), 'string_agg', '') ELSE '' END,
      '{INTAKE}>{PLACED}>', CAST(event_ms AS VARCHAR), ',')"""
    return {
        "id_time": _query(
            "SELECT DISTINCT trace_id, b.origin_ms AS id_ms FROM produce JOIN b ON b.event_id = produce.event_id"
        ),
        "rca_prompt": _query(
            f"""SELECT trace_id, pipeline, last_service, last_topic, stuck_for_ms, {_PROMPT} AS prompt FROM stuck""",
            _STUCK,
        ),
        "trace_rca": _query(
            f"""SELECT trace_id, pipeline, last_service, last_topic, stuck_for_ms,
                CASE WHEN ({_PROMPT}) IS NOT NULL AND last_hop_count = 1
                THEN 'Nothing consumed ' || last_topic || '. Check its consumer.' END AS root_cause FROM stuck""",
            _STUCK,
        ),
        "trace_rca_answers": _query(
            f"""SELECT pipeline, count(*) AS alerts, count({_PROMPT}) AS answers,
                count(*) FILTER (WHERE ({_PROMPT}) IS NOT NULL AND last_hop_count <> 1) AS rejected
                FROM stuck GROUP BY 1""",
            _STUCK,
        ),
        "trail_hops": _query(
            """SELECT kafka_topic, CAST(event_id % 6 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
               CASE WHEN stage = 3 AND event_id % 1300 = 21
                 THEN concat(substr(trace_id, 1, 13), 'f', substr(trace_id, 15)) ELSE trace_id END AS trace_id,
               CAST(pos AS INTEGER) AS pos, hop_service AS service, hop_topic AS topic,
               hop_ms AS ts_ms, event_id % 1000 = 1 AS truncated FROM hops""",
            _HOPS,
        ),
        "trail_violations": _query(
            f"""SELECT kafka_topic, count(*) AS trails, {_wrong(21)} AS id_differs,
               count(*) FILTER (WHERE origin_ts = 'bad' OR (s = 3 AND event_id % 1300 = 22)) AS origin_ts_differs,
               {_wrong(23)} AS origin_service_differs,
               count(*) FILTER (WHERE s = 2 AND event_id % 900 = 17) AS pipeline_differs,
               {_wrong(24)} AS service_differs, {_wrong(25)} AS topic_differs,
               count(*) FILTER (WHERE coalesce(hop_count <> s, TRUE) AND NOT (s = 1 AND event_id % 1000 = 1))
                 AS hop_count_differs,
               {_wrong(26)} AS backwards, {_wrong(22)} AS id_time_differs
               FROM (SELECT *, {_STAGE} AS s FROM produce) GROUP BY 1"""
        ),
        "untagged_trail_records": _query(
            """SELECT kafka_topic, count(*) AS records FROM raw
               WHERE trace_id IS NULL OR consumer_service IS NOT NULL GROUP BY 1"""
        ),
        "trace_path": _query(path),
        "l26_dated_path": _query(
            f"""SELECT q.*, strftime(make_timestamp(b.origin_ms * 1000), '%Y-%m-%d') AS origin_day
                FROM ({path}) q JOIN (SELECT DISTINCT trace_id, event_id FROM produce) k USING (trace_id)
                JOIN b USING (event_id)
                WHERE q.event_ms >= epoch_ms(DATE '2024-01-01') AND q.event_ms < epoch_ms(DATE '2024-01-02')"""
        ),
        "l26_one_trace": _query(
            "SELECT * FROM ("
            + _path("FROM steps", "hop_count, step, topic, service")
            + ") WHERE trace_id = (SELECT min(trace_id) FROM produce WHERE hop_count = 32)",
            _ALL_STEPS,
        ),
        "l28_trace_journey": _query(_path("FROM steps", "hop_count, step, topic, service"), _ALL_STEPS),
        "relay_output": _query(
            f"""SELECT coalesce(trace_id, new_id) AS trace_id,
                CASE WHEN trace_id IS NULL THEN sent_ms ELSE origin_ms END AS origin_ts_ms,
                CASE WHEN trace_id IS NULL THEN '{ENRICHMENT}' ELSE origin_service END AS origin_service,
                CASE WHEN trace_id IS NULL THEN 'orders' ELSE pipeline END AS pipeline,
                '{ENRICHMENT}' AS this_service, '{ENRICHED}' AS this_topic,
                CAST(CASE WHEN trace_id IS NULL THEN 1 WHEN event_id % 1000 = 1 THEN 32 ELSE 2 END AS INTEGER)
                  AS hop_count,
                event_id, '{ENRICHED}' AS kafka_topic,
                concat(CASE WHEN trace_id IS NULL THEN '' ELSE {old_hop} END,
                       '{ENRICHMENT}>{ENRICHED}>', CAST(sent_ms AS VARCHAR)) AS hops,
                trace_id IS NOT NULL AND hop_count >= 32 AS truncated, sent_ms AS event_ms,
                concat('k', CAST(event_id % 100 AS VARCHAR)) AS key, CAST(event_id AS VARCHAR) AS value
                FROM fresh""",
            relayed.replace("WITH_PLACED", "placed_rows"),
        ),
        "started_traces": _query(
            f"""SELECT new_id AS trace_id, sent_ms AS origin_ts_ms, '{INTAKE}' AS origin_service,
                'orders' AS pipeline, '{INTAKE}' AS this_service, '{PLACED}' AS this_topic,
                CAST(1 AS INTEGER) AS hop_count, CAST(0 AS BIGINT) AS latency_ms, event_id, sent_ms AS event_ms
                FROM fresh WHERE trace_id IS NULL""",
            relayed.replace("WITH_PLACED", "placed_rows").replace("event_ms + 250", "event_ms"),
        ),
        "consume_markers": _query(
            f"""SELECT trace_id, origin_ts_ms, origin_service, pipeline, this_service AS producer_service,
                this_topic AS consumed_topic, '{FULFILLMENT}' AS consumer_service,
                hop_count AS hop_count_at_consume, '{MARKER_TOPIC}' AS kafka_topic, event_ms + 50 AS event_ms,
                CAST(NULL AS VARCHAR) AS key
                FROM produce WHERE kafka_topic = '{ENRICHED}'"""
        ),
    }


def _counted(view: str, dims: str) -> str:
    return _query(f"SELECT window_start, {dims}, count(*) AS records FROM {view} GROUP BY ALL")


_AVG_S = "sum(CAST(latency_ms AS DOUBLE)) / 1000 / nullif(count(latency_ms), 0)"


def _meters() -> dict[str, str]:
    minutes = """minutes AS (SELECT window_start, count(latency_ms) AS n,
      sum(CAST(latency_ms AS DOUBLE)) AS total FROM produce GROUP BY 1)"""
    return {
        "k01_avg_latency": _query(
            f"""SELECT window_start, pipeline, origin_service, this_topic, {_AVG_S} AS avg_seconds
                FROM produce GROUP BY 1, 2, 3, 4"""
        ),
        "k02_max_latency": _query(
            """SELECT window_start, pipeline, origin_service, this_topic, max(latency_ms) / 1000 AS max_seconds
               FROM produce GROUP BY 1, 2, 3, 4"""
        ),
        "k03_produce_edges": _counted("produce", "pipeline, origin_service, this_service, this_topic"),
        "k04_hop_counts": _counted("produce", "pipeline, this_topic, hop_count"),
        "k05_consume_edges": _counted("consume", "pipeline, this_topic, consumer_service"),
        "k06_time_to_consume": _query(
            f"""SELECT window_start, pipeline, consumer_service, this_topic, {_AVG_S} AS avg_seconds
                FROM consume GROUP BY 1, 2, 3, 4"""
        ),
        "k07_consume_age": _query(
            f"""SELECT window_start, pipeline, consumer_service, this_topic, {_AVG_S} AS avg_age_seconds
                FROM consume GROUP BY 1, 2, 3, 4"""
        ),
        "k08_consumer_throughput": _counted("consume", "consumer_service"),
        "k09_failure_ratio": _query(
            """SELECT window_start, this_service,
               count(*) FILTER (WHERE status <> 'success') / greatest(CAST(count(*) AS DOUBLE), 1e-9) AS failure_ratio
               FROM slid GROUP BY 1, 2""",
            _sliding("produce"),
        ),
        "k10_completion_share": _query(
            """SELECT window_start,
               count(*) FILTER (WHERE hop_count = 3) / greatest(CAST(count(*) AS DOUBLE), 1e-9) AS completion_share
               FROM slid GROUP BY 1""",
            _sliding("produce"),
        ),
        "k11_lagging_consumers": _query(
            f"""SELECT * FROM (SELECT window_start, consumer_service, {_AVG_S} AS avg_age_seconds
                FROM slid GROUP BY 1, 2) a WHERE avg_age_seconds > 30""",
            _sliding("consume"),
        ),
        "k12_silent_services": _query(
            """SELECT f.this_service, g.window_start
               FROM (SELECT this_service, min(window_start) AS first_ms FROM produce GROUP BY 1) f
               CROSS JOIN (SELECT unnest(generate_series(lo, hi, 60000)) AS window_start
                           FROM (SELECT min(window_start) AS lo, max(window_start) - 60000 AS hi FROM produce) e) g
               WHERE g.window_start > f.first_ms
                 AND NOT EXISTS (SELECT 1 FROM active a WHERE a.this_service = f.this_service
                                 AND a.window_start = g.window_start)
                 AND NOT EXISTS (SELECT 1 FROM active a WHERE a.this_service = f.this_service
                                 AND a.window_start = g.window_start + 60000)""",
            "active AS (SELECT DISTINCT this_service, window_start FROM produce)",
        ),
        "k12_silent_by_pipeline": _query(
            """SELECT f.pipeline, f.this_service, g.window_start
               FROM (SELECT pipeline, this_service, min(window_start) AS first_ms FROM produce GROUP BY 1, 2) f
               CROSS JOIN (SELECT unnest(generate_series(lo, hi, 60000)) AS window_start
                           FROM (SELECT min(window_start) AS lo, max(window_start) - 60000 AS hi FROM produce) e) g
               WHERE g.window_start > f.first_ms
                 AND NOT EXISTS (SELECT 1 FROM active a WHERE a.this_service = f.this_service
                                 AND a.pipeline IS NOT DISTINCT FROM f.pipeline
                                 AND (a.window_start = g.window_start OR a.window_start = g.window_start + 60000))""",
            "active AS (SELECT DISTINCT pipeline, this_service, window_start FROM produce)",
        ),
        "k13_drop_off": _query(
            f"""SELECT window_start,
                count(*) FILTER (WHERE consumer_service IS NOT NULL AND this_topic = '{ENRICHED}')
                - count(*) FILTER (WHERE consumer_service IS NOT NULL AND this_topic = '{FULFILLED}') AS consumed_drop,
                count(*) FILTER (WHERE consumer_service IS NULL AND this_topic = '{ENRICHED}')
                - count(*) FILTER (WHERE consumer_service IS NULL AND this_topic = '{FULFILLED}') AS produced_drop
                FROM slid WHERE this_topic IN ('{ENRICHED}', '{FULFILLED}') GROUP BY 1""",
            _sliding("sig"),
        ),
        "k14_end_to_end_latency": _query(
            f"""SELECT window_start, {_AVG_S} AS avg_seconds FROM consume
                WHERE consumer_service = '{SHIPPING}' GROUP BY 1"""
        ),
        "k15_hop_ceiling": _query(
            "SELECT window_start, count(*) AS records FROM slid WHERE hop_count = 32 GROUP BY 1",
            _sliding("produce"),
        ),
        "k16_pipeline_records": _counted("produce", "pipeline"),
        "k17_topic_records": _counted("produce", "this_topic"),
        "k18_latency_change": _query(
            """SELECT n.window_start, n.avg AS now_seconds, e.avg AS earlier_seconds,
               n.avg - e.avg AS change_seconds
               FROM averages n JOIN averages e ON e.window_start = n.window_start - 7200000
               WHERE n.avg IS NOT NULL AND e.avg IS NOT NULL""",
            _sliding("produce"),
            f"averages AS (SELECT window_start, {_AVG_S} AS avg FROM slid GROUP BY 1)",
        ),
        "k19_pass_through": _query(
            f"""SELECT window_start,
                count(*) FILTER (WHERE consumer_service = '{SHIPPING}') / CAST(nullif(count(*) FILTER (
                  WHERE consumer_service IS NULL AND this_topic = '{PLACED}'), 0) AS DOUBLE) AS pass_through
                FROM slid WHERE consumer_service = '{SHIPPING}'
                   OR (consumer_service IS NULL AND this_topic = '{PLACED}') GROUP BY 1""",
            _sliding("sig"),
        ),
        "k20_new_services": _query(
            """SELECT this_service, window_start FROM active n WHERE NOT EXISTS (
                 SELECT 1 FROM active e WHERE e.this_service = n.this_service
                 AND e.window_start = n.window_start - 3600000)""",
            "active AS (SELECT DISTINCT this_service, window_start FROM produce)",
        ),
        "k21_pipeline_filter": _query(
            """SELECT window_start, pipeline, this_service, count(*) AS records FROM produce
               WHERE regexp_full_match(pipeline, 'ord.*') GROUP BY 1, 2, 3"""
        ),
        "k21_pipelines": _query("SELECT DISTINCT pipeline FROM produce WHERE pipeline IS NOT NULL"),
    }


def _questions() -> dict[str, str]:
    deploy = 1704088800000
    unfinished = f"unfinished AS (SELECT * FROM stuck WHERE last_topic <> '{FULFILLED}')"
    placed = f"(SELECT DISTINCT trace_id, pipeline FROM produce WHERE this_topic = '{PLACED}')"
    done = f"(SELECT DISTINCT trace_id FROM consume WHERE consumer_service = '{SHIPPING}')"

    def lost(first: str, second: str) -> str:
        return f"""SELECT '{first}' AS from_topic, '{second}' AS to_topic, count(*) AS traces,
          count(*) FILTER (WHERE b.trace_id IS NULL) AS lost
          FROM (SELECT DISTINCT trace_id FROM produce WHERE this_topic = '{first}') a
          LEFT JOIN (SELECT DISTINCT trace_id FROM produce WHERE this_topic = '{second}') b USING (trace_id)"""

    def survived(service: str) -> str:
        return f"""SELECT '{service}' AS service, count(*) AS consumed_traces, count(s.trace_id) AS sent_on
          FROM (SELECT DISTINCT trace_id FROM consume WHERE consumer_service = '{service}') c
          LEFT JOIN (SELECT DISTINCT trace_id FROM produce WHERE this_service = '{service}') s USING (trace_id)"""

    return {
        "l01_record_tags": _query(
            """SELECT kafka_topic, CAST(event_id % 6 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
               trace_id IS NOT NULL AS tagged, origin_service, hop_count FROM raw"""
        ),
        "l05_relay_survival": _query(survived(ENRICHMENT) + " UNION ALL " + survived(FULFILLMENT)),
        "l06_trace_pipeline": _query(
            """SELECT trace_id, max(pipeline) AS pipeline, count(DISTINCT coalesce(pipeline, '')) = 1 AS consistent
               FROM produce GROUP BY 1"""
        ),
        "l08_service_graph": _query(
            """SELECT window_start, pipeline, this_service AS producer_service, this_topic AS topic,
               consumer_service, count(*) AS records, count(DISTINCT trace_id) AS distinct_traces
               FROM consume GROUP BY 1, 2, 3, 4, 5"""
        ),
        "l12_traces_per_pipeline": _query(
            """SELECT window_start, pipeline, count(DISTINCT trace_id) AS distinct_traces, count(*) AS records
               FROM produce GROUP BY 1, 2"""
        ),
        "l13_latency_around": _query(
            f"""SELECT *, after_ms - before_ms AS change_ms FROM (
                SELECT pipeline, this_topic,
                  avg(CAST(latency_ms AS DOUBLE)) FILTER (WHERE event_ms < {deploy}) AS before_ms,
                  avg(CAST(latency_ms AS DOUBLE)) FILTER (WHERE event_ms >= {deploy}) AS after_ms
                FROM produce WHERE event_ms >= {deploy} - 7200000 AND event_ms < {deploy} + 7200000
                GROUP BY 1, 2) a"""
        ),
        "l14_completion": _query(
            f"""SELECT p.pipeline, count(*) AS placed, count(d.trace_id) AS completed,
                count(d.trace_id) / count(*) AS completion_share
                FROM {placed} p LEFT JOIN {done} d USING (trace_id) GROUP BY 1"""
        ),
        "l15_lost_between": _query(lost(PLACED, ENRICHED) + " UNION ALL " + lost(ENRICHED, FULFILLED)),
        "l16_duplicates": _query(
            f"""SELECT trace_id, consumer_service, count(*) AS times FROM consume
                WHERE consumer_service = '{SHIPPING}' GROUP BY 1, 2 HAVING count(*) > 1"""
        ),
        "l17_unfinished": _query("SELECT * EXCLUDE (kafka_partition) FROM unfinished", _STUCK, unfinished),
        "l19_first_appearance": _query(
            "SELECT this_service, min(window_start) AS first_window_start FROM produce GROUP BY 1"
        ),
        "l20_pipeline_percentiles": _query(
            """SELECT pipeline,
               round(quantile_cont(CAST(latency_ms AS DOUBLE), 0.5), 6) AS p50_ms,
               round(quantile_cont(CAST(latency_ms AS DOUBLE), 0.95), 6) AS p95_ms,
               round(quantile_cont(CAST(latency_ms AS DOUBLE), 0.99), 6) AS p99_ms,
               count(*) AS sample_count
               FROM produce WHERE latency_ms IS NOT NULL GROUP BY 1"""
        ),
        "l21_worst_minute": _query(
            """SELECT w.window_start, w.pipeline, w.origin_service, w.this_topic, w.p99_ms,
               p.trace_id, p.latency_ms
               FROM (SELECT * FROM percentiles ORDER BY p99_ms DESC, window_start,
                     pipeline NULLS FIRST, origin_service NULLS FIRST, this_topic NULLS FIRST LIMIT 1) w
               JOIN produce p ON p.window_start = w.window_start
                AND p.pipeline IS NOT DISTINCT FROM w.pipeline
                AND p.origin_service IS NOT DISTINCT FROM w.origin_service
                AND p.this_topic IS NOT DISTINCT FROM w.this_topic
                AND p.latency_ms >= w.p99_ms""",
            f"percentiles AS ({_PERCENTILES})",
        ),
        "l22_topology_drift": _query(
            """SELECT coalesce(s.edge_type, d.edge_type) AS edge_type, coalesce(s.service, d.service) AS service,
               coalesce(s.topic, d.topic) AS topic,
               CASE WHEN d.edge_type IS NULL THEN 'undocumented' ELSE 'missing' END AS drift
               FROM seen s FULL OUTER JOIN documented d
                 ON s.edge_type = d.edge_type AND s.service = d.service AND s.topic = d.topic
               WHERE s.edge_type IS NULL OR d.edge_type IS NULL""",
            """seen AS (SELECT DISTINCT CASE WHEN consumer_service IS NULL THEN 'produce' ELSE 'consume' END AS edge_type,
               coalesce(consumer_service, this_service) AS service, this_topic AS topic FROM sig)""",
            f"""documented(edge_type, service, topic) AS (VALUES
               ('produce', '{INTAKE}', '{PLACED}'), ('consume', '{ENRICHMENT}', '{PLACED}'),
               ('produce', '{ENRICHMENT}', '{ENRICHED}'), ('consume', '{FULFILLMENT}', '{ENRICHED}'),
               ('produce', '{FULFILLMENT}', '{FULFILLED}'), ('produce', '{SHIPPING}', 'orders.shipped'))""",
        ),
        "l23_stuck_rate": _query(
            f"""SELECT t.period, coalesce(a.alerts, 0) AS alerts, t.traces,
                coalesce(a.alerts, 0) / t.traces AS stuck_rate
                FROM (SELECT CASE WHEN first_ms < {deploy} THEN 'before' ELSE 'after' END AS period,
                             count(*) AS traces
                      FROM (SELECT trace_id, min(event_ms) AS first_ms FROM produce GROUP BY 1) f GROUP BY 1) t
                LEFT JOIN (SELECT CASE WHEN last_seen_ts_ms < {deploy} THEN 'before' ELSE 'after' END AS period,
                             count(*) AS alerts FROM unfinished GROUP BY 1) a USING (period)""",
            _STUCK,
            unfinished,
        ),
        "l24_stuck_breakdown": _query(
            """SELECT last_service, kafka_partition,
               CAST(last_seen_ts_ms // 3600000 % 24 AS INTEGER) AS hour, count(*) AS alerts
               FROM stuck GROUP BY 1, 2, 3""",
            _STUCK,
        ),
        "l27_missed_services": _query(
            f"""SELECT t.trace_id, string_agg(e.service, ',' ORDER BY e.rank) AS missing
                FROM (SELECT DISTINCT trace_id FROM produce) t
                CROSS JOIN (VALUES (1, '{INTAKE}'), (2, '{ENRICHMENT}'), (3, '{FULFILLMENT}')) e(rank, service)
                LEFT JOIN (SELECT DISTINCT trace_id, this_service FROM produce) v
                  ON v.trace_id = t.trace_id AND v.this_service = e.service
                WHERE v.trace_id IS NULL GROUP BY 1"""
        ),
        "l29_audit": _query(
            f"""SELECT CASE WHEN d.trace_id IS NOT NULL AND u.trace_id IS NOT NULL THEN 'completed after alert'
                       WHEN d.trace_id IS NOT NULL THEN 'completed'
                       WHEN u.trace_id IS NOT NULL THEN 'stuck' ELSE 'violation' END AS outcome,
                count(*) AS traces
                FROM {placed} p LEFT JOIN {done} d USING (trace_id)
                LEFT JOIN (SELECT DISTINCT trace_id FROM unfinished) u USING (trace_id) GROUP BY 1""",
            _STUCK,
            unfinished,
        ),
        "l12_traces_across_days": _query(
            """SELECT pipeline, count(DISTINCT trace_id) AS distinct_traces, TRUE AS near FROM produce GROUP BY 1"""
        ),
        "l15_lost_across_days": _query(
            f"""SELECT f.topic AS from_topic, f.next AS to_topic, count(*) AS traces,
                count(*) FILTER (WHERE NOT EXISTS (
                  SELECT 1 FROM produce n WHERE n.trace_id = f.trace_id AND n.this_topic = f.next)) AS lost, TRUE AS near
                FROM (SELECT DISTINCT trace_id, this_topic AS topic,
                        CASE this_topic WHEN '{PLACED}' THEN '{ENRICHED}' ELSE '{FULFILLED}' END AS next
                      FROM produce WHERE this_topic <> '{FULFILLED}') f GROUP BY 1, 2"""
        ),
        "l30_correlated": _query(
            """SELECT t.event_id, t.trace_id, t.records, t.last_ms, e.user_id, e.event_type
               FROM (SELECT event_id, trace_id, count(*) AS records, max(event_ms) AS last_ms
                     FROM produce GROUP BY 1, 2) t JOIN events e USING (event_id)"""
        ),
    }


def _replays(batch: dict[str, str]) -> dict[str, str]:
    """What streams say once a day without records has passed."""
    minutes = """minutes AS (
      SELECT this_service, window_start, lag(window_start) OVER s AS before, lead(window_start) OVER s AS after
      FROM (SELECT DISTINCT this_service, window_start FROM produce)
      WINDOW s AS (PARTITION BY this_service ORDER BY window_start)
    )"""
    return {
        "stuck_trace_replayed": batch["stuck_trace"],
        "l14_completion_replayed": batch["l14_completion"],
        "l29_audit_replayed": batch["l29_audit"],
        "k12_silent_services_replayed": _query(
            """SELECT this_service, unnest(range(window_start + 60000,
                 least(coalesce(after - 120000, window_start + 3600000), window_start + 3540000) + 1, 60000))
                 AS window_start
               FROM minutes""",
            minutes,
        ),
        "k20_new_services_replayed": _query(
            """SELECT m.this_service, m.window_start, before IS NULL OR window_start - before >= 86400000 AS first
               FROM minutes m WHERE before IS NULL OR window_start - before >= 86400000 OR NOT EXISTS (
                 SELECT 1 FROM minutes e
                 WHERE e.this_service = m.this_service AND e.window_start = m.window_start - 3600000)""",
            minutes,
        ),
        "k13_drop_off_replayed": _query(
            f"""SELECT window_start, consumed, count(*) AS traces, count(*) FILTER (WHERE NOT came) AS dropped
                FROM (SELECT s.window_start, s.trace_id, s.consumer_service IS NOT NULL AS consumed,
                        bool_or(c.trace_id IS NOT NULL) AS came
                      FROM sig s LEFT JOIN sig c ON c.trace_id = s.trace_id AND c.this_topic = '{FULFILLED}'
                        AND (c.consumer_service IS NULL) = (s.consumer_service IS NULL)
                        AND c.event_ms BETWEEN s.event_ms - 300000 AND s.event_ms + 300000
                      WHERE s.this_topic = '{ENRICHED}' GROUP BY ALL) GROUP BY ALL"""
        ),
    }


def all_queries() -> dict[str, str]:
    batch = _reports() | _trails() | _meters() | _questions()
    return batch | _replays(batch)
