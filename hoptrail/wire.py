"""Fixed values of the record-header contract.

Everything here must match what producers write and what report readers
expect, byte for byte.
"""

# Header names. The first holds the JSON trail, the next seven describe the
# latest hop, the last one appears on consume markers only.
TRAIL = "x-isotope"
TRACE_ID = "x-isotope-trace-id"
ORIGIN_TS = "x-isotope-origin-ts"
ORIGIN_SERVICE = "x-isotope-origin-service"
PIPELINE = "x-isotope-pipeline"
THIS_SERVICE = "x-isotope-this-service"
THIS_TOPIC = "x-isotope-this-topic"
HOP_COUNT = "x-isotope-hop-count"
CONSUMER_SERVICE = "x-isotope-consumer-service"

SCALAR_HEADERS = (
    TRACE_ID,
    ORIGIN_TS,
    ORIGIN_SERVICE,
    PIPELINE,
    THIS_SERVICE,
    THIS_TOPIC,
    HOP_COUNT,
)

# Topics read by the reports: three stages and the consume markers.
PLACED = "orders.placed"
ENRICHED = "orders.enriched"
FULFILLED = "orders.fulfilled"
STAGE_TOPICS = (PLACED, ENRICHED, FULFILLED)
MARKER_TOPIC = "isotope_consume_edge_markers"
SOURCE_TOPICS = STAGE_TOPICS + (MARKER_TOPIC,)

# Services of the chain, in order; the last one only consumes.
INTAKE = "order-intake-service"
ENRICHMENT = "order-enrichment-service"
FULFILLMENT = "order-fulfillment-service"
SHIPPING = "shipping-notification-service"
CHAIN = (INTAKE, ENRICHMENT, FULFILLMENT, SHIPPING)

# Topics the reports are published to, by report table name.
REPORT_TOPICS = {
    "latency_report_1m": "isotope_report_latency_1m",
    "topology_report_1m": "isotope_report_topology_1m",
    "bipartite_topology_report_1m": "isotope_report_bipartite_topology_1m",
    "hop_distribution_1m": "isotope_report_hop_distribution_1m",
    "coverage_report_1m": "isotope_report_coverage_1m",
    "stuck_trace_alerts_1m": "isotope_report_stuck_trace_1m",
    "latency_percentiles_flat_1m": "isotope_report_latency_percentiles_1m",
    "trace_rca_1m": "isotope_report_trace_rca_1m",
}

# A trail keeps this many hops; older ones are dropped and the trail marked.
MAX_HOPS = 32

# Report window, lateness allowance and silence after which a trace is stuck.
WINDOW = "1 minute"
WINDOW_MS = 60_000
WATERMARK_DELAY = "5 seconds"
STUCK_AFTER_MS = 60_000
CHECKPOINT_EVERY = "30 seconds"

# Reported quantiles of the latency.
QUANTILES = (0.5, 0.95, 0.99)

# What the model job asks for: two sentences in fewer characters than this.
MAX_ANSWER = 400
# Labels of the facts in a prompt, in order, with the alert columns they name.
PROMPT_FACTS = {
    "pipeline": "pipeline",
    "trace_id": "trace_id",
    "last_service": "last_service",
    "last_topic": "last_topic",
    "hop_count": "last_hop_count",
    "idle_ms": "stuck_for_ms",
}
