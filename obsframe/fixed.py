"""Fixed values.

Everything in this module is a constant that results depend on: default bucket
bounds, level rules, reason phrases, metric and label names.  Operators take all
of them as parameters; these are only the defaults.
"""

# -- fixed values: service and metric names ---------------------------------
SERVICE = "bookapp"
INGESTION_TOPIC = "book_ingestion"
CALLS_METRIC = "traces_spanmetrics_calls_total"
LATENCY_METRIC = "traces_spanmetrics_latency"
EDGE_REQUESTS_METRIC = "traces_service_graph_request_total"
EDGE_FAILED_METRIC = "traces_service_graph_request_failed_total"
EDGE_SERVER_METRIC = "traces_service_graph_request_server_seconds"
EDGE_CLIENT_METRIC = "traces_service_graph_request_client_seconds"
LOG_COUNT_METRIC = "bt_service_log_count"
SPAN_EVENT_COUNT_METRIC = "bt.span.event.count"
SQL_BOOKS_METRIC = "bt.sql_books_count"

# -- fixed values: attribute of the link from a consumed message to its producer ---
LINK_ATTRIBUTE = ("somekey", "somevalue")

# -- fixed values: histogram bounds in seconds, upper bound inclusive ---------
SPAN_BOUNDS = (0.002, 0.004, 0.008, 0.016, 0.032, 0.064, 0.128, 0.256, 0.512, 1.02, 2.05, 4.10)
EDGE_BOUNDS = (0.1, 0.2, 0.4, 0.8, 1.6, 3.2, 6.4, 12.8)
HTTP_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)

# -- fixed values: severity levels, most severe first ------------------------
LEVELS = ("ERROR", "WARN", "INFO", "DEBUG", "TRACE")

# -- fixed values: maximum verbosity per target prefix ------------------------
TRACE_TARGET_LEVELS = {
    "bookapp": "TRACE",
    "backend": "TRACE",
    "sqlx": "DEBUG",
    "tower_http": "INFO",
    "hyper_util": "INFO",
    "h2": "WARN",
    "otel::tracing": "INFO",
}
LOG_TARGET_LEVELS = {
    "backend": "DEBUG",
    "bookapp": "DEBUG",
    "sqlx": "INFO",
    "hyper": "ERROR",
    "tonic": "ERROR",
    "reqwest": "ERROR",
}
DEFAULT_LEVEL = "INFO"

# -- fixed values: log attribute rewrites -------------------------------------
LOG_RESOURCE_KEY = "injected_resource_attribute"
LOG_RESOURCE_VALUE = "otel-collector"
LOG_LOCATION_PATTERN = r"^(?:event\s+)?([^\s:]+):(\d+)"
LOG_LOCATION_KEYS = ("file_path", "line_number")
UNSPECIFIED_FILE = "unspecified_file_path"

# -- fixed values: span events that are counted ---------------------------------
COUNTED_NAMESPACE = ("code.namespace", "bookapp::db")
EXCEPTION_EVENT = "exception"

# -- fixed values: resource attributes promoted to point labels ---------------
CONTAINER_LABELS = {
    "hostname": "container.hostname",
    "container_name": "container.name",
    "image_name": "container.image.name",
}
QUEUE_LABELS = {"cluster_alias": "kafka.cluster.alias"}

# -- fixed values: error tracker ---------------------------------------------
DROPPED_URL_PARTS = ("/health", "/metrics")
TRACE_SAMPLE_RATE = 0.1
UNTRACED_PATHS = ("/health",)

# -- fixed values: panel and alert --------------------------------------------
THRESHOLD_STEPS = ((None, "green"), (5.0, "#EAB839"), (15.0, "red"))
ALERT_THRESHOLD = 10.0
ALERT_RANGE = "3 hours"
HEATMAP_HIDE_BELOW = 1e-9

# -- fixed values: book status -------------------------------------------------
BOOK_STATUS = ("available", "borrowed", "lost")
DEFAULT_STATUS = "available"

# -- fixed values: rule table limits ------------------------------------------
RULES_PER_METHOD = 100
RULES_TOTAL = 1000

# -- fixed values: registered HTTP reason phrases -----------------------------
HTTP_REASONS = {
    400: "Bad Request",
    401: "Unauthorized",
    402: "Payment Required",
    403: "Forbidden",
    404: "Not Found",
    405: "Method Not Allowed",
    406: "Not Acceptable",
    407: "Proxy Authentication Required",
    408: "Request Timeout",
    409: "Conflict",
    410: "Gone",
    411: "Length Required",
    412: "Precondition Failed",
    413: "Payload Too Large",
    414: "URI Too Long",
    415: "Unsupported Media Type",
    416: "Range Not Satisfiable",
    417: "Expectation Failed",
    418: "I'm a teapot",
    421: "Misdirected Request",
    422: "Unprocessable Entity",
    423: "Locked",
    424: "Failed Dependency",
    426: "Upgrade Required",
    428: "Precondition Required",
    429: "Too Many Requests",
    431: "Request Header Fields Too Large",
    451: "Unavailable For Legal Reasons",
    500: "Internal Server Error",
    501: "Not Implemented",
    502: "Bad Gateway",
    503: "Service Unavailable",
    504: "Gateway Timeout",
    505: "HTTP Version Not Supported",
    506: "Variant Also Negotiates",
    507: "Insufficient Storage",
    508: "Loop Detected",
    510: "Not Extended",
    511: "Network Authentication Required",
}
INJECTED_REASON = "Injected Error"
