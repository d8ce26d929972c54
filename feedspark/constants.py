"""Fixed values that must equal the reference's for the same results.

Field-name candidates, sentinels, thresholds and text patterns are stated
here once, in their natural order, and passed to operators as default
arguments so callers can override every one of them.
"""

# --- fixed values: candidate field names, in the order they are tried -----
ID_FIELDS = ("id", "eventId", "_id", "event_id")
ID_FIELDS_PROBE = ("id", "eventId", "_id", "event_id", "ID", "Id")
ID_FIELDS_CSV = ("id", "eventId", "event_id")
SSE_ID_GATE_FIELDS = ("id", "eventId")
TYPE_FIELDS = ("type", "eventType", "event_type")
TIME_FIELDS_REPORT = ("timestamp", "created_at", "createdAt", "time", "ts", "occurred_at")
TIME_FIELDS_PROBE = ("timestamp", "created_at", "createdAt", "time", "date", "ts",
                     "eventTime", "occurred_at")
DUMP_ARRAY_FIELDS = ("data", "ids", "events")

# --- fixed values: id sentinels dropped after the pick (no fallthrough) ----
ID_SENTINELS = ("undefined", "null")

# --- fixed values: device types named by the source ------------------------
DEVICE_TYPES = ("mobile", "desktop", "tablet")

# --- fixed values: bare-id length gate (exclusive bounds) ------------------
BARE_ID_MIN_LEN_EXCL = 5
BARE_ID_MAX_LEN_EXCL = 200

# --- fixed values: SSE framing ---------------------------------------------
SSE_DATA_PREFIX = "data:"
SSE_DONE = "[DONE]"

# --- fixed values: timestamp format classes (epoch bounds) -----------------
UNIX_SECONDS_LO_EXCL = 1_000_000_000
UNIX_SECONDS_HI_EXCL = 2_000_000_000
UNIX_MILLIS_LO_EXCL = 1_000_000_000_000
ISO_PREFIX_PATTERN = r"^\d{4}-\d{2}-\d{2}"

# --- fixed values: string format classes, tested in this order ------------
BASE64_PATTERN = r"^[A-Za-z0-9+/=]+$"
NUMERIC_PATTERN = r"^\d+$"
UUID_LOOSE_PATTERN = r"^[0-9a-fA-F-]{36}$"
UUID_STRICT_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

# --- fixed values: page and script text patterns ---------------------------
SCRIPT_SRC_PATTERN = r'<script[^>]+src="([^"]+)"'
SCRIPT_KEEP_SUFFIX = ".js"
SCRIPT_KEEP_CONTAINS = "assets/"
SCRIPT_MAX = 3
FETCH_URL_PATTERN = r"""fetch\s*\(\s*["'`]([^"'`]+)["'`]"""
CALL_URL_PREFIXES = ("/api/", "/internal/")
PATH_LITERAL_PATTERN = r"""["'`](/(?:api/v\d+|internal)/[a-zA-Z0-9/_-]+)["'`]"""
QUERY_PARAM_PATTERN = r"[?&]([a-zA-Z_]+)="
HEADER_NAME_PATTERN = r"""["']([A-Z][a-zA-Z]+-[A-Za-z-]+)["']\s*:"""
LINK_REL_PATTERN = r'<([^>]+)>;\s*rel="(?:stream|export|bulk|download)"'

# --- fixed values: request outcome classes ---------------------------------
AUTH_STATUSES = (401, 403)
THROTTLED_STATUS = 429

# --- fixed values: worker health thresholds (ms, strict greater-than) ------
STUCK_AFTER_MS = 30_000
DEAD_AFTER_MS = 60_000

# --- fixed values: throughput trend ratios ---------------------------------
TREND_UP_RATIO = 1.05
TREND_DOWN_RATIO = 0.85

# --- fixed values: sizes ---------------------------------------------------
EXPORT_BATCH = 50_000
RECENT_SAMPLES = 1000
RATE_WINDOW_MS = 10_000
SHORTFALL_MAX_PASSES = 3
ESTIMATE_EXACT_BELOW = 10_000
TIME_SLICES = 6
