"""Fixed values and defaults.

Everything in the block marked FIXED VALUES must equal what the record-log
service this library re-expresses uses, or results stop matching.  The
"""

# ---------------------------------------------------------------- FIXED VALUES
CORRELATION_HEADER = "X-Correlation-Id"
TRACEABILITY_HEADER = "X-Traceability-Id"
CALLER_ID_HEADER = "X-Caller-Id"
AUTHORIZATION_HEADER = "Authorization"
STACK_TRACE_HEADER = "X-Stack-Trace"          # [decision] name of the stack-trace header
DLQ_EXT = ".dlq"

AUDIT_TYPES = ("REACTIVE_CONSUMER", "ACTIVE_CONSUMER", "STREAMING_CONSUMER", "PRODUCER")
AUDIT_STATUSES = ("SUCCESS", "FAILURE")
FORMATS = ("BINARY", "JSON", "AVRO", "JSONSCHEMA", "PROTOBUF", "STRING")
DEFAULT_FORMAT = "JSONSCHEMA"

REPLAY_ERROR_CODE = "ERR12218"
REPLAY_RULES = (
    # (rule name, error detail) in the order they are checked
    ("empty_topic", "topic name can not be empty"),
    ("topic_not_configured", "provided topic in request must match one of the topics in consuming topic list"),
    ("negative_partition", "partition can not be negative"),
    ("negative_start", "replay start offset can not be negative"),
    ("negative_end", "replay end offset can not be negative"),
    ("start_after_end", "replay end offset can not be less than start offset"),
    ("start_equals_end", "replay end offset can not be equal to start offset"),
    ("empty_group", "replay consumer group can not be empty"),
    ("no_destination", "Destination topic can not be empty for a streaming app"),
)
REPLAY_START_MISMATCH = ("For the first batch , start offset and first read offset do not match, "
                         "possible error in input start offset, abort")

# error status table: (code, status_code, message)
STATUS_TABLE = (
    ("ERR10010", 500, "RUNTIME_EXCEPTION"),
    ("ERR12216", None, "PRODUCER_NOT_ENABLED"),
    ("ERR12218", None, "TOPIC_REPLAY_METADATA_ERROR"),
    ("ERR30000", 400, "FIRST_ERROR_IN_APP"),
    ("ERR30001", 400, "INVALID_TOPIC_NAME"),
    ("ERR30002", 400, "KSQL_IMPLEMENTATION_ERROR"),
    ("ERR30003", 400, "DLQ_ACTIVE_PROCEDURE_ERROR"),
    ("ERR30004", None, None),
)
# ------------------------------------------------------------ END FIXED VALUES

# configured limits used as operator defaults
MAX_POLL_RECORDS = 100
MAX_FETCH_BYTES = 102400
ROLLBACK_THRESHOLD_PCT = 30

# numbering: rows of one (group, chunk) are ranked in one task; a chunk holds at
# most this many consecutive values of the ordering column, so no task ever ranks
# more than that many rows however skewed the groups are.
OFFSET_CHUNK = 1 << 20
