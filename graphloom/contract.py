"""Event contract: fixed names, values and schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: these must match the published event contract -----------------
SCHEMA_VERSION = "1.0.0"
STATE_VERSION = 1
LANGUAGE = "python"

NODE_UPSERT = "NODE_UPSERT"
NODE_DELETE = "NODE_DELETE"
EDGE_UPSERT = "EDGE_UPSERT"
EDGE_DELETE = "EDGE_DELETE"
FILE_METADATA_UPSERT = "FILE_METADATA_UPSERT"
PARSER_ERROR = "PARSER_ERROR"

EDGE_TYPES = ("AST", "CFG", "DFG", "CALL")
STATUSES = ("PARSED", "FAILED")

# category -> (topic, key column, JSONL dump name)
CATEGORIES = {
    "node": ("cpg.nodes", "node_id", "nodes.jsonl"),
    "edge": ("cpg.edges", "edge_id", "edges.jsonl"),
    "metadata": ("cpg.metadata", "file_id", "metadata.jsonl"),
    "error": ("cpg.errors", "error_id", "errors.jsonl"),
}
ERROR_RETENTION_DAYS = 7

EXCLUDED_DIRECTORIES = (
    ".git", ".github", ".venv", "__pycache__", "build", "dist", "test", "tests", "venv",
)
EXCLUDED_FILENAMES = ("setup.py",)
GENERATED_SUFFIXES = ("_pb2.py", "_pb2_grpc.py")

PLACEHOLDER = "<placeholder>"
CODE_LIMIT = 300
LABEL_VALUE_LIMIT = 20
PROPERTY_VALUE_LIMIT = 100
# ---------------------------------------------------------------------------------

TOPICS = {category: topic for category, (topic, _, _) in CATEGORIES.items()}
KEYS = {category: key for category, (_, key, _) in CATEGORIES.items()}

COMMON_FIELDS = (
    "schema_version", "event_type", "event_time", "repository", "file_id", "path",
    "content_sha256",
)
COUNT_FIELDS = (
    "ast_node_count", "ast_edge_count", "cfg_edge_count", "dfg_edge_count", "call_edge_count",
)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
_COMMON = tuple((name, _S) for name in COMMON_FIELDS)

# ``properties`` is a free-form JSON object; as StringType Spark keeps its JSON text.
NODE_EVENT = _schema(
    *_COMMON, ("node_id", _S), ("structural_path", _S), ("node_type", _S), ("label", _S),
    ("lineno", _I), ("col_offset", _I), ("end_lineno", _I), ("end_col_offset", _I),
    ("code", _S), ("properties", _S),
)
EDGE_EVENT = _schema(
    *_COMMON, ("edge_id", _S), ("edge_type", _S), ("source_id", _S), ("target_id", _S),
    ("properties", _S),
)
METADATA_EVENT = _schema(
    *_COMMON, ("language", _S), ("size_bytes", _L), ("line_count", _I),
    *((name, _I) for name in COUNT_FIELDS), ("status", _S),
)
ERROR_EVENT = _schema(
    *_COMMON, ("error_id", _S), ("error_type", _S), ("error_message", _S),
    ("lineno", _I), ("col_offset", _I),
)
EVENT_SCHEMAS = {
    "node": NODE_EVENT, "edge": EDGE_EVENT, "metadata": METADATA_EVENT, "error": ERROR_EVENT,
}

FILES = _schema(
    ("repository", _S), ("path", _S), ("content", T.BinaryType()),
    ("read_error_type", _S), ("read_error_message", _S),
)

# Keyed-log record. ``revision_seq`` orders records of different topics.
ENVELOPE = _schema(
    ("key", _S), ("value", _S), ("topic", _S), ("partition", _I), ("offset", _L),
    ("timestamp", T.TimestampType()), ("revision_seq", _L),
)
