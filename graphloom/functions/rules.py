"""Event contract rules as columns: each event gets the list of rules it violates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom import contract as C

# --- fixed values: patterns and value sets of the event contract ---------------------
HEX_ID = r"^[0-9a-f]{64}$"
HEX_OR_EMPTY = r"^([0-9a-f]{64})?$"
DATE_TIME = (r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)"
             r"(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$")

_COMMON = {
    "schema_version": {"const": C.SCHEMA_VERSION},
    "event_time": {"type": "string", "format": DATE_TIME},
    "repository": {"type": "string", "minLength": 1},
    "file_id": {"type": "string", "pattern": HEX_ID},
    "path": {"type": "string", "minLength": 1},
    "content_sha256": {"type": "string", "pattern": HEX_OR_EMPTY},
}
_ID = {"type": "string", "pattern": HEX_ID}
_TEXT = {"type": "string"}
_FILLED = {"type": "string", "minLength": 1}
_COUNT = {"type": "integer", "minimum": 0}
_OBJECT = {"type": "object"}

_NODE_BODY = {
    "structural_path": _FILLED, "node_type": _FILLED, "label": _TEXT, "lineno": _COUNT,
    "col_offset": _COUNT, "end_lineno": _COUNT, "end_col_offset": _COUNT, "code": _TEXT,
    "properties": _OBJECT,
}

# category -> (fields, fields required by one event type only)
RULES = {
    "node": (
        {**_COMMON, "event_type": {"enum": (C.NODE_UPSERT, C.NODE_DELETE)}, "node_id": _ID, **_NODE_BODY},
        {name: C.NODE_UPSERT for name in _NODE_BODY},
    ),
    "edge": (
        {**_COMMON, "event_type": {"enum": (C.EDGE_UPSERT, C.EDGE_DELETE)}, "edge_id": _ID,
         "edge_type": {"enum": C.EDGE_TYPES}, "source_id": _ID, "target_id": _ID,
         "properties": _OBJECT},
        {"properties": C.EDGE_UPSERT},
    ),
    "metadata": (
        {**_COMMON, "event_type": {"const": C.FILE_METADATA_UPSERT}, "language": {"const": C.LANGUAGE},
         "size_bytes": _COUNT, "line_count": _COUNT, **{n: _COUNT for n in C.COUNT_FIELDS},
         "status": {"enum": C.STATUSES}},
        {},
    ),
    "error": (
        {**_COMMON, "event_type": {"const": C.PARSER_ERROR}, "error_id": _ID, "error_type": _FILLED,
         "error_message": _FILLED, "lineno": _COUNT, "col_offset": _COUNT},
        {},
    ),
}
# -------------------------------------------------------------------------------------


def with_violations(df: DataFrame, category: str, value: str = "value") -> DataFrame:
    """Add ``violations`` for the JSON text of events of one category."""
    return check_rules(df, value, *RULES[category])


def check_rules(df: DataFrame, value: str, fields: Mapping[str, dict], conditional: Mapping[str, str],
                type_field: str = "event_type", out: str = "violations") -> DataFrame:
    """Add the sorted names, ``rule:field``, of the rules that a JSON text breaks.

    ``conditional`` fields are required only when ``type_field`` has the given value; all other
    fields are always required, and no field beyond ``fields`` is allowed. The text is parsed once
    into variants; their kinds and texts are columns of their own, so no rule works them out again.
    """
    document = "struct<" + ",".join(f"{name}:variant" for name in fields) + ">"
    parsed = df.withColumns({
        "_document": F.from_json(value, document), "_keys": F.json_object_keys(F.col(value))})
    described = {}
    for name in fields:
        described[f"_kind_{name}"] = F.schema_of_variant(F.col(f"_document.{name}"))
        described[f"_text_{name}"] = F.try_variant_get(F.col(f"_document.{name}"), "$", "string")
    members = parsed.withColumns(described)

    broken: list[Column] = []

    def rule(condition: Column, name: str) -> None:
        broken.append(F.when(F.coalesce(condition, F.lit(False)), F.lit(name)))

    for name, spec in fields.items():
        kind = F.coalesce(F.col(f"_kind_{name}"), F.lit("VOID"))
        text, is_string = F.col(f"_text_{name}"), kind == "STRING"
        present = F.array_contains("_keys", name)
        needed = F.lit(True)
        if name in conditional:
            needed = F.coalesce(F.col(f"_text_{type_field}") == conditional[name], F.lit(False))
        rule(~present & needed, f"required:{name}")
        if "const" in spec:
            rule(present & ~(is_string & (text == spec["const"])), f"const:{name}")
        if "enum" in spec:
            rule(present & ~(is_string & text.isin(*spec["enum"])), f"enum:{name}")
        if spec.get("type") == "string":
            rule(present & ~is_string, f"type:{name}")
        if spec.get("type") == "object":
            rule(present & ~kind.startswith("OBJECT"), f"type:{name}")
        if spec.get("type") == "integer":
            number = text.try_cast("decimal(38,6)")
            numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
            whole = F.coalesce(number == F.floor(number), F.lit(False))
            rule(present & ~(numeric & whole), f"type:{name}")
            rule(numeric & (number < spec["minimum"]), f"minimum:{name}")
        if "minLength" in spec:
            rule(is_string & (F.length(text) < spec["minLength"]), f"minLength:{name}")
        if "pattern" in spec:
            rule(is_string & ~text.rlike(spec["pattern"]), f"pattern:{name}")
        if "format" in spec:
            rule(is_string & ~text.rlike(spec["format"]), f"format:{name}")

    extra = F.transform(F.array_except("_keys", F.array(*map(F.lit, fields))),
                        lambda key: F.concat(F.lit("additionalProperties:"), key))
    found = F.array_sort(F.concat(F.array_compact(F.array(*broken)), extra))
    no_object = F.array(F.lit("type:$"))
    return members.withColumn(out, F.when(F.col("_keys").isNull(), no_object).otherwise(found)).drop(
        "_document", "_keys", *described)
