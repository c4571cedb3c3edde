"""Deterministic identifiers and canonical JSON as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_path(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def sha256(value: Column) -> Column:
    return F.sha2(value, 256)


def digest_of(*parts: Column) -> Column:
    """SHA-256 of the parts joined by ':'; NULL if a part is NULL."""
    joined = [parts[0]]
    for part in parts[1:]:
        joined += [F.lit(":"), part]
    return sha256(F.concat(*joined))


def file_id(repository: Column, path: Column) -> Column:
    return digest_of(repository, normalize_path(path))


def node_id(file: Column, structural_path: Column, node_type: Column) -> Column:
    return digest_of(file, structural_path, node_type)


def edge_id(file: Column, edge_type: Column, source: Column, target: Column, properties: Column) -> Column:
    """``properties`` is canonical JSON text; the id is taken over its ASCII form."""
    return digest_of(file, edge_type, source, target, ascii_json(properties))


def error_id(file: Column, kind: Column, lineno: Column, col_offset: Column, message: Column) -> Column:
    return digest_of(file, kind, lineno.cast("string"), col_offset.cast("string"), message)


def packed(id: Column) -> Column:
    """An id as bytes for a shuffle, whose compression leaves hex digits as they are: a digest in half its length, any other
    text as it is. The first byte tells which; ``unpacked`` gives the same text back."""
    digest = id.rlike(r"^[0-9a-f]{64}\z")
    return F.when(digest, F.concat(F.lit(bytearray(b"\1")), F.unhex(id))).otherwise(
        F.concat(F.lit(bytearray(b"\0")), id.cast("binary")))


def unpacked(id: Column) -> Column:
    rest = F.substr(id, F.lit(2))
    return F.when(F.substr(id, F.lit(1), F.lit(1)) == F.lit(bytearray(b"\1")), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def ascii_json(text: Column) -> Column:
    r"""JSON text with every non-ASCII character written as ``\uXXXX`` (UTF-16 units)."""
    def escape(char: Column) -> Column:
        units = F.lower(F.hex(F.encode(char, "UTF-16BE")))
        return F.when(F.ascii(char) < 128, char).otherwise(
            F.regexp_replace(units, "(.{4})", r"\\u$1")
        )

    escaped = F.array_join(F.transform(F.split(text, ""), escape), "")
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(escaped)
