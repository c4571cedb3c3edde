"""Path rules: exclusion reasons, part-wise order and the containment guard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom import contract as C


def path_parts(path: Column) -> Column:
    """Parts of a relative path; sorting by this array is sorting part by part."""
    return F.split(path, "/")


def exclusion_reason(
    parts: Column,
    directories: Sequence[str] = C.EXCLUDED_DIRECTORIES,
    filenames: Sequence[str] = C.EXCLUDED_FILENAMES,
    suffixes: Sequence[str] = C.GENERATED_SUFFIXES,
) -> Column:
    """Why a file is left out, or NULL: directory first, then file name, then generated code."""
    name = F.element_at(parts, -1)
    hit = F.array_min(F.array_intersect(parts, F.array(*map(F.lit, directories))))
    generated = F.lit(False)
    for suffix in suffixes:
        generated = generated | name.endswith(suffix)
    return F.coalesce(
        F.concat(F.lit("excluded_directory:"), hit),
        F.when(name.isin(*filenames), F.concat(F.lit("excluded_filename:"), name)),
        F.when(generated, F.lit("generated_file")),
    )


def escapes_root(path: Column) -> Column:
    """True when a path is absolute or climbs above its root at any step."""
    step = lambda part: (
        F.when(part == "..", -1).when(part.isin("", "."), 0).otherwise(1)
    )
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("lowest"))

    def walk(state: Column, part: Column) -> Column:
        depth = state["depth"] + step(part)
        return F.struct(depth.alias("depth"), F.least(state["lowest"], depth).alias("lowest"))

    return path.startswith("/") | (F.aggregate(path_parts(path), start, walk)["lowest"] < 0)
