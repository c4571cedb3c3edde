"""Order-based operators: successor in a block, inherited successor, last prior value, latest per key.

All take column names, so the same code serves code graphs and ordinary tables. Groups may be
very uneven, therefore none of them needs a whole group in one task: successors are equi joins on
the position, the latest record is a partial aggregate, and the as-of window can be cut in chunks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions import ids


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join whose sides both grow with the input: sorted and merged, never broadcast. Spark guesses the
    size of a table from its compressed file, where repeated values take next to nothing, and would send all of it to the driver."""
    return df.hint("merge")


def own_ids(df: DataFrame) -> list[str]:
    """Columns whose ids differ from row to row; a file's id is shared by its rows."""
    return [name for name in df.columns if name.endswith("_id") and name != "file_id"]


def packed_ids(df: DataFrame) -> DataFrame:
    return df.withColumns({name: ids.packed(F.col(name)) for name in own_ids(df)})


def unpacked_ids(df: DataFrame) -> DataFrame:
    return df.withColumns({name: ids.unpacked(F.col(name)) for name in own_ids(df)})


def dealt_by_file(df: DataFrame) -> DataFrame:
    """``df`` dealt out to tasks by file, its ids packed on the way. What a file's rows share is packed by the shuffle if they
    lie together before it. A file is a bounded unit, since one task parses it."""
    return unpacked_ids(packed_ids(df).repartition("file_id"))


def next_in_block(
    df: DataFrame, block: Sequence[str], index: str, carry: dict[str, str], within: Sequence[str] = (),
) -> DataFrame:
    """Each row with columns of the row one position later in its block, NULL for the last one.

    Positions are dense integers per block, so the successor is found by an equi join whose key is
    unique, not by a window over the block: no block size can overload a task. If some columns of the ``block`` tell a
    bounded unit in which no position comes twice, name them as ``within``: one window over the unit's blocks does the same.
    """
    if within:
        rest = [name for name in block if name not in within]
        window = Window.partitionBy(*within).orderBy(*rest, index)
        later = lambda name: F.lead(name).over(window)
        stays = _all(later(name) == F.col(name) for name in rest) & (later(index) == F.col(index) + 1)
        return df.withColumns({name: F.when(stays, later(column)) for column, name in carry.items()})
    following = df.select(
        *block, (F.col(index) - 1).alias(index),
        *(F.col(column).alias(name) for column, name in carry.items()),
    )
    return df.join(merged(following), [*block, index], "left")


def _all(conditions: Iterable[Column]) -> Column:
    return functools.reduce(lambda a, b: a & b, conditions)


def inherited_follow(
    df: DataFrame, by: Sequence[str], pos: str, block: Sequence[str], index: str,
    owners: str, fallback: str, out: str = "follow", bounded: bool = False,
) -> DataFrame:
    """Successor of every row: the next one in its block, else the first successor found among its
    ``owners`` (positions, nearest first), else ``fallback``.

    If the rows of one ``by`` are a ``bounded`` unit and no position comes twice in it, windows over the unit find the same,
    and rows are dealt out once. The places that the successor was found by (block, index, owners and fallback) are not returned then.
    """
    if bounded:
        return _inherited_within(df, by, pos, block, index, owners, fallback, out)
    stepped = next_in_block(df, [*by, *block], index, {pos: "_next"})
    known = stepped.filter("_next is not null").select(
        *by, F.col(pos).alias("_owner"), F.col("_next").alias("_owner_next"))
    climb = (
        stepped.filter("_next is null")
        .select(*by, pos, F.posexplode(owners).alias("_level", "_owner"))
        .join(merged(known), [*by, "_owner"])
        .groupBy(*by, pos).agg(F.min_by("_owner_next", "_level").alias("_inherited"))
    )
    return (
        stepped.join(merged(climb), [*by, pos], "left")
        .withColumn(out, F.coalesce("_next", "_inherited", fallback))
        .drop("_next", "_inherited")
    )


def _inherited_within(
    df: DataFrame, by: Sequence[str], pos: str, block: Sequence[str], index: str, owners: str, fallback: str, out: str,
) -> DataFrame:
    stepped = next_in_block(df, [*by, *block], index, {pos: "_next"}, within=by)
    kept = [name for name in df.columns if name not in (*block, index, owners, fallback)]
    # a row with a successor stands at its own position, any other one at the positions of all its owners
    stands = F.when(F.col("_next").isNotNull(), F.array(pos)).otherwise(F.col(owners))
    climb = stepped.select(
        *kept, fallback, "_next", F.col("_next").isNull().alias("_asks"), F.posexplode_outer(stands).alias("_level", "_owner"))
    seen = asof_within(climb, by, ["_owner"], ["_asks"], [(F.col("_next"), "_owner_next")])
    inherited = F.min_by("_owner_next", F.when(F.col("_owner_next").isNotNull(), F.col("_level")))
    return (
        seen.groupBy(*kept, fallback, "_next").agg(inherited.alias("_inherited"))
        .select(*kept, F.coalesce("_next", "_inherited", fallback).alias(out))
    )


def asof_last(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, out: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Add the last non-NULL ``value`` strictly before each row, per ``by`` in ``order``.

    ``chunk`` is an optional integer expression that never decreases along ``order`` (for example
    a log offset divided by a constant). With it no task ever holds more than one chunk of a
    group: the window runs per chunk, and what earlier chunks carry over comes from one
    pre-aggregated row per chunk.
    """
    valued = df.withColumn("_value", value)
    before = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    if chunk is None:
        window = before(Window.partitionBy(*by).orderBy(*order))
        return valued.withColumn(out, F.last("_value", ignorenulls=True).over(window)).drop("_value")

    chunked = valued.withColumn("_chunk", chunk)
    window = before(Window.partitionBy(*by, "_chunk").orderBy(*order))
    local = chunked.withColumn("_local", F.last("_value", ignorenulls=True).over(window))
    marked = F.when(F.col("_value").isNotNull(), F.struct(*order))
    ends = chunked.groupBy(*by, "_chunk").agg(F.max_by("_value", marked).alias("_end"))
    carry_window = before(Window.partitionBy(*by).orderBy("_chunk"))
    carried = ends.select(
        *by, "_chunk", F.last("_end", ignorenulls=True).over(carry_window).alias("_carried"))
    return (
        local.join(carried, [*by, "_chunk"], "left")
        .withColumn(out, F.coalesce("_local", "_carried"))
        .drop("_value", "_chunk", "_local", "_carried")
    )


def asof_within(
    df: DataFrame, by: Sequence[str], group: Sequence[str], order: Sequence[str], values: Sequence[tuple[Column, str]],
) -> DataFrame:
    """Add, for each (value, name), the last non-NULL value strictly before each row of its ``group`` in ``order``.

    For very many small groups of a bounded unit: rows are dealt out by ``by`` alone before they come here, so that steps
    with other groups of the same unit need no exchange between them.
    """
    window = Window.partitionBy(*by, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({name: F.last(value, ignorenulls=True).over(window) for value, name in values})


def latest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``. A partial aggregate, so a key with very many versions
    is reduced before the shuffle."""
    rest = [name for name in df.columns if name not in key]
    newest = df.groupBy(*key).agg(
        F.max_by(F.struct(*(F.col(f"`{n}`") for n in rest)), F.struct(*order)).alias("_row"))
    return newest.select(*key, "_row.*").select(*df.columns)


def first_by_group(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group in ``order``."""
    rest = [name for name in df.columns if name not in group]
    oldest = df.groupBy(*group).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return oldest.select(*group, "_row.*").select(*df.columns)
