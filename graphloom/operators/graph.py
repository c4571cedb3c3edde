"""Nodes and the AST and CFG edges of flat syntax rows, and edge-set operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.functions import ids, text
from graphloom.operators.sequence import inherited_follow

ENVELOPE = ("repository", "path", "file_id", "content_sha256")
EDGE_COLUMNS = (*ENVELOPE, "edge_id", "edge_type", "source_id", "target_id", "properties", "ord")

# --- fixed values: statement kinds and branch labels -----------------------------
LOOPS = ("For", "AsyncFor", "While")
WITHS = ("With", "AsyncWith")
DEAD_ENDS = ("Return", "Raise", "Break", "Continue")
OWN_BRANCHES = ("If", *LOOPS, *WITHS, "Try", *DEAD_ENDS)   # no plain ``next`` edge
# ---------------------------------------------------------------------------------


def quoted(name: Column) -> Column:
    """JSON string of a name that needs no escapes."""
    return F.concat(F.lit('"'), name, F.lit('"'))


def node_id_column() -> Column:
    return ids.node_id(F.col("file_id"), F.col("structural_path"), F.col("node_type"))


def label() -> Column:
    kind, name = F.col("node_type"), F.col("name")
    shown = F.when(
        kind == "Constant", F.substring("value", 1, C.LABEL_VALUE_LIMIT)
    ).when(
        kind.isin("FunctionDef", "AsyncFunctionDef", "ClassDef", "Name", "arg", "Attribute", "Call"),
        name,
    )
    return F.coalesce(F.concat(kind, F.lit(":"), shown), kind)


def node_properties() -> Column:
    kind, name = F.col("node_type"), F.col("name")
    return (
        F.when(kind.isin("FunctionDef", "AsyncFunctionDef"),
               F.to_json(F.struct(F.col("names").alias("args"), name.alias("name"))))
        .when(kind == "ClassDef", F.to_json(F.struct(name.alias("name"))))
        .when(kind == "Name", F.to_json(F.struct("ctx", name.alias("id"))))
        .when(kind == "arg", F.to_json(F.struct(name.alias("arg"))))
        .when(kind == "Attribute", F.to_json(F.struct(name.alias("attr"))))
        .when(kind == "Constant", F.to_json(F.struct("value")))
        .otherwise(F.lit("{}"))
    )


def nodes(flat: DataFrame) -> DataFrame:
    """One row per syntax node; a projection, no shuffle."""
    shown = label()
    return flat.filter("pos is not null").select(
        *ENVELOPE, node_id_column().alias("node_id"), "structural_path", "node_type",
        shown.alias("label"), "lineno", "col_offset", "end_lineno", "end_col_offset",
        text.shorten(F.coalesce(F.col("code"), shown), C.CODE_LIMIT).alias("code"),
        node_properties().alias("properties"), F.col("pos").cast("long").alias("ord"),
    )


#: An edge before its ids are made: the paths in the tree and the types of its ends, which repeat and compress as ids do not.
PATHS = (*ENVELOPE, "edge_type", "source_path", "source_type", "target_path", "target_type", "properties", "ord")


def paths_of(df: DataFrame, edge_type: str, source: tuple[Column, Column], target: tuple[Column, Column], properties: Column,
             rank: int, position: Column) -> DataFrame:
    """Edges by the paths and types of their ends; ``ord`` keeps the kinds in order, then source order."""
    return df.select(
        *ENVELOPE, F.lit(edge_type).alias("edge_type"), source[0].alias("source_path"), source[1].alias("source_type"),
        target[0].alias("target_path"), target[1].alias("target_type"), properties.alias("properties"),
        (F.lit(rank).cast("long") * F.lit(1 << 33) + position.cast("long")).alias("ord"))


def identified(paths: DataFrame) -> DataFrame:
    """Edges by path with the ids of their ends and themselves; a projection."""
    end_id = lambda end: ids.node_id(F.col("file_id"), F.col(f"{end}_path"), F.col(f"{end}_type"))
    ends = paths.withColumns({"source_id": end_id("source"), "target_id": end_id("target")})
    return ends.withColumn("edge_id", _edge_id()).select(*EDGE_COLUMNS)


def _edge_id() -> Column:
    return ids.edge_id(*(F.col(n) for n in ("file_id", "edge_type", "source_id", "target_id", "properties")))


def ast_edges(flat: DataFrame) -> DataFrame:
    return identified(ast_paths(flat))


def ast_paths(flat: DataFrame) -> DataFrame:
    """Parent -> child. A row tells its parent's path and type, so no join is needed."""
    index = F.coalesce(F.concat(F.lit(',"index":'), F.col("index").cast("string")), F.lit(""))
    properties = F.concat(F.lit('{"field":'), quoted(F.col("field")), index, F.lit("}"))
    return paths_of(flat.filter("parent_pos is not null"), "AST", (F.col("parent_path"), F.col("parent_type")),
                    (F.col("structural_path"), F.col("node_type")), properties, 0, F.col("pos"))


def _labelled(name: Column) -> Column:
    return F.concat(F.lit('{"label":'), quoted(name), F.lit("}"))


#: An edge by position: the file's number, where its ends are in the file, and what its id and order need.
PLACES = ("file_no", "edge_type", "source_pos", "target_pos", "properties", "ord")


def places(df: DataFrame, edge_type: str, source: Column, target: Column, properties: Column, rank: int,
           position: Column) -> DataFrame:
    """Edges by position, without self loops. Positions are short and tell the nodes of a file apart, so everything that
    is joined, sorted or counted uses them; ids are looked up last, where an event or a stored row is made."""
    return df.select(
        "file_no", F.lit(edge_type).alias("edge_type"), source.alias("source_pos"), target.alias("target_pos"),
        properties.alias("properties"), (F.lit(rank).cast("long") * F.lit(1 << 33) + position.cast("long")).alias("ord"),
    ).filter("source_pos <> target_pos")


def with_ids(found: DataFrame, flat: DataFrame) -> DataFrame:
    """Edges by position -> edges with the ids of their nodes and themselves, and their file's columns. The id of a node is made
    once, after the rows were dealt out, however many edges it has."""
    ends = _with_ends(found, flat, {"_id": F.unhex(node_id_column())}).withColumns(
        {f"{end}_id": F.lower(F.hex(f"_{end}_id")) for end in ("source", "target")})
    return ends.withColumn("edge_id", _edge_id()).select(*EDGE_COLUMNS)


def with_paths(found: DataFrame, flat: DataFrame) -> DataFrame:
    """Edges by position -> edges by path, with their file's columns."""
    edges = _with_ends(found, flat, {"_path": F.col("structural_path"), "_type": F.col("node_type")})
    return edges.withColumnsRenamed({f"_{end}_{name}": f"{end}_{name}" for end in ("source", "target") for name in ("path", "type")}).select(*PATHS)


def _with_ends(found: DataFrame, flat: DataFrame, told: dict[str, Column]) -> DataFrame:
    """Edges by position with what is ``told`` of the nodes at both of their ends, and with their file's columns.

    Nodes and edges are dealt out once, by file, where a file's rows stay together and compress well. There each edge takes
    the last node up to each of its ends, which must be at that very position. A file is a bounded
    unit, since one task parses it.
    """
    # what can be an end: statements of blocks, names that are read or bound, calls and their callees
    known = flat.filter("owners is not null or uses is not null or (parent_type = 'Call' and field = 'func')").select(
        "file_no", F.col("pos").alias("source_pos"), F.col("pos").alias("target_pos"), F.col("pos").alias("_pos"),
        "structural_path", "node_type", *ENVELOPE)
    rows = found.unionByName(known, allowMissingColumns=True).repartition("file_no").withColumns(told).drop("structural_path", "node_type")
    for end, more in (("source", ENVELOPE), ("target", ())):
        # a node has no edge type and so comes before the edges of its position
        window = Window.partitionBy("file_no").orderBy(f"{end}_pos", "edge_type").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = lambda name: F.last(name, ignorenulls=True).over(window)
        rows = rows.withColumns({f"_{end}{name}": last(name) for name in ("_pos", *told)} | {n: last(n) for n in more})
    return rows.filter("edge_type is not null and _source_pos = source_pos and _target_pos = target_pos")


def _entries(flat: DataFrame) -> tuple[DataFrame, Column]:
    """First statements of the blocks that their owner branches into, and the name of the branch."""
    owner, field = F.col("parent_type"), F.col("field")
    body, orelse = field == "body", field == "orelse"
    handler = (owner == "ExceptHandler") & body
    branches = (
        ((owner == "If") & body, F.lit("branch_true")), ((owner == "If") & orelse, F.lit("branch_false")),
        (owner.isin(*LOOPS) & body, F.lit("loop_enter")), (owner.isin(*LOOPS) & orelse, F.lit("loop_exit")),
        (owner.isin(*WITHS) & body, F.lit("with_enter")), ((owner == "Try") & body, F.lit("try_body")),
        (handler, F.concat(F.lit("except_"), F.regexp_extract("parent_path", r"\[(\d+)\]$", 1))),
    )
    name, enters = F.lit(None).cast("string"), F.lit(False)
    for condition, label in reversed(branches):
        name, enters = F.when(condition, label).otherwise(name), condition | enters
    return flat.filter(F.col("owners").isNotNull() & (F.col("index") == 0) & enters), name


def enters_block() -> Column:
    """Whether a row is the first statement of a block that its owner branches into; never NULL."""
    owner, field = F.col("parent_type"), F.col("field")
    either = owner.isin("If", *LOOPS) & field.isin("body", "orelse")
    body = owner.isin(*WITHS, "Try", "ExceptHandler") & (field == "body")
    return F.coalesce(F.col("owners").isNotNull() & (F.col("index") == 0) & (either | body), F.lit(False))


def entry_edges(flat: DataFrame) -> DataFrame:
    return identified(entry_paths(flat))


def entry_paths(flat: DataFrame) -> DataFrame:
    """Branches into a block: from its owner to the block's first statement; a projection."""
    firsts, name = _entries(flat)
    owner = F.col("parent_type")
    handler = owner == "ExceptHandler"
    source = (
        F.when(handler, F.regexp_replace("parent_path", r"\.handlers\[\d+\]$", ""))
        .otherwise(F.col("parent_path")),
        F.when(handler, F.lit("Try")).otherwise(owner),
    )
    return paths_of(firsts, "CFG", source, (F.col("structural_path"), F.col("node_type")), _labelled(name), 1, F.col("parent_pos"))


def file_rows(flat: DataFrame) -> DataFrame:
    """One row per file, parsed or failed."""
    return flat.filter("size_bytes is not null")


def follow_places(flat: DataFrame, bounded: bool = False) -> DataFrame:
    """``next`` edges, and false branches and loop exits that leave through the successor. The rows of parsed files are
    ``bounded``: one task parses a file, and its positions are distinct."""
    kind = F.col("node_type")
    name = (
        F.when((kind == "If") & ~F.col("has_orelse"), F.lit("branch_false"))
        .when(kind.isin(*LOOPS) & ~F.col("has_orelse"), F.lit("loop_exit"))
        .when(~kind.isin(*OWN_BRANCHES), F.lit("next"))
    )
    statements = flat.filter("owners is not null").select(
        "file_no", "pos", "parent_pos", "field", "index", "owners", "loop_pos", name.alias("_label"))
    followed = inherited_follow(
        statements, ["file_no"], "pos", ["parent_pos", "field"], "index", "owners", "loop_pos", bounded=bounded)
    return places(followed.filter("_label is not null and follow is not null"), "CFG", F.col("pos"), F.col("follow"),
                  _labelled(F.col("_label")), 1, F.col("pos"))


def cfg_edges(flat: DataFrame) -> DataFrame:
    return entry_edges(flat).unionByName(with_ids(follow_places(flat), flat))


def usable_edges(edges: DataFrame, source: str = "source_id", target: str = "target_id",
                 edge_type: str | None = "edge_type") -> DataFrame:
    """Edges without self loops or empty endpoints; an unknown edge type is fatal. For edges that are distinct as they are
    made; no shuffle."""
    usable = (F.col(source) != F.col(target)) & (F.col(source).cast("string") != "") & (
        F.col(target).cast("string") != "")
    kept = edges.filter(usable)
    if edge_type:
        kept = kept.withColumn(edge_type, F.when(
            F.col(edge_type).isin(*C.EDGE_TYPES), F.col(edge_type)).otherwise(
            F.raise_error(F.concat(F.lit("no such edge type: "), F.col(edge_type))).cast("string")))
    return kept


def dedupe_edges(edges: DataFrame, source: str = "source_id", target: str = "target_id",
                 edge_type: str | None = "edge_type", position: str = "ord") -> DataFrame:
    """Distinct usable edges.

    An edge's id is a digest of its other columns, so equal ids are equal rows. Of equal edges the
    first ``position`` is kept, if there is such a column.
    """
    kept = usable_edges(edges, source, target, edge_type)
    if position not in kept.columns:
        return kept.distinct()
    rest = [name for name in kept.columns if name != position]
    return kept.groupBy(*rest).agg(F.min(position).alias(position)).select(*kept.columns)


def edge_counts(edges: DataFrame, by: str = "file_id", kind: str = "edge_type",
                kinds: tuple[str, ...] = C.EDGE_TYPES) -> DataFrame:
    """Edges of each kind per group, one column per kind."""
    return edges.groupBy(by).agg(*(
        F.count_if(F.col(kind) == value).alias(f"{value.lower()}_edge_count") for value in kinds))
