"""Execution plans of the monitored databases, stored as lines with their depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The host's plan columns in their order, and those that are always null.
PLAN_COLUMNS = (
    "sql_id",
    "plan_hash_value",
    "operation",
    "options",
    "object_node",
    "object_owner",
    "object_name",
    "object_type",
    "optimizer",
    "id",
    "parent_id",
    "depth",
    "position",
    "cost",
    "cardinality",
    "bytes",
    "other_tag",
    "partition_start",
    "partition_stop",
    "partition_id",
    "other",
    "distribution",
    "cpu_cost",
    "io_cost",
    "temp_space",
    "access_predicates",
    "filter_predicates",
)
ALWAYS_NULL = (
    "address",
    "hash_value",
    "child_number",
    "object_no",
    "object_alias",
    "search_columns",
    "projection",
    "time",
    "qblock_name",
    "remarks",
)
RULE = "-" * 40
BLANK = " " * 40

LABELS = {
    "object_name": "",
    "cost": "cost=",
    "cardinality": "rows=",
    "access_predicates": "access: ",
    "filter_predicates": "filter: ",
}

_HEADER, _RULE, _TEXT, _PLAN = 0, 1, 2, 3


def _of(lines: DataFrame, dbid: int | None, inst_id: int | None) -> DataFrame:
    if dbid is not None:
        lines = lines.where(F.col("dbid") == dbid)
    if inst_id is not None:
        lines = lines.where(F.col("inst_id") == inst_id)
    return lines


def plan_rows(plan_lines: DataFrame, dbid: int | None = None, compat: bool = False) -> DataFrame:
    """Plan lines of one database, or of all, in the host's column order; ``compat`` adds its columns that are null."""
    columns = [c for c in PLAN_COLUMNS if c in plan_lines.columns]
    nulls = [F.lit(None).cast("string").alias(c) for c in ALWAYS_NULL] if compat else []
    return _of(plan_lines, dbid, None).select("dbid", *columns, *nulls)


def plan_table(plan_lines: DataFrame, dbid: int | None = None, inst_id: int | None = None) -> DataFrame:
    """Distinct plan lines: a plan stored for several instances of a database comes once."""
    return plan_rows(_of(plan_lines, dbid, inst_id)).distinct()


def _line(columns: list[str]) -> Column:
    """One plan operation as text: number, indented operation, then what else is known."""
    indent = F.repeat(F.lit(" "), F.col("depth").cast("int"))
    options = [F.col("options")] if "options" in columns else []
    parts = [
        F.lpad(F.col("id").cast("string"), 4, " "),
        F.concat(indent, F.concat_ws(" ", F.col("operation"), *options)),
    ]
    parts += [F.concat(F.lit(label), F.col(name).cast("string")) for name, label in LABELS.items() if name in columns]
    return F.concat_ws(" | ", *parts)


def _row(section: int, dbid: Column, plan: Column, line: Column, text: Column) -> list[Column]:
    return [
        F.lit(section).alias("section"),
        dbid.cast("bigint").alias("dbid"),
        plan.cast("bigint").alias("plan_hash_value"),
        line.cast("bigint").alias("line"),
        text.alias("text"),
    ]


_ORDER = ("section", "dbid", "plan_hash_value", "line", "text")


def _title(plan: Column) -> Column:
    return F.concat(F.lit("Plan hash value is :"), plan.cast("string"))


def _plan_lines(lines: DataFrame) -> DataFrame:
    return lines.select(*_row(_PLAN, F.col("dbid"), F.col("plan_hash_value"), F.col("id"), _line(lines.columns))).distinct()


def render(
    plan_lines: DataFrame, sqltext: DataFrame, sql_id: str, plan: int | None = None, dbid: int | None = None,
    text_chars: int | None = None, inst_id: int | None = None,
) -> DataFrame:
    """Text of one statement and its plans, one row per line, ordered by section, database, plan and line.

    Without ``plan`` every stored plan is shown and one text; with it, that plan and every stored text. A plan stored for
    several databases is shown for each. ``text_chars`` shortens the texts shown; which texts there are is judged on the whole
    ones. ``dbid`` and ``inst_id`` keep the plan lines of one target.
    """
    spark = plan_lines.sparkSession
    lines = plan_table(plan_lines, dbid, inst_id).where(F.col("sql_id") == sql_id)
    texts = sqltext.where(F.col("sql_id") == sql_id)
    if dbid is not None:
        texts = texts.where(F.col("dbid") == dbid)
    shown = texts.select(F.col("sql_text").alias("text")).distinct()
    head = spark.range(1)
    if plan is None:
        shown = shown.agg(F.min("text").alias("text")).where(F.col("text").isNotNull())
    else:
        lines = lines.where(F.col("plan_hash_value") == plan)
    plans = lines.select("dbid", "plan_hash_value").distinct()
    if plan is not None:  # its title comes also where no line of it is stored
        titled = head.select(F.lit(dbid).cast("bigint").alias("dbid"), F.lit(plan).cast("bigint").alias("plan_hash_value"))
        plans = plans.unionByName(titled.where(~plans.exists()))
    if text_chars is not None:
        shown = shown.select(F.substring("text", 1, text_chars).alias("text"))
    database, hash_value, none = F.col("dbid"), F.col("plan_hash_value"), F.lit(None)
    parts = [
        head.select(*_row(_HEADER, none, none, F.lit(0), F.lit(f"SQL ID {sql_id}"))),
        head.select(*_row(_RULE, none, none, F.lit(0), F.lit(RULE))),
        shown.select(*_row(_TEXT, none, none, F.lit(0), F.col("text"))),
        plans.select(*_row(_PLAN, database, hash_value, F.lit(-2), F.lit(BLANK))),
        plans.select(*_row(_PLAN, database, hash_value, F.lit(-1), _title(hash_value))),
        _plan_lines(lines),
    ]
    text = parts[0]
    for part in parts[1:]:
        text = text.unionByName(part)
    return text.orderBy(*_ORDER)


def render_first(plan_lines: DataFrame, sql_id: str, dbid: int | None = None, inst_id: int | None = None) -> DataFrame:
    """Title and lines of the statement's plan with the smallest hash value, for each database that has it."""
    lines = plan_table(plan_lines, dbid, inst_id).where(F.col("sql_id") == sql_id)
    first = lines.agg(F.min("plan_hash_value").alias("plan_hash_value"))
    chosen = lines.where(F.col("plan_hash_value") == first.scalar())
    hash_value = F.col("plan_hash_value")
    title = chosen.select("dbid", "plan_hash_value").distinct()
    title = title.select(*_row(_PLAN, F.col("dbid"), hash_value, F.lit(-1), _title(hash_value)))
    return title.unionByName(_plan_lines(chosen)).orderBy(*_ORDER)


_TREE_KEYS = ("dbid", "inst_id", "sql_id", "plan_hash_value")


def with_tree(plan_lines: DataFrame) -> DataFrame:
    """Plan lines with ``depth`` and ``line_no`` told by their parents, for plans stored without depth or with ids out of order.

    A line whose parent is not stored is a root. Children come in the order of ``position``, if there is one, then of id. Lines
    that are their own ancestors are left out. Meant for the plans of some statements: Spark bounds the rows of a recursion.
    """
    keys = [k for k in _TREE_KEYS if k in plan_lines.columns]
    place = "struct(coalesce(position, id) as position, id)" if "position" in plan_lines.columns else "struct(id as position, id)"
    lines = plan_lines.drop("depth", "line_no").distinct()
    link = " and ".join(f"c.{k} <=> p.{k}" for k in keys)
    walked = plan_lines.sparkSession.sql(
        f"""
        with recursive lines as (select *, {place} as __place from {{lines}}),
        tree as (
            select {", ".join(f"c.{k}" for k in keys)}, c.id, 0 as depth, array(c.__place) as path
            from lines c left anti join lines p on {link} and c.parent_id = p.id
            union all
            select {", ".join(f"c.{k}" for k in keys)}, c.id, p.depth + 1, concat(p.path, array(c.__place))
            from tree p join lines c on {link} and c.parent_id = p.id)
        select *, row_number() over (partition by {", ".join(keys)} order by path) as line_no from tree""",
        lines=lines,
    ).drop("path")
    same = [walked[k].eqNullSafe(lines[k]) for k in [*keys, "id"]]
    found = lines.join(walked, same, "inner")
    return found.select(*[lines[c] for c in lines.columns], walked["depth"].cast("bigint").alias("depth"), walked["line_no"].cast("bigint").alias("line_no"))


def _display_rows(plan_lines: DataFrame, sqltext: DataFrame) -> DataFrame:
    """The texts and plans of all statements as rendered, with ``first`` for the least text and the least plan of each."""
    of_sql = Window.partitionBy("sql_id")
    texts = sqltext.where(F.col("sql_text").isNotNull()).select("sql_id", F.col("sql_text").alias("text")).distinct()
    none = F.lit(None)
    shown = texts.select("sql_id", *_row(_TEXT, none, none, F.lit(0), F.col("text")), (F.col("text") == F.min("text").over(of_sql)).alias("first"))
    lines = plan_table(plan_lines)
    plans = lines.select("sql_id", "dbid", "plan_hash_value").distinct()
    database, hash_value = F.col("dbid"), F.col("plan_hash_value")
    parts = [
        plans.select("sql_id", *_row(_PLAN, database, hash_value, F.lit(-2), F.lit(BLANK))),
        plans.select("sql_id", *_row(_PLAN, database, hash_value, F.lit(-1), _title(hash_value))),
        lines.select("sql_id", *_row(_PLAN, database, hash_value, F.col("id"), _line(lines.columns))).distinct(),
    ]
    least = (F.col("plan_hash_value") == F.min("plan_hash_value").over(of_sql)).alias("first")
    return shown.unionByName(parts[0].unionByName(parts[1]).unionByName(parts[2]).select("*", least))


def register_functions(plan_lines: DataFrame, sqltext: DataFrame, prefix: str = "") -> list[str]:
    """Table functions for report SQL: ``display(sql_id [, plan])`` and ``display_plan(sql_id)``, as ``render`` and ``render_first``.

    They give section, dbid, plan_hash_value, line and text; order by these. A plan that is not stored has no title here. The
    functions are temporary and plain SQL over a temporary view of all statements; a statement's filter reaches the scans.
    """
    spark, view = plan_lines.sparkSession, f"{prefix}display_rows"
    _display_rows(plan_lines, sqltext).createOrReplaceTempView(view)
    columns = "section int, dbid bigint, plan_hash_value bigint, line bigint, text string"
    rows = f"select section, dbid, plan_hash_value, line, text from {view} where sql_id = wanted"
    bodies = {
        "display(wanted string, plan bigint default null)": f"""
            select {_HEADER}, cast(null as bigint), cast(null as bigint), 0L, concat('SQL ID ', wanted)
            union all select {_RULE}, cast(null as bigint), cast(null as bigint), 0L, '{RULE}'
            union all {rows} and section = {_TEXT} and (first or plan is not null)
            union all {rows} and section = {_PLAN} and (plan is null or plan_hash_value = plan)""",
        "display_plan(wanted string)": f"{rows} and section = {_PLAN} and first and line >= -1",
    }
    for signature, body in bodies.items():
        spark.sql(f"create or replace temporary function {prefix}{signature} returns table ({columns}) return {body}")
    return [f"{prefix}{signature.split('(')[0]}" for signature in bodies]
