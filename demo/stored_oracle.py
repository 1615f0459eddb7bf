"""SQL for the check of the queries on stored tables, written from the definitions."""

from __future__ import annotations

from waitlens.constants import SQLSTAT_DELTAS

_WIDE_SUMS = ", ".join(
    f"sum((o_orderkey * {n + 1} + o_custkey) % {97 + n}) as {c}" for n, c in enumerate(SQLSTAT_DELTAS)
)
_WIDE_TOTALS = ", ".join(
    f"cast(sum({c}) over (partition by dbid, instance_number, sql_id order by snap_id) as bigint) as {c}" for c in SQLSTAT_DELTAS
)
_WIDE_CHANGES = ", ".join(f"s.{c} - o.{c} as {d}" for c, d in SQLSTAT_DELTAS.items())

INPUTS = {
    "wide": f"""
select snap_id, dbid, instance_number, sql_id, cast(0 as bigint) as plan_hash_value, {_WIDE_TOTALS}
from (select cast(year(o_orderdate) * 12 + month(o_orderdate) as bigint) as snap_id, 1 + o_custkey % 3 as dbid,
             1 + o_custkey % 2 as instance_number, concat('q', cast(o_custkey % 50 as string)) as sql_id, {_WIDE_SUMS}
      from orders group by 1, 2, 3, 4) g""",
    "wide_previous": """
select c.dbid, c.instance_number, c.snap_id, max(o.snap_id) as previous
from (select distinct dbid, instance_number, snap_id from wide) c
left join (select distinct dbid, instance_number, snap_id from wide) o
     on o.dbid = c.dbid and o.instance_number = c.instance_number and o.snap_id < c.snap_id
group by 1, 2, 3""",
    "wide_deltas": f"""
select s.*, {_WIDE_CHANGES}
from wide s join wide_previous p on p.dbid = s.dbid and p.instance_number = s.instance_number and p.snap_id = s.snap_id
left join wide o on o.dbid = s.dbid and o.instance_number = s.instance_number and o.sql_id = s.sql_id and o.snap_id = p.previous""",
    "osstat": """
select snap_id, dbid, inst_id, event_no as osstat_id, cast(sum(wait_count * wait_time_milli) as bigint) as value
from event_histogram group by 1, 2, 3, 4""",
    "metric_wanted": """
select m.* from metric_rows m
where intsize_csec > 2000 and exists (select 1 from metric_names n where n.dbid = m.dbid and n.metric_id = m.metric_id)""",
    "metric_load1": """
select * from metric_wanted where begin_time < timestamp '1998-02-01 00:00:00' and begin_time > timestamp '1998-01-02 00:00:00'""",
    "metric_load2": """
select w.* from metric_wanted w left join (select dbid, inst_id, max(begin_time) as mark from metric_load1 group by 1, 2) k
     on k.dbid = w.dbid and k.inst_id = w.inst_id
where begin_time < timestamp '1999-01-01 00:00:00' and begin_time > coalesce(mark, timestamp '1998-12-02 00:00:00')""",
    "metric_load3": """
select w.* from metric_wanted w
left join (select dbid, inst_id, max(begin_time) as mark from (select * from metric_load1 union all select * from metric_load2) x group by 1, 2) k
     on k.dbid = w.dbid and k.inst_id = w.inst_id
where begin_time < timestamp '2002-01-01 00:00:00' and begin_time > coalesce(mark, timestamp '2001-12-02 00:00:00')""",
    "metric_loads": """
select * exclude (snap_id), cast(1 as bigint) as snap_id from metric_load1
union all select * exclude (snap_id), 2 from metric_load2 union all select * exclude (snap_id), 3 from metric_load3""",
    # the lines of three statements as one, under one hash value in every database
    "shared_lines": """
select distinct dbid, cast(5 as bigint) as plan_hash_value, id, depth, concat(operation, '_', cast(dbid as string)) as operation, options
from plan_lines where sql_id in ('q7', 'q8', 'q9')""",
    "shared_text": """
select dbid, plan_hash_value, id,
       concat(lpad(cast(id as string), 4, ' '), ' | ', repeat(' ', cast(depth as int)), operation, ' ', options) as text from shared_lines""",
    "display_text": """
select distinct dbid, plan_hash_value, id,
       concat(lpad(cast(id as string), 4, ' '), ' | ', repeat(' ', cast(depth as int)), operation, ' ', options) as text
from plan_lines where sql_id in ('q7', 'q8', 'q9')""",
}
NEEDS = {
    "wide_previous": ["wide"],
    "wide_deltas": ["wide", "wide_previous"],
    "osstat": ["event_histogram"],
    "metric_wanted": ["metric_rows", "metric_names"],
    "metric_load1": ["metric_wanted"],
    "metric_load2": ["metric_wanted", "metric_load1"],
    "metric_load3": ["metric_wanted", "metric_load1", "metric_load2"],
    "metric_loads": ["metric_load1", "metric_load2", "metric_load3"],
    "shared_lines": ["plan_lines"],
    "shared_text": ["shared_lines"],
    "display_text": ["plan_lines"],
}

_SUMMARY = """
select {span}, dbid, instance_number, group_id, metric_id, metric_name, metric_unit, min(begin_time) as begin_time,
       max(end_time) as end_time, max(intsize) as intsize, count(*) as num_interval, min(value) as minval, max(value) as maxval,
       round(avg(value), 6) as average, round(stddev_samp(value), 6) as standard_deviation
from metric_named group by 1, 2, 3, 4, 5, 6, 7"""
_NO_TEXT = "select distinct sql_text as text from sqltext where sql_id = 'q7'"


def stored_sql(q: dict[str, str], sql, parts) -> dict[str, str]:
    """``q`` has the queries that rows here share; ``sql`` joins inputs and a body; ``parts`` are the pieces of the jobs' oracle."""
    out = {
        "stored_latest_sqlstats": q["latest_sqlstats"],
        "stored_metric_recent": q["metric_recent"],
        "stored_history_by_snapshot": q["history_by_snapshot"],
        "sqlstat_increments": sql("wide_deltas", "select * from wide_deltas"),
        "sqlstat_history_fleet": sql("wide_deltas", "select * from wide_deltas"),
        "metric_runs": sql("metric_loads", "select * from metric_loads"),
        "metric_marks": sql("metric_loads", "select dbid, inst_id, max(begin_time) as mark from metric_loads group by 1, 2"),
        "delete_expired_hours": sql(
            "samples",
            "select *, cast(sample_time as date) as sample_date from samples where sample_time >= timestamp '2024-01-29 12:00:00'",
        ),
        "expire_snapshot_files": sql(
            "event_histogram snapshots",
            """select * from event_histogram h where exists (select 1 from snapshots s where s.hist_sample_id = h.snap_id
               and s.hist_date >= timestamp '2024-01-23 00:00:00')""",
        ),
        "dim_merge_buckets": q["dim_upsert"],
        "metric_summary_from_moments": sql("metric_named", _SUMMARY.format(span="snap_id")),
        "metric_summary_by_year": sql("metric_named", _SUMMARY.format(span="(snap_id - 1) // 12 as year")),
        "stream_activity_compacted": q["stream_activity"],
        "osstat_named": sql(
            "osstat event_names",
            """select o.snap_id, o.dbid, o.inst_id as instance_number, o.osstat_id, n.name as stat_name, o.value
               from osstat o join event_names n on n.dbid = o.dbid and n.event_no = o.osstat_id""",
        ),
        "wait_groups_file": q["wait_class_remap"],
        "active_session_filter_wide_blockers": q["active_session_filter"]
        .replace("& 2147418112) // 65536", "& 2147221504) // 262144")
        .replace("& 65535 end", "& 262143 end"),
        "view_parameter": sql("", _PARAMS + " select * from params where dbid = 2"),
        "view_dba_users": sql("users", "select * from users where dbid = 2"),
        "view_dba_data_files": sql("data_files", "select * from data_files where dbid = 2"),
        "view_all_objects": sql("objects", "select * from objects where dbid = 2"),
        "view_sql": sql("sqltext", "select dbid, sql_id, 100 as command_type, sql_text from sqltext where dbid = 2"),
        "view_sqltext_with_newlines": sql("sqltext", "select dbid, sql_id, sql_text from sqltext where dbid = 2"),
        "view_sql_plan": sql("plan_lines", f"select dbid, sql_id, plan_hash_value, operation, options, id, parent_id, depth, {_PLAN_NULLS} from plan_lines where dbid = 2"),
        "view_sqlstats": sql(
            "wide",
            """select * exclude (snap_id) from wide where dbid = 2 and instance_number = 1
               and snap_id = (select max(snap_id) from wide where dbid = 2 and instance_number = 1)""",
        ),
        "view_iostat_function": sql(
            "iofuncstats snapshots",
            """select * exclude (snap_id) from iofuncstats where dbid = 2 and instance_number = 1
               and snap_id = (select max(hist_sample_id) from snapshots where dbid = 2 and instance_number = 1)""",
        ),
        "view_instance": sql(
            "targets",
            """select '19' as version, inst_num as instance_number, host as host_name, concat(dbname, '_', cast(inst_num as string)) as instance_name
               from targets where dbid = 2 and inst_num = 2""",
        ),
        "view_database": sql(
            "targets",
            """select dbid, host as host_name, concat(dbname, '_', cast(inst_num as string)) as instance_name, dbname as name
               from targets where dbid = 2 and inst_num = 2""",
        ),
        "plan_render_shared": sql("shared_text sqltext", parts.render("select distinct dbid, plan_hash_value from shared_text", f"select min(text) as text from ({_NO_TEXT}) m", "select * from shared_text")),
        "plan_render_first_shared": sql(
            "shared_text",
            f"""select distinct 3 as section, dbid, plan_hash_value, cast(-1 as bigint) as line, {parts.title} as text from shared_text
            union all select 3, dbid, plan_hash_value, id, text from shared_text""",
        ),
        "plan_display_sql": sql(
            "display_text sqltext",
            f""", whole as ({parts.render("select distinct dbid, plan_hash_value from display_text", f"select min(text) as text from ({_NO_TEXT}) m", "select * from display_text")})
            , one as ({parts.render("select distinct dbid, plan_hash_value from display_text where plan_hash_value = 1", _NO_TEXT, "select * from display_text where plan_hash_value = 1")})
            select 'all' as called, * from whole union all select 'one', * from one
            union all select 'first', * from whole where section = 3 and line >= -1
                and plan_hash_value = (select min(plan_hash_value) from display_text)""",
        ),
        "plan_tree": _PLAN_TREE.format(lines=parts.inputs["plan_lines"].strip()),
    }
    last, hot = parts.last_snap, "hot_month"
    stamped = "select * exclude (snap_id), cast({last} as bigint) as snap_id from {table}"
    of_job = {
        "users": ("customers users", parts.new_customers),
        "data_files": ("data_files", "select * from data_files"),
        "sqltext": ("hot sqltext sqltext_by_plan", f"select *, cast(1 as bigint) as command_type from ({parts.new_text.format(hot='hot')}) x"),
        "sqlstats": ("hot sqlstat_deltas", parts.one_sql.format(hot="hot")),
        "plan_lines": ("hot plan_lines", parts.new_lines.format(hot="hot")),
        "objects": ("samples objects", f"{parts.hot_month} {parts.new_objects}"),
        "metric_history": ("metric_rows metric_names", f"select * exclude (snap_id), cast({last} as bigint) as snap_id from ({parts.metric_new}) m"),
        "io_events": ("system_events", f"select *, timestamp '2024-01-31 00:00:00' as sample_time, cast({last} as bigint) as snap_id from ({parts.io_events}) e"),
        "instance_stats": ("instance_stats stat_names", f"select *, timestamp '2024-01-31 00:00:00' as sample_time from ({_FLAGGED}) e"),
        "snapshots": ("targets", f"select cast({last} as bigint) as hist_sample_id, dbid, inst_num as instance_number, timestamp '2024-01-31 00:00:00' as hist_date from targets"),
    }
    for table in ("event_histogram", "time_model", "osstat", "iofuncstats"):
        of_job[table] = (table, stamped.format(last=last, table=table))
    assert hot in parts.hot_month
    out |= {f"snapshot_of_{name}": sql(inputs, body) for name, (inputs, body) in of_job.items()}
    not_first = "select * from {table} where dbid <> 1"
    of_load = {
        "event_names": ("event_names", not_first.format(table="event_names")),
        "users": ("customers users", parts.new_customers),
        "stat_names": ("stat_names", "select dbid, statistic, name, cast(0 as bigint) as collect from stat_names where dbid <> 1"),
        "time_model_names": ("event_names", "select dbid, event_no as stat_id, name as stat_name from event_names where dbid <> 1"),
        "extents": ("extents", "select distinct * from extents x where segment_type <> 'ECONOMY'"),
        "data_files": ("data_files", "select * from data_files"),
        "latches": ("metric_names", "select dbid, metric_id as latch_no, metric_name as name from metric_names where dbid <> 1"),
        "osstat_names": ("event_names", "select dbid, event_no as osstat_id, name as stat_name from event_names where dbid <> 1"),
        "params": ("", _PARAMS + " select * from params where dbid <> 1"),
        "metric_names": ("metric_names", "select dbid, metric_id, 'User Transaction Per Sec' as metric_name, metric_unit from metric_names where dbid <> 1 and metric_id = 0"),
    }
    return out | {f"load_of_{name}": sql(inputs, body) for name, (inputs, body) in of_load.items()}


_FLAGGED = """
select i.* from instance_stats i
where statistic in (select statistic from stat_names n where n.dbid = i.dbid and collect = 1)"""
_PARAMS = """
with params as (select d.dbid, n_name as name, cast(n_regionkey as string) as value
from nation cross join (select distinct 1 + user_id % 3 as dbid from events) d)"""
_PLAN_NULLS = ", ".join(
    f"cast(null as string) as {c}"
    for c in ("address", "hash_value", "child_number", "object_no", "object_alias", "search_columns", "projection", "time", "qblock_name", "remarks")
)
_PLAN_TREE = """
with recursive lines as ({lines}), tree as (
    select dbid, inst_id, sql_id, plan_hash_value, id, cast(0 as bigint) as depth, [id] as path from lines c
    where not exists (select 1 from lines p where p.dbid = c.dbid and p.inst_id = c.inst_id and p.sql_id = c.sql_id
                      and p.plan_hash_value = c.plan_hash_value and p.id = c.parent_id)
    union all
    select c.dbid, c.inst_id, c.sql_id, c.plan_hash_value, c.id, p.depth + 1, list_append(p.path, c.id)
    from tree p join lines c on p.dbid = c.dbid and p.inst_id = c.inst_id and p.sql_id = c.sql_id
         and p.plan_hash_value = c.plan_hash_value and p.id = c.parent_id)
select l.* exclude (depth), t.depth,
    row_number() over (partition by t.dbid, t.inst_id, t.sql_id, t.plan_hash_value order by t.path) as line_no
from tree t join lines l using (dbid, inst_id, sql_id, plan_hash_value, id)"""
