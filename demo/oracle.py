"""SQL for the check of the registered queries, written from the definitions and not from the Spark plans.

The inputs come first, as common table expressions over the driver tables; every query names those it needs.
"""

from __future__ import annotations

from types import SimpleNamespace

from demo import stored_oracle

_INPUTS = {
    "samples": """
select 1 + user_id % 3 as dbid, 1 + (event_id % 4) % 2 as inst_id, event_id as sample_id,
       date_trunc('second', ts) as sample_time, user_id as session_id, user_id % 20 as user_id,
       case when event_type = 'purchase' then 'ON CPU' else 'WAITING' end as session_state,
       cast(case when user_id % 10 = 0 then 17 when user_id % 10 = 1 then 2 when user_id % 10 = 2 then 4 else 1 end as bigint) as session_type,
       event_id % 26 as event_no,
       case when event_id % 11 = 0 then null when event_id % 13 = 0 then '0'
            else concat('q', cast(cast(floor(value) as bigint) % 40 as string)) end as sql_id,
       event_id % 3 as sql_plan_hash_value, event_id % 8 as sql_opcode,
       event_id % 100 as p1, event_id % 7 as p2, user_id as p3, cast(floor(value * 1000) as bigint) as time_waited,
       user_id as current_obj, 1 + event_id % 4 as current_file, (event_id * 37) % 4096 as current_block,
       concat('prog', cast(user_id % 5 as string)) as program, event_type as module,
       case when event_id % 17 = 0 then user_id end as qc,
       cast(case event_id % 8 when 0 then 4294967295 when 1 then 4294967292 when 2 then 4294967291
            else 65536 * (1 + user_id % 2) + event_id % 150 end as bigint) as ksuseblocker
from events""",
    "raw_sessions": """
select s.*, event_id % 2 as ksspaflg, event_id % 16 as ksuseidl, event_id % 5 as ksusetim,
       cast(case when event_id % 9 = 0 then 4294967293 else 262144 * (1 + event_id % 3) + event_id % 500 end as bigint) as ksusefblocker,
       (event_id % 4) * 1024 as ksusstmbv,
       case when event_id % 9 = 0 then 65535 else event_id % 4 end as sql_child_number, event_id % 6 as sql_exec_id,
       event_id % 5 as plsql_entry_object_id, event_id % 3 as plsql_entry_subprogram_id,
       event_id % 7 as plsql_object_id, event_id % 4 as plsql_subprogram_id
from samples s join events e on s.sample_id = e.event_id""",
    "event_names": """
select d.dbid, cast(n_nationkey as bigint) as event_no, cast(n_nationkey + 5000 as bigint) as event_id, n_name as name,
       case when n_nationkey = 24 then null when r_regionkey = 0 then 'User I/O' when r_regionkey = 1 then 'System I/O'
            when r_regionkey = 2 then 'Concurrency' when r_regionkey = 3 then 'Application' else 'Idle' end as wait_class,
       cast(1000 + r_regionkey as bigint) as wait_class_id
from nation join region on n_regionkey = r_regionkey
cross join (select distinct 1 + user_id % 3 as dbid from events) d""",
    "snapshots": """
select distinct cast(day(ts) as bigint) as hist_sample_id, 1 + user_id % 3 as dbid,
       1 + (event_id % 4) % 2 as instance_number, date_trunc('day', ts) as hist_date
from events""",
    "sqlstats": """
select snap_id, dbid, instance_number, sql_id, plan_hash_value,
       cast(sum(n) over (partition by dbid, sql_id order by snap_id) as bigint) as executions,
       cast(sum(cents) over (partition by dbid, sql_id order by snap_id) as bigint) as elapsed_time
from (select cast(year(o_orderdate) * 12 + month(o_orderdate) as bigint) as snap_id, 1 + o_custkey % 3 as dbid,
             cast(1 as bigint) as instance_number, concat('q', cast(o_custkey % 50 as string)) as sql_id,
             cast(0 as bigint) as plan_hash_value, count(*) as n,
             sum(cast(round(o_totalprice * 100) as bigint)) as cents
      from orders group by 1, 2, 4) g""",
    "metric_rows": """
select 1 + l_suppkey % 3 as dbid, cast(1 as bigint) as inst_id,
       cast(year(l_shipdate) * 12 + month(l_shipdate) as bigint) as snap_id, date_trunc('day', l_shipdate) as begin_time,
       cast(case when l_linenumber % 2 = 1 then 6000 else 1500 end as bigint) as intsize_csec,
       cast(2 as bigint) as group_id, l_partkey % 6 as metric_id, l_quantity as value
from lineitem""",
    "metric_names": """
select cast(1 + r.r_regionkey % 3 as bigint) as dbid, cast(m.r_regionkey as bigint) as metric_id, m.r_name as metric_name,
       'Per Second' as metric_unit
from region r cross join region m where r.r_regionkey < 3""",
    "metric_named": """
select snap_id, n.dbid, inst_id as instance_number, begin_time,
       begin_time + to_milliseconds(intsize_csec * 10) as end_time, intsize_csec as intsize,
       group_id, n.metric_id, metric_name, value, metric_unit
from metric_names n, metric_rows h where n.metric_id = h.metric_id and n.dbid = h.dbid""",
    "event_histogram": """
select cast(day(ts) as bigint) as snap_id, 1 + user_id % 3 as dbid, cast(1 as bigint) as inst_id, event_id % 26 as event_no,
       cast(case when value <= 1 then 1 when value <= 2 then 2 when value <= 4 then 4 when value <= 8 then 8 when value <= 16 then 16
            when value <= 32 then 32 when value <= 64 then 64 when value <= 128 then 128 when value <= 256 then 256 else 512 end as bigint)
       as wait_time_milli, count(*) as wait_count
from events group by 1, 2, 4, 5""",
    "iofuncstats": """
select dbid, inst_id as instance_number, snap_id, event_no as function_id, cast(sum(wait_count) as bigint) as number_of_waits,
       max(wait_time_milli) as wait_time
from event_histogram group by 1, 2, 3, 4""",
    "time_model": """
select snap_id, dbid, inst_id, event_no as stat_id, cast(sum(wait_count) as bigint) as value
from event_histogram group by 1, 2, 3, 4""",
    "system_events": """
select 1 + user_id % 3 as dbid, 1 + (event_id % 4) % 2 as inst_id,
       case event_id % 10 when 0 then 'log file sync' when 1 then 'log file parallel write' when 2 then 'db file scattered read'
            when 3 then 'db file sequential read' when 4 then 'direct path read' when 5 then 'direct path read temp'
            when 6 then 'direct write' when 7 then 'direct write temp' when 8 then 'latch free' else 'buffer busy waits' end as event,
       count(*) as total_waits, cast(sum(cast(floor(value * 1000) as bigint)) as bigint) as time_waited_micro
from events group by 1, 2, 3""",
    "instance_stats": """
select 1 + o_custkey % 3 as dbid, cast(1 as bigint) as inst_id, o_custkey % 7 as statistic, count(*) as value
from orders group by 1, 3""",
    "stat_names": """
select d.dbid, cast(r_regionkey as bigint) as statistic, r_name as name, 1 - r_regionkey % 2 as collect
from region cross join (select distinct 1 + user_id % 3 as dbid from events) d""",
    "targets": """
select d as dbid, concat('host', cast(d as string)) as host, cast(1521 as bigint) as port, concat('db', cast(d as string)) as dbname,
       i as inst_num
from (select distinct 1 + user_id % 3 as d, 1 + (event_id % 4) % 2 as i from events
      union all select cast(9 as bigint), cast(1 as bigint)) t""",
    "sqltext": """
select 1 + p_partkey % 3 as dbid, concat('q', cast(p_partkey % 30 as string)) as sql_id, min(p_name) as sql_text from part group by 1, 2""",
    "sqltext_by_plan": """
select 1 + p_partkey % 3 as dbid, concat('q', cast(p_partkey % 40 as string)) as sql_id, p_name as sql_text from part""",
    "plan_lines": """
select concat('q', cast(l_orderkey % 40 as string)) as sql_id, l_orderkey % 3 as plan_hash_value,
       cast(l_linenumber as bigint) - 1 as id, cast(l_linenumber as bigint) - 2 as parent_id, cast(l_linenumber as bigint) - 1 as depth,
       concat('OP_', min(l_returnflag)) as operation, concat('OPT_', min(l_linestatus)) as options,
       1 + l_orderkey % 3 as dbid, 1 + l_orderkey % 2 as inst_id
from lineitem group by 1, 2, 3, 4, 5, 8, 9""",
    "customers": "select 1 + c_custkey % 3 as dbid, c_custkey as user_id, c_name as username from customer",
    "users": "select 1 + c_custkey % 3 as dbid, c_custkey as user_id, c_name as username from customer where c_acctbal >= 0",
    "new_users": "select 1 + c_custkey % 3 as dbid, c_custkey as user_id, c_name as username from customer where c_acctbal < 0",
    "renamed_users": """
select 1 + c_custkey % 3 as dbid, c_custkey as user_id, c_name as username from customer where c_mktsegment = 'BUILDING'""",
    "objects": """
select 1 + p_partkey % 3 as dbid, p_partkey as object_id, p_name as object_name, p_type as object_type from part""",
    "data_files": """
select 1 + s_suppkey % 3 as dbid, s_suppkey as file_id, s_name as file_name, concat('ts', cast(s_nationkey as string)) as tablespace_name
from supplier""",
    "extents": """
select 1 + p_partkey % 3 as dbid, 1 + p_partkey % 4 as file_id, 16 * (p_partkey // 12) as block_id,
       cast(1 + p_size % 16 as bigint) as blocks, concat(p_name, '_', cast(p_partkey as string)) as segment_name, p_type as segment_type
from part""",
    # session history of the whole fleet, from samples and event names
    "ash": """
select s.dbid, s.inst_id, s.sample_time, s.session_id, s.session_state, s.user_id, s.sql_id, s.sql_plan_hash_value, s.sql_opcode,
       s.p1, s.p2, s.p3, s.current_obj, s.current_file, s.current_block, s.program, s.module, s.sample_id, s.time_waited,
       case s.session_type & 19 when 17 then 'BACKGROUND' when 1 then 'FOREGROUND' when 2 then 'RECURSIVE' else '?' end as session_type,
       case when s.session_state = 'WAITING' then s.event_no end as event_no,
       case when s.session_state = 'WAITING' then s.event_no end as event_id,
       case when s.session_state = 'WAITING' then e.name end as event,
       coalesce(e.wait_class, 'Other') as wait_class, e.wait_class_id,
       case when s.qc is not null then s.inst_id end as qc_instance_id, s.qc as qc_session_id,
       s.p1 as p1text, s.p2 as p2text, s.p3 as p3text,
       case when s.ksuseblocker between 4294967291 and 4294967295 then null else s.ksuseblocker & 65535 end as blocking_session,
       case s.ksuseblocker when 4294967295 then 'UNKNOWN' when 4294967294 then 'UNKNOWN' when 4294967293 then 'UNKNOWN'
            when 4294967292 then 'NO HOLDER' when 4294967291 then 'NOT IN WAIT' else 'VALID' end as blocking_session_status
from samples s join event_names e on e.event_no = s.event_no and e.dbid = s.dbid""",
    # samples of the last week, ranked per target
    "hot_counts": """
select dbid, inst_id, sql_id, sql_plan_hash_value, count(*) as cnt from samples
where sql_id <> '0' and sample_time > timestamp '2024-01-24 00:00:00' and sample_time <= timestamp '2024-01-31 00:00:00'
group by 1, 2, 3, 4""",
    "hot": """
select * exclude (rn) from (select *, row_number() over (partition by dbid, inst_id order by cnt desc, sql_id, sql_plan_hash_value) as rn
from hot_counts) r where rn <= 20""",
    "sqlstat_snaps": "select distinct dbid, instance_number, snap_id from sqlstats",
    "previous_snaps": """
select c.dbid, c.instance_number, c.snap_id, max(o.snap_id) as previous
from sqlstat_snaps c left join sqlstat_snaps o on o.dbid = c.dbid and o.instance_number = c.instance_number and o.snap_id < c.snap_id
group by 1, 2, 3""",
    "sqlstat_deltas": """
select s.*, s.executions - o.executions as executions_delta, s.elapsed_time - o.elapsed_time as elapsed_time_delta
from sqlstats s join previous_snaps p on p.dbid = s.dbid and p.instance_number = s.instance_number and p.snap_id = s.snap_id
left join sqlstats o on o.dbid = s.dbid and o.instance_number = s.instance_number and o.sql_id = s.sql_id
     and o.plan_hash_value = s.plan_hash_value and o.snap_id = p.previous""",
    "sqlstats_latest": """
select * from sqlstats s where snap_id = (select max(snap_id) from sqlstats h where h.dbid = s.dbid and h.instance_number = s.instance_number)""",
    # one statement's plan lines as text
    "plan_text": """
select distinct dbid, plan_hash_value, id, concat(lpad(cast(id as string), 4, ' '), ' | ', repeat(' ', cast(depth as int)), operation, ' ', options) as text
from plan_lines where sql_id = 'q7'""",
}

_NEEDS = {
    "raw_sessions": ["samples"],
    "metric_named": ["metric_rows", "metric_names"],
    "iofuncstats": ["event_histogram"],
    "time_model": ["event_histogram"],
    "ash": ["samples", "event_names"],
    "hot_counts": ["samples"],
    "hot": ["hot_counts"],
    "sqlstat_snaps": ["sqlstats"],
    "previous_snaps": ["sqlstat_snaps"],
    "sqlstat_deltas": ["sqlstats", "previous_snaps"],
    "sqlstats_latest": ["sqlstats"],
    "plan_text": ["plan_lines"],
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for needed in [*_closure(_NEEDS.get(name, [])), name]:
            if needed not in ordered:
                ordered.append(needed)
    return ordered


_INPUTS |= stored_oracle.INPUTS
_NEEDS |= stored_oracle.NEEDS


def _sql(inputs: str, body: str) -> str:
    parts = [f"{name} as ({_INPUTS[name].strip()})" for name in _closure(inputs.split())]
    return f"with {', '.join(parts)} {body.strip()}" if parts else body.strip()


# percent of the total with two digits, half up, in whole numbers
_LOAD = """
select {keys}, cnt, ((cnt * 20000 + total) // (2 * total)) / 100.0 as pctload
from (select {exprs}, count(*) as cnt, cast(sum(count(*)) over () as bigint) as total from ash where {where} group by {groups}) g"""


def _load(keys: dict[str, str], where: str) -> str:
    return _LOAD.format(
        keys=", ".join(keys),
        exprs=", ".join(f"{e} as {k}" for k, e in keys.items()),
        where=where,
        groups=", ".join(str(i + 1) for i in range(len(keys))),
    )


_LAST_WEEK = "sample_time > timestamp '2024-01-24 00:00:00' and sample_time <= timestamp '2024-01-31 00:00:00'"
_LAST_MONTH = "sample_time > timestamp '2024-01-01 00:00:00' and sample_time <= timestamp '2024-01-31 00:00:00'"
_LAST_DAY = "sample_time > timestamp '2024-01-29 00:00:00' and sample_time <= timestamp '2024-01-30 00:00:00'"
_TOP_RANGE = "sample_time >= timestamp '2024-01-08 00:00:00' and sample_time <= timestamp '2024-01-22 00:00:00'"
_EVENT_OR_CPU = "case when session_state = 'ON CPU' then 'ON CPU' else event end"
_SQL_KEYS = {"sql_id": "sql_id", "sql_plan_hash_value": "sql_plan_hash_value"}
_SESSION = f"session_id = 7 and {_LAST_MONTH}"
_EVENT = f"{_LAST_WEEK} and session_type <> 'BACKGROUND' and event = 'NATION_0'"

_CLASS_TITLES = {
    "User I/O": "User I/O", "System I/O": "System I/O", "Administrative": "Administration", "Other": "Other",
    "Configuration": "Configuration", "Application": "Application", "Concurrency": "Concurrency", "Network": "Network",
}
_WAITS = ", ".join(
    f"""nullif(count(*) filter (where session_state = 'WAITING' and wait_class = '{c}'), 0) as "{title}\""""
    for c, title in _CLASS_TITLES.items()
)

_TOP_SQL = f"""
select sql_id, nullif(count(*) filter (where session_state = 'ON CPU'), 0) as "CPU", {_WAITS}, count(*) as "Total"
from ash
where {_TOP_RANGE} and session_state in ('WAITING', 'ON CPU') and sql_id is not null
group by sql_id order by "Total" desc, sql_id limit 9"""

_GRAPH = f"""
, buckets as (
  select cast(to_timestamp(900 * cast(floor(epoch(sample_time) / 900) as bigint)) at time zone 'UTC' as timestamp) as bucket_time,
         case when session_state = 'WAITING' then wait_class when session_state = 'ON CPU' then 'ON CPU' end as wait_class
  from ash where {_LAST_DAY})
, edge as (
  select distinct wait_class from event_names where wait_class <> 'Idle' union all select 'ON CPU' union all select 'null')
, points as (
  select bucket_time, wait_class, count(*) / 900.0 as cnt, cast(null as integer) as wait_order from buckets group by 1, 2
  union all
  select timestamp '2024-01-30 00:00:00' - to_seconds(900 * k), 'null', 0.001, null from range(1, 97) r(k)
  union all
  select timestamp '2024-01-28 23:45:00', wait_class, 0.001,
         case wait_class when 'null' then 0 when 'ON CPU' then 1 when 'User I/O' then 2 when 'System I/O' then 3 when 'Concurrency' then 4
              when 'Application' then 5 when 'Commit' then 6 when 'Configuration' then 7 when 'Administrative' then 8 when 'Network' then 9
              when 'Queueing' then 10 when 'Other' then 11 when 'Scheduler' then 12 when 'Cluster' then 13 end
  from edge)
select bucket_time, strftime(bucket_time, '%H:%M:%S') as dtime, wait_class, cnt, wait_order from points"""

_DECODED = """
select r.dbid, r.inst_id, r.sample_time, r.session_id, r.user_id, r.sql_id, r.sql_plan_hash_value, r.sql_opcode, r.p1, r.p2, r.p3,
       r.time_waited, r.current_obj, r.current_file, r.current_block, r.program, r.module, r.qc, r.ksuseblocker,
       nullif(r.sql_child_number, 65535) as sql_child_number, nullif(r.sql_exec_id, 0) as sql_exec_id,
       nullif(r.plsql_entry_object_id, 0) as plsql_entry_object_id,
       case when r.plsql_entry_object_id = 0 then null else r.plsql_entry_subprogram_id end as plsql_entry_subprogram_id,
       case when r.plsql_object_id <> 0 and r.ksusstmbv & 2048 = 2048 then r.plsql_object_id end as plsql_object_id,
       case when r.plsql_subprogram_id <> 0 and r.ksusstmbv & 2048 = 2048 then r.plsql_subprogram_id end as plsql_subprogram_id,
       case when r.ksusetim = 0 then 'WAITING' else 'ON CPU' end as session_state,
       r.session_type, r.event_no, r.ksusetim as wait_time,
       case when r.ksuseblocker >= 4294967291 then null else (r.ksuseblocker & 2147418112) // 65536 end as blocking_instance,
       case when r.ksuseblocker >= 4294967291 then null else r.ksuseblocker & 65535 end as blocking_session,
       case when r.ksusefblocker >= 4294967291 then null else (r.ksusefblocker & 2147418112) // 65536 end as final_blocking_instance,
       case when r.ksusefblocker >= 4294967291 then null else r.ksusefblocker & 65535 end as final_blocking_session
from raw_sessions r
where r.session_id <> 3 and r.ksspaflg & 1 <> 0 and r.session_type & 1 <> 0 and """
_NOT_IDLE = "r.event_no not in (select e.event_no from event_names e where e.dbid = r.dbid and e.wait_class = 'Idle')"

_LAST_SNAP = 2001 * 12 + 6
_PLAN_TITLE = "concat('Plan hash value is :', cast(plan_hash_value as string))"


def _render(plans: str, texts: str, lines: str) -> str:
    return f"""
select 0 as section, cast(null as bigint) as dbid, cast(null as bigint) as plan_hash_value, cast(0 as bigint) as line, 'SQL ID q7' as text
union all select 1, null, null, 0, repeat('-', 40)
union all select 2, null, null, 0, text from ({texts}) x where text is not null
union all select 3, dbid, plan_hash_value, -2, repeat(' ', 40) from ({plans}) x
union all select 3, dbid, plan_hash_value, -1, {_PLAN_TITLE} from ({plans}) x
union all select 3, dbid, plan_hash_value, id, text from ({lines}) x"""


def _counts(parts: dict[str, str]) -> str:
    return " union all ".join(f"select '{name}' as table_name, count(*) as n from ({body}) x" for name, body in parts.items())


_HOT_MONTH = """
, hot_month as (select current_obj as object_id from samples where current_obj > 0 and sample_time > timestamp '2024-01-01 00:00:00'
  and sample_time <= timestamp '2024-01-31 00:00:00' group by 1 order by count(*) desc, 1 limit 99)"""
_NEW_TEXT = """
select dbid, sql_id, min(sql_text) as sql_text from sqltext_by_plan p
where exists (select 1 from {hot} h where h.dbid = p.dbid and h.sql_id = p.sql_id)
  and not exists (select 1 from sqltext s where s.dbid = 1 and s.dbid = p.dbid and s.sql_id = p.sql_id)
group by 1, 2"""
_NEW_LINES = """
select p.* from plan_lines p
where exists (select 1 from {hot} h where h.dbid = p.dbid and h.inst_id = p.inst_id and h.sql_id = p.sql_id
              and h.sql_plan_hash_value = p.plan_hash_value)
  and not exists (select 1 from plan_lines s where s.inst_id = 1 and s.dbid = p.dbid and s.inst_id = p.inst_id and s.sql_id = p.sql_id
                  and s.plan_hash_value = p.plan_hash_value)"""
_NEW_OBJECTS = """
select o.* from objects o where object_id in (select object_id from hot_month)
  and not exists (select 1 from objects s where s.dbid = 2 and s.dbid = o.dbid and s.object_id = o.object_id)"""
_VARIANTS = ", variants as (select distinct dbid, inst_id, sql_id, sql_plan_hash_value from samples where sql_id = 'q7')"
_METRIC_NEW = """
select m.* from metric_rows m
where intsize_csec > 2000 and exists (select 1 from metric_names n where n.dbid = m.dbid and n.metric_id = m.metric_id)
  and begin_time > coalesce((select max(begin_time) from metric_rows l where l.dbid = m.dbid and l.inst_id = m.inst_id
                             and l.begin_time < timestamp '2000-01-01 00:00:00'), timestamp '2001-10-06 00:00:00')"""
_NEW_CUSTOMERS = """
select * from customers c where not exists (select 1 from users u where u.dbid = c.dbid and u.user_id = c.user_id)"""
_IO_EVENTS = "select * from system_events where event not in ('latch free', 'buffer busy waits')"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["session_history"] = _sql("ash", "select * from ash")
    q["top_sql_by_wait_class"] = _sql("ash", _TOP_SQL)
    q["db_time_by_sql"] = _sql(
        "ash",
        _load(
            {"sample_time": "date_trunc('hour', sample_time)", "event": _EVENT_OR_CPU, **_SQL_KEYS},
            f"{_LAST_WEEK} and session_type <> 'BACKGROUND'",
        ),
    )
    q["event_rows"] = _sql("ash", f"select * from ash where {_EVENT}")
    q["event_details"] = _sql(
        "ash", f"select sample_time, sql_opcode, session_state, p1text, program, module from ash where {_EVENT}"
    )
    q["top_sessions"] = _sql("ash", _load({"session_id": "session_id"}, _LAST_WEEK))
    q["session_details"] = _sql("ash", f"select * from ash where {_SESSION}")
    q["session_sqls"] = _sql("ash", _load(_SQL_KEYS, _SESSION))
    q["session_events"] = _sql("ash", _load({"event": "event"}, _SESSION))
    q["session_sql_events"] = _sql("ash", _load({"event": _EVENT_OR_CPU, **_SQL_KEYS}, _SESSION))
    q["activity_graph"] = _sql("ash", _GRAPH)

    q["counter_delta"] = _sql("sqlstat_deltas", "select * from sqlstat_deltas")
    q["sqlstat_history"] = _sql("sqlstat_deltas", "select * from sqlstat_deltas where dbid = 1")
    q["latest_sqlstats"] = _sql("sqlstats_latest", "select * from sqlstats_latest")
    q["sqlstats_for_sql"] = _sql("sqlstats_latest", "select * from sqlstats_latest where sql_id = 'q7'")
    q["latest_iostat"] = _sql(
        "iofuncstats snapshots",
        """select * from iofuncstats io where snap_id = (select max(hist_sample_id) from snapshots h
           where h.instance_number = io.instance_number and h.dbid = io.dbid)""",
    )
    q["snapshot_stamp"] = _sql(
        "event_histogram",
        """select dbid, inst_id, event_no, wait_time_milli, cast(sum(wait_count) as bigint) as wait_count, cast(32 as bigint) as snap_id
           from event_histogram group by 1, 2, 3, 4""",
    )
    q["io_event_snapshot"] = _sql("system_events", f"select *, cast(32 as bigint) as snap_id from ({_IO_EVENTS}) e")
    q["flagged_stat_snapshot"] = _sql(
        "instance_stats stat_names",
        """select i.* from instance_stats i
           where statistic in (select statistic from stat_names n where n.dbid = i.dbid and collect = 1)""",
    )
    q["metric_incremental"] = _sql("metric_rows metric_names", _METRIC_NEW)
    q["snapshot_register"] = _sql(
        "metric_rows",
        """select snap_id as hist_sample_id, dbid, inst_id as instance_number, min(begin_time) as hist_date
           from metric_rows group by 1, 2, 3""",
    )
    q["snapshot_list"] = _sql(
        "snapshots", "select hist_sample_id as snap_id, dbid, instance_number, hist_date as begin_interval_time from snapshots"
    )
    q["metric_history"] = _sql("metric_named", "select * from metric_named")
    q["metric_recent"] = _sql(
        "metric_named",
        """select * from metric_named where dbid = 1 and instance_number = 1
           and begin_time > timestamp '2001-10-06 00:00:00' and begin_time <= timestamp '2001-11-05 00:00:00'""",
    )
    q["metric_summary"] = _sql(
        "metric_named",
        """select snap_id, dbid, instance_number, group_id, metric_id, metric_name, metric_unit, min(begin_time) as begin_time,
                  max(end_time) as end_time, max(intsize) as intsize, count(*) as num_interval, min(value) as minval, max(value) as maxval,
                  round(avg(value), 6) as average, round(stddev_samp(value), 6) as standard_deviation
           from metric_named group by 1, 2, 3, 4, 5, 6, 7""",
    )
    q["event_histogram_named"] = _sql(
        "event_histogram event_names",
        """select h.snap_id, h.dbid, h.inst_id as instance_number, e.event_id, e.name as event_name, cast(null as bigint) as wait_class_id,
                  e.wait_class, h.wait_time_milli, h.wait_count
           from event_histogram h join event_names e on e.dbid = h.dbid and e.event_no = h.event_no""",
    )
    q["time_model_named"] = _sql(
        "time_model event_names",
        """select m.snap_id, m.dbid, m.inst_id as instance_number, m.stat_id, n.name as stat_name, m.value
           from time_model m join event_names n on n.dbid = m.dbid and n.event_no = m.stat_id""",
    )

    q["history_by_snapshot"] = _sql(
        "ash snapshots",
        """select s.hist_sample_id as snap_id, s.dbid, a.inst_id as instance_number, a.* exclude (dbid, inst_id)
           from ash a join snapshots s on s.dbid = a.dbid and s.instance_number = a.inst_id
                and a.sample_time between s.hist_date and s.hist_date + interval 1440 minute
           where strftime(a.sample_time, '%S') like '%0'""",
    )
    q["block_to_segment"] = _sql(
        "samples extents",
        """select s.dbid, s.inst_id, s.sample_id, s.session_id, s.current_file, s.current_block, x.segment_name, x.segment_type
           from samples s join extents x on x.dbid = s.dbid and x.file_id = s.current_file
                and s.current_block >= x.block_id and s.current_block < x.block_id + x.blocks""",
    )

    q["active_session_filter"] = _sql("raw_sessions event_names", f"{_DECODED} r.ksuseidl & 9 = 1 and {_NOT_IDLE}")
    q["active_session_filter_v10"] = _sql(
        "raw_sessions event_names", f"{_DECODED} r.ksusetim <> 0 and r.ksuseidl & 11 = 1 and {_NOT_IDLE}"
    )
    q["active_session_filter_v9"] = _sql(
        "raw_sessions event_names", f"{_DECODED} ((r.ksusetim <> 0 and r.ksuseidl & 11 = 1) or r.event_no not in (4, 9))"
    )
    q["blocker_decode"] = _sql(
        "samples",
        """select sample_id, session_id, ksuseblocker,
                  case when ksuseblocker >= 4294967291 then null else (ksuseblocker & 2147418112) // 65536 end as blocking_instance,
                  case when ksuseblocker >= 4294967291 then null else ksuseblocker & 65535 end as blocking_session
           from samples""",
    )
    q["stamp_samples"] = _sql(
        "samples",
        """select dbid, inst_id, sample_time, session_id, session_state, event_no, sql_id, cast(epoch(sample_time) as bigint) as sample_id
           from samples""",
    )
    q["dim_append_new"] = _sql("customers users", _NEW_CUSTOMERS)
    q["dim_append_strict"] = _sql("new_users", "select * from new_users")
    q["dim_append_strict_clash"] = _sql("customers", "select * from customers where 1 = 0")
    q["dim_upsert"] = _sql(
        "users renamed_users",
        """select u.dbid, u.user_id, case when r.user_id is null then u.username else concat(r.username, '*') end as username
           from users u left join renamed_users r on r.dbid = u.dbid and r.user_id = u.user_id
           union all
           select dbid, user_id, concat(username, '*') from renamed_users c
           where not exists (select 1 from users u where u.dbid = c.dbid and u.user_id = c.user_id)""",
    )
    q["metric_name_filter"] = _sql(
        "metric_named",
        "select distinct dbid, metric_id, metric_name, metric_unit from metric_named where metric_name in ('AFRICA', 'ASIA', 'EUROPE')",
    )
    q["wait_class_remap"] = _sql(
        "event_names",
        """select dbid, event_no, event_id, name, case when wait_class_id = 1004 then null when event_no % 4 = 0 then 'Network'
                  when event_no % 4 = 1 then 'Commit' when event_no % 4 = 2 then 'Configuration' else 'Other' end as wait_class, wait_class_id
           from event_names""",
    )

    q["hot_sql"] = _sql("hot", "select * from hot")
    q["hot_sql_target"] = _sql(
        "hot_counts",
        "select * from hot_counts where dbid = 1 and inst_id = 1 order by cnt desc, sql_id, sql_plan_hash_value limit 20",
    )
    q["sql_variants"] = _sql("samples", "select distinct dbid, inst_id, sql_id, sql_plan_hash_value from samples where sql_id = 'q7'")
    q["hot_objects_new"] = _sql("samples objects", f"{_HOT_MONTH} {_NEW_OBJECTS}")
    q["sql_text_new"] = _sql("hot sqltext sqltext_by_plan", _NEW_TEXT.format(hot="hot"))
    q["plan_lines_new"] = _sql("hot plan_lines", _NEW_LINES.format(hot="hot"))
    q["sqlstats_hot"] = _sql(
        "hot sqlstats",
        """select snap_id, dbid, instance_number, sql_id, plan_hash_value, executions, elapsed_time, cast(0 as bigint) as cpu_time
           from sqlstats s where exists (select 1 from hot h where h.dbid = s.dbid and h.inst_id = s.instance_number
                and h.sql_id = s.sql_id and h.sql_plan_hash_value = s.plan_hash_value)""",
    )
    one_sql = f"""select d.* from sqlstat_deltas d where snap_id = {_LAST_SNAP} and exists (select 1 from {{hot}} v
        where v.dbid = d.dbid and v.inst_id = d.instance_number and v.sql_id = d.sql_id and v.sql_plan_hash_value = d.plan_hash_value)"""
    q["snapshot_one_sql"] = _sql("samples sqlstat_deltas", f"{_VARIANTS} {one_sql.format(hot='variants')}")
    q["snapshot_one_plan_lines"] = _sql("samples plan_lines", f"{_VARIANTS} {_NEW_LINES.format(hot='variants')}")

    q["dim_for_target"] = _sql("customers", "select * from customers where dbid = 1")
    q["sql_text_for_sql"] = _sql("sqltext", "select dbid, sql_id, 100 as command_type, sql_text from sqltext where sql_id = 'q7'")
    plan_columns = "dbid, sql_id, plan_hash_value, operation, options, id, parent_id, depth"
    q["plan_rows"] = _sql("plan_lines", f"select {plan_columns} from plan_lines where dbid = 1")
    q["plan_table"] = _sql("plan_lines", f"select distinct {plan_columns} from plan_lines")
    texts = "select distinct sql_text as text from sqltext where sql_id = 'q7'"
    q["plan_render"] = _sql(
        "plan_text sqltext",
        _render("select distinct dbid, plan_hash_value from plan_text", f"select min(text) as text from ({texts}) m", "select * from plan_text"),
    )
    q["plan_render_one"] = _sql(
        "plan_text sqltext",
        _render(
            "select distinct dbid, plan_hash_value from plan_text where plan_hash_value = 1",
            texts,
            "select * from plan_text where plan_hash_value = 1",
        ),
    )
    q["plan_render_first"] = _sql(
        "plan_text",
        f""", first as (select * from plan_text where plan_hash_value = (select min(plan_hash_value) from plan_text))
        select distinct 3 as section, dbid, plan_hash_value, cast(-1 as bigint) as line, {_PLAN_TITLE} as text from first
        union all select 3, dbid, plan_hash_value, id, text from first""",
    )

    q["partitioned_roundtrip"] = _sql(
        "samples", f"select *, cast(sample_time as date) as sample_date from samples where {_TOP_RANGE}"
    )
    q["retention_expire"] = _sql("samples", "select * from samples where sample_time >= timestamp '2024-01-24 00:00:00'")
    q["retention_by_snapshot"] = _sql(
        "event_histogram snapshots",
        """select h.* from event_histogram h where not exists (select 1 from snapshots s where s.hist_sample_id = h.snap_id
           and s.dbid = h.dbid and s.instance_number = h.inst_id and s.hist_date < timestamp '2024-01-23 00:00:00')""",
    )
    q["target_coverage"] = _sql(
        "targets samples",
        """select t.dbid, t.host, t.port, t.dbname, t.inst_num, count(s.sample_id) as samples, min(s.sample_time) as first_sample,
                  max(s.sample_time) as last_sample,
                  coalesce(max(s.sample_time) < timestamp '2024-01-30 21:00:00', true) as stale
           from targets t left join samples s on s.dbid = t.dbid and s.inst_id = t.inst_num group by 1, 2, 3, 4, 5""",
    )
    q["duplicate_keys"] = _sql(
        "users renamed_users",
        """select dbid, user_id, count(*) as cnt from (select * from users union all select * from renamed_users) x
           group by 1, 2 having count(*) > 1""",
    )

    q["stream_ingest"] = _sql("samples", "select *, cast(sample_time as date) as sample_date from samples")
    q["store_lifecycle"] = _sql(
        "samples",
        "select *, cast(sample_time as date) as sample_date from samples where sample_time >= timestamp '2024-01-24 00:00:00'",
    )
    q["stream_activity"] = _sql(
        "ash",
        """select date_trunc('hour', sample_time) as bucket_time,
                  case when session_state = 'WAITING' then wait_class when session_state = 'ON CPU' then 'ON CPU' end as wait_class,
                  count(*) / 3600.0 as cnt
           from ash group by 1, 2""",
    )
    q["stream_db_time"] = _sql(
        "ash",
        f"""select date_trunc('day', sample_time) as bucket_time, {_EVENT_OR_CPU} as event, sql_id, count(*) as n
            from ash where session_type <> 'BACKGROUND' group by 1, 2, 3""",
    )
    q["stream_flagged_stats"] = _sql(
        "stat_names",
        """select 1 + o_custkey % 3 as dbid, cast(1 as bigint) as inst_id, o_orderdate as sample_time, o_custkey % 7 as statistic,
                  o_orderkey as value
           from orders where exists (select 1 from stat_names n where n.dbid = 1 + o_custkey % 3 and n.statistic = o_custkey % 7
                and n.collect = 1)""",
    )
    snapshot_parts = {
        "users": _NEW_CUSTOMERS,
        "data_files": "select * from data_files",
        "sqltext": _NEW_TEXT.format(hot="hot"),
        "sqlstats": one_sql.format(hot="hot"),
        "plan_lines": _NEW_LINES.format(hot="hot"),
        "objects": _NEW_OBJECTS,
        "metric_history": _METRIC_NEW,
        "io_events": _IO_EVENTS,
        "event_histogram": "select * from event_histogram",
        "time_model": "select * from time_model",
        "iofuncstats": "select * from iofuncstats",
        "snapshots": "select * from targets",
    }
    q["snapshot_job"] = _sql(
        "hot customers users data_files sqltext sqltext_by_plan sqlstat_deltas plan_lines objects metric_rows metric_names system_events"
        " iofuncstats time_model targets",
        f"{_HOT_MONTH} {_counts(snapshot_parts)}",
    )
    q["load_dimensions"] = _sql(
        "event_names customers users stat_names extents data_files",
        _counts(
            {
                "event_names": "select * from event_names where dbid <> 1",
                "users": _NEW_CUSTOMERS,
                "stat_names": "select * from stat_names where dbid <> 1",
                "time_model_names": "select * from event_names where dbid <> 1",
                "extents": "select * from extents where segment_type <> 'ECONOMY'",
                "data_files": "select * from data_files",
            }
        ),
    )
    q["report_sql_on_views"] = _sql(
        "ash",
        """select wait_class, session_type, count(*) as cnt from ash where dbid = 1 and inst_id = 1 and session_type <> 'BACKGROUND'
           group by 1, 2""",
    )
    parts = SimpleNamespace(
        inputs=_INPUTS, render=_render, title=_PLAN_TITLE, last_snap=_LAST_SNAP, new_customers=_NEW_CUSTOMERS, new_text=_NEW_TEXT,
        new_lines=_NEW_LINES, new_objects=_NEW_OBJECTS, hot_month=_HOT_MONTH, metric_new=_METRIC_NEW, io_events=_IO_EVENTS, one_sql=one_sql,
    )
    return q | stored_oracle.stored_sql(q, _sql, parts)
