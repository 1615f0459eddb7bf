"""Column types of the input tables."""

from __future__ import annotations

from pyspark.sql import types as T

from waitlens.constants import SQLSTAT_DELTAS, SQLSTAT_OTHER

_LONG, _DOUBLE, _TEXT, _TIME = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _struct(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in spec.items()])


def _columns(kind: T.DataType, names: str) -> dict[str, T.DataType]:
    return {name: kind for name in names.split()}


# The columns of stored samples, in stored order.
SAMPLES = _struct(
    {
        "dbid": _LONG,
        "sample_time": _TIME,
        "session_id": _LONG,
        "session_state": _TEXT,
        "session_serial": _LONG,
        "osuser": _TEXT,
        "session_type": _LONG,
        "user_id": _LONG,
        "command": _LONG,
        "machine": _TEXT,
        "port": _LONG,
        "sql_address": _TEXT,
        "sql_plan_hash_value": _LONG,
        "sql_child_number": _LONG,
        "sql_id": _TEXT,
        "sql_opcode": _LONG,
        "sql_exec_start": _TIME,
        "sql_exec_id": _LONG,
        "plsql_entry_object_id": _LONG,
        "plsql_entry_subprogram_id": _LONG,
        "plsql_object_id": _LONG,
        "plsql_subprogram_id": _LONG,
        "event_no": _LONG,
        "seq_no": _LONG,
        "p1": _LONG,
        "p2": _LONG,
        "p3": _LONG,
        "wait_time": _LONG,
        "time_waited": _LONG,
        "current_obj": _LONG,
        "current_file": _LONG,
        "current_block": _LONG,
        "current_row": _LONG,
        "program": _TEXT,
        "module": _TEXT,
        "module_hash": _LONG,
        "action": _TEXT,
        "action_hash": _LONG,
        "logon_time": _TIME,
        "ksuseblocker": _LONG,
        "service_name": _TEXT,
        "fixed_table_sequence": _LONG,
        "qc": _LONG,
        "blocking_instance": _LONG,
        "blocking_session": _LONG,
        "final_blocking_instance": _LONG,
        "final_blocking_session": _LONG,
        "sample_id": _LONG,
        "terminal": _TEXT,
        "inst_id": _LONG,
    }
)
EVENT_NAMES = _struct(
    _columns(_LONG, "dbid event_no event_id") | _columns(_TEXT, "wait_class name") | _columns(_LONG, "wait_class_id")
)
WAIT_GROUPS = _struct(_columns(_TEXT, "name wait_class"))
SNAPSHOTS = _struct(_columns(_LONG, "hist_sample_id dbid instance_number") | _columns(_TIME, "hist_date"))
SQLSTATS = _struct(
    _columns(_LONG, "snap_id dbid instance_number")
    | _columns(_TEXT, "sql_id")
    | _columns(_LONG, "plan_hash_value")
    | {name: _LONG for name in (*SQLSTAT_DELTAS, *SQLSTAT_OTHER, *SQLSTAT_DELTAS.values())}
)
SQLTEXT = _struct(_columns(_LONG, "dbid") | _columns(_TEXT, "sql_id sql_text") | _columns(_LONG, "command_type"))
# The columns of stored plan lines, in stored order.
PLAN_LINES = _struct(
    {
        "sql_id": _TEXT,
        "plan_hash_value": _LONG,
        "remarks": _TEXT,
        "operation": _TEXT,
        "options": _TEXT,
        "object_node": _TEXT,
        "object_owner": _TEXT,
        "object_name": _TEXT,
        "object_instance": _LONG,
        "object_type": _TEXT,
        "optimizer": _TEXT,
        "search_columns": _LONG,
        "id": _LONG,
        "parent_id": _LONG,
        "depth": _LONG,
        "position": _LONG,
        "cost": _LONG,
        "cardinality": _LONG,
        "bytes": _LONG,
        "other_tag": _TEXT,
        "partition_start": _TEXT,
        "partition_stop": _TEXT,
        "partition_id": _LONG,
        "other": _TEXT,
        "distribution": _TEXT,
        "cpu_cost": _LONG,
        "io_cost": _LONG,
        "temp_space": _LONG,
        "access_predicates": _TEXT,
        "filter_predicates": _TEXT,
        "dbid": _LONG,
        "inst_id": _LONG,
    }
)
METRIC_HISTORY = _struct(
    _columns(_LONG, "dbid inst_id snap_id")
    | _columns(_TIME, "begin_time")
    | _columns(_LONG, "intsize_csec group_id metric_id")
    | _columns(_DOUBLE, "value")
)
METRIC_NAMES = _struct(_columns(_LONG, "dbid metric_id") | _columns(_TEXT, "metric_name metric_unit"))
EVENT_HISTOGRAM = _struct(_columns(_LONG, "snap_id dbid inst_id event_no wait_time_milli wait_count"))
IO_EVENTS = _struct(
    _columns(_LONG, "dbid inst_id snap_id")
    | _columns(_TIME, "sample_time")
    | _columns(_LONG, "total_waits total_timeouts time_waited")
    | _columns(_DOUBLE, "average_wait")
    | _columns(_LONG, "time_waited_micro event_id")
)
IOFUNCSTATS = _struct(
    _columns(_LONG, "dbid instance_number snap_id function_id")
    | _columns(_TEXT, "function_name")
    | _columns(_LONG, "small_read_megabytes small_write_megabytes large_read_megabytes large_write_megabytes")
    | _columns(_LONG, "small_read_reqs small_write_reqs large_read_reqs large_write_reqs number_of_waits wait_time")
)
TIME_MODEL = _struct(_columns(_LONG, "snap_id dbid inst_id stat_id value"))
TIME_MODEL_NAMES = _struct(_columns(_LONG, "dbid stat_id") | _columns(_TEXT, "stat_name"))
OSSTAT = _struct(_columns(_LONG, "snap_id dbid inst_id osstat_id value"))
OSSTAT_NAMES = _struct(_columns(_LONG, "dbid osstat_id") | _columns(_TEXT, "stat_name comments cumulative"))
INSTANCE_STATS = _struct(
    _columns(_LONG, "dbid inst_id") | _columns(_TIME, "sample_time") | _columns(_LONG, "statistic") | _columns(_DOUBLE, "value")
)
STAT_NAMES = _struct(_columns(_LONG, "dbid statistic") | _columns(_TEXT, "name") | _columns(_LONG, "collect"))
USERS = _struct(_columns(_LONG, "dbid") | _columns(_TEXT, "username") | _columns(_LONG, "user_id"))
OBJECTS = _struct(
    _columns(_LONG, "dbid object_id") | _columns(_TEXT, "owner object_name subobject_name object_type")
)
DATA_FILES = _struct(
    _columns(_LONG, "dbid") | _columns(_TEXT, "file_name") | _columns(_LONG, "file_id") | _columns(_TEXT, "tablespace_name")
)
EXTENTS = _struct(
    _columns(_LONG, "dbid")
    | _columns(_TEXT, "segment_name partition_name segment_type tablespace_name")
    | _columns(_LONG, "extent_id file_id block_id bytes blocks relative_fno")
)
PARAMS = _struct(_columns(_LONG, "dbid") | _columns(_TEXT, "name value"))
LATCHES = _struct(_columns(_LONG, "dbid latch_no") | _columns(_TEXT, "name"))
TARGETS = _struct(
    _columns(_LONG, "dbid")
    | _columns(_TEXT, "host")
    | _columns(_LONG, "port")
    | _columns(_TEXT, "dbname sid")
    | _columns(_LONG, "inst_num")
    | _columns(_TEXT, "db_link version")
    | _columns(_LONG, "cpu_count")
)
