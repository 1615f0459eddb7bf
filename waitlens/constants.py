"""Fixed values of the data model: names, codes and defaults that results depend on."""

from __future__ import annotations

from datetime import timedelta

# Blocker codes that carry no session, with the status text of each.
BLOCKER_STATUS = {
    4294967295: "UNKNOWN",
    4294967294: "UNKNOWN",
    4294967293: "UNKNOWN",
    4294967292: "NO HOLDER",
    4294967291: "NOT IN WAIT",
}
BLOCKER_VALID = "VALID"

# Layout -> (bits of the session number, mask of the instance bits).
BLOCKER_LAYOUTS = {16: (16, 2147418112), 18: (18, 2147221504)}

# Session type code (flag bits & 19) -> text.
SESSION_TYPE_MASK = 19
SESSION_TYPES = {17: "BACKGROUND", 1: "FOREGROUND", 2: "RECURSIVE"}
SESSION_TYPE_UNKNOWN = "?"

# Wait classes shown by the top-SQL report, in column order.
REPORT_WAIT_CLASSES = (
    "User I/O",
    "System I/O",
    "Administrative",
    "Other",
    "Configuration",
    "Application",
    "Concurrency",
    "Network",
)

# Drawing order of the activity graph's classes.
GRAPH_CLASS_ORDER = (
    "null",
    "ON CPU",
    "User I/O",
    "System I/O",
    "Concurrency",
    "Application",
    "Commit",
    "Configuration",
    "Administrative",
    "Network",
    "Queueing",
    "Other",
    "Scheduler",
    "Cluster",
)
GRAPH_FILLER = 0.001

# Metrics whose names are kept.
METRIC_NAMES = (
    "User Transaction Per Sec",
    "Physical Reads Per Sec",
    "Physical Reads Per Txn",
    "Physical Writes Per Sec",
    "Redo Generated Per Sec",
    "Redo Generated Per Txn",
    "Redo Writes Per Sec",
    "Logons Per Sec",
    "User Calls Per Sec",
    "User Commits Per Sec",
    "Logical Reads Per Txn",
    "Logical Reads Per Sec",
    "Total Parse Count Per Txn",
    "Network Traffic Volume Per Sec",
    "Enqueue Requests Per Txn",
    "DB Block Changes Per Txn",
    "Current Open Cursors Count",
    "SQL Service Response Time",
    "Response Time Per Txn",
    "Executions Per Sec",
    "Average Synchronous Single-Block Read Latency",
    "I/O Megabytes per Second",
    "I/O Requests per Second",
    "Average Active Sessions",
)

# Events of the I/O event snapshot.
IO_EVENT_NAMES = (
    "log file sync",
    "log file parallel write",
    "db file scattered read",
    "db file sequential read",
    "direct path read",
    "direct path read temp",
    "direct write",
    "direct write temp",
)

# Events that mode "v9" treats as idle (compared in lower case).
V9_IDLE_EVENTS = (
    "queue monitor wait",
    "null event",
    "pl/sql lock timer",
    "px deq: execution msg",
    "px deq: table q normal",
    "px idle wait",
    "sql*net message from client",
    "sql*net message from dblink",
    "dispatcher timer",
    "lock manager wait for remote message",
    "pipe get",
    "pmon timer",
    "queue messages",
    "rdbms ipc message",
    "slave wait",
    "smon timer",
    "virtual circuit status",
    "wakeup time manager",
    "i/o slave wait",
    "jobq slave wait",
)

# Cumulative counters of SQL statistics -> name of their delta.
SQLSTAT_DELTAS = {
    "fetches": "fetches_delta",
    "end_of_fetch_count": "end_of_fetch_count_delta",
    "sorts": "sorts_delta",
    "executions": "executions_delta",
    "px_servers_executions": "px_servers_execs_delta",
    "loads": "loads_delta",
    "invalidations": "invalidations_delta",
    "parse_calls": "parse_calls_delta",
    "disk_reads": "disk_reads_delta",
    "buffer_gets": "buffer_gets_delta",
    "rows_processed": "rows_processed_delta",
    "cpu_time": "cpu_time_delta",
    "elapsed_time": "elapsed_time_delta",
    "user_io_wait_time": "iowait_delta",
    "cluster_wait_time": "clwait_delta",
    "application_wait_time": "apwait_delta",
    "concurrency_wait_time": "ccwait_delta",
    "direct_writes": "direct_writes_delta",
    "plsql_exec_time": "plsexec_time_delta",
    "java_exec_time": "javexec_time_delta",
    "io_interconnect_bytes": "io_interconnect_bytes_delta",
    "io_disk_bytes": "io_disk_bytes_delta",
    "physical_read_requests": "physical_read_requests_delta",
    "physical_read_bytes": "physical_read_bytes_delta",
    "physical_write_requests": "physical_write_requests_delta",
    "physical_write_bytes": "physical_write_bytes_delta",
}

# SQL statistics that have no delta.
SQLSTAT_OTHER = (
    "serializable_aborts",
    "version_count",
    "avg_hard_parse_time",
    "sharable_mem",
    "total_sharable_mem",
    "typecheck_mem",
    "exact_matching_signature",
    "force_matching_signature",
)

# Retention mode -> how long samples are kept, how many days of snapshots are kept.
SAMPLE_RETENTION = {
    "d": timedelta(days=7),
    "w": timedelta(days=31),
    "h": timedelta(hours=24),
    "m": timedelta(minutes=30),
}
SNAPSHOT_RETENTION_DAYS = {"d": 8, "w": 32, "h": 1, "m": 1}

# Defaults of the collection settings.
SNAPSHOT_MINUTES = 15
HOT_SQL_ROWS = 20
HOT_OBJECT_ROWS = 99
TOP_SQL_ROWS = 9
METRIC_MIN_CENTISECONDS = 2000
METRIC_FIRST_LOAD_DAYS = 30
GRAPH_MINUTES = 30
GRAPH_BUCKET_SECONDS = 15
SQL_COMMAND_TYPE = 100
STORED_COMMAND_TYPE = 1

#: Fixed value: the report titles one class by another word.
REPORT_TITLES = {"Administrative": "Administration"}
