from waitlens.sources.snapshots import SnapshotStore, advance
from waitlens.sources.store import (
    append_missing,
    delete_expired,
    folders,
    drop_expired,
    materialise,
    merge_buckets,
    read_samples,
    replace_partitions,
    work_folder,
    write_new,
    write_samples,
)
from waitlens.sources.tables import conform, read_table, read_wait_groups

__all__ = [
    "SnapshotStore",
    "advance",
    "append_missing",
    "conform",
    "delete_expired",
    "folders",
    "drop_expired",
    "materialise",
    "merge_buckets",
    "read_samples",
    "read_table",
    "read_wait_groups",
    "replace_partitions",
    "work_folder",
    "write_new",
    "write_samples",
]
