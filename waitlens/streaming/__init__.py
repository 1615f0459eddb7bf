from waitlens.streaming.samples import (
    activity_by_window,
    compact_windows,
    counts_by_window,
    deduplicate,
    enrich,
    ingest_counters,
    ingest_metrics,
    ingest_samples,
    read_sample_stream,
    read_windows,
    write_windows,
)

__all__ = [
    "activity_by_window",
    "compact_windows",
    "counts_by_window",
    "deduplicate",
    "enrich",
    "ingest_counters",
    "ingest_metrics",
    "ingest_samples",
    "read_sample_stream",
    "read_windows",
    "write_windows",
]
