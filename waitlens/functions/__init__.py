from waitlens.functions.columns import (
    blocker_instance,
    blocker_session,
    blocker_status,
    bucket_start,
    bucket_text,
    has_bits,
    null_if,
    session_type_name,
    share_percent,
    timestamp_lit,
    timestamp_text,
)

__all__ = [
    "blocker_instance",
    "blocker_session",
    "blocker_status",
    "bucket_start",
    "bucket_text",
    "has_bits",
    "null_if",
    "session_type_name",
    "share_percent",
    "timestamp_lit",
    "timestamp_text",
]
