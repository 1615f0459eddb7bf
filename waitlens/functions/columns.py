"""Column expressions shared by the operators; all are built-in, so they stay in generated code.

Arguments are column names or SQL expressions as text.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from waitlens.constants import (
    BLOCKER_LAYOUTS,
    BLOCKER_STATUS,
    BLOCKER_VALID,
    SESSION_TYPE_MASK,
    SESSION_TYPE_UNKNOWN,
    SESSION_TYPES,
)


def timestamp_text(moment: datetime) -> str:
    """A literal in the session time zone (a Python datetime would use the driver's own zone)."""
    return f"timestamp_ltz'{moment.isoformat(sep=' ')}'"


def timestamp_lit(moment: datetime) -> Column:
    return F.expr(timestamp_text(moment))


def has_bits(flags: str, mask: int, value: int | None = None) -> str:
    """Condition: ``flags & mask`` equals ``value``; without ``value``, any of the bits is set."""
    return f"({flags} & {mask}) <> 0" if value is None else f"({flags} & {mask}) = {value}"


def null_if(value: str, sentinel: int) -> Column:
    return F.expr(f"nullif({value}, {sentinel})")


def _case(value: str, results: Mapping[int, str], otherwise: str) -> Column:
    branches = " ".join(f"when {code} then '{text}'" for code, text in results.items())
    return F.expr(f"case {value} {branches} else '{otherwise}' end")


def _layout(layout: int) -> tuple[int, int]:
    if layout not in BLOCKER_LAYOUTS:
        raise ValueError(f"blocker layout must be one of {sorted(BLOCKER_LAYOUTS)}, not {layout}")
    return BLOCKER_LAYOUTS[layout]


def _decoded(code: str, value: str) -> Column:
    codes = ", ".join(str(c) for c in BLOCKER_STATUS)
    return F.expr(f"case when {code} not in ({codes}) then {value} end")


def blocker_session(code: str, layout: int = 16) -> Column:
    bits, _ = _layout(layout)
    return _decoded(code, f"{code} & {(1 << bits) - 1}L")


def blocker_instance(code: str, layout: int = 16) -> Column:
    bits, mask = _layout(layout)
    return _decoded(code, f"shiftright({code} & {mask}L, {bits})")


def blocker_status(code: str) -> Column:
    """``VALID`` also for a null code."""
    return _case(code, BLOCKER_STATUS, BLOCKER_VALID)


def session_type_name(flags: str) -> Column:
    return _case(f"{flags} & {SESSION_TYPE_MASK}", SESSION_TYPES, SESSION_TYPE_UNKNOWN)


def bucket_text(moment: str, seconds: int) -> str:
    """Start of the bucket of ``seconds`` that holds ``moment``."""
    epoch = f"unix_timestamp({moment})"
    return f"timestamp_seconds({epoch} - pmod({epoch}, {seconds}))"


def bucket_start(moment: str, seconds: int) -> Column:
    return F.expr(bucket_text(moment, seconds))


def share_percent(part: str, total: Column) -> Column:
    """``part`` in percent of ``total``, two digits, half up; decimal arithmetic keeps ties exact."""
    return F.round(F.expr(f"cast({part} as decimal(20,0)) * 100") / total.cast("decimal(20,0)"), 2).cast("double")
