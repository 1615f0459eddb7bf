"""Join patterns for a very large left side.

A right side is broadcast only when the optimizer's estimate of its size is under a limit, with the copies of an explode
counted; where these are not known, it is not broadcast. Beyond the limit the join is
shuffled, and rows that share one key are spread over several tasks by a salt taken from the row itself (a hash, not a
random number, so a retried task makes the same choice). A salt copies the right side, so it is used only as far as the
copies stay small next to the left side; skew that is left then is split by adaptive execution. All ways give the same
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_SETTING = "spark.waitlens.broadcastBytes"
SALTS_SETTING = "spark.waitlens.joinSalts"
# the estimate counts compressed file bytes; in memory the rows may take some twenty times as much
DEFAULT_BROADCAST_BYTES = 16 * 1024 * 1024
DEFAULT_SALTS = 16

_SALT = "__salt"
_LEVEL = "__level"
_BUCKET = "__bucket"
_START = "__start"
_STOP = "__stop"
_POINT = "__point"


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None for a stream or where the session does not give it."""
    plan = getattr(df, "_jdf", None)
    if plan is None or df.isStreaming:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _exploded(plan) -> int | None:
    """How often the explodes of a plan repeat a row at most, or None where only the data tells."""
    copies = 1
    if plan.getClass().getSimpleName() == "Generate":
        inputs = plan.generator().children()
        array = inputs.apply(0) if inputs.size() else None
        kind = None if array is None else array.getClass().getSimpleName()
        if kind == "CreateArray":
            copies = array.children().size()
        elif kind == "Literal" and array.value() is not None and array.dataType().typeName() == "array":
            copies = array.value().numElements()
        else:
            return None
    below = [_exploded(plan.children().apply(i)) for i in range(plan.children().size())]
    if None in below:
        return None
    return max(1, copies) * max([1, *below])


def fits_broadcast(df: DataFrame, copies: int | None = None) -> bool:
    """True if the estimated size, times the copies an explode makes, is under the limit.

    The estimate does not count explodes. ``copies`` is a proven bound on how often each row is repeated by those still to
    come; explodes of arrays written in the plan are counted from it, and with others the side does not fit.
    """
    limit = int(df.sparkSession.conf.get(BROADCAST_SETTING, str(DEFAULT_BROADCAST_BYTES)))
    size = estimated_bytes(df)
    if size is None or size > limit:
        return False
    repeats = _exploded(df._jdf.queryExecution().optimizedPlan())
    return repeats is not None and size * repeats * (copies or 1) <= limit


def salt_count(left: DataFrame, right: DataFrame) -> int:
    """How many salts to use: as many as allowed while all copies of ``right`` take at most a quarter of ``left``."""
    allowed = int(left.sparkSession.conf.get(SALTS_SETTING, str(DEFAULT_SALTS)))
    left_size, right_size = estimated_bytes(left), estimated_bytes(right)
    if left_size is None or not right_size:
        return allowed
    return max(1, min(allowed, left_size // (4 * right_size)))


def _shuffle_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, salts: int, salt_on: Sequence[str] | None
) -> DataFrame:
    """A join that Spark does not turn into a broadcast by an estimate that leaves out explodes."""
    if not salt_on or salts <= 1:
        return left.join(right.hint("merge"), keys, how)
    left = left.withColumn(_SALT, F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    right = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*keys, _SALT], how).drop(_SALT)


def lookup(
    facts: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_on: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``facts`` to ``side`` on equal columns: inner, left, left_semi or left_anti.

    ``salt_on`` names fact columns that differ between rows of one key; they are read only when the side is too big to
    broadcast. Without them a skewed shuffle is left to adaptive execution.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    on = list(on)
    if how in ("left_semi", "left_anti"):
        side = side.select(*on)
    if fits_broadcast(side):
        return facts.join(F.broadcast(side), on, how)
    if how in ("left_semi", "left_anti"):
        side = side.distinct()
    return _shuffle_join(facts, side, on, how, salt_count(facts, side), salt_on)


#: A bucket of a level is this many of the level below, as a power of two; levels beyond the last are not needed for 64 bits.
_FAN_BITS = 4
_LEVELS = 15


def _pieces(first: str, last: str) -> str:
    """SQL: the (level, bucket) pieces that make up the buckets from ``first`` to ``last``, without overlap.

    On each level the buckets up to the next whole bucket of the level above go by themselves at either end; where few
    are left, all of them do. A span of any length so gives some thirty pieces a level.
    """
    fan = 1 << _FAN_BITS
    low = f"shiftright({first} + shiftleft(1L, {_FAN_BITS} * {{i}}) - 1, {_FAN_BITS} * {{i}})"
    high = f"shiftright({last} + 1, {_FAN_BITS} * {{i}}) - 1"

    def run(a: str, b: str) -> str:
        return f"if({a} <= {b}, transform(sequence({a}, {b}), x -> struct(i as level, x as bucket)), array())"

    few = f"({high} - {low} < {2 * fan})"
    a, b = low.format(i="i"), high.format(i="i")
    above_a, above_b = low.format(i="(i + 1)"), high.format(i="(i + 1)")
    ends = f"concat({run(a, f'{fan} * ({above_a}) - 1')}, {run(f'{fan} * ({above_b} + 1)', b)})"
    here = f"case when {few.format(i='i')} or i = {_LEVELS - 1} then {run(a, b)} else {ends} end"
    level = f"i -> if(i > 0 and {few.format(i='(i - 1)')}, array(), {here})"
    return f"flatten(transform(sequence(0, {_LEVELS - 1}), {level}))"


def range_lookup(
    facts: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    point: Column,
    start: Column,
    stop: Column,
    width: int,
    max_buckets: int | None = None,
    salt_on: Sequence[str] | None = None,
    interval_columns: Sequence[str] = (),
) -> DataFrame:
    """Inner join of each fact to all intervals with ``start <= point <= stop``, as an equi-join on buckets.

    ``point``, ``start`` and ``stop`` are whole numbers. With ``max_buckets``, the proven number of buckets of ``width`` that an
    interval touches, it is repeated for each of them, and a fact lies in one bucket. Otherwise intervals may be of any
    length: one is cut into pieces of growing levels, a number that grows with the logarithm of its length, and a fact is
    looked up in its bucket on each level that occurs. Pieces do not overlap, so no pair is found twice.
    """
    on = list(on)
    spans = intervals.select(
        *on, *interval_columns, start.cast("bigint").alias(_START), stop.cast("bigint").alias(_STOP)
    ).where(F.col(_START) <= F.col(_STOP))
    first, last, place = (f"({c} - pmod({c}, {width}L)) div {width}L" for c in (_START, _STOP, _POINT))
    keyed = facts.withColumn(_POINT, point.cast("bigint"))
    if max_buckets is None:
        pieces = spans.withColumns({_BUCKET: F.expr(first), _LEVEL: F.expr(last)}).withColumn("__piece", F.expr(f"explode({_pieces(_BUCKET, _LEVEL)})"))
        bucketed = pieces.withColumns({_LEVEL: F.col("__piece.level"), _BUCKET: F.col("__piece.bucket")}).drop("__piece")
        levels = bucketed.agg(F.collect_set(_LEVEL).alias("levels"))  # fifteen at most
        keyed = keyed.withColumn(_LEVEL, F.explode(levels.scalar()))
        keyed = keyed.withColumn(_BUCKET, F.expr(f"shiftright({place}, {_FAN_BITS} * {_LEVEL})"))
        keys = [*on, _LEVEL, _BUCKET]
    else:
        bucketed = spans.withColumn(_BUCKET, F.expr(f"explode(sequence({first}, {last}))"))
        keyed = keyed.withColumn(_BUCKET, F.expr(place))
        keys = [*on, _BUCKET]
    if max_buckets is not None and fits_broadcast(spans, copies=max_buckets):
        joined = keyed.join(F.broadcast(bucketed), keys)
    else:
        joined = _shuffle_join(keyed, bucketed, keys, "inner", salt_count(facts, spans), salt_on)
    return joined.where(f"{_POINT} between {_START} and {_STOP}").drop(_LEVEL, _BUCKET, _START, _STOP, _POINT)
