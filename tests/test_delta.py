from __future__ import annotations

import random

from conftest import rows

from waitlens.operators import delta

STATS = "snap_id long, dbid long, instance_number long, sql_id string, plan_hash_value long, executions long"


def stats(spark, *given):
    return spark.createDataFrame([(s, d, i, q, 0, v) for s, d, i, q, v in given], STATS)


def deltas(df, **options):
    return rows(delta.counter_delta(df, columns=["executions"], **options), "dbid", "instance_number", "sql_id", "snap_id", "executions_delta")


def test_gap_first_and_restart(either):
    df = stats(either, (10, 1, 1, "a", 5), (20, 1, 1, "a", 9), (20, 1, 1, "b", 100), (30, 1, 1, "b", 40), (40, 1, 1, "a", 12), (40, 1, 1, "b", 45))
    expected = [(1, 1, "a", 10, None), (1, 1, "a", 20, 4), (1, 1, "a", 40, None), (1, 1, "b", 20, None), (1, 1, "b", 30, -60), (1, 1, "b", 40, 5)]
    assert deltas(df) == expected
    assert deltas(df, on_reset="null")[4] == (1, 1, "b", 30, None)


def test_targets_share_snap_ids_but_not_the_previous_one(either):
    # database 2 has no snapshot 2, so its previous one of 3 is 1
    df = stats(either, (1, 1, 1, "a", 1), (2, 1, 1, "z", 0), (3, 1, 1, "a", 5), (1, 2, 1, "a", 1), (3, 2, 1, "a", 5), (3, 1, 2, "a", 7))
    assert deltas(df) == [
        (1, 1, "a", 1, None),
        (1, 1, "a", 3, None),
        (1, 1, "z", 2, None),
        (1, 2, "a", 3, None),
        (2, 1, "a", 1, None),
        (2, 1, "a", 3, 4),
    ]


def test_registered_snapshots_replace_those_found(either):
    df = stats(either, (1, 1, 1, "a", 1), (3, 1, 1, "a", 5))
    registry = either.createDataFrame([(1, 1, 1), (1, 1, 2), (1, 1, 3)], "dbid long, instance_number long, snap_id long")
    assert deltas(df, snapshots=registry) == [(1, 1, "a", 1, None), (1, 1, "a", 3, None)]


def test_long_history_across_blocks(either):
    """An entity much longer than a block, against a plain loop."""
    rnd = random.Random(3)
    given, expected = [], []
    for entity in ("a", "b"):
        last = None
        for snap in range(1, 4 * delta.BLOCK):
            if entity == "b" and rnd.random() < 0.3:
                last = None
                continue
            value = rnd.randrange(1000)
            given.append((snap, 1, 1, entity, value))
            expected.append((1, 1, entity, snap, None if last is None else value - last))
            last = value
    rnd.shuffle(given)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert deltas(stats(either, *given)) == sorted(expected, key=key)


def test_sum_of_deltas_is_last_minus_first(spark):
    df = stats(spark, *[(s, 1, 1, "a", s * s) for s in range(1, 200)])
    total = delta.counter_delta(df, columns={"executions": "change"}).groupBy().sum("change").collect()[0][0]
    assert total == 199 * 199 - 1
