"""The join patterns against plain joins."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from waitlens.operators import dims, joins


def facts(spark):
    """A third of all rows share key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 50)
    return spark.range(3000).select("id", key.cast("long").alias("k"))


def side(spark):
    return spark.sql(
        "select * from values (0L, 'zero'), (1L, 'one'), (1L, 'uno'), (7L, 'seven'), (null, 'null'), (99L, 'none') as v(k, name)"
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_equals_join(either, how):
    given = facts(either)
    plain = given.join(side(either), ["k"], how)
    result = joins.lookup(given, side(either), ["k"], how, salt_on=["id"])
    assert rows(result) == rows(plain)
    broadcast = joins.fits_broadcast(side(either))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) is broadcast and ("__salt" in plan) is not broadcast


def test_lookup_type_unknown(spark):
    with pytest.raises(ValueError):
        joins.lookup(facts(spark), side(spark), ["k"], "full")


def test_salt_spreads_one_key(shuffled):
    shuffled.conf.set("spark.waitlens.joinSalts", "8")
    big = shuffled.range(200_000).withColumn("k", F.lit(0).cast("long"))
    small = shuffled.sql("select 0L as k, 'zero' as name")
    assert joins.salt_count(big, small) == 8
    result = joins.lookup(big, small, ["k"], salt_on=["id"])
    assert "__salt" in result._jdf.queryExecution().executedPlan().toString()
    assert result.columns == ["k", "id", "name"] and result.count() == 200_000


def test_no_salt_where_copies_would_be_big(shuffled):
    left, right = shuffled.range(1000).withColumnRenamed("id", "k"), shuffled.range(10_000).withColumnRenamed("id", "k")
    assert joins.salt_count(left, right) == 1
    assert "__salt" not in joins.lookup(left, right, ["k"], salt_on=["k"])._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [1, 7, 64, 100_000])
@pytest.mark.parametrize("max_buckets", [None, 2000])
def test_range_lookup_equals_between(either, width, max_buckets):
    points = either.range(500).selectExpr("id", "id % 2 as g", "(id * 37) % 900 - 100 as p")
    spans = either.range(60).selectExpr("id as span", "id % 2 as g", "(id * 53) % 800 - 90 as a", "(id * 53) % 800 - 90 + (id % 9) * 11 - 5 as b")
    got = joins.range_lookup(points, spans, ["g"], F.col("p"), F.col("a"), F.col("b"), width, max_buckets, ["id"], ["span"])
    want = points.alias("x").join(spans.alias("y"), F.expr("x.g = y.g and p between a and b")).select("x.id", "span")
    assert rows(got, "id", "span") == rows(want)


@pytest.mark.parametrize("width", [1, 64])
def test_intervals_of_any_length(either, width):
    """Lengths from 1 to 10^12, below and above zero, against a plain condition."""
    points = either.range(3000).selectExpr("id", "id % 2 as g", "(id * 7919) % 4001 * case id % 3 when 0 then 1 when 1 then 1000003 else -77777 end as p")
    spans = either.range(80).selectExpr("id as span", "id % 2 as g", "(id * 53) % 800 * (id * id - 700) as a", "cast(pow(1.41, id) as bigint) as n")
    spans = spans.selectExpr("span", "g", "a", "a + n as b")
    got = joins.range_lookup(points, spans, ["g"], F.col("p"), F.col("a"), F.col("b"), width, None, ["id"], ["span"])
    want = points.alias("x").join(spans.alias("y"), F.expr("x.g = y.g and p between a and b")).select("x.id", "span")
    assert rows(got, "id", "span") == rows(want)


def test_pieces_cover_an_interval_once(spark):
    """A billion buckets are some hundred pieces that lie one after the other."""
    spans = spark.sql("select * from values (0L, 999999999L), (-5L, 5L), (17L, 17L), (-1000003L, 70000001L), (15L, 16L * 16 * 16) as v(a, b)")
    pieces = spans.selectExpr("a", "b", f"explode({joins._pieces('a', 'b')}) as p").selectExpr(
        "a", "b", "shiftleft(p.bucket, 4 * p.level) as low", "shiftleft(p.bucket + 1, 4 * p.level) - 1 as high"
    )
    for a, b in spans.collect():
        own = sorted((r.low, r.high) for r in pieces.where((F.col("a") == a) & (F.col("b") == b)).collect())
        assert own[0][0] == a and own[-1][1] == b and len(own) <= 200
        assert all(x[1] + 1 == y[0] for x, y in zip(own, own[1:]))


def test_a_long_extent_is_few_rows(either):
    """One extent of a billion blocks in the plan of the block lookup: no nested loop, and some hundred rows to join."""
    blocks = either.range(2000).selectExpr("1L as dbid", "1L as current_file", "id * 499979 as current_block", "id as session_id", "id as sample_id")
    extents = either.sql(
        "select * from values (1L, 1L, 0L, 1000000000L, 'big'), (1L, 1L, 1000000000L, 8L, 'small'), (1L, 2L, 0L, 100L, 'other')"
        " as v(dbid, file_id, block_id, blocks, segment_name)"
    )
    found = dims.block_to_segment(blocks, extents, width=1)
    assert found.where("segment_name = 'big'").count() == found.count() == blocks.where("current_block < 1000000000").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    spans = extents.selectExpr("block_id as a", "block_id + blocks - 1 as b")
    assert spans.selectExpr(f"explode({joins._pieces('a', 'b')})").count() < 300


def test_copies_of_an_explode_count(spark):
    """A side is broadcast by its estimate times what explodes make of it; unknown numbers do not fit."""
    one = spark.range(1).select(F.col("id").alias("k"))
    assert joins.fits_broadcast(one.withColumn("x", F.expr("explode(array(1, 2, 3))")))
    assert not joins.fits_broadcast(one.withColumn("x", F.expr("explode(sequence(1, 1000000))")).withColumn("y", F.expr("explode(sequence(k, x))")))
    many = one.withColumn("x", F.expr("explode(sequence(1, 5000000))"))
    assert not joins.fits_broadcast(many)
    plan = joins.lookup(spark.range(10).withColumnRenamed("id", "k"), many, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert not joins.fits_broadcast(one, copies=10**12) and joins.fits_broadcast(one, copies=2)
