from __future__ import annotations

import pytest
from conftest import SAMPLES as SCHEMA
from conftest import at, event_names, rows, sample, samples

from waitlens import sources, streaming

STREAM_SCHEMA = SCHEMA


def write_files(spark, folder, *batches):
    """One file per batch, in this order of age."""
    import os

    for number, batch in enumerate(batches):
        path = f"{folder}/b{number}"
        samples(spark, *batch).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            if name.endswith(".parquet"):
                os.utime(f"{path}/{name}", (1_700_000_000 + number, 1_700_000_000 + number))
    return f"{folder}/*"


def test_stream_equals_batch_with_replayed_rows(spark, tmp_path):
    one = [sample(f"1 10:00:{s:02d}", sample_id=s, session_id=n) for s in range(20) for n in (1, 2)]
    two = one[30:] + [sample(f"1 10:00:{s:02d}", sample_id=s, session_id=1) for s in range(20, 40)]
    source = write_files(spark, str(tmp_path / "in"), one, two)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    stream = streaming.read_sample_stream(spark, source, STREAM_SCHEMA, max_files=1)
    streaming.ingest_samples(stream, out, check).awaitTermination()
    stored = sources.read_samples(spark, out)
    expected = samples(spark, *one, *two).distinct()
    columns = ["dbid", "sample_id", "sample_time", "session_id", "event_no", "sql_id"]
    assert rows(stored, *columns) == rows(expected, *columns)
    # a second start takes nothing again
    streaming.ingest_samples(streaming.read_sample_stream(spark, source, STREAM_SCHEMA), out, check).awaitTermination()
    assert sources.read_samples(spark, out).count() == expected.count()


def test_late_rows_are_kept(spark, tmp_path):
    first = [sample("1 10:00:00", sample_id=1), sample("1 11:00:00", sample_id=2)]
    between = [sample("1 11:00:01", sample_id=5)]
    late = [sample("1 10:30:00", sample_id=3), sample("1 10:55:00", sample_id=4)]
    source = write_files(spark, str(tmp_path / "in"), first, between, late)
    stream = streaming.read_sample_stream(spark, source, STREAM_SCHEMA, max_files=1)
    streaming.ingest_samples(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert rows(sources.read_samples(spark, str(tmp_path / "out")), "sample_id") == [(1,), (2,), (3,), (4,), (5,)]


def test_activity_windows(spark, tmp_path):
    given = [sample("1 10:00:01")] * 30 + [sample("1 10:00:16", session_state="ON CPU")] * 15 + [sample("1 10:10:00")]
    source = write_files(spark, str(tmp_path / "in"), given)
    stream = streaming.enrich(streaming.read_sample_stream(spark, source, STREAM_SCHEMA), event_names(spark))
    activity = streaming.activity_by_window(stream, 15, "1 minute")
    out = str(tmp_path / "out")
    streaming.write_windows(activity, out, str(tmp_path / "c")).awaitTermination()
    assert rows(streaming.read_windows(spark, out, ["wait_class"])) == [
        (at("1 10:00:00"), "User I/O", 2.0),
        (at("1 10:00:15"), "ON CPU", 1.0),
        (at("1 10:10:00"), "User I/O", 1 / 15),
    ]


def test_windows_grow_over_batches(spark, tmp_path):
    source = write_files(spark, str(tmp_path / "in"), [sample("1 10:00:01")] * 3, [sample("1 10:00:02")] * 4, [sample("1 10:00:20")])
    stream = streaming.enrich(streaming.read_sample_stream(spark, source, STREAM_SCHEMA, max_files=1), event_names(spark))
    counts = streaming.counts_by_window(stream, {"wait_class": "wait_class"}, 15)
    streaming.write_windows(counts, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert rows(streaming.read_windows(spark, str(tmp_path / "out"), ["wait_class"])) == [
        (at("1 10:00:00"), "User I/O", 7),
        (at("1 10:00:15"), "User I/O", 1),
    ]


def test_compaction_bounds_the_files(spark, tmp_path):
    """A thousand batches end as a few files, at once and again, with the same windows; the newest batch is left alone."""
    path = tmp_path / "w"
    # window k changes in the batches k * 20 to k * 20 + 29
    rows_in = spark.range(1000).selectExpr("id as batch", "explode(sequence(greatest(0L, (id - 29 + 19) div 20), id div 20)) as k").selectExpr(
        "timestamp'2024-01-01' + make_dt_interval(0, int(k * 6)) as bucket_time", "'x' as wait_class", "batch * 10 as n", "batch"
    )
    rows_in.repartition("batch").write.partitionBy("batch").parquet(str(path))
    want = rows(streaming.read_windows(spark, str(path), ["wait_class"]), "bucket_time", "wait_class", "n")
    assert len(want) == 50
    for before in ("5 00:00:00", "9 00:00:00", "9 00:00:00"):
        streaming.compact_windows(spark, str(path), ["wait_class"], at(before))
        assert rows(streaming.read_windows(spark, str(path), ["wait_class"]), "bucket_time", "wait_class", "n") == want
    open_files, closed_files = list(path.rglob("*.parquet")), list((tmp_path / "w-closed").rglob("*.parquet"))
    assert len(open_files) <= 4 and len(closed_files) <= 2 * 9
    # a window that was closed and comes again counts with its newer batch
    late = spark.sql("select timestamp'2024-01-02 00:00:00' as bucket_time, 'x' as wait_class, 7L as n, 1000L as batch union all select timestamp'2024-02-01', 'x', 1L, 1001L")
    late.write.mode("append").partitionBy("batch").parquet(str(path))
    streaming.compact_windows(spark, str(path), ["wait_class"], at("20 00:00:00"))
    got = {r[0]: r[2] for r in rows(streaming.read_windows(spark, str(path), ["wait_class"]), "bucket_time", "wait_class", "n")}
    assert got[at("2 00:00:00")] == 7 and len(got) == 51


def test_a_new_checkpoint_needs_a_new_path(spark, tmp_path):
    given = samples(spark, sample("1 10:00:00"))
    given.write.parquet(str(tmp_path / "in"))
    stream = streaming.read_sample_stream(spark, str(tmp_path / "in"), given.schema)
    counts = streaming.counts_by_window(stream, {"sql_id": "sql_id"}, 60)
    streaming.write_windows(counts, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    streaming.write_windows(counts, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    with pytest.raises(ValueError):
        streaming.write_windows(counts, str(tmp_path / "out"), str(tmp_path / "c2"))


def test_batches_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    """The parts of the input come in three batches, also where many tasks write them."""
    from conftest import SF_DIR

    from demo import registry

    (tmp_path / "sf").mkdir()
    spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(7).write.parquet(str(tmp_path / "sf/events.parquet"))
    spark.read.parquet(f"{SF_DIR}/nation.parquet").write.parquet(str(tmp_path / "sf/nation.parquet"))
    monkeypatch.setattr(sources, "work_folder", lambda _: str(tmp_path / "work"))
    settings = {"spark.sql.files.openCostInBytes": "1g", "spark.sql.files.maxPartitionBytes": "1m"}  # a task for each file
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = registry.queries()["stream_activity_compacted"](spark, str(tmp_path / "sf")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len([f for f in (tmp_path / "work/checkpoint/sources/0").iterdir() if f.name[0].isdigit()]) == 3  # with new files
    monkeypatch.setattr(sources, "work_folder", lambda _: str(tmp_path / "other"))
    plain = registry.queries()["stream_activity"](spark, SF_DIR).collect()
    assert {(r.bucket_time, r.wait_class, r.cnt) for r in found} == {(r.bucket_time, r.wait_class, r.cnt) for r in plain}
