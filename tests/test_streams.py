import os
import time

import pytest
from pyspark.sql import functions as F

from lakeline import session
from lakeline.sources import streams
from lakeline.streaming import counts
from lakeline.streaming import sinks
from lakeline.streaming.sinks import compact, merged_ranges, per_batch, read_sink

TEXTS = ["a b a", "b c", "a"]


@pytest.fixture
def texts(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    now = time.time()
    for at, text in enumerate(TEXTS):
        path = folder / f"{at}.txt"
        path.write_text(text)
        os.utime(path, (now - 100 + at, now - 100 + at))
    return str(folder)


def test_each_batch_counts_anew(spark, texts, tmp_path):
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")
    stream = streams.stream_files(spark, texts, "value string", "text", files_per_batch=1)
    counts.per_batch_word_count(stream, "value", sink, state, every=None).awaitTermination()
    found = {}
    for row in read_sink(spark, sink, "word string, n bigint").collect():
        found.setdefault(row.batch_id, {})[row.word] = row.n
    assert found == {0: {"a": 2, "b": 1}, 1: {"b": 1, "c": 1}, 2: {"a": 1}}


def test_restart_goes_on_and_a_repeated_batch_counts_once(spark, texts, tmp_path):
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")
    run = lambda: counts.per_batch_word_count(
        streams.stream_files(spark, texts, "value string", "text", 1), "value", sink, state, every=None
    ).awaitTermination()
    run()
    last = str(tmp_path / "state" / "commits" / "2")
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), ".2.crc")
    if os.path.exists(crc):
        os.remove(crc)
    run()
    total = read_sink(spark, sink, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    assert {r.word: r.n for r in total.collect()} == {"a": 3, "b": 2, "c": 1}


def test_kafka_options_and_records(spark):
    options = streams.kafka_options("host:9092", ["orders", "clicks"], group_id="g", max_offsets_per_trigger=5)
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "orders,clicks", "startingOffsets": "latest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "5"}
    records = spark.createDataFrame([(bytearray(b"k"), bytearray("é x".encode()))], "key binary, value binary")
    assert tuple(streams.decode_records(records).first()) == ("k", "é x")


def test_intervals_of_table_and_stream(spark, tmp_path):
    rows = [(t, "x" if t % 2 else "y") for t in range(0, 60)]
    df = spark.createDataFrame(rows, "s int, kind string").select(
        F.timestamp_seconds("s").alias("ts"), "kind")
    source = str(tmp_path / "events")
    df.repartition(3).write.parquet(source)
    table = {(r.start, r.kind): r.n for r in counts.interval_count(df, "ts", "kind").collect()}
    assert len(table) == 24 and sum(table.values()) == 60

    stream = streams.stream_files(spark, source, files_per_batch=1)
    sink = str(tmp_path / "sink")
    counts.per_batch_interval_count(
        stream, "ts", "kind", sink, str(tmp_path / "state"), every=None).awaitTermination()
    parts = read_sink(spark, sink, "start timestamp, kind string, n bigint")
    assert parts.select("batch_id").distinct().count() == 3
    merged = {(r.start, r.kind): r.n for r in counts.merged_intervals(parts, "kind").collect()}
    assert merged == table

    # with a watermark, closed intervals come out and agree with the table
    timed = counts.interval_count(streams.stream_files(spark, source), "ts", "kind", late="1 second")
    query = (timed.writeStream.outputMode("append").format("memory").queryName("closed")
             .option("checkpointLocation", str(tmp_path / "closed")).trigger(availableNow=True).start())
    query.awaitTermination()
    closed = {(r.start, r.kind): r.n for r in spark.table("closed").collect()}
    assert closed and closed.items() <= table.items()


def test_trigger_interval(spark, texts, tmp_path):
    stream = streams.stream_files(spark, texts, "value string", "text")
    query = per_batch(stream, lambda b: b, str(tmp_path / "s"), str(tmp_path / "c"), every="1 second")
    try:
        query.processAllAvailable()
        assert read_sink(spark, str(tmp_path / "s"), "value string").count() == 3
    finally:
        query.stop()


def test_shared_folder_is_read_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = session.shared_root(spark)
    assert root == named.rstrip("/") if named else os.path.isdir(root)
    assert session.work_folder(spark, "x") != session.work_folder(spark, "x")


def numbered_files(tmp_path, count):
    folder = tmp_path / "many"
    folder.mkdir()
    now = time.time()
    for at in range(count):
        path = folder / f"{at:03}.txt"
        path.write_text(f"row {at}")
        os.utime(path, (now - 1000 + at, now - 1000 + at))
    return str(folder)


def run_merged(spark, source, tmp_path, merge):
    stream = streams.stream_files(spark, source, "value string", "text", files_per_batch=1)
    per_batch(stream, lambda b: b, str(tmp_path / "sink"), str(tmp_path / "state"), merge=merge).awaitTermination()
    return str(tmp_path / "sink")


def test_many_batches_become_few_files_and_each_row_counts_once(spark, tmp_path):
    sink = run_merged(spark, numbered_files(tmp_path, 14), tmp_path, 3)
    assert merged_ranges(spark, sink) and [r[:2] for r in merged_ranges(spark, sink)] == [(0, 8), (9, 11)]
    folders = [name for name in os.listdir(sink) if name.startswith("batch_id=")]
    assert sorted(folders) == ["batch_id=12", "batch_id=13"]
    files = [name for _, _, names in os.walk(os.path.join(sink, "_merged")) for name in names if name.endswith(".parquet")]
    assert len(files) == 2
    rows = sorted((r.batch_id, r.value) for r in read_sink(spark, sink, "value string").collect())
    assert rows == [(at, f"row {at}") for at in range(14)]


def test_a_merged_batch_that_runs_again_counts_once(spark, tmp_path):
    source = numbered_files(tmp_path, 6)
    sink = run_merged(spark, source, tmp_path, 3)
    commits = tmp_path / "state" / "commits"
    for name in ("5", ".5.crc"):
        if (commits / name).exists():
            os.remove(commits / name)
    run_merged(spark, source, tmp_path, 3)
    assert read_sink(spark, sink, "value string").count() == 6
    assert not [name for name in os.listdir(sink) if name.startswith("batch_id=")]


def test_a_merge_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    source = numbered_files(tmp_path, 3)
    sink = run_merged(spark, source, tmp_path, None)
    monkeypatch.setattr(sinks, "drop_folders", lambda *names: None)
    compact(spark, sink, "value string", 0, 1)  # committed, old folders still there
    spark.range(1).selectExpr("'ghost' AS value", "0L AS batch_id").write.parquet(f"{sink}/_merged/0-2-lost")
    rows = sorted((r.batch_id, r.value) for r in read_sink(spark, sink, "value string").collect())
    assert rows == [(at, f"row {at}") for at in range(3)]


def test_late_rows_of_closed_intervals_are_dropped(spark, tmp_path):
    source, now = tmp_path / "events", time.time()
    for at, seconds in enumerate(([1, 3, 21], [2, 22, 40], [4, 23, 60])):
        part = str(tmp_path / f"part{at}")
        spark.createDataFrame([(s, "x") for s in seconds], "s int, kind string").select(
            F.timestamp_seconds("s").alias("ts"), "kind").coalesce(1).write.parquet(part)
        name = next(n for n in os.listdir(part) if n.endswith(".parquet"))
        os.makedirs(source, exist_ok=True)
        os.rename(os.path.join(part, name), source / f"{at}.parquet")
        os.utime(source / f"{at}.parquet", (now - 100 + at, now - 100 + at))
    stream = streams.stream_files(spark, str(source), "ts timestamp, kind string", files_per_batch=1)
    sink = str(tmp_path / "closed")
    counts.closed_interval_count(
        stream, "ts", "kind", sink, str(tmp_path / "state"), late="10 seconds", every=None).awaitTermination()
    found = sorted((int(r.start.timestamp()), r.n) for r in spark.read.parquet(sink).collect())
    # 2 comes with the batch that closes 0..5 and still counts, 4 after that; 60 stays open
    assert found == [(0, 3), (20, 3), (40, 1)]


def test_bare_paths_get_the_default_scheme(spark, tmp_path):
    assert session.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert session.qualified(spark, f"file://{tmp_path}/x").startswith("file:/")


def test_scratch_is_gone_when_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path))
    frame = session.stored(spark.range(5), "numbers")
    scratch = session.Scratch(spark, "steps")
    scratch.keep(frame, "one")
    kept = scratch.keep(frame, "two")
    scratch.drop("one", "never")
    folder = f"{session.shared_root(spark)}/lakeline/{spark.sparkContext.applicationId}"
    assert os.listdir(scratch.folder) == ["two"] and kept.count() == frame.count() == 5
    session.clear_scratch(spark)
    assert not os.path.exists(folder)
