"""Streams end where the batch twin does; late rows, repeats and sinks."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException

from shoplens.sources.readers import stream_json, stream_parquet
from shoplens.sources.schemas import STREAM_EVENTS
from shoplens.sources.writers import write_event_landing
from shoplens.streaming import runner
from shoplens.streaming import windows as w

KEYS = ["window_start", "window_end", "event_name"]


def land(folder, *files):
    """Write JSON-lines files whose modification times follow the order given."""
    folder.mkdir(exist_ok=True)
    start = time.time() - 1000
    for i, events in enumerate(files):
        path = folder / f"events_{i:03}.json"
        path.write_text("".join(json.dumps(e) + "\n" for e in events))
        os.utime(path, (start + i * 10, start + i * 10))
    return str(folder)


def event(minute, name="view_product", session="s1", day="2024-03-01", i=0):
    return {
        "session_id": session, "event_name": name, "event_time": f"{day} 10:{minute:02}:00", "event_id": f"{i}",
        "traffic_source": "web", "event_metadata": None,
    }


def events(spark, folder, max_files=1):
    return w.with_event_time(stream_json(spark, folder, STREAM_EVENTS, max_files), "event_time")


def at_rest(spark, folder):
    return w.with_event_time(spark.read.schema(STREAM_EVENTS).json(folder), "event_time")


def bag(df, *cols):
    return sorted(map(str, (df.select(*cols) if cols else df).collect()))


def test_update_stream_has_no_repeated_windows(spark, tmp_path):
    folder = land(
        tmp_path / "in", [event(1), event(2, session="s2")], [event(3)], [event(7), event(4, "checkout")], [event(2)]
    )
    streamed = runner.upsert_stream(w.window_counts(events(spark, folder), "event_name"), KEYS)
    batch = w.window_counts(at_rest(spark, folder), "event_name")
    cols = [*KEYS, "event_count", "unique_sessions"]
    assert bag(streamed, *cols) == bag(batch, *cols)
    assert sum(r.event_count for r in streamed.collect()) == 6


def test_late_rows_are_dropped_and_reported(spark, tmp_path):
    folder = land(tmp_path / "in", [event(1)], [event(40)], [event(3, day="2023-11-01")])
    closed, query = runner.append_stream(w.window_counts(events(spark, folder), "event_name"))
    progress = runner.stream_progress(query).collect()
    assert sum(r.late_rows_dropped for r in progress) == 1
    assert sum(r.input_rows for r in progress) == 3
    assert [r.event_count for r in closed.collect()] == [1]  # 10:00; 10:40 is still open


def test_replay_without_watermark_keeps_late_rows(spark, tmp_path):
    folder = land(tmp_path / "in", [event(1)], [event(40)], [event(3, day="2023-11-01")])
    counts = w.window_counts(events(spark, folder), "event_name", watermark=None)
    assert sum(r.event_count for r in runner.upsert_stream(counts, KEYS).collect()) == 3


def test_landing_replay_equals_batch(spark, tmp_path):
    rows = [event(m % 60, session=f"s{m % 7}", i=m) for m in range(300)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], STREAM_EVENTS)
    landing = write_event_landing(df, str(tmp_path / "landing"), files=8)
    counts = w.window_counts(events(spark, landing, 3), "event_name", watermark=None)
    cols = [*KEYS, "event_count"]
    assert bag(runner.upsert_stream(counts, KEYS), *cols) == bag(w.window_counts(at_rest(spark, landing), "event_name"), *cols)


def test_exact_sessions(spark, tmp_path):
    folder = land(
        tmp_path / "in", [event(1), event(2), event(3, session="s2")], [event(4), event(6)], [event(50)], [event(51)]
    )
    closed, _ = runner.append_stream(w.exact_sessions(events(spark, folder), "event_name"))
    batch = w.exact_sessions(at_rest(spark, folder), "event_name")
    assert sorted(r.sessions for r in closed.collect()) == [1, 2]
    assert sorted(r.sessions for r in batch.collect()) == [1, 1, 2]


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, [event(1)])
    result, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        counts = w.window_counts(events(spark, str(folder)), "event_name")
        runner.run_stream(counts, runner.revisions_to(result), mode="update", checkpoint=checkpoint)
        return [r.event_count for r in runner.latest_revisions(spark, result, KEYS).collect()]

    assert run() == [1]
    (folder / "events_late.json").write_text(json.dumps(event(2)) + "\n")
    assert run() == [2]


def test_memory_and_console_sinks(spark, tmp_path, capfd):
    folder = land(tmp_path / "in", [event(1)], [event(2)])
    counts = w.window_counts(events(spark, folder), "event_name")
    runner.run_stream(counts, "memory", mode="complete", name="window_table")
    assert [r.event_count for r in spark.table("window_table").collect()] == [2]
    runner.run_stream(counts, "console", mode="update", numRows=30, truncate=False)


def test_live_stream_stops_after_its_time(spark, tmp_path):
    folder = land(tmp_path / "in", [event(1)])
    query = runner.run_stream(events(spark, folder), "parquet", path=str(tmp_path / "out"), timeout=8)
    assert not query.isActive and runner.active_streams(spark) == []
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_two_live_streams_side_by_side(spark, tmp_path):
    folder = land(tmp_path / "in", [event(1)], [event(40)])
    counts = [w.window_counts(events(spark, folder), key) for key in ("event_name", "traffic_source")]
    out = [str(tmp_path / name) for name in ("names", "sources")]
    running = [
        runner.start_stream(c, "parquet", path=o, name=f"live_{i}") for i, (c, o) in enumerate(zip(counts, out))
    ]
    assert sorted(name for name, _ in runner.active_streams(spark)) == ["live_0", "live_1"]
    for query in running:
        query.processAllAvailable()
    runner.finish(running, timeout=1)
    assert runner.active_streams(spark) == []
    assert [spark.read.parquet(o).count() for o in out] == [1, 1]


def test_a_failing_stream_raises(spark, tmp_path):
    def broken(batch, batch_id):
        raise RuntimeError("no room")

    folder = land(tmp_path / "in", [event(1)])
    with pytest.raises(StreamingQueryException, match="no room"):
        runner.run_stream(events(spark, folder), broken)
    assert runner.active_streams(spark) == []


def test_stop_all(spark, tmp_path):
    folder = land(tmp_path / "in", [event(1)])
    query = runner.start_stream(events(spark, folder), "noop", name="endless")
    assert [name for name, _ in runner.active_streams(spark)] == ["endless"]
    runner.stop_all(spark)
    assert not query.isActive


@pytest.mark.parametrize("as_folder", [True, False])
def test_stream_over_parquet_folder_or_file(spark, testdata, tmp_path, as_folder):
    path = f"{testdata}/sf0.001/events.parquet"
    df = spark.read.parquet(path)
    if as_folder:
        path = str(tmp_path / "events.parquet")
        df.repartition(3).write.parquet(path)
    streamed, _ = runner.append_stream(stream_parquet(spark, path, df.schema).select("event_id"))
    assert streamed.count() == df.count()


def test_null_and_unreadable_times_have_no_window(spark, tmp_path):
    bad = {**event(1), "event_time": "garbage"}
    folder = land(tmp_path / "in", [event(1), bad, {**bad, "event_time": None}])
    assert [r.event_count for r in w.window_counts(at_rest(spark, folder), "event_name").collect()] == [1]


def test_rollup_counts(spark, tmp_path):
    folder = land(tmp_path / "in", [event(1), event(2), event(3, session="s2")])
    for exact in (True, False):
        result = w.rollup_counts(at_rest(spark, folder), "traffic_source", exact=exact)
        assert [tuple(r) for r in result.collect()] == [("web", 3, 2)]


def test_progress_of_more_batches_than_a_query_remembers(spark, tmp_path):
    folder = land(tmp_path / "in", *([event(i % 60, i=i)] for i in range(112)))
    _, log = runner.append_stream(events(spark, folder).select("event_id"))
    rows = runner.stream_progress(log).collect()
    assert sum(r.input_rows for r in rows) == 112 and len({r.batch_id for r in rows if r.input_rows}) == 112


def test_compaction_and_restart_equal_the_batch(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, [event(1)], [event(7)], [event(2)])
    place = {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "check")}

    def run():
        counts = w.window_counts(events(spark, str(folder)), "event_name")
        return bag(runner.upsert_stream(counts, KEYS, **place), *KEYS, "event_count")

    def batch():
        return bag(w.window_counts(at_rest(spark, str(folder)), "event_name"), *KEYS, "event_count")

    assert run() == batch()
    for _ in range(2):
        runner.compact_revisions(spark, place["path"], KEYS)
        assert bag(runner.latest_revisions(spark, place["path"], KEYS), *KEYS, "event_count") == batch()
    assert len(list((tmp_path / "out").glob("revision=*"))) == 1
    (folder / "events_later.json").write_text(json.dumps(event(8)) + "\n")
    assert run() == batch()


def test_an_empty_source_gives_an_empty_result(spark, tmp_path):
    (tmp_path / "in").mkdir()
    result = runner.upsert_stream(w.window_counts(events(spark, str(tmp_path / "in")), "event_name"), KEYS)
    assert result.count() == 0 and {*KEYS, "event_count"} <= set(result.columns)


def test_few_sessions_are_counted_exactly(spark):
    rows = spark.range(14_000).selectExpr(
        "timestamp_seconds(1700000100 + 300 * (id div 7)) AS event_ts", "'a' AS event_name",
        "IF(id % 7 = 6, NULL, concat('u', id, '-2024-03-01')) AS session_id",
    )
    found = w.window_counts(rows, "event_name").select("event_count", "unique_sessions").distinct().collect()
    assert [tuple(r) for r in found] == [(7, 6)]
    few = w.rollup_counts(rows.limit(200), "event_name").collect()[0]
    assert few.unique_sessions == w.rollup_counts(rows.limit(200), "event_name", exact=True).collect()[0].unique_sessions
