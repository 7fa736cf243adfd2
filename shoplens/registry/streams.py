"""Streams over the events table, run until all of it is processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.registry import bindings as b
from shoplens.registry.entries import query
from shoplens.registry.storage import text_clicks
from shoplens.scratch import materialize, scratch_path
from shoplens.sources.catalog import load_table
from shoplens.sources.readers import stream_json, stream_parquet
from shoplens.sources.schemas import STREAM_EVENTS
from shoplens.sources.writers import land_in_order, write_event_landing
from shoplens.streaming import runner
from shoplens.streaming import windows as w

WINDOW = ["window_start", "window_end"]


def _landed(spark: SparkSession, sf: str) -> str:
    """The events as files in the order of time: eight, or one for each part of the table that a task would scan."""
    events = load_table(spark, "events", sf)
    slots = max(8, events.rdd.getNumPartitions())
    return land_in_order(events, scratch_path(spark, "events-in-order"), "ts", slots, tie=["event_id"])


def live_events(spark: SparkSession, sf: str, landed: str | None = None) -> DataFrame:
    """The events table as a stream in the order of time, one landed file to a micro-batch."""
    raw = stream_parquet(spark, landed or _landed(spark, sf), load_table(spark, "events", sf).schema, max_files=1)
    return w.with_event_time(b.as_clickstream(raw), "event_time")


def batch_events(spark: SparkSession, sf: str) -> DataFrame:
    return w.with_event_time(b.clickstream(spark, sf), "event_time")


def plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in WINDOW})


def _windows_sql(key: str, having: str = "") -> str:
    return f"""WITH {b.SQL_CLICKS},
cut AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start FROM clicks)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, {key}, count(*) AS event_count
FROM cut WHERE event_time IS NOT NULL GROUP BY 1, 2, 3 {having}"""


CLOSED = "HAVING window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


@query(_windows_sql("event_name"))
def stream_event_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = w.window_counts(live_events(spark, sf), "event_name", sessions_as="active_sessions")
    return plain_times(runner.upsert_stream(counts, [*WINDOW, "event_name"])).drop("active_sessions")


@query(_windows_sql("traffic_source"))
def stream_traffic(spark: SparkSession, sf: str) -> DataFrame:
    counts = w.window_counts(live_events(spark, sf), "traffic_source")
    return plain_times(runner.upsert_stream(counts, [*WINDOW, "traffic_source"])).drop("unique_sessions")


@query(f"""WITH {b.SQL_CLICKS},
cut AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start FROM clicks)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_name, count(*) AS event_count,
       count(DISTINCT session_id) AS sessions, true AS estimate_is_near
FROM cut WHERE event_time IS NOT NULL GROUP BY 1, 2, 3""")
def stream_active_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's approximate session counts beside the exact ones of the table at rest."""
    counts = w.window_counts(live_events(spark, sf), "event_name", sessions_as="active_sessions")
    streamed = plain_times(runner.upsert_stream(counts, [*WINDOW, "event_name"]))
    exact = plain_times(w.exact_sessions(batch_events(spark, sf), "event_name"))
    # Far beyond the sketch's error: 20 %, or one session.
    near = F.abs(F.col("active_sessions") - F.col("sessions")) <= F.greatest(F.lit(1.0), 0.2 * F.col("sessions"))
    return streamed.join(exact, [*WINDOW, "event_name"]).select(*WINDOW, "event_name", "event_count", "sessions", near.alias("estimate_is_near"))


@query(_windows_sql("traffic_source", CLOSED))
def stream_parquet_append(spark: SparkSession, sf: str) -> DataFrame:
    """Append to Parquet: the windows that the watermark has closed."""
    closed, _ = runner.append_stream(w.window_counts(live_events(spark, sf), "traffic_source"))
    return plain_times(closed).drop("unique_sessions")


@query(_windows_sql("event_name"))
def stream_landing_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Events laid out as JSON files in the order of time and replayed five to a micro-batch, watermark on."""
    clicks = text_clicks(spark, sf)
    slots = max(20, clicks.rdd.getNumPartitions())
    landing = write_event_landing(clicks, scratch_path(spark, "landing"), files=slots)
    events = w.with_event_time(stream_json(spark, landing, STREAM_EVENTS, max_files=5), "event_time")
    counts = w.window_counts(events, "event_name")
    return plain_times(runner.upsert_stream(counts, [*WINDOW, "event_name"])).drop("unique_sessions")


_LATE = "SELECT * FROM events WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 6 HOUR"


@query(f"""WITH late AS ({_LATE}), {b.SQL_CLICKS.replace("FROM events", "FROM late")}
SELECT (SELECT count(*) FROM events) + (SELECT count(*) FROM late) AS input_rows, true AS several_batches,
       count(DISTINCT (time_bucket(INTERVAL 5 MINUTE, event_time), traffic_source)) AS late_groups_dropped FROM clicks""")
def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """All micro-batches of a stream to which the events of the first six hours come a second time, after all others.

    They are summed per window and source before they meet the watermark, so as many groups are dropped.
    """
    landed = _landed(spark, sf)
    events = load_table(spark, "events", sf)
    first = events.agg(F.min("ts")).scalar()
    late = events.withColumn("first", first).where(F.col("ts") < F.col("first") + F.expr("INTERVAL 6 HOURS")).drop("first")
    late.coalesce(1).write.mode("append").parquet(landed)
    _, log = runner.append_stream(w.window_counts(live_events(spark, sf, landed), "traffic_source"))
    return runner.stream_progress(log).agg(
        F.sum("input_rows").alias("input_rows"),
        (F.count_if(F.col("input_rows") > 0) >= 3).alias("several_batches"),
        F.sum("late_rows_dropped").alias("late_groups_dropped"),
    )


@query(_windows_sql("traffic_source"))
def batch_event_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The same aggregate on the table at rest."""
    return plain_times(w.window_counts(batch_events(spark, sf), "traffic_source")).drop("unique_sessions")


@query(f"""WITH {b.SQL_CLICKS}
SELECT traffic_source, count(*) AS event_count, count(DISTINCT session_id) AS unique_sessions
FROM clicks GROUP BY 1""")
def traffic_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return w.rollup_counts(b.clickstream(spark, sf), "traffic_source", exact=True)


@query(f"""WITH {b.SQL_CLICKS}
SELECT traffic_source, count(*) AS event_count, count(DISTINCT session_id) AS unique_sessions, true AS estimate_is_near
FROM clicks GROUP BY 1""")
def traffic_rollup_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The approximate session counts beside the exact ones: within 20 %, or one session."""
    clicks = b.clickstream(spark, sf)
    estimates = w.rollup_counts(clicks, "traffic_source").select("traffic_source", F.col("unique_sessions").alias("estimate"))
    exact = w.rollup_counts(clicks, "traffic_source", exact=True)
    near = F.abs(F.col("estimate") - F.col("unique_sessions")) <= F.greatest(F.lit(1.0), 0.2 * F.col("unique_sessions"))
    return exact.join(estimates, "traffic_source").select("traffic_source", "event_count", "unique_sessions", near.alias("estimate_is_near"))


def _sessions_sql(closed: str) -> str:
    return f"""WITH {b.SQL_CLICKS},
cut AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS w FROM clicks WHERE event_time IS NOT NULL),
kept AS (SELECT * FROM cut {closed}),
periods AS (SELECT unit, date_trunc(unit, w)::TIMESTAMP AS window_start, traffic_source, session_id FROM kept, (VALUES ('hour'), ('day')) u(unit))
SELECT unit, window_start, traffic_source, count(*) AS event_count, count(DISTINCT session_id) AS sessions, true AS estimate_is_near
FROM periods GROUP BY 1, 2, 3"""


def _united(sketches: DataFrame, exact_from: DataFrame) -> DataFrame:
    """Hours and days from stored sketches of five minutes, beside the exact sessions of the same events."""
    found = None
    hours = w.unite_sketches(sketches, "traffic_source", "hour")
    for unit, stored in (("hour", hours), ("day", w.unite_sketches(hours, "traffic_source", "day"))):
        keys = ["window_start", "traffic_source"]
        start = F.date_trunc(unit, "event_ts").alias("window_start")
        exact = exact_from.groupBy(start, "traffic_source").agg(F.count_distinct("session_id").alias("exact"))
        near = F.abs(F.col("sessions") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.065 * F.col("exact"))
        both = w.sketch_estimates(stored).join(exact, keys)
        rows = both.select(
            F.lit(unit).alias("unit"), F.col("window_start").cast("timestamp_ntz").alias("window_start"), "traffic_source",
            "event_count", F.col("exact").alias("sessions"), near.alias("estimate_is_near"),
        )
        found = rows if found is None else found.unionByName(rows)
    return found


@query(_sessions_sql(""))
def sketch_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of hours and days as unions of stored five-minute sketches: within four times the sketch's error of the exact ones."""
    events = batch_events(spark, sf).where("event_ts IS NOT NULL")
    return _united(materialize(w.window_sketches(events, "traffic_source"), "sketches"), events)


@query(_sessions_sql("WHERE w + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"))
def stream_session_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the sketches that an append stream has stored, for the windows that the watermark has closed."""
    closed, _ = runner.append_stream(w.window_sketches(live_events(spark, sf), "traffic_source"))
    last = closed.agg(F.max("window_end")).scalar()
    events = batch_events(spark, sf).withColumn("last", last).where(F.col("event_ts") < F.col("last"))
    return _united(closed, events)
