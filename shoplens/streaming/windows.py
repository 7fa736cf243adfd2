"""Windowed aggregates; the same functions serve batch tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_event_time(events: DataFrame, col: str, out: str = "event_ts") -> DataFrame:
    """Event time as a zoned timestamp, which watermarks need; unreadable text becomes NULL."""
    return events.withColumn(out, F.col(col).try_cast("timestamp"))


def _estimated(session: str, precision: int = 12) -> Column:
    """Approximate distinct values: some hundreds are all but exactly counted, more of them with an error of about 1.6 %.

    ``approx_count_distinct`` has 512 registers however few the values are, so two or three of seven sessions may share one.
    """
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.col(session).cast("string"), precision))


def _bounds() -> list[Column]:
    return [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]


def window_counts(
    events: DataFrame,
    key: str,
    session: str = "session_id",
    ts: str = "event_ts",
    window: str = "5 minutes",
    watermark: str | None = "10 minutes",
    slide: str | None = None,
    sessions_as: str = "unique_sessions",
) -> DataFrame:
    """Events and approximate distinct sessions per time window and key.

    Tumbling, or sliding with ``slide``. The watermark lets a stream forget old windows and
    drop rows that come later than that; a batch ignores it. ``None`` keeps all state, for
    replays of bounded data in any order.
    """
    timed = events.withWatermark(ts, watermark) if watermark else events
    return (
        timed.groupBy(F.window(ts, window, slide).alias("w"), key)
        .agg(F.count("*").alias("event_count"), _estimated(session).alias(sessions_as))
        .select(*_bounds(), key, "event_count", sessions_as)
    )


def exact_sessions(
    events: DataFrame,
    key: str,
    session: str = "session_id",
    ts: str = "event_ts",
    window: str = "5 minutes",
    watermark: str = "10 minutes",
) -> DataFrame:
    """Exact distinct sessions per window and key, on streams too.

    Streams refuse a distinct count, so one aggregate finds the sessions and a second counts
    them. Unlike dropped duplicates an aggregate combines before it shuffles: a session with
    very many events in one window leaves each task as a single row.
    """
    seen = events.withWatermark(ts, watermark).groupBy(F.window(ts, window).alias("w"), key, session).count()
    return (
        seen.groupBy("w", key)
        .agg(F.count(session).alias("sessions"))
        .select(*_bounds(), key, "sessions")
    )


def window_sketches(
    events: DataFrame,
    key: str,
    session: str = "session_id",
    ts: str = "event_ts",
    window: str = "5 minutes",
    watermark: str | None = "10 minutes",
    precision: int = 12,
) -> DataFrame:
    """Events per window and key, and a sketch of its sessions that can be stored and united with others.

    A sketch has 2 ** ``precision`` registers and a relative error of about 1.04 / 2 ** (precision / 2), 1.6 % as given;
    sets of some hundreds are all but exact. NULL sessions are not counted.
    """
    timed = events.withWatermark(ts, watermark) if watermark else events
    return (
        timed.groupBy(F.window(ts, window).alias("w"), key)
        .agg(F.count("*").alias("event_count"), F.hll_sketch_agg(session, precision).alias("sessions"))
        .select(*_bounds(), key, "event_count", "sessions")
    )


def unite_sketches(sketches: DataFrame, key: str, unit: str) -> DataFrame:
    """Stored sketches of windows, or of shorter periods, united per ``unit`` (as of date_trunc): no event is read again."""
    start = F.date_trunc(unit, "window_start").alias("window_start")
    return sketches.groupBy(start, key).agg(F.sum("event_count").alias("event_count"), F.hll_union_agg("sessions").alias("sessions"))


def sketch_estimates(sketches: DataFrame, out: str = "sessions") -> DataFrame:
    """Sketches replaced by their estimated counts."""
    return sketches.withColumn(out, F.hll_sketch_estimate("sessions"))


def rollup_counts(events: DataFrame, key: str, session: str = "session_id", exact: bool = False) -> DataFrame:
    """Events and distinct sessions per key over the whole table."""
    distinct = F.count_distinct(session) if exact else _estimated(session)
    return events.groupBy(key).agg(F.count("*").alias("event_count"), distinct.alias("unique_sessions"))
