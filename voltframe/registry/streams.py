"""Streaming jobs drained over the given events, next to the batch statement of their result."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltframe.functions.scalars import exact_sum
from voltframe.operators.tables import Day, Lake
from voltframe.registry.base import plain, query, table
from voltframe.schemas import describe
from voltframe.session import new_folder, use_utc
from voltframe.streaming import events as streams

_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def _stream(spark, sf):
    return streams.parquet_stream(use_utc(spark), f"{sf}/events.parquet")


def _cents():
    return F.sum(F.round(F.col("value") * 100).cast("bigint"))


@query("stream_tumbling", f"""
SELECT s AS window_start, s + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS s FROM events)
WHERE s + INTERVAL 6 HOUR <= {_CLOSED} GROUP BY ALL""")
def stream_tumbling(spark, sf):
    windows = streams.tumbling(_stream(spark, sf), "ts", "1 hour", "6 hours", ["event_type"],
                               {"n": F.count(F.lit(1)), "cents": _cents()})
    return plain(streams.drained(spark, windows, "tumbling"))


@query("stream_sliding", f"""
SELECT s AS window_start, s + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS n FROM (
  SELECT event_type, time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '2024-01-01') - INTERVAL 2 HOUR * k AS s FROM events, range(0, 3) r(k))
WHERE s + INTERVAL 6 HOUR <= {_CLOSED} GROUP BY ALL""")
def stream_sliding(spark, sf):
    windows = streams.tumbling(_stream(spark, sf), "ts", "1 hour", "6 hours", ["event_type"], {"n": F.count(F.lit(1))}, slide="2 hours")
    return plain(streams.drained(spark, windows, "sliding"))


@query("stream_session", f"""
WITH marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked),
s AS (SELECT user_id, session, min(ts) AS session_start, max(ts) + INTERVAL 4 HOUR AS session_end, count(*) AS n FROM numbered GROUP BY ALL)
SELECT user_id, session_start, session_end, n FROM s WHERE session_end <= {_CLOSED}""")
def stream_session(spark, sf):
    sessions = streams.sessions(_stream(spark, sf), "ts", "1 hour", "4 hours", ["user_id"], {"n": F.count(F.lit(1))})
    return plain(streams.drained(spark, sessions, "session"))


@query("stream_first_seen", "SELECT event_id, user_id, event_type FROM events")
def stream_first_seen(spark, sf):
    """Every event twice on the stream, once in the table."""
    twice = _stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return plain(streams.drained(spark, streams.first_seen(twice, "ts", "1 day", ["event_id"]).select("event_id", "user_id", "event_type"), "dedupe"))


@query("stream_append", "SELECT event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total FROM events GROUP BY 1")
def stream_append(spark, sf):
    stored = streams.drained(spark, _stream(spark, sf), "append")
    return plain(stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total")))


@query("stream_failures", "SELECT event_id, ts, user_id FROM events WHERE event_type = 'error'")
def stream_failures(spark, sf):
    alerts = streams.failures(_stream(spark, sf), "event_type", "error").select("event_id", "ts", "user_id")
    return plain(streams.drained(spark, alerts, "failures"))


_STATE = describe("""
    user_id bigint !
    ts timestamp
    event_id bigint
    event_type string
    value double
""")


@query("stream_latest", """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def stream_latest(spark, sf):
    folder = new_folder(spark, "latest")
    store = Lake(spark, folder, {"state": _STATE}, {"state": Day("bucket", of=("user_id",), buckets=8)})
    feed = _stream(spark, sf).select("user_id", "ts", "event_id", "event_type", "value")
    streams.keep_latest(feed, store, "state", ["user_id"], ["ts", "event_id"], f"{folder}/checkpoint")
    return plain(store.read("state"))


@query("stream_json_docks", """
SELECT 'P' || s_suppkey AS BikepointID, s_name AS Street, CAST(s_nationkey AS BIGINT) AS No_Bikes, s_acctbal AS Latitude FROM supplier""")
def stream_json_docks(spark, sf):
    """Suppliers as dock messages: a JSON stream without event time, stamped on arrival."""
    folder = new_folder(spark, "docks")
    messages = table(spark, sf, "supplier").select(
        F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("BikepointID"), F.col("s_name").alias("Street"),
        F.lit("N").alias("Neighbourhood"), F.col("s_acctbal").alias("Latitude"), F.lit(0.0).alias("Longitude"),
        F.col("s_nationkey").cast("bigint").alias("No_Bikes"), F.lit(1).cast("bigint").alias("No_Empty_Docks"))
    messages.write.json(f"{folder}/in")
    stored = streams.drained(spark, streams.json_stream(spark, f"{folder}/in"), "docks")
    return plain(stored.where("arrived_at IS NOT NULL").select("BikepointID", "Street", "No_Bikes", "Latitude"))


@query("stream_late_rows", f"""
SELECT s AS window_start, s + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, max(event_id) AS last_id
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS s FROM events)
WHERE s + INTERVAL 6 HOUR <= {_CLOSED} GROUP BY ALL""")
def stream_late_rows(spark, sf):
    """Events in files of no order, a file a batch: nearly all are late after the first file, and none is lost."""
    folder = new_folder(spark, "late")
    shuffled = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for i in range(4):
        shuffled.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == i).write.mode("append").parquet(f"{folder}/feed")
    feed = spark.readStream.schema(shuffled.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/feed")
    windows = streams.LateWindows(spark, f"{folder}/state", "ts", "1 hour", "6 hours", ["event_type"], {
        "n": (F.count(F.lit(1)), F.sum), "cents": (_cents(), F.sum), "last_id": (F.max("event_id"), F.max)})
    windows.run(feed, f"{folder}/checkpoint")
    return plain(windows.closed())
