"""Streaming queries: the events table as a file stream, drained and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.plans.catalogue import Tables, lists
from lodestone.streaming import streams as S

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)


def _events(t: Tables) -> DataFrame:
    return S.file_stream(t.spark, f"{t.folder}/events.parquet")


def _text(df: DataFrame) -> DataFrame:
    """Times as text and sums rounded, as the checking SQL has them."""
    out = df.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
    return out.withColumn("total", F.round("total", 4)) if "total" in df.columns else out


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_daily_stats(t: Tables) -> DataFrame:
    return _text(S.drain_complete(S.windowed(_events(t), "ts", "1 day", None, "event_type"), "daily"))


@query("""SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT unnest([time_bucket(INTERVAL 6 HOURS, ts), time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 6 HOURS]) AS s, value FROM events) GROUP BY 1""")
def stream_sliding(t: Tables) -> DataFrame:
    return _text(S.drain_complete(S.windowed(_events(t), "ts", "12 hours", "6 hours"), "sliding"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 2 HOURS THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, user_id, count(*) AS n FROM s GROUP BY user_id, k""")
def stream_session(t: Tables) -> DataFrame:
    return _text(S.drain_complete(S.sessions(_events(t), "ts", "2 hours", "user_id"), "session"))


@query("SELECT event_id FROM events")
def stream_dedupe(t: Tables) -> DataFrame:
    events = _events(t)
    twice = events.withColumn("again", F.explode(F.array(F.lit(1), F.lit(2))))
    return S.drain_append(S.deduplicated(twice, "ts", ["event_id"]).select("event_id"), "dedupe")


@query("SELECT user_id AS task, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS failures, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) >= 3 AS given_up FROM events GROUP BY user_id")
def stream_retries(t: Tables) -> DataFrame:
    failed = _events(t).select("user_id", (F.col("event_type") == "error").cast("int").alias("failed"))
    return S.drain_update(S.retries(failed, "user_id", "failed"), "retries", "task")


@query("""WITH c AS (SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id) SELECT c_custkey, coalesce(c.value, c_acctbal) AS c_acctbal FROM customer LEFT JOIN c ON c_custkey = user_id""")
def stream_change_feed(t: Tables) -> DataFrame:
    def merge(old: DataFrame, changes: DataFrame) -> DataFrame:
        new = changes.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by("value", "event_id").alias("new"))
        return old.join(new, "c_custkey", "left").select("c_custkey", F.coalesce("new", "c_acctbal").alias("c_acctbal"))

    return S.apply_changes(_events(t), merge, t.customer.select("c_custkey", "c_acctbal"), "feed")
