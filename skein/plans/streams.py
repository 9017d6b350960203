"""The event log as a stream; each query's SQL is its batch form."""

from __future__ import annotations

from skein.plans.base import query
from skein.streaming import events as S


def _log(spark, folder):
    return S.read_log(spark, f"{folder}/events.parquet*")


@query("stream_status", "SELECT event_id, user_id, value FROM events WHERE event_type = 'error'")
def stream_status(spark, folder):
    return S.drain(S.status_filter(_log(spark, folder), "error"), "append")


@query("stream_tumbling", "SELECT epoch(time_bucket(INTERVAL 1 HOUR, ts))::BIGINT AS start_s, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_tumbling(spark, folder):
    return S.drain(S.tumbling(_log(spark, folder), "1 hour", "10 minutes"), "update", ["start_s", "event_type"])


@query(
    "stream_session",
    """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS nw FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def stream_session(spark, folder):
    """Sessions that have ended by the watermark; later ones stay open in the state."""
    return S.drain(S.sessions(_log(spark, folder), "2 hours", "10 minutes"), "append")


@query("stream_lifecycle", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS stage, count(*) AS n FROM events GROUP BY 1")
def stream_lifecycle(spark, folder):
    return S.drain(S.lifecycle(_log(spark, folder)), "update", ["user_id"])


@query(
    "stream_staleness",
    "SELECT user_id, event_id, gap_us / 1e6 AS gap_s FROM (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap_us FROM events) WHERE gap_us > 36000000000",
)
def stream_staleness(spark, folder):
    return S.drain(S.stale_gaps(_log(spark, folder), 36_000), "append")
