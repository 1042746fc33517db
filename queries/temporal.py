"""Queries in time: responses as of a request, events near an error, sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.corpora import table, text
from queries.registry import query
from sheaf.operators.temporal import asof_join, near_pairs, sessions

URL_SQL = "CASE WHEN event_id % 3 = 0 THEN 'https://hot' ELSE 'https://user/' || user_id END"


def asked(spark, sf_dir):
    """``(event_id, user_id, url, ts)``: a third of all events ask for one URL."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    url = F.when(F.col("event_id") % 3 == 0, "https://hot").otherwise(text("https://user/", F.col("user_id")))
    return events.withColumn("url", url)


@query(f"""
WITH asked AS (SELECT *, {URL_SQL} AS url FROM events),
landed AS (SELECT url, ts, max(event_id) AS response FROM asked WHERE event_type = 'purchase' OR event_id % 4 = 1 GROUP BY url, ts)
SELECT a.event_id, a.url, l.response FROM asked a ASOF LEFT JOIN landed l ON a.url = l.url AND a.ts >= l.ts
""")
def asof_responses(spark, sf_dir):
    requests = asked(spark, sf_dir)
    landed = requests.where((F.col("event_type") == "purchase") | (F.col("event_id") % 4 == 1)).select("url", "ts", F.col("event_id").alias("response"))
    return asof_join(requests.select("event_id", "url", "ts"), landed, "url", "ts").drop("ts")


@query("""
SELECT e.event_id, f.event_id AS error_id FROM events e JOIN events f
ON e.user_id = f.user_id AND f.event_type = 'error' AND e.event_type <> 'error'
AND e.ts BETWEEN f.ts - INTERVAL 30 MINUTE AND f.ts + INTERVAL 30 MINUTE
""")
def events_near_errors(spark, sf_dir):
    events = asked(spark, sf_dir)
    errors = events.where("event_type = 'error'").select("user_id", F.col("event_id").alias("error_id"), F.col("ts").alias("error_ts"))
    others = events.where("event_type <> 'error'").select("user_id", "event_id", "ts")
    return near_pairs(others, errors, "user_id", "ts", 1800, right_time="error_ts").select("event_id", "error_id")


@query("""
SELECT user_id, min(ts) AS started, max(ts) AS last, count(*)::BIGINT AS n_events
FROM (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
      FROM (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 2 HOUR, true) AS gap FROM events))
GROUP BY user_id, session
""")
def user_sessions(spark, sf_dir):
    found = sessions(asked(spark, sf_dir), "user_id", "ts", "2 hours")
    return found.select("user_id", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("started", "last")), "n_events")
