"""Joins and groups in time: the response that was valid when a request was made, what happened near to what, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(time.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, *, bucket_seconds: int = 3600) -> DataFrame:
    """Each row of ``left`` with the columns of the last row of ``right`` that has its ``key``, at its ``time`` or before.

    Rows without such a partner get nulls, as do rows with a null key or time. Of right-hand rows at the same time the
    greatest counts. Both sides are sorted together within (key, bucket of time), and the last value is carried on;
    what a bucket inherits is told by a table with a row for each key and bucket. So a key that holds a large share
    of all rows is as many groups as it has buckets, and no pair of rows is made that isn't in the result.
    """
    payload = [c for c in right.columns if c not in (key, time)]
    if clash := set(payload) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    answers = right.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(key, time).agg(F.max(F.struct(*payload)).alias("_last"))
    whole = left.withColumn("_asks", F.lit(True)).unionByName(answers.withColumn("_asks", F.lit(False)), allowMissingColumns=True)
    whole = whole.withColumn("_bucket", _bucket(F.col(time), bucket_seconds))

    # One row for each key and bucket: its own last value, then that of the buckets before it.
    ends = whole.where(F.col(key).isNotNull() & F.col("_bucket").isNotNull()).groupBy(key, "_bucket").agg(F.max(F.when(F.col("_last").isNotNull(), F.struct(F.col(time).alias("at"), "_last"))).alias("end"))
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(key, "_bucket", F.last("end", ignorenulls=True).over(earlier)["_last"].alias("_carried"))

    # A value at the same time comes before the row that asks.
    within = Window.partitionBy(key, "_bucket").orderBy(time, "_asks").rowsBetween(Window.unboundedPreceding, 0)
    seen = whole.withColumn("_seen", F.last("_last", ignorenulls=True).over(within)).where("_asks")
    found = seen.join(carried, [key, "_bucket"], "left")
    valid = F.when(F.col(key).isNotNull() & F.col(time).isNotNull(), F.coalesce("_seen", "_carried"))
    found = found.withColumn("_valid", valid)
    return found.select(*left.columns, *(F.col(f"_valid.{c}").alias(c) for c in payload))


def near_pairs(left: DataFrame, right: DataFrame, key: str, time: str, seconds: int, *, right_time: str) -> DataFrame:
    """All pairs of rows with the same ``key`` whose times lie up to ``seconds`` apart, each once.

    The right side's time is called ``right_time``; the sides share no column but the key. A row of the left goes to
    its bucket of time, one of the right to its own and both neighbours, so partners meet in one bucket by an equality,
    and the exact test follows. Null keys and times have no partners.
    """
    here = left.withColumn("_bucket", _bucket(F.col(time), seconds))
    own = _bucket(F.col(right_time), seconds)
    there = right.withColumn("_bucket", F.explode(F.array(own - 1, own, own + 1)))
    apart = F.abs(F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col(right_time).cast("timestamp")))
    return here.join(there, [key, "_bucket"]).where(apart <= seconds * 1_000_000).drop("_bucket")


def sessions(events: DataFrame, key: str, time: str, gap: str) -> DataFrame:
    """``(key, started, last, n_events)``: runs of a key's rows with up to ``gap`` between one and the next.

    Works on a table and, behind a watermark on ``time``, on a stream. Sessions merge in partial aggregates, so a key
    with very many rows is not gathered. Rows without time belong to none.
    """
    grouped = events.where(F.col(time).isNotNull()).groupBy(key, F.session_window(time, gap).alias("session"))
    found = grouped.agg(F.max(time).alias("last"), F.count(F.lit(1)).alias("n_events"))
    return found.select(key, F.col("session.start").alias("started"), "last", "n_events")
