import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sheaf.operators.temporal import asof_join, near_pairs, sessions

START = datetime(1969, 12, 31, 23, 0)


def at(seconds):
    return START + timedelta(seconds=seconds)


def rows(seed, n):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot", "hot", "a", "b"]), at(rng.randrange(20_000))) for i in range(n)]


def test_asof_against_brute_force(spark):
    left, right = rows(1, 300), rows(2, 60)
    left += [(900, None, at(5)), (901, "a", None), (902, "nobody", at(5)), (903, "hot", right[0][2])]
    right += [(990, "hot", right[0][2]), (991, None, at(0)), (992, "a", None)]
    want = {}
    for i, key, time in left:
        known = [(t, j) for j, k, t in right if None not in (key, time, k, t) and k == key and t <= time]
        want[i] = max(known)[1] if known else None
    frame = asof_join(spark.createDataFrame(left, "id long, key string, ts timestamp"), spark.createDataFrame(right, "answer long, key string, ts timestamp"), "key", "ts", bucket_seconds=700)
    found = frame.collect()
    assert frame.columns == ["id", "key", "ts", "answer"] and len(found) == len(left)
    assert {r.id: r.answer for r in found} == want


def test_a_hot_key_is_as_many_groups_as_buckets(spark):
    left = spark.range(1000).select("id", F.lit("hot").alias("key"), F.timestamp_seconds("id").alias("ts"))
    right = left.where("id % 100 = 0").select(F.col("id").alias("answer"), "key", "ts")
    found = asof_join(left, right, "key", "ts", bucket_seconds=10)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key#" in text and "NestedLoop" not in text and "Cartesian" not in text
    assert {r.id: r.answer for r in found.collect()} == {i: i // 100 * 100 for i in range(1000)}


def test_near_pairs_against_brute_force(spark):
    left, right = rows(3, 200) + [(900, None, at(1)), (901, "a", None)], rows(4, 80) + [(990, None, at(1))]
    seconds = 300
    frame = near_pairs(spark.createDataFrame(left, "id long, key string, ts timestamp"), spark.createDataFrame(right, "other long, key string, other_ts timestamp"), "key", "ts", seconds, right_time="other_ts")
    want = sorted((i, j) for i, k, t in left for j, q, s in right if k is not None and k == q and t is not None and abs((t - s).total_seconds()) <= seconds)
    assert sorted((r.id, r.other) for r in frame.collect()) == want and want
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_sessions_merge_up_to_the_gap(spark):
    times = [0, 10, 69, 130, 190, 251, 313, 1000]
    events = spark.createDataFrame([("a", at(s)) for s in times] + [("b", at(5)), ("a", None), (None, at(5))], "key string, ts timestamp")
    found = sessions(events, "key", "ts", "61 seconds").collect()
    got = sorted((str(r.key), r.started, r.last, r.n_events) for r in found)
    assert got == [("None", at(5), at(5), 1), ("a", at(0), at(251), 6), ("a", at(313), at(313), 1), ("a", at(1000), at(1000), 1), ("b", at(5), at(5), 1)]


def test_sessions_of_a_stream_leave_late_rows_out(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    source = tmp_path / "in"
    source.mkdir()
    day = 86_400  # a stream starts with its watermark at 1970
    batches = [[("a", at(day)), ("a", at(day + 30))], [("a", at(day + 5000))], [("a", at(day + 10)), ("a", at(day + 5010))], [("a", at(day + 20_000))]]
    stream = spark.readStream.schema("key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(source))
    frame = sessions(stream.withWatermark("ts", "10 minutes"), "key", "ts", "60 seconds")
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, "key string, ts timestamp").coalesce(1).write.mode("append").parquet(str(source))
        started = frame.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        started.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.started, r.n_events) for r in found) == [(at(day), 2), (at(day + 5000), 2)]
