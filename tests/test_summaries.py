import random
from collections import Counter
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from sheaf.operators.summaries import COUNT_ERROR, DISTINCT_ERROR, RANK_ERROR, estimates, merge_summaries, summarize
from sheaf.sinks.snapshots import RunFailed, publish, read_summaries

ROWS = "repo string, file_name string, entry string, item string"


def test_merged_summaries_are_within_their_bounds(spark):
    rng = random.Random(1)
    rows = [("r", f"f{i % 3}", "x" * rng.randrange(1, 5000), "hot" if i % 7 < 3 else f"i{rng.randrange(20000)}") for i in range(30_000)]
    df = spark.createDataFrame(rows, ROWS).repartition(6)
    parts = [summarize(df.where(F.abs(F.hash("entry")) % 3 == k), F.col("item")) for k in range(3)]
    kept = parts[0].unionByName(parts[1]).unionByName(parts[2])
    by_file = merge_summaries(kept, ["file_name"])
    for summary, own in ((by_file, None), (merge_summaries(by_file), rows)):
        keys = ["file_name"] if own is None else []
        for r in estimates(summary, keys, (0.1, 0.5, 0.9), 3).collect():
            mine = own or [x for x in rows if x[1] == r.file_name]
            assert r.n_rows == len(mine)
            distinct = len({x[2] for x in mine})
            assert abs(r.n_distinct - distinct) <= DISTINCT_ERROR * distinct
            for q, value in zip((0.1, 0.5, 0.9), r.quantiles, strict=True):
                below, upto = (sum(len(x[2]) < value + k for x in mine) / len(mine) for k in (0, 1))
                assert below <= q + RANK_ERROR and upto >= q - RANK_ERROR
            counts = Counter(x[3] for x in mine)
            assert r.frequent[0]["item"] == "hot" and len(r.frequent) == 3
            assert r.count_error == int(len(mine) * COUNT_ERROR)
            assert all(abs(x["count"] - counts[x["item"]]) <= r.count_error for x in r.frequent)


def test_nulls_and_nothing(spark):
    rows = [("r", "f", None, None), ("r", "f", "a", None), ("r", "f", "a", "i"), (None, None, "bb", "i"), ("r", "bare", None, None)]
    df = spark.createDataFrame(rows, ROWS)
    got = {r.file_name: r for r in estimates(merge_summaries(summarize(df, F.col("item")), ["file_name"]), ["file_name"], (0.5,)).collect()}
    assert (got["f"].n_rows, got["f"].n_distinct, got["f"].quantiles) == (3, 1, [1])
    assert [tuple(x) for x in got["f"].frequent] == [("i", 1)] and got[None].quantiles == [2]
    assert (got["bare"].n_rows, got["bare"].n_distinct, got["bare"].quantiles, got["bare"].frequent) == (1, 0, [None], [])
    empty = summarize(df.limit(0), F.col("item"))
    assert empty.count() == 0 and merge_summaries(empty, ["file_name"]).count() == 0
    assert estimates(merge_summaries(empty)).collect() == []


def test_summaries_add_up_before_the_shuffle(spark):
    df = spark.createDataFrame([("r", "f", "a", "i")], ROWS)
    plan = summarize(df, F.col("item"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_kll_sketch_agg_bigint" in plan


def test_a_failed_run_keeps_no_summary(spark, tmp_path):
    outputs = spark.createDataFrame([("r", "f", 1, "a"), ("r", "f", 2, "b"), ("r", "hidden", 1, "c")], "repo string, file_name string, url_pos long, entry string")
    files = spark.createDataFrame([("r", "f", "u", 2, True), ("r", "hidden", "u", 1, False)], "repo string, file_name string, url string, row_count long, published boolean")
    fine, bad = spark.createDataFrame([], "problem string"), spark.createDataFrame([("p",)], "problem string")
    root = str(tmp_path)
    for day, errors in ((1, fine), (2, bad), (3, fine)):
        moment = datetime(2024, 1, day, tzinfo=UTC)
        if errors is bad:
            with pytest.raises(RunFailed):
                publish(outputs, files, errors, root, moment, frequent=F.col("entry"))
        else:
            publish(outputs, files, errors, root, moment, frequent=F.col("entry"))
    # Written, but never made visible.
    summarize(outputs, F.col("entry")).withColumn("run", F.lit("20240105T000000000000")).write.partitionBy("run").mode("append").parquet(f"{root}/summaries")
    kept = read_summaries(spark, root)
    assert sorted((r.run[:8], r.file_name, r.n_rows) for r in kept.collect()) == [("20240101", "f", 2), ("20240103", "f", 2)]
    (row,) = estimates(merge_summaries(kept, ["file_name"]), ["file_name"]).collect()
    assert (row.n_rows, row.n_distinct) == (4, 2) and {tuple(x) for x in row.frequent} == {("a", 2), ("b", 2)}
