"""What the physical plans promise at scale."""

import pyarrow as pa
from pyspark.sql import functions as F

from sheaf.operators.extract import extract_all, extract_by_key, flatten_entries
from sheaf.operators.fetch import fetch, landed_outcomes, landed_texts
from sheaf.operators.requested import asked, asked_for, request_bitmap
from sheaf.operators.reshape import parsed_fields, with_dataset_fields, with_errors
from sheaf.operators.routing import split_by_publisher
from sheaf.plans.harvest import fetch_listings, harvest
from sheaf.plans.staging import Stage, checkpointed
from sheaf.schemas import RESPONSES
from sheaf.sources.catalog import repo_catalog
from sheaf.sources.responses import read_responses


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def landed(spark, tmp_path):
    spark.createDataFrame([], RESPONSES).write.parquet(str(tmp_path / "landed"))
    return read_responses(spark, str(tmp_path / "landed"))


def test_extraction_shuffles_nothing(spark, tmp_path):
    text = plan(extract_all(landed_texts(landed(spark, tmp_path))))
    assert "Exchange" not in text
    assert text.count("regexp_extract_all(") == 1


def test_extraction_parses_once(spark, tmp_path):
    pages = landed(spark, tmp_path).select(
        F.col("url").alias("repo"), F.lit(0).alias("url_pos"), F.decode("body", "UTF-8").alias("content"),
        F.lit("embedded_jsonld").alias("metadata"),
    )
    text = plan(flatten_entries(extract_by_key(pages)).groupBy("repo").count())
    # Once natively per extractor, and one helper per extractor.
    assert text.count("ArrowEvalPython") <= 2
    assert text.count("regexp_extract_all(") == 1


def test_listing_lookup_shuffles_no_bodies(spark, tmp_path):
    repos = repo_catalog(spark, [{"name": "r", "url": "http://l", "sitemap": "xml", "metadata": "jsonld"}])
    text = plan(fetch_listings(repos, landed(spark, tmp_path)))
    join = next(line for line in text.splitlines() if "LeftSemi" in line)
    assert "BroadcastHashJoin" in join and "SortMergeJoin" not in text.split("LeftSemi")[1]


def test_reshape_parses_once_under_a_filter(spark):
    df = spark.createDataFrame([], "repo string, url_pos int, item_pos int, entry string")
    df = df.repartition(2)
    fields = with_dataset_fields(with_errors(parsed_fields(df))).where(~F.col("failed"))
    # Once, and once more for the texts that only the helper could read.
    assert plan(fields).count("parseJson(") == 2


def test_a_request_meets_its_response_in_one_join(spark, tmp_path):
    requests = spark.createDataFrame([("r", 0, "http://a")], "repo string, url_pos int, url string")
    statuses = landed_outcomes(landed(spark, tmp_path), unique_urls=True)
    text = plan(fetch(requests, statuses))
    assert text.count("Join") == 1 and "ReadSchema: struct<url:string,status:int,net_error:string>" in text


def test_split_is_one_narrow_pass(spark):
    df = spark.range(5).select(F.lit("{}").alias("entry"))
    assert "Exchange" not in plan(split_by_publisher(df))


def test_bodies_nobody_asks_for_are_dropped_before_decoding(spark, tmp_path):
    requests = spark.createDataFrame([("http://a", "jsonld")], "url string, metadata string")
    wanted = asked_for(landed(spark, tmp_path), request_bitmap(requests, ["jsonld", "embedded_jsonld"]))
    text = plan(extract_all(landed_texts(wanted), wanted=asked))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # Plans are printed from the last step to the first: decoding and parsing stand above the join.
    assert "is_valid_utf8" not in text.split("BroadcastHashJoin")[1]


def test_each_extractor_sees_what_is_asked_of_it(spark):
    rows = [(f" http://{i}/ ", 200, bytearray(f"body {i}", "utf-8"), None) for i in range(2000)]
    responses = spark.createDataFrame(rows, RESPONSES)
    keys = ("one", "two")
    requests = spark.createDataFrame(
        [(f"http://{i}/", key) for i in range(0, 2000, 10) for key in ("one", "two", "none")[i % 3 :]], "url string, metadata string"
    )

    def seen(df):
        return df.withColumn("entries", F.array("content")).withColumn("raw", F.array("content"))

    wanted = asked_for(responses, request_bitmap(requests, keys))
    found = extract_all(landed_texts(wanted), dict.fromkeys(keys, seen), asked).collect()
    assert sorted(int(r.url.strip(" /").split("/")[-1]) for r in found) == list(range(0, 2000, 10))
    for r in found:
        i = int(r.url.strip(" /").split("/")[-1])
        assert r.by_one.entries == [f"body {i}" if i % 3 == 0 else None]
        assert r.by_two.entries == [f"body {i}" if i % 3 < 2 else None]


def test_a_harvest_parses_what_it_follows(spark, tmp_path):
    listing = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">' + "".join(f"<url><loc>http://d/{i}</loc></url>" for i in range(5)) + "</urlset>"
    rows = [("http://l", 200, bytearray(listing, "utf-8"), None)]
    rows += [(f"http://d/{i}", 200, bytearray(f'{{"id": {i}}}', "utf-8"), None) for i in range(400)]
    repos = repo_catalog(spark, [{"name": "r", "url": "http://l", "sitemap": "xml", "metadata": "jsonld"}])
    parsed = spark.sparkContext.accumulator(0)

    @F.arrow_udf("array<string>")
    def counting(contents: pa.Array) -> pa.Array:
        parsed.add(len(contents) - contents.null_count)
        return pa.array([None if c is None else [c] for c in contents.to_pylist()], pa.list_(pa.string()))

    def extractor(df):
        return df.withColumn("entries", counting.asNondeterministic()(F.col("content"))).withColumn("raw", F.col("entries"))

    with Stage(spark, str(tmp_path)) as stage:
        done = harvest(repos, spark.createDataFrame(rows, RESPONSES), extractors={"jsonld": extractor}, stage=stage)
        assert done.entries.count() == 5
    assert parsed.value == 5


def test_a_url_that_many_ask_for_is_split(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        url = F.when(F.col("id") % 3 > 0, F.concat(F.lit("http://"), "id")).otherwise("http://hot")
        requests = spark.range(0, 30000, numPartitions=16).select(F.col("id").cast("string").alias("repo"), url.alias("url"))
        responses = requests.select("url", F.lit(200).alias("status"), F.lit(None).cast("string").alias("net_error"))
        done = fetch(requests, checkpointed(landed_outcomes(responses)))
        assert done.where("outcome = 'ok'").count() == 30000
        done.collect()
        assert "skew=true" in plan(done)
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
