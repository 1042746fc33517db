import json
import random

import pytest

from sheaf.sinks.documents import document_lines, write_documents

SCHEMA = "repo string, file_name string, url_pos int, item_pos int, entry string"


def outputs(spark, sizes, seed=1):
    rows = [(repo, name, i // 3, i % 3, json.dumps({"n": i, "of": name})) for (repo, name), size in sizes.items() for i in range(size)]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def expected(size, name):
    lines = [json.dumps({"n": i, "of": name}) for i in range(size)]
    return "[\n" + ",\n".join(lines) + "\n]" if size else "[]"


SIZES = {("a", "x.json"): 1, ("a", "y.json"): 2, ("b", "x.json"): 700, ("c", "z.json"): 3, (None, "q.json"): 4}


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_lines_of_files_that_span_partitions(spark, partitions):
    missing = [("a", "a.json"), ("b", "zz.json"), ("z", "z.json"), ("b", "x.json")]
    files = spark.createDataFrame([*missing, *SIZES], "repo string, file_name string")
    lines = document_lines(outputs(spark, SIZES), files, partitions=partitions)
    assert lines.columns == ["repo", "file_name", "url_pos", "item_pos", "value"]
    found = {}
    for row in lines.collect():
        found.setdefault((row.repo, row.file_name), []).append(row.value)
    assert {k: "\n".join(v) for k, v in found.items()} == {k: expected(SIZES.get(k, 0), k[1]) for k in {*missing, *SIZES}}


def test_small_batches_wait_for_their_successor(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        values = [r.value for r in document_lines(outputs(spark, {("r", "f"): 5, ("r", "g"): 2}), partitions=1).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "\n".join(values) == expected(5, "f") + "\n" + expected(2, "g")


def test_no_outputs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert document_lines(empty).collect() == []
    files = spark.createDataFrame([("r", "f.json")], "repo string, file_name string")
    assert [r.value for r in document_lines(empty, files).collect()] == ["[]"]


def test_entries_are_shuffled_once(spark):
    text = document_lines(outputs(spark, SIZES))._jdf.queryExecution().optimizedPlan().toString()
    # All that is left above the ordered rows is the edges' table, a row for each partition.
    assert text.count("Join") == 1 and "LogicalRDD" in text


def test_written_parts_concatenate(spark, tmp_path):
    write_documents(outputs(spark, {("r", "f.json"): 300, ("r", "g.json"): 1}), str(tmp_path), partitions=7)
    for name, size in (("f.json", 300), ("g.json", 1)):
        parts = sorted((tmp_path / "repo=r" / f"file_name={name}").glob("part-*"))
        assert "".join(p.read_text() for p in parts) == expected(size, name) + "\n"
