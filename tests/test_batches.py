import pyarrow as pa

from sheaf.functions.batches import BYTES_SETTING, bound_batches


def test_long_rows_reach_python_a_megabyte_or_so_at_a_time(spark):
    bound_batches(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    try:
        found = spark.range(0, 400, 1, 1).selectExpr("repeat('x', 20000) AS text").mapInArrow(sizes, "rows long, bytes long").collect()
    finally:
        spark.conf.unset(BYTES_SETTING)
    assert sum(r.rows for r in found) == 400
    assert max(r.bytes for r in found) < 2 << 20
