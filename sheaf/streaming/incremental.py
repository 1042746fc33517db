"""Incremental harvest: what has landed since the last run is decoded and parsed, once; a harvest then reads entries.

Decoding and parsing need no state, so a stream does them file by file and appends the results with its own commit log:
a run that was cut off is taken up where it was, and no file counts twice. What is last for a URL is settled on the
results, which are small beside the bodies: by the harvest itself, as for any landed table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.operators.extract import EXTRACTORS, Extractor, extract_all
from sheaf.operators.fetch import DATASET, landed_texts
from sheaf.schemas import CHARSET, LANDED_AT, RESPONSES

_RESULT = T.StructType().add("entries", T.ArrayType(T.StringType())).add("raw", T.ArrayType(T.StringType()))


def stream_responses(spark: SparkSession, path: str, *, charset: bool = False, files_per_batch: int = 1000) -> DataFrame:
    """Landed responses with ``landed_at``, as a stream over the files below ``path``."""
    schema = T.StructType([*RESPONSES.fields, *([CHARSET] * charset), LANDED_AT])
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def extracted_responses(
    responses: DataFrame,
    client_error_scope: str = DATASET,
    extractors: Mapping[str, Extractor] = EXTRACTORS,
    detect: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``(url, status, net_error, landed_at, outcome, by_<key>...)``: no body is left. For tables and for streams.

    Who will ask for a URL is not known when it lands, so all ``extractors`` read all documents; name those in use.
    """
    return extract_all(landed_texts(responses, client_error_scope, detect), extractors)


def advance(extracted: DataFrame, root: str) -> None:
    """Append the results of all files that no earlier run under ``root`` has seen, and return."""
    query = (
        extracted.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/extracted")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_extracted(spark: SparkSession, root: str, extractors: Mapping[str, Extractor] = EXTRACTORS) -> DataFrame:
    """The results of all runs, for ``harvest(..., extracted=True)``; files of a run that was cut off are not among them."""
    plain = [f for f in RESPONSES.fields if f.name != "body"]
    results = [T.StructField(f"by_{key}", _RESULT) for key in extractors]
    return spark.read.schema(T.StructType([*plain, LANDED_AT, T.StructField("outcome", T.StringType()), *results])).parquet(f"{root}/extracted")
