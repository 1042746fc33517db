"""Landed responses: one row per fetched URL, with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.schemas import CHARSET, LANDED_AT, RESPONSES


def read_responses(
    spark: SparkSession, path: str, *, charset: bool = False, landed_at: bool = False
) -> DataFrame:
    """Scan a Parquet table of landed responses; only the columns a step uses are read."""
    extra = [CHARSET] * charset + [LANDED_AT] * landed_at
    return spark.read.schema(T.StructType([*RESPONSES.fields, *extra])).parquet(path)


def latest_by_url(df: DataFrame, payload: list[str]) -> DataFrame:
    """One row per URL: the last landed, then the one with the greatest status and payload.

    Copies of a URL are reduced before the shuffle, so a URL that landed very often costs no task
    more than the others.
    """
    order = [c for c in ("landed_at", "status", "net_error") if c in df.columns]
    best = F.max(F.struct(*order, *payload)).alias("best")
    return df.groupBy("url").agg(best).select("url", *(f"best.{column}" for column in payload))
