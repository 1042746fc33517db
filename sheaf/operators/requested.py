"""Look before reading: a bitmap of the requested URLs tells which landed bodies anybody asks for, and how."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.urls import request_key

#: Bits of the bitmap, whatever the number of requests, in words of 64: at most 2^20 rows, which is the bound on what
#: is broadcast. Up to some ten million requested URLs, nearly all others are told apart; beyond, fewer and fewer.
BITS = 1 << 26


def _placed(df: DataFrame) -> DataFrame:
    """Add the word and the bit within it that stand for ``url``."""
    place = F.xxhash64(request_key(F.col("url"))).bitwiseAND(F.lit(BITS - 1))
    df = df.withColumn("_place", place)
    return df.withColumn("_word", F.shiftright("_place", 6)).withColumn("_bit", F.expr("shiftleft(1L, CAST(_place & 63 AS INT))")).drop("_place")


def request_bitmap(requests: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``(_word, _any, _asked_<key>...)``: the bits of ``requests (url, metadata)``, all and by extractor key.

    Words are or-ed before the shuffle, so a URL that is asked for very often costs no more than another.
    """
    bits = [F.bit_or("_bit").alias("_any")]
    bits += [F.coalesce(F.bit_or(F.when(F.col("metadata") == key, F.col("_bit"))), F.lit(0).cast("long")).alias(f"_asked_{key}") for key in keys]
    return _placed(requests.select("url", "metadata")).groupBy("_word").agg(*bits)


def asked_for(responses: DataFrame, bitmap: DataFrame) -> DataFrame:
    """The responses whose URL's bit is set, with a column ``_asked_<key>`` for each key: whether that bit is.

    A narrow step that reads no body. A URL may share its bit with another, so the exact join is still to come; none
    that is asked for is left out.
    """
    placed = _placed(responses)
    asked = [c for c in bitmap.columns if c.startswith("_asked_")]
    hit = placed.join(F.broadcast(bitmap), "_word").where(F.col("_any").bitwiseAND(F.col("_bit")) != 0)
    return hit.select(*responses.columns, *((F.col(c).bitwiseAND(F.col("_bit")) != 0).alias(c) for c in asked))


def asked(key: str) -> Column:
    """Whether :func:`asked_for` found a request that names this extractor."""
    return F.col(f"_asked_{key}")
