"""Schemas of the tables that pass between the harvest steps."""

from pyspark.sql import types as T

REPOS = T.StructType(
    [
        T.StructField("repo_pos", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("sitemap", T.StringType(), False),
        T.StructField("metadata", T.StringType(), True),
        T.StructField("commit", T.BooleanType(), True),
    ]
)

RESPONSES = T.StructType(
    [
        T.StructField("url", T.StringType(), False),
        T.StructField("status", T.IntegerType(), True),
        T.StructField("body", T.BinaryType(), True),
        T.StructField("net_error", T.StringType(), True),
    ]
)

# Columns a responses table may carry on top of RESPONSES.
CHARSET = T.StructField("charset", T.StringType(), True)
LANDED_AT = T.StructField("landed_at", T.TimestampType(), True)
