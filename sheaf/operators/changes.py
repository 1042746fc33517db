"""What changed from one version of the published files to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def version_changes(old: DataFrame, new: DataFrame, identity: Column, keys: Sequence[str] = ("file_name",), content: str = "entry") -> DataFrame:
    """``(keys..., identity, added, removed, changed)``: one row for each record of which copies differ.

    ``identity`` is an expression over both sides that names a record within its file; null is a name too. Copies with the
    same content cancel out, however often and wherever they stand. Of what remains under one name, an old copy and a
    new one are a change; those left over were added or removed. Contents are compared by their SHA-256. Both steps
    aggregate before they shuffle, so a file or a name of any size is no single task, and no version is joined.
    """
    def signed(side: DataFrame, sign: int) -> DataFrame:
        digest = F.unhex(F.sha2(F.col(content).cast("binary"), 256))
        return side.select(*keys, identity.alias("identity"), digest.alias("_digest"), F.lit(sign).cast("long").alias("_sign"))

    net = signed(old, -1).unionByName(signed(new, 1)).groupBy(*keys, "identity", "_digest").agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    more, less = F.sum(F.greatest("_net", F.lit(0))), F.sum(F.greatest(-F.col("_net"), F.lit(0)))
    found = net.groupBy(*keys, "identity").agg(more.alias("_more"), less.alias("_less")).withColumn("changed", F.least("_more", "_less"))
    return found.select(*keys, "identity", (F.col("_more") - F.col("changed")).alias("added"), (F.col("_less") - F.col("changed")).alias("removed"), "changed")
