"""The catalog of repositories to harvest."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sheaf.schemas import REPOS

REQUIRED = ("name", "url", "sitemap")
OPTIONAL = ("metadata", "commit", "http_client")


def repo_catalog(spark: SparkSession, records: Iterable[Mapping]) -> DataFrame:
    """Catalog from configuration records, in their order.

    A missing or unknown field is refused. ``http_client`` settings are accepted and left out: they
    steer the download, which has happened by the time responses are harvested.
    """
    rows = []
    for pos, record in enumerate(records):
        missing = [field for field in REQUIRED if record.get(field) is None]
        unknown = sorted(set(record) - {*REQUIRED, *OPTIONAL})
        if missing or unknown:
            raise TypeError(f"repository {pos}: missing fields {missing}, unknown fields {unknown}")
        rows.append(
            (pos, *(record[field] for field in REQUIRED), record.get("metadata"), record.get("commit", True))
        )
    # Handed over as an Arrow table, the catalog has a size that the optimiser knows: it broadcasts a small one by itself.
    table = pa.Table.from_pylist([dict(zip(REPOS.names, row, strict=True)) for row in rows], to_arrow_schema(REPOS))
    return spark.createDataFrame(table, REPOS)


def catalog_table(table: DataFrame) -> DataFrame:
    """Catalog from a table: absent optional columns and NULL ``commit`` get their defaults."""
    missing = {"repo_pos", *REQUIRED} - set(table.columns)
    unknown = set(table.columns) - {"repo_pos", *REQUIRED, *OPTIONAL}
    if missing or unknown:
        raise TypeError(f"missing columns {sorted(missing)}, unknown columns {sorted(unknown)}")
    metadata = F.col("metadata") if "metadata" in table.columns else F.lit(None)
    commit = F.col("commit") if "commit" in table.columns else F.lit(None)
    return table.select(
        "repo_pos",
        *REQUIRED,
        metadata.cast("string").alias("metadata"),
        F.coalesce(commit.cast("boolean"), F.lit(True)).alias("commit"),
    )
