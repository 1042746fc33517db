"""Enough tasks for steps that cost much more than reading their input."""

from __future__ import annotations

from pyspark.sql import DataFrame


#: Rows of a task, about, where their number is known.
TASK_ROWS = 50_000


def spread_rows(scan: DataFrame, tasks: int | None = None, rows: int = 0) -> DataFrame:
    """Deal rows out to ``tasks`` (``spark.sql.shuffle.partitions``), for work per row that costs far more than the shuffle.

    For inputs in a few small files, which would otherwise be worked on by as many tasks; the caller knows them. With
    ``rows``, about how many there are, there are tasks enough for each to get ``TASK_ROWS`` at most.
    """
    tasks = tasks or int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scan.repartition(max(tasks, -(-rows // TASK_ROWS)))
