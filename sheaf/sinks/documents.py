"""JSON documents, one per repository and output file, written as ordered part files."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.functions.json import storable
from sheaf.plans.staging import checkpointed

POSITION = ("url_pos", "item_pos", "title_pos", "description_pos", "license_pos")
# Two repositories on one special route write files of the same name: a document belongs to both.
FILE = ("repo", "file_name")
# Columns of the way: whether a row is an entry or an expected file's mark, its partition, and what its ends adjoin.
_ENTRY, _PART, _OPENED, _GOES_ON = "_entry", "_part", "_opened", "_goes_on"


def _position(df: DataFrame) -> list[str]:
    return [column for column in POSITION if column in df.columns]


def _ordered(df: DataFrame, partitions: int | None) -> DataFrame:
    """Order rows by file and position over all tasks.

    The range bounds include the position, so a file with very many rows is cut into many parts.
    """
    keys = [*FILE, *_position(df)]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_lines(outputs: DataFrame, path: str, partitions: int | None = None) -> None:
    """One entry per line under ``path/repo=<repo>/file_name=<name>/``; parts in name order give the order.

    A file without entries gets no folder.
    """
    lines = _ordered(outputs, partitions).select(*FILE, F.col("entry").alias("value"))
    lines.write.partitionBy(*FILE).mode("overwrite").text(path)


def document_lines(
    outputs: DataFrame, files: DataFrame | None = None, indent: int | None = None, partitions: int | None = None
) -> DataFrame:
    """Lines of one JSON array per repository and file, in order: concatenated they are the documents.

    An entry is one compact line; with ``indent`` it is laid out over several, at the cost of a parse in Python.
    ``files (repo, file_name)`` names the documents to expect: one without entries becomes ``[]``.

    The entries are shuffled once, by ranges of file and position, and written in that order to the shared folder.
    Whether a file goes on beyond a partition's ends tells a table with one row a partition; so brackets and commas
    are set in passing, without a count or a bound of any file.
    """
    positions = _position(outputs)
    rows = outputs.withColumn(_ENTRY, F.lit(True))
    if files is not None:
        rows = rows.unionByName(files.select(*FILE).distinct().withColumn(_ENTRY, F.lit(False)), allowMissingColumns=True)
    keys = [*FILE, _ENTRY, *positions]  # the mark of an expected file comes before its entries
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    ordered = checkpointed(ranged.sortWithinPartitions(*keys)).withColumn(_PART, F.spark_partition_id())

    row = F.struct(*FILE, _ENTRY)
    edges = ordered.groupBy(_PART).agg(F.min(row).alias("low"), F.max(row).alias("high"))
    above, below = F.lag("high").over(Window.orderBy(_PART)), F.lead("low").over(Window.orderBy(_PART))
    edges = edges.withColumns({"above": above, "below": below})

    def joined(one: str, other: str) -> Column:
        alike = [F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in FILE]
        return F.col(one).isNotNull() & alike[0] & alike[1]

    opened = joined("above", "low") & F.col(f"above.{_ENTRY}")
    edges = edges.select(_PART, F.coalesce(opened, F.lit(False)).alias(_OPENED), joined("high", "below").alias(_GOES_ON))
    marked = ordered.join(F.broadcast(edges), _PART).drop(_PART)

    kept = [c for c in outputs.columns if c != "entry"]
    fields = [*(T.StructField(c, outputs.schema[c].dataType) for c in kept), T.StructField("value", T.StringType())]

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines of a partition; each batch waits for the first row of the next."""
        held, before = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None:
                first = _file(batch, 0)
                before = (*first, True) if batch.column(_OPENED)[0].as_py() else None
            else:
                yield _lines(held, before, _file(batch, 0), kept, indent)
                before = (*_file(held, -1), held.column(_ENTRY)[-1].as_py())
            held = batch
        if held is not None:
            after = _file(held, -1) if held.column(_GOES_ON)[0].as_py() else None
            yield _lines(held, before, after, kept, indent)

    return marked.mapInArrow(bracketed, T.StructType(fields))


def _file(batch: pa.RecordBatch, row: int) -> tuple:
    return tuple(batch.column(c)[row].as_py() for c in FILE)


def _lines(batch: pa.RecordBatch, before: tuple | None, after: tuple | None, kept: list[str], indent: int | None) -> pa.RecordBatch:
    """The batch's lines. ``before``: the last row's file and whether that was an entry; ``after``: the next row's file."""
    names = list(zip(*(batch.column(c).to_pylist() for c in FILE), strict=True))
    entries = batch.column(_ENTRY).to_pylist()
    texts = batch.column("entry").to_pylist()
    values: list[str | None] = []
    for i, (name, is_entry, text) in enumerate(zip(names, entries, texts, strict=True)):
        goes_on = name == (names[i + 1] if i + 1 < len(names) else after)
        if not is_entry:
            values.append(None if goes_on else "[]")
        else:
            opens = (*name, True) != before
            text = text if indent is None else _pretty(text, indent)
            values.append(f"{'[' + chr(10) if opens else ''}{text}{',' if goes_on else chr(10) + ']'}")
        before = (*name, is_entry)
    lines = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(values, pa.string())], names=[*kept, "value"])
    return lines.filter(lines.column("value").is_valid())


def write_documents(
    outputs: DataFrame,
    path: str,
    files: DataFrame | None = None,
    indent: int | None = None,
    partitions: int | None = None,
) -> None:
    """Like :func:`write_lines`, but the parts of a file concatenate to one JSON array."""
    lines = document_lines(outputs, files, indent, partitions)
    # Already in this order; said again, as the writer would otherwise sort by file alone.
    lines = lines.sortWithinPartitions(*FILE, *_position(outputs))
    lines.select(*FILE, "value").write.partitionBy(*FILE).mode("overwrite").text(path)


def _pretty(entry: str, indent: int) -> str:
    pad = " " * indent
    text = storable(json.dumps(json.loads(entry), indent=indent, ensure_ascii=False))
    return "\n".join(pad + line for line in text.split("\n"))
