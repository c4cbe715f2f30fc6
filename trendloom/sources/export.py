"""Trend export files (CSV) to raw rows.

The rank of an exported trend is its line in the file.  A task reads its file
or file block from first to last byte, so it can number the rows while they
stream past, with a counter and no sort.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.times import as_instant
from ..schemas import EXPORT_COLUMNS, EXPORT_SCHEMA

# Fixed value: trends_{geo}_{hours}h_{category}_{yyyyMMdd-HHmmss}.csv, which may
# also be the folder that Spark wrote as one CSV file.
FILE_NAME = r"(?:^|[/=])trends_([^/]+)_(\d+)h_(\w+?)_(\d{8}-\d{6})\.csv(?:/[^/]+)?$"


def _number_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Append the 1-based position of each row within its file block."""
    current, seen = None, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        files = batch.column("file_path").to_numpy(zero_copy_only=False)
        blocks = batch.column("block").to_numpy()
        index = np.arange(len(files))
        starts = np.r_[(files[0], blocks[0]) != current, (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])]
        begin = np.maximum.accumulate(np.where(starts, index, -1))
        # rows before the first start continue the block of the previous batch
        rank = np.where(begin >= 0, index - begin, index + seen) + 1
        current, seen = (files[-1], blocks[-1]), int(rank[-1])
        yield batch.append_column("rank", pa.array(rank, pa.int32()))


def _name_fields(file_path: str) -> dict[str, Column]:
    """What a file's name says: NULLs where it is no export's name."""
    name = F.try_url_decode(file_path)
    part = lambda i: F.nullif(F.regexp_extract(name, FILE_NAME, i), F.lit(""))
    at = F.try_to_timestamp(F.concat(part(4), F.lit(" +00:00")), F.lit("yyyyMMdd-HHmmss XXX"))
    return {"geo": part(1), "hours": part(2).cast("int"), "category": part(3), "fetched_at": at}


def rejected_exports(spark: SparkSession, path: str) -> DataFrame:
    """Files whose name is no export's name; :func:`read_exports` leaves them out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(path)
    fields = _name_fields("path")
    return files.where(fields["geo"].isNull() | fields["fetched_at"].isNull()).select(F.col("path").alias("file_path"))


def read_exports(
    spark: SparkSession, path: str, multi_line: bool = True, geos: Sequence[str] | None = None, start=None, end=None
) -> DataFrame:
    """Raw export rows with ``geo, hours, category, fetched_at, rank`` added.

    ``geos``, ``start`` and ``end`` (inclusive) look at the files' names, so files that they
    leave out are not opened.

    By default a file is read by one task, since its cells may hold line breaks;
    ranks then need no shuffle.  ``multi_line=False`` is for large files without
    such cells: they are read in blocks, and the row counts of the blocks before
    are added to the position in the block.

    ``enforceSchema=false`` makes a file with other headers fail instead of
    shifting its columns.  The time in a file name is taken as UTC.
    """
    raw = (
        spark.read.schema(EXPORT_SCHEMA)
        .options(header=True, multiLine=multi_line, escape='"', enforceSchema=False)
        .csv(path)
        .select(
            *[F.col(f"`{c}`") for c in EXPORT_COLUMNS],
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )
    named = _name_fields("file_path")
    raw = raw.where(named["geo"].isNotNull() & named["fetched_at"].isNotNull())
    if geos is not None:
        raw = raw.where(named["geo"].isin(list(geos)))
    if start is not None:
        raw = raw.where(named["fetched_at"] >= as_instant(start))
    if end is not None:
        raw = raw.where(named["fetched_at"] <= as_instant(end))
    numbered = raw.mapInArrow(_number_rows, f"{EXPORT_SCHEMA}, file_path STRING, block BIGINT, rank INT")
    if not multi_line:
        before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = numbered.groupBy("file_path", "block").agg(F.max("rank").alias("n")).select(
            "file_path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int").alias("offset")
        )
        numbered = numbered.join(offsets, ["file_path", "block"]).withColumn("rank", F.col("rank") + F.col("offset"))
    return numbered.select(
        *[column.alias(name) for name, column in _name_fields("file_path").items()],
        "rank",
        *[F.col(f"`{c}`") for c in EXPORT_COLUMNS],
    )


#: Columns of a file of unknown layout that are looked at.
MAX_COLUMNS = 32
_MARK = "\ufeff"


def _headers_in(batch: pa.RecordBatch, current: str | None):
    """Slices of one file each: first row, last row, file, whether the file begins there."""
    files = batch.column("file_path").to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist(), len(files)]
    for a, b in zip(edges, edges[1:]):
        yield a, b, files[a], a > 0 or files[a] != current


def _header_row(batch: pa.RecordBatch, at: int) -> list[str]:
    cells = [batch.column(f"c{i}")[at].as_py() for i in range(MAX_COLUMNS)]
    while cells and cells[-1] is None:
        cells.pop()
    return [(c or "").strip().removeprefix(_MARK).strip() for c in cells]


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current = None
    for batch in batches:
        found = {"file_path": [], "header": []}
        for a, _, name, begins in _headers_in(batch, current) if batch.num_rows else ():
            if begins:
                found["file_path"].append(name)
                found["header"].append(_header_row(batch, a))
            current = name
        yield pa.RecordBatch.from_pydict(found, pa.schema([("file_path", pa.string()), ("header", pa.list_(pa.string()))]))


def _rows_by_name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the cells of the expected columns, wherever a file has them; files without one give none."""
    current, places, seen = None, None, 0
    for batch in batches:
        for a, b, name, begins in _headers_in(batch, current) if batch.num_rows else ():
            if begins:
                header = _header_row(batch, a)
                places = [header.index(c) for c in EXPORT_COLUMNS] if set(EXPORT_COLUMNS) <= set(header) else None
                a, seen, current = a + 1, 0, name
            if places is None or a == b:
                continue
            part = batch.slice(a, b - a)
            rank = pa.array(np.arange(seen + 1, seen + 1 + len(part)), pa.int32())
            seen += len(part)
            cells = [part.column(f"c{i}") for i in places]
            yield pa.RecordBatch.from_arrays([*cells, part.column("file_path"), rank], [*EXPORT_COLUMNS, "file_path", "rank"])


def _cells(spark: SparkSession, path: str) -> DataFrame:
    """All rows of all files by position, header rows included; a file is read by one task."""
    raw = spark.read.schema(", ".join(f"c{i} STRING" for i in range(MAX_COLUMNS)))
    raw = raw.options(header=False, multiLine=True, escape='"', recursiveFileLookup=True, pathGlobFilter="*.csv").csv(path)
    return raw.select(*[f"c{i}" for i in range(MAX_COLUMNS)], F.col("_metadata.file_path").alias("file_path"))


def _named(rows: DataFrame, *columns: Column | str) -> DataFrame:
    return rows.select(*[column.alias(name) for name, column in _name_fields("file_path").items()], *columns)


def read_exports_by_name(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_exports`, with columns found by the names in each file's header row.

    Columns may stand in any order and between others.  Files that lack one are left out and listed
    by :func:`export_quarantine`.  The header travels with the task that reads the file: no join, no shuffle.
    """
    rows = _cells(spark, path).mapInArrow(_rows_by_name, f"{EXPORT_SCHEMA}, file_path STRING, rank INT")
    named = _named(rows, "rank", *[F.col(f"`{c}`") for c in EXPORT_COLUMNS])
    return named.where(F.col("geo").isNotNull() & F.col("fetched_at").isNotNull())


def export_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with a row: ``geo, hours, category, fetched_at, file_path, header, missing, extra``."""
    found = _cells(spark, path).mapInArrow(_first_rows, "file_path STRING, header ARRAY<STRING>")
    wanted = F.array(*[F.lit(c) for c in EXPORT_COLUMNS])
    return _named(
        found, "file_path", "header",
        F.array_except(wanted, "header").alias("missing"), F.array_except("header", wanted).alias("extra"),
    )


def export_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Files that :func:`read_exports_by_name` leaves out, with a ``reason``; files of no bytes are no rows to Spark."""
    missing = F.when(F.size("missing") > 0, F.concat(F.lit("no "), F.array_join("missing", ", ")))
    foreign = F.when(F.col("geo").isNull() | F.col("fetched_at").isNull(), F.lit("no export's name"))
    judged = export_headers(spark, path).withColumn("reason", F.concat_ws("; ", foreign, missing))
    return judged.where(F.col("reason") != "").select("geo", "hours", "category", "fetched_at", "file_path", "reason")
