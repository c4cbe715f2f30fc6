"""File sinks.  ``mode`` is Spark's save mode; all of them write in parallel.

Texts repeat names and addresses in every row: plain they take several times the disk of the tables they come from, so
that large ones are best written with a ``compression`` (``gzip``), one reading task per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_ISO = "yyyy-MM-dd'T'HH:mm:ssXXX"


def write_csv(flat: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """Flat columns with a header, ISO times, quotes doubled inside cells."""
    flat.write.mode(mode).options(header=True, escape='"', timestampFormat=_ISO, compression=compression).csv(path)


def write_json(rows: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """One JSON object per line with ISO times; NULL fields are kept."""
    rows.write.mode(mode).options(timestampFormat=_ISO, ignoreNullFields=False, compression=compression).json(path)


def write_parquet(rows: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    """Parquet, by ``partition_by`` if given: then the rows of one folder meet first, so that files grow with
    the folders and not with folders times tasks; adaptive execution splits large folders."""
    writer = (rows.hint("rebalance", *partition_by) if partition_by else rows).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def as_records(rows: DataFrame) -> DataFrame:
    """One column ``record`` with a JSON object per row, NULL fields kept."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))
