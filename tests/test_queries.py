"""Every registered query gives the same rows as its SQL text in DuckDB."""

from pathlib import Path

import pytest
from compare import compare, connect

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, duck, name):
    result = compare(spark, duck, entry_points.queries()[name], entry_points.oracle_sql()[name], SF_DIR)
    assert result["ok"], result
    assert result["rows"] > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_feed_documents_read_the_ranked_lists(spark):
    from trendloom.plans import streams

    documents = streams._feed_documents(spark, "/root/testdata/sf0.001")
    assert documents.count() > 0
    assert all("/snapshots-" in name for name in documents.inputFiles())


def test_export_rows_become_text_where_they_are_written(spark):
    from trendloom.plans import exports

    d = "/root/testdata/sf0.001"
    filed = exports._filed(spark, d)
    moved = {f.name: f.dataType.simpleString() for f in filed.schema.fields if f.name != "file"}
    given = dict(spark.read.parquet(f"{d}/orders.parquet").dtypes)
    assert moved.items() <= given.items()
    rows = exports.rendered(filed).where("file like 'trends_ASIA%'").orderBy("file", "o_orderkey")
    names = rows.columns[2:]
    at = exports.export_folder(spark, d)
    for file in {r.file for r in rows.select("file").collect()}:
        parts = spark.read.options(header=True, escape='"', multiLine=True).csv(f"{at}/file={file}")
        assert len(parts.inputFiles()) == 1
        want = [tuple(r)[2:] for r in rows.where(rows.file == file).collect()]
        assert [tuple(r) for r in parts.select(*[f"`{n}`" for n in names]).collect()] == want
        break
