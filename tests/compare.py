"""Run registered queries against their SQL texts in DuckDB."""

from __future__ import annotations

import math
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(rows, order):
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, fn, sql: str, sf_dir: str) -> dict:
    started = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = result.fetchall()
    out = {"rows": len(got), "want": len(want), "sec": round(seconds, 2), "types": dict(df.dtypes)}
    if sorted(names) != sorted(df.columns):
        return {**out, "ok": False, "why": f"columns {df.columns} vs {names}"}
    order = sorted(names)
    a = _rows(got, [df.columns.index(n) for n in order])
    b = _rows(want, [names.index(n) for n in order])
    if a != b:
        first = next(((x, y) for x, y in zip(a, b) if x != y), (a[len(b):][:1], b[len(a):][:1]))
        return {**out, "ok": False, "why": f"{order}\n   spark {first[0]}\n   sql   {first[1]}"}
    return {**out, "ok": True}


if __name__ == "__main__":
    import sys

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry_points
    from pyspark.sql import SparkSession

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    texts = entry_points.oracle_sql()
    for name, fn in entry_points.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            if name in texts:
                r = compare(session, con, fn, texts[name], sf)
            else:
                t = time.time()
                r = {"ok": True, "rows": fn(session, sf).count(), "sec": round(time.time() - t, 2), "want": "-"}
        except Exception as e:  # report and go on with the next query
            r = {"ok": False, "why": f"{type(e).__name__}: {str(e)[:700]}"}
        print(f"{'ok ' if r['ok'] else 'BAD'} {name:28} {r.get('rows')}/{r.get('want')} {r.get('sec')}s {r.get('why', '')}", flush=True)
