"""Compare registered queries with their SQL oracles in DuckDB.

``python tests/oracle.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].removesuffix("T00:00:00")
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        v = float(v)
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def kind(type_name):
    name = str(type_name).lower()
    for key, kinds in (
        ("int", ("bigint", "hugeint", "int", "integer", "smallint", "tinyint")),
        ("double", ("double", "float")),
        ("string", ("varchar", "string")),
    ):
        if name in kinds:
            return key
    return name.split("(")[0]


def compare(df, con, sql):
    """Problems as text, empty when both results agree."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want_kinds = {d[0]: kind(d[1]) for d in result.description}
    want = rows_of(want_columns, result.fetchall())
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}", len(want)
    got = rows_of(df.columns, df.collect())
    kinds = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    if got != want:
        diff = [(g, w) for g, w in zip(got, want, strict=False) if g != w]
        return f"{len(got)} vs {len(want)} rows, {len(diff)} differ, first {diff[:2]}", len(want)
    odd = {c: (kinds[c], want_kinds[c]) for c in kinds if kinds[c] != want_kinds[c]}
    return (f"types {odd}" if odd else ""), len(got)


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from shoptally.session import build_session

    sf = argv[0] if argv else "sf0.01"
    names = argv[1:] or list(queries())
    spark = build_session("oracle", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(DATA / sf)
    failures = 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, str(DATA / sf))
            sql = oracle_sql().get(name)
            problem, n = compare(df, con, sql) if sql else ("", df.count())
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", 0
        failures += bool(problem)
        kind_ = "oracle" if name in oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {kind_:6} {n:7} rows {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{len(names)} queries, {failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
