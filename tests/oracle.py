"""Compare a registered query with its SQL on DuckDB: columns, types, and rows in any order."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def database(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(v)


def _table(arrow) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(arrow.column_names)
    kinds = [str(arrow.schema.field(n).type) for n in names]
    columns = [[_cell(v) for v in arrow.column(n).to_pylist()] for n in names]
    return names, kinds, sorted(zip(*columns)) if columns else []


def differences(con: duckdb.DuckDBPyConnection, sql: str, df: DataFrame) -> list[str]:
    want = con.sql(sql).to_arrow_table()
    wn, wk, wr = _table(want)
    gn, gk, gr = _table(df.toArrow())
    out = []
    if wn != gn:
        return [f"columns: expected {wn}, got {gn}"]
    out += [f"type of {n}: expected {a}, got {b}" for n, a, b in zip(wn, wk, gk) if a != b and {a, b} != {"string", "large_string"}]
    if len(wr) != len(gr):
        out.append(f"rows: expected {len(wr)}, got {len(gr)}")
    missing, extra = sorted(set(wr) - set(gr))[:3], sorted(set(gr) - set(wr))[:3]
    out += [f"expected only: {dict(zip(wn, r))}" for r in missing] + [f"got only: {dict(zip(wn, r))}" for r in extra]
    if wr != gr and not out:
        out.append("row multiplicities differ")
    return out


def main(names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry_points

    from voltframe import session

    sf = "/root/testdata/sf0.01"
    spark = session.build(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = database(sf), 0
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    for name in names or list(queries):
        began = time.time()
        try:
            df = queries[name](spark, sf)
            found = differences(con, oracles[name], df) if name in oracles else [] if df.count() else ["no rows"]
        except Exception as e:  # noqa: BLE001 - reported per query
            found = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {name:32} {time.time() - began:6.2f}s", *found, sep="\n       " if found else " ", flush=True)
    print(f"{bad} of {len(names or queries)} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(bool(main(sys.argv[1:])))
