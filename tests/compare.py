"""Run registered queries against their SQL counterparts in DuckDB.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def _canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, bool) or v is None or isinstance(v, str):
            return v
        if isinstance(v, float) or type(v).__name__ == "Decimal":
            number = float(v)
            return 0.0 if number == 0 or math.isnan(number) else number
        return v

    return [columns[i] for i in order], sorted(
        (tuple(value(row[i]) for i in order) for row in rows), key=_key
    )


def differences(spark, folder: str, name: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    import __spark_entry__ as e

    df = e.queries()[name](spark, folder)
    ours = _canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(e.oracle_sql()[name])
    theirs = _canonical([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} != {theirs[0]}"]
    if len(ours[1]) != len(theirs[1]):
        return [f"{len(ours[1])} rows != {len(theirs[1])}"]
    return [f"{a!r:.300}\n    {b!r:.300}" for a, b in zip(ours[1], theirs[1]) if a != b]


def main() -> None:
    import __spark_entry__ as e
    from gradeframe.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.oracle_sql())
    spark = build_session(
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        start = time.time()
        try:
            bad = differences(spark, folder, name, con)
        except Exception as error:  # noqa: BLE001
            bad = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{name}: {'same' if not bad else f'{len(bad)} differ'} ({time.time() - start:.1f} s)", flush=True)
        for line in bad[:3]:
            print("   ", line)


if __name__ == "__main__":
    main()
