"""Run a query and its SQL over the same tables and compare the rows as multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as connection:
        for file in sorted(Path(sf_dir).glob("*.parquet")):
            connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
        cursor = connection.execute(sql)
        return [column[0] for column in cursor.description], cursor.fetchall()


def normalised(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark, builder, sql: str, sf_dir: str) -> str | None:
    """None if both give the same rows, else a short account of what differs."""
    df = builder(spark, sf_dir)
    columns, rows = normalised(df.columns, [tuple(row) for row in df.collect()])
    expected_columns, expected = normalised(*sql_rows(sql, sf_dir))
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if rows != expected:
        extra, missing = rows - expected, expected - rows
        return (
            f"{sum(rows.values())} rows against {sum(expected.values())}; "
            f"extra {list(extra)[:2]}, missing {list(missing)[:2]}"
        )
    return None


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as contract
    from civicmart.session import local_session

    spark = local_session(cpus=8)
    oracles = contract.oracle_sql()
    for name, builder in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = differences(spark, builder, oracles[name], sf_dir) or "same"
            else:
                verdict = f"{builder(spark, sf_dir).count()} rows, no SQL"
        except Exception as error:
            verdict = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:26s} {time.time() - start:6.2f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
