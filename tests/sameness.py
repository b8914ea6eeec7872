"""Comparison of a Spark result with DuckDB's over the same tables."""

from pathlib import Path

import duckdb

SF = Path("/root/testdata/sf0.001")


def connection(folder: Path = SF):
    con = duckdb.connect()
    for path in sorted(folder.glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(table) -> list[str]:
    names = sorted(table.column_names)
    cell = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted("\t".join(map(cell, row)) for row in zip(*(table.column(n).to_pylist() for n in names)))


def same(df, sql: str, con) -> None:
    got, want = df.toArrow(), con.execute(sql).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    a, b = _rows(got), _rows(want)
    assert len(a) == len(b), (len(a), len(b), a[:2], b[:2])
    assert a == b, [(x, y) for x, y in zip(a, b) if x != y][:3]
