"""Run registered queries beside their SQL in DuckDB and compare rows.

    python tests/oracle.py [--sf 0.01] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(directory: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{directory}/{t}.parquet')")
    return con


TIMES: list[float] = []


def kind(dtype: str) -> str:
    """Coarse type class: a difference in class would change the value hash."""
    d = dtype.lower()
    if d.startswith(("hugeint", "uhugeint")):
        return "hugeint"
    if any(x in d for x in ("int", "long", "short", "byte")):
        return "int"
    if any(x in d for x in ("double", "float", "real")):
        return "float"
    if d.startswith(("varchar", "string")):
        return "string"
    if d.startswith("bool"):
        return "bool"
    return d


def norm(value):
    if isinstance(value, float):
        return None if value != value else round(value, 9) + 0.0
    return value


def compare(spark_df, con, sql: str) -> tuple[list[str], int]:
    problems = []
    rel = con.sql(sql)
    want_types = {c: kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    got_types = {f.name: kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    if want_types != got_types:
        problems.append(f"schema: spark {got_types} / sql {want_types}")
    cols = sorted(set(want_types) & set(got_types))
    key = lambda r: tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in r)
    start = time.time()
    rows = spark_df.collect()
    TIMES.append(time.time() - start)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in rows), key=key)
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=key)
    if len(got) != len(want):
        problems.append(f"rows: spark {len(got)} / sql {len(want)}")
    if got != want:
        a, b = set(got), set(want)
        problems.append(f"values {cols}: only spark {len(a - b)} {sorted(a - b, key=key)[:3]} / only sql {len(b - a)} "
                        f"{sorted(b - a, key=key)[:3]}")
    return problems, len(got)


def main(argv: list[str]) -> int:
    from foliograph.catalog import load
    from foliograph.plans.session import local_session

    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    directory = f"/root/testdata/sf{sf}"
    queries, oracles = load()
    spark, con, failed = local_session("oracle"), connect(directory), 0
    for name in argv or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, directory)
            built = time.time() - start
            if name in oracles:
                problems, n = compare(df, con, oracles[name])
            else:
                problems, n = [], df.count()
        except Exception as error:  # noqa: BLE001
            problems, n = [f"{type(error).__name__}: {str(error)[:1500]}"], -1
        failed += bool(problems)
        state = "FAIL" if problems else ("ok" if name in oracles else "rows")
        spent = f"build {built:.1f}s run {TIMES[-1]:.1f}s" if TIMES and not problems else ""
        print(f"{state:4} {name} n={n} total {time.time() - start:.1f}s {spent}", flush=True)
        for p in problems:
            print("     ", p[:1800], flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
