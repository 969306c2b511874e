"""Compare registered queries with their SQL twins: python tests/compare.py [folder] [name part]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder):
    db = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(value))
    if hasattr(value, "as_tuple"):
        return repr(float(value))
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, db, folder, name, function, sql):
    """None if equal, else a short report."""
    df = function(spark, folder)
    names, mine = normal(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    wanted_names, wanted = normal([d[0] for d in result.description], result.fetchall())
    if names != wanted_names:
        return f"columns {names} against {wanted_names}"
    if mine == wanted:
        return None
    extra, absent = sorted(set(mine) - set(wanted)), sorted(set(wanted) - set(mine))
    return f"{len(mine)} rows against {len(wanted)}; ours {extra[:3]}; theirs {absent[:3]}"


if __name__ == "__main__":
    from gaugeloom.plans.queries import ORACLES, QUERIES
    from gaugeloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    part = sys.argv[2] if len(sys.argv) > 2 else ""
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    db, bad = connect(folder), []
    for name, function in QUERIES.items():
        if part not in name:
            continue
        start = time.time()
        try:
            if name in ORACLES:
                report = differences(spark, db, folder, name, function, ORACLES[name])
            else:
                report = None if function(spark, folder).count() else "no rows"
        except Exception as error:
            report = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok ' if report is None else 'BAD'} {time.time() - start:6.2f}s {name} {report or ''}", flush=True)
        bad += [name] if report else []
    print(len(bad), "bad:", bad)
