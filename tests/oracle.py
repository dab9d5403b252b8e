"""Compare registered queries with their SQL in an in-process DuckDB."""

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return con


def plain(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, int):
        return f"{v}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, folder):
    df = query(spark, folder)
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    return mine, want


def main(folder, names):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from noticeloom.session import build_session

    spark = build_session("oracle", "local[8]", 8, zone="UTC")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name not in sqls:
                print(f"{name}: rows only {query(spark, folder).count()} {time.time() - start:.1f}s")
                continue
            (mc, mr), (wc, wr) = compare(spark, con, name, query, sqls[name], folder)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name}: ERROR {str(e)[:900]}")
            continue
        if mc != wc or mr != wr:
            bad += 1
            print(f"{name}: DIFF cols {mc == wc} {mc} {wc} rows {len(mr)} {len(wr)}")
            sm, sw = set(mr), set(wr)
            print("   mine", [r for r in mr if r not in sw][:2])
            print("   want", [r for r in wr if r not in sm][:2])
        else:
            print(f"{name}: ok {len(mr)} rows {time.time() - start:.1f}s")
    print("bad", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
