"""Run registered queries in Spark and DuckDB and compare schema and values."""

import datetime
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    body = sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)
    return names, body


def run_pair(spark, con, query, sql, sf_dir):
    started = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - started
    got = canonical(df.columns, rows)
    if sql is None:
        return None, got, None, took
    rel = con.execute(sql)
    want = canonical([d[0] for d in rel.description], rel.fetchall())
    return got == want, got, want, took


def main(names):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = "/root/testdata/sf0.01"
    spark, con = make_session(), duck(sf_dir)
    sqls = entry.oracle_sql()
    bad = []
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        try:
            same, got, want, took = run_pair(spark, con, query, sqls.get(name), sf_dir)
        except Exception as e:
            print(f"ERR  {name}: {str(e)[:600]}")
            bad.append(name)
            continue
        print(f"{'ok' if same else 'rows-only' if same is None else 'DIFF':9} {name} rows={len(got[1])} {took:.2f}s")
        if same is False:
            bad.append(name)
            if got[0] != want[0]:
                print("  columns", got[0], want[0])
            else:
                print("  rows", len(got[1]), len(want[1]))
                for a, b in list(zip(got[1], want[1])):
                    if a != b:
                        print("   spark", dict(zip(got[0], a)))
                        print("   duck ", dict(zip(got[0], b)))
                        break
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
