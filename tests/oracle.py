"""Runs registered queries and their SQL on the same tables and compares the rows.

    python tests/oracle.py [folder] [name ...]
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, int):
        return v
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def kinds(types):
    """Type by column, in DuckDB's names."""
    spark = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "string": "VARCHAR",
             "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BLOB"}
    return {c: spark.get(t, t) for c, t in types}


def compare(spark, con, folder, name, run, sql):
    """None if equal, else what differs."""
    df = run(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, {len(want)} expected"
    types, wanted = kinds(df.dtypes), {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    if types != wanted:
        return f"types {[(c, types[c], wanted[c]) for c in types if types[c] != wanted[c]]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ: {sorted(df.columns)} {bad[:3]}" if bad else None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("foretell")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    import __spark_entry__ as e

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark, con, sqls = session(), connect(folder), e.oracle_sql()
    failed = []
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, e.queries()[name], sqls.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok':4} {name:26} {time.time() - start:6.2f}s "
              f"{'' if name in sqls else '(rows only)'} {problem or ''}", flush=True)
    print(f"{len(names) - len(failed)}/{len(names)} ok", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
