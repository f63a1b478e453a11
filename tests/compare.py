"""Run registered queries beside their SQL twins in an in-process DuckDB."""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 10))
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


FAMILY = {
    "bigint": "int", "int": "int", "integer": "int", "hugeint": "int", "smallint": "int",
    "double": "double", "float": "double", "string": "text", "varchar": "text",
    "boolean": "bool", "timestamp": "ts", "timestamp_ntz": "ts",
}


def difference(spark, con, sf_dir, query):
    """None when both sides agree, else a short description."""
    df = query.build(spark, sf_dir)
    rows = df.collect()
    if query.sql is None:
        return None if rows or not df.columns else "no rows"
    con.execute(query.sql)
    names = [d[0] for d in con.description]
    kinds = {d[0]: FAMILY.get(str(d[1]).lower(), str(d[1]).lower()) for d in con.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wide = {n: (k, kinds[n]) for n, k in df.dtypes if FAMILY.get(k, k) != kinds[n]}
    if wide:
        return f"types {wide}"
    huge = [d[0] for d in con.description if str(d[1]).lower() in ("hugeint",)]
    if huge:
        return f"hugeint {huge}"
    ours = rows_of(df.columns, rows)
    theirs = rows_of(names, con.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}; {ours[:2]} | {theirs[:2]}"
    if not ours:
        return "both empty"
    off = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(off)} of {len(ours)} rows differ, e.g. {off[0]}" if off else None


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    from distaff.plans.registry import QUERIES

    entry.queries()
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf)
    bad = 0
    for name, q in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem = difference(spark, con, sf, q)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {time.time()-start:6.2f}s {'' if q.sql else '(rows only) '}{name} {problem or ''}", flush=True)
    print("failed:", bad)
