"""Run registered queries and their SQL side by side: ``python tests/check_oracles.py SF_DIR [name ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def compare(spark, con, name, run, sql, sf_dir):
    start = time.time()
    got = run(spark, sf_dir).toPandas()
    took = time.time() - start
    if sql is None:
        return f"rows only: {len(got)} rows", took, len(got) > 0
    start = time.time()
    want = con.execute(sql).fetch_df()
    sql_took = time.time() - start
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}", took, False
    columns = sorted(got.columns)
    kinds = [f"{c}:{got[c].dtype}/{want[c].dtype}" for c in columns if str(got[c].dtype) != str(want[c].dtype)]
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}", took, False
    a = got[columns].sort_values(columns).reset_index(drop=True)
    b = want[columns].sort_values(columns).reset_index(drop=True)
    bad = [c for c in columns if not (a[c].astype(str) == b[c].astype(str)).all()]
    if bad:
        where = (a[bad[0]].astype(str) != b[bad[0]].astype(str))
        return f"{where.sum()} of {len(a)} differ in {bad}: {a[where].head(2).to_dict('records')} / {b[where].head(2).to_dict('records')}", took, False
    return f"equal, {len(a)} rows, sql {sql_took:.1f}s" + (f"; types {kinds}" if kinds else ""), took, not kinds


def main():
    import duckdb
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    sqls, failed = entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            text, took, ok = compare(spark, con, name, run, sqls.get(name), sf_dir)
        except Exception as e:
            text, took, ok = f"{type(e).__name__}: {str(e)[:1500]}", 0.0, False
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} {took:.1f}s {text}", flush=True)
    print(f"{len(failed)} failed: {failed}; without SQL: {sorted(set(entry.queries()) - set(sqls))}; stray SQL: {sorted(set(sqls) - set(entry.queries()))}")


if __name__ == "__main__":
    main()
