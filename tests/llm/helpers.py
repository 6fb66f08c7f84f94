import os
import random

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no benchmark tables")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **columns):
    """Documents numbered from 0, with some texts."""
    rows = [
        (i, t, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["s"] * len(texts))[i], len(t or ""))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def sql_rows(sql, columns):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(columns)
    at = [names.index(c) for c in columns]
    return sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)


def exchanges(spark, make):
    """How many shuffles the plan of ``make()`` has if Spark broadcasts nothing."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = make()._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")
    finally:
        spark.conf.set(setting, before)
