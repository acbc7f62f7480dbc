"""Compare a query's rows with its SQL twin's."""

import datetime
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck(folder):
    db = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(shaped, key=repr)


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def spark_rows(df):
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(db, text):
    result = db.execute(text)
    return canonical([column[0] for column in result.description], result.fetchall())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan AQE arrived at when the frame was collected."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]
