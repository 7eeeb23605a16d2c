"""Row sets of a Spark query and of SQL over the same parquet tables, made comparable."""

import glob
import math
import os
from collections import Counter

import duckdb


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return _counted(names, cursor.fetchall())


def spark_rows(frame) -> tuple[list[str], Counter]:
    return _counted(frame.columns, [tuple(row) for row in frame.collect()])


def _counted(names: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(_value(row[i]) for i in order) for row in rows)


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value
