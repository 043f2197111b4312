"""Scan of an operational store kept in one SQLite file.

``spark.read.format("sqlite").option("path", ...).option("table", ...)`` reads a
table in parallel: its row ids are cut into equal ranges, one partition each,
and every task opens the file for its own range, read only. Filters that
SQLite understands are pushed into the range's query (set
``spark.sql.python.filterPushdown.enabled``) and still checked by Spark; a
schema with some of the columns reads only those. The file must lie where all
executors see it; SQLite is a library inside the task, no server.

Options: ``partitions`` (default: one for each ``rowsPerPartition`` row ids,
100,000). A table without row ids (``WITHOUT ROWID``) cannot be cut and is
refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that a task hands on at a time.
CHUNK = 10_000
OPERATORS = {D.EqualTo: "=", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<="}


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _open(path: str):
    import sqlite3
    from urllib.parse import quote

    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


def _type(declared: str) -> T.DataType:
    """Type of a column by SQLite's rules of affinity."""
    d = declared.upper()
    if "INT" in d:
        return T.LongType()
    if any(x in d for x in ("CHAR", "CLOB", "TEXT")):
        return T.StringType()
    if not d or "BLOB" in d:
        return T.BinaryType()
    return T.DoubleType() if any(x in d for x in ("REAL", "FLOA", "DOUB")) else T.StringType()


def condition(f: D.Filter, types: dict[str, T.DataType]) -> tuple[str, list] | None:
    """A filter as SQL with its values; None if SQLite might judge otherwise."""
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in types:
        return None
    name, kind = quoted(f.attribute[0]), types[f.attribute[0]]
    fits = {T.LongType: int, T.DoubleType: float, T.StringType: str}.get(type(kind))
    if isinstance(f, D.IsNull | D.IsNotNull):
        return f"{name} IS {'NOT ' * isinstance(f, D.IsNotNull)}NULL", []
    values = list(f.value) if isinstance(f, D.In) else [getattr(f, "value", None)]
    if fits is None or not values or any(type(v) is not fits for v in values):
        return None
    if isinstance(f, D.In):
        return f"{name} IN ({', '.join('?' * len(values))})", values
    return (f"{name} {OPERATORS[type(f)]} ?", values) if type(f) in OPERATORS else None


class Range(D.InputPartition):
    """Row ids from ``lo`` to below ``hi``."""

    def __init__(self, lo: int, hi: int):
        super().__init__((lo, hi))
        self.lo, self.hi = lo, hi


class SqliteReader(D.DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.count = int(options.get("partitions", 0))
        self.per = int(options.get("rowsperpartition", options.get("rowsPerPartition", 100_000)))
        self.where: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[D.Filter]):
        types = {f.name: f.dataType for f in self.schema.fields}
        for f in filters:
            sql = condition(f, types)
            if sql:
                self.where.append(sql)
            yield f  # checked by Spark too

    def partitions(self) -> list[Range]:
        con = _open(self.path)
        try:
            lo, hi = con.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}").fetchone()
        finally:
            con.close()
        if lo is None:
            return [Range(0, 0)]
        n = self.count or -(-(hi - lo + 1) // self.per)
        step = -(-(hi - lo + 1) // n)
        return [Range(a, min(a + step, hi + 1)) for a in range(lo, hi + 1, step)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        names = ", ".join(quoted(f.name) for f in self.schema.fields) or "NULL"
        where = " AND ".join(["rowid >= ?", "rowid < ?", *(sql for sql, _ in self.where)])
        values = [partition.lo, partition.hi, *(v for _, own in self.where for v in own)]
        con = _open(self.path)
        try:
            cursor = con.execute(f"SELECT {names} FROM {quoted(self.table)} WHERE {where}", values)
            while rows := cursor.fetchmany(CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
        finally:
            con.close()


class SqliteSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> T.StructType:
        con = _open(self.options["path"])
        try:
            columns = con.execute(f"PRAGMA table_info({quoted(self.options['table'])})").fetchall()
        finally:
            con.close()
        if not columns:
            raise ValueError(f"no table {self.options['table']} in {self.options['path']}")
        return T.StructType([T.StructField(c[1], _type(c[2])) for c in columns])

    def reader(self, schema: T.StructType) -> SqliteReader:
        return SqliteReader(self.options, schema)


def register_sqlite(spark: SparkSession) -> None:
    """Make the format known to a session and let filters reach it."""
    from pyspark import cloudpickle
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def operational_orders(spark: SparkSession, path: str, table: str = "orders", limit: int | None = None, **options):
    """The operational store's table, or its newest ``limit`` orders by
    timestamp (order id breaks ties)."""
    from pyspark.sql import functions as F

    register_sqlite(spark)
    rows = spark.read.format("sqlite").options(path=path, table=table, **options).load()
    return rows if limit is None else rows.orderBy(F.col("order_timestamp").desc(), "order_id").limit(limit)
