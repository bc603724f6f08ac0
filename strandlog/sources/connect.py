"""Sources: Parquet folders and JDBC tables, opened lazily, and what a database's catalogue says of them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandlog.plans.status import Catalog
from strandlog.spec import TableSpec

#: The views of the catalogue that a preflight asks, as PostgreSQL names them.
COLUMNS = "SELECT column_name, data_type, is_nullable FROM information_schema.columns WHERE table_schema = '{schema}' AND table_name = '{table}'"
INDEXES = "SELECT indexdef FROM pg_indexes WHERE schemaname = '{schema}' AND tablename = '{table}'"
TRIGGERS = "SELECT CAST(count(*) AS VARCHAR(20)) AS n FROM information_schema.triggers WHERE event_object_schema = '{schema}' AND event_object_table = '{table}' AND action_timing = 'BEFORE' AND event_manipulation = 'UPDATE'"


def open_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Files are listed anew: a listing kept from an earlier run would hide newer rows."""
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)


def open_jdbc(spark: SparkSession, spec: TableSpec, url: str, options: dict[str, str] | None = None, partitions: int | None = None) -> DataFrame:
    """The source table over JDBC. Filters, columns and limits of a page are pushed into the query.

    With a numeric key and ``partitions``, the read is split by key range, whose bounds come from the table.
    """
    name = f'"{spec.schema}"."{spec.source_table}"'
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    if partitions and spec.primary_key_type in ("integer", "bigint"):
        ends = reader.option("query", f'SELECT min("{spec.primary_key}") AS lo, max("{spec.primary_key}") AS hi FROM {name}').load().collect()[0]
        if ends[0] is not None:  # by place: databases fold the names of unquoted columns
            reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
            reader = reader.options(partitionColumn=spec.primary_key, lowerBound=str(ends[0]), upperBound=str(ends[1]), numPartitions=str(partitions))
    return reader.option("dbtable", name).load()


def jdbc_query(spark: SparkSession, url: str, options: dict[str, str] | None = None) -> Callable[[str], DataFrame]:
    """A function that runs a query of the database."""
    return lambda sql: spark.read.format("jdbc").option("url", url).options(**(options or {})).option("query", sql).load()


def indexed_columns(definition: str) -> tuple[str, ...]:
    """The columns of an index definition, in order; a column that is only part of an expression is none."""
    inside = re.search(r"\((.*)\)", definition.split(" WHERE ")[0].split(" INCLUDE ")[0])
    names = [x.strip().split(" ")[0].strip('"') for x in (inside[1].split(",") if inside else [])]
    return tuple(n if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", n) else "" for n in names)


def read_catalog(query: Callable[[str], DataFrame], spec: TableSpec) -> Catalog:
    """Columns, indexes and update triggers of the source table: a few rows each, read from the catalogue's views.

    Names are identifiers (``validate_spec``), so they can stand in the query.
    """
    ask = lambda sql: query(sql.format(schema=spec.schema, table=spec.source_table)).collect()
    columns = {r[0]: (r[1], r[2] != "NO") for r in ask(COLUMNS)}
    triggers = ask(TRIGGERS)
    return Catalog(tuple(indexed_columns(r[0]) for r in ask(INDEXES)), bool(triggers) and int(triggers[0][0] or 0) > 0, columns)
