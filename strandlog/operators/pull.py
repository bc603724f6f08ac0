"""Incremental scans: predicates, pages in cursor order, key pages, ranges and high-water marks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlog.spec import TableSpec

KEY_PAGE = 1000


@dataclass(frozen=True)
class Cursor:
    """Where a table's replication stands: the last row's (change time, key)."""

    updated_at: datetime
    pk: Any


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def after(first: Column, second: Column, x: Any, y: Any) -> Column:
    """(first, second) > (x, y) row by row, spelled so that scans can push it down.

    Comparing structs gives the same rows, but no filter reaches Parquet.
    """
    return (first >= x) & ((first > x) | ((first == x) & (second > y)))


def typed(df: DataFrame, column: str, value: Any) -> Column:
    """A literal of the column's own type: the constant is cast, never the column."""
    return F.lit(value).cast(df.schema[column].dataType)


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Exactly the registered source columns."""
    return df.select(*[quoted(c.source) for c in spec.columns])


def cutoff(df: DataFrame, spec: TableSpec, now: datetime | str) -> Column:
    """Rows at least the safety lag old. ``now`` is given, so every plan of a page sees the same rows."""
    lag = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(spec.safety_lag).cast("decimal(18,6)"))
    return quoted(spec.cursor_column) <= typed(df, spec.cursor_column, now) - lag


def changes(df: DataFrame, spec: TableSpec, cursor: Cursor | None, now: datetime | str, overlap_s: float = 0.0) -> DataFrame:
    """All rows after the cursor and up to the cutoff, projected, in no order: a page without an end.

    With ``overlap_s``, rows from so many seconds before the cursor on.
    """
    rows = df.where(cutoff(df, spec, now))
    if cursor is not None and overlap_s:
        back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(overlap_s).cast("decimal(18,6)"))
        rows = rows.where(quoted(spec.cursor_column) >= typed(df, spec.cursor_column, cursor.updated_at) - back)
    elif cursor is not None:
        x, y = typed(df, spec.cursor_column, cursor.updated_at), typed(df, spec.primary_key, cursor.pk)
        rows = rows.where(after(quoted(spec.cursor_column), quoted(spec.primary_key), x, y))
    return project(rows, spec)


def page(df: DataFrame, spec: TableSpec, cursor: Cursor | None, now: datetime | str, limit: int | None = None) -> DataFrame:
    """The first rows after the cursor, in (cursor, key) order."""
    order = (quoted(spec.cursor_column).asc_nulls_last(), quoted(spec.primary_key).asc_nulls_last())
    return changes(df, spec, cursor, now).orderBy(*order).limit(limit or spec.page_size)


def last_of(rows: DataFrame, cursor_column: str, primary_key: str) -> DataFrame:
    """updated_at and pk of the row that is last in cursor order, and the number of rows."""
    top = F.max(F.struct(quoted(cursor_column).alias("updated_at"), quoted(primary_key).alias("pk")))
    return rows.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).select("top.updated_at", "top.pk", "n")


def next_cursor(rows: DataFrame, spec: TableSpec, before: Cursor | None) -> tuple[Cursor | None, int]:
    """The cursor after these rows, which an empty page leaves as it was, and their number."""
    got = last_of(rows, spec.cursor_column, spec.primary_key).collect()[0]
    return (Cursor(got["updated_at"], got["pk"]) if got["n"] else before), got["n"]


def key_page(df: DataFrame, spec: TableSpec, after_pk: Any = None, limit: int = KEY_PAGE) -> DataFrame:
    """Keys in order, after one: text keys in byte order."""
    pk = quoted(spec.primary_key)
    rows = df.select(pk.alias("pk"))
    if after_pk is not None:
        rows = rows.where(F.col("pk") > typed(df, spec.primary_key, after_pk))
    return rows.orderBy(F.col("pk").asc_nulls_last()).limit(limit)


def key_range(keys: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    """Keys of (low, high]; None means without that end."""
    rows = keys
    if high is not None:
        rows = rows.where(quoted(column) <= typed(keys, column, high))
    if low is not None:
        rows = rows.where(quoted(column) > typed(keys, column, low))
    return rows.select(quoted(column).alias("pk"))


def high_water_mark(df: DataFrame, spec: TableSpec) -> DataFrame:
    """n as text, and the greatest change time."""
    return df.agg(F.count(F.lit(1)).cast("string").alias("n"), F.max(quoted(spec.cursor_column)).alias("hwm"))


def page_numbers(df: DataFrame, spec: TableSpec, folder: str, size: int | None = None) -> DataFrame:
    """pk and page of every row, the page that a walk in (cursor, key) order would find it in.

    Rows are dealt to ranges of that order and written once to ``folder``, a shared one; each range is numbered by
    itself and moved up by the sizes of the ranges before it, a list of one number for each range.
    """
    order = ["updated_at", "pk"]
    rows = df.select(quoted(spec.cursor_column).alias("updated_at"), quoted(spec.primary_key).alias("pk"))
    rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).write.parquet(folder)
    kept = df.sparkSession.read.parquet(folder)
    sizes = kept.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    shift = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    numbered = kept.withColumn("k", F.row_number().over(W.partitionBy("part").orderBy(*order)))
    return numbered.join(F.broadcast(shift), "part").select("pk", F.ceil((F.col("before") + F.col("k")) / (size or spec.page_size)).cast("long").alias("page"))


#: Columns that ``numbered`` adds; a table that has one of them can't be numbered.
NUMBERING = frozenset(("_part", "_place", "_n", "_before", "_row"))


def numbered(df: DataFrame, order: tuple[str, ...], folder: str) -> DataFrame:
    """``df`` with ``_row``, each row's place from 0 in that order.

    As in ``page_numbers``; a range is sorted as it is written, so the rows need no second sort.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within the range
    dealt = df.repartitionByRange(*map(quoted, order)).sortWithinPartitions(*map(quoted, order))
    dealt = dealt.withColumns({"_part": F.spark_partition_id(), "_place": place})
    dealt.write.parquet(folder)
    kept = df.sparkSession.read.schema(dealt.schema).parquet(folder)
    shift = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    shift = shift.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    rows = kept.join(F.broadcast(shift), "_part").withColumn("_row", F.col("_before") + F.col("_place"))
    return rows.select(*[quoted(c) for c in df.columns], "_row")
