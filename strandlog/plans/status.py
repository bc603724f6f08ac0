"""What operators look at: states with lag, parity of counts, and preflight checks."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlog.functions.encode import parse_timestamp
from strandlog.functions.scalars import lag_seconds, stuck
from strandlog.operators.pull import quoted
from strandlog.spec import TableSpec


def status_df(specs: DataFrame, states: DataFrame, now: Column) -> DataFrame:
    """Every registered table with its state, lag and whether its run is stuck; no state means never synced."""
    joined = specs.join(states, "table_key", "left")
    at = parse_timestamp(F.col("cursor_updated_at"))
    return joined.select(
        *specs.columns,
        *[c for c in states.columns if c != "table_key"],
        F.col("cursor_updated_at").isNull().alias("never_synced"),
        lag_seconds(now, at).alias("lag_seconds"),
        stuck(F.col("last_run_status"), parse_timestamp(F.col("last_run_started_at")), now).alias("stuck"),
    ).orderBy("table_key")


def spec_table(spark: SparkSession, registry: Iterable[TableSpec]) -> DataFrame:
    return spark.createDataFrame([(s.key, f"{s.schema}.{s.source_table}", s.target_table, s.reconcile_deletes) for s in registry], "table_key string, source string, target string, reconcile boolean")


def parity(source: DataFrame, replica: DataFrame, cursor: str) -> DataFrame:
    """Counts of both sides and the source's greatest change time, in one row."""
    left = source.agg(F.count(F.lit(1)).alias("source_rows"), F.max(quoted(cursor)).alias("source_hwm"))
    right = replica.agg(F.count(F.lit(1)).alias("replica_rows"))
    # Two aggregates without keys: one row each, whatever the tables.
    return left.crossJoin(right).withColumn("in_parity", F.col("source_rows") == F.col("replica_rows"))


@dataclass(frozen=True)
class Catalog:
    """What a database knows beyond a schema: indexes (their columns, in order), update triggers, and columns.

    ``columns``: name to (type, may be null); None where only the frame is asked.
    """

    indexes: tuple[tuple[str, ...], ...] = ()
    has_update_trigger: bool = False
    columns: dict[str, tuple[str, bool]] | None = None


def preflight(df: DataFrame | None, spec: TableSpec, catalog: Catalog | None = None, check_nulls: bool = False) -> list[str]:
    """Problems that would break or slow the replication of a table, in order of severity; none is fine.

    Index and trigger are only asked of a source that has a catalogue (``sources.connect.read_catalog``).
    """
    listed = catalog.columns if catalog else None
    if (df is None and listed is None) or listed == {}:
        return [f"table {spec.schema}.{spec.source_table} does not exist"]
    if listed is None:
        listed = {f.name: ("timestamp" if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else f.dataType.simpleString(), f.nullable) for f in df.schema.fields}
    out = []
    missing = [c.source for c in spec.columns if c.source not in listed]
    if missing:
        out.append(f"missing columns: {', '.join(missing)}")
    for what, name in (("primary key", spec.primary_key), ("cursor column", spec.cursor_column)):
        # Files don't promise NOT NULL, so there the rows are asked.
        if name in listed and listed[name][1] and (catalog is not None or (check_nulls and df.where(quoted(name).isNull()).limit(1).count())):
            out.append(f"{what} {name} is nullable")
    if spec.cursor_column in listed and not listed[spec.cursor_column][0].startswith("timestamp"):
        out.append(f"cursor column {spec.cursor_column} is {listed[spec.cursor_column][0]}, not a timestamp")
    fields = set(df.columns) if df is not None else set()
    if check_nulls and spec.primary_key in fields and df.groupBy(quoted(spec.primary_key)).count().where("count > 1").limit(1).count():
        out.append(f"primary key {spec.primary_key} is not unique")
    if catalog is not None:
        if (spec.cursor_column, spec.primary_key) not in [i[:2] for i in catalog.indexes]:
            out.append(f"no index on ({spec.cursor_column}, {spec.primary_key})")
        if not catalog.has_update_trigger:
            out.append(f"no BEFORE UPDATE trigger keeps {spec.cursor_column} up to date")
    return out


def budget_exhausted(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.bool_or(F.col("status") == "partial"), F.lit(False)).alias("budget_exhausted"))


def failed_tables(results: DataFrame) -> DataFrame:
    names = F.sort_array(F.collect_list(F.when(F.col("status") == "error", F.col("table_key"))))
    return results.agg(F.concat_ws(", ", names).alias("failed"))
