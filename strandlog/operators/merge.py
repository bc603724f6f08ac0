"""Last-writer-wins merge of change rows onto a replica, in closed form.

Change rows carry ``_op`` ('U' or 'D') and ``_seq``, the order of arrival. Replaying them one by one, with an
upsert taken only if its cursor is not older, ends in this state: for each key, of the upserts that arrived
after its last delete, the greatest by (cursor, arrival); none means absent. One aggregate computes it, with
partial aggregation before its only shuffle, so a key of many versions is reduced where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlog.operators.pull import quoted

UPSERT, DELETE = "U", "D"


def fold(log: DataFrame, key: str, cursor: str, ops: bool = True) -> DataFrame:
    """State of every key of a change log (the replica's columns, _op and _seq)."""
    rest = [c for c in log.columns if c not in ("_op", "_seq", key)]
    version = F.struct(quoted(cursor).alias("_c"), F.col("_seq"), *[quoted(c) for c in rest])
    if ops:
        # Deletes are rare: only keys that have one are looked at twice.
        cuts = log.where(F.col("_op") == DELETE).groupBy(quoted(key)).agg(F.max("_seq").alias("_cut"))
        log = log.where(F.col("_op") == UPSERT).join(cuts, key, "left").where(F.col("_cut").isNull() | (F.col("_seq") > F.col("_cut")))
    won = log.groupBy(quoted(key)).agg(F.max_by(version, F.struct(quoted(cursor), F.col("_seq"))).alias("_v"))
    order = [c for c in log.columns if c in (key, *rest)]
    return won.select(*[quoted(key) if c == key else F.col("_v")[c].alias(c) for c in order])


def as_upserts(rows: DataFrame, seq: Column | int) -> DataFrame:
    return rows.withColumn("_op", F.lit(UPSERT)).withColumn("_seq", F.lit(seq).cast("long") if isinstance(seq, int) else seq)


def as_deletes(keys: DataFrame, like: DataFrame, key: str, seq: int) -> DataFrame:
    """Tombstones with the replica's columns, NULL but for the key, which takes its stored type."""
    out = [quoted(key).cast(like.schema[key].dataType).alias(key) if c == key else F.lit(None).cast(like.schema[c].dataType).alias(c) for c in like.columns]
    return keys.select(*out).withColumn("_op", F.lit(DELETE)).withColumn("_seq", F.lit(seq).cast("long"))


def upsert(base: DataFrame, changes: list[DataFrame], key: str, cursor: str) -> DataFrame:
    """``base`` after batches of upserts in order of arrival; of equal cursors the later one wins."""
    log = as_upserts(base, 0)
    for k, batch in enumerate(changes, 1):
        log = log.unionByName(as_upserts(batch, k))
    return fold(log, key, cursor, ops=False)


def insert_if_absent(base: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return base.unionByName(rows.join(base.select(key), key, "left_anti").select(*base.columns))


def delete_keys(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``base`` without the keys, compared in the stored type."""
    return base.join(keys.select(quoted(key).cast(base.schema[key].dataType).alias(key)), key, "left_anti").select(*base.columns)


def split_purged(rows: DataFrame, tombstone: str) -> tuple[DataFrame, DataFrame]:
    """(live rows, deleted rows); a row without the column is live."""
    if tombstone not in rows.columns:
        return rows, rows.limit(0)
    return rows.where(quoted(tombstone).isNull()), rows.where(quoted(tombstone).isNotNull())
