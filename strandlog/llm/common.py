"""What the operators of this subpackage share: reading tables, the scratch folder, bounded broadcasts."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlog.sources.scratch import scratch_path

#: White space that separates words, as a Java and RE2 character class.
WHITE_CLASS = r"[\x20\x09-\x0D]"
#: Largest table, in rows, that an operator hands to every executor. Checked before, never assumed.
BROADCAST_ROWS = 100_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def exists(spark: SparkSession, sf_dir: str, table: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage at files that every executor sees, so a lost executor costs a reread and not
    a recomputation of all before. The files go when ``free`` is called, or else when the session's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def free(*tables: DataFrame) -> None:
    """Delete the files of materialized tables, of which all that is needed has been materialized in turn."""
    for t in tables:
        _delete(t.sparkSession, t._scratch)


def drop_table(spark: SparkSession, name: str, path: str) -> None:
    """The same for a table of the catalogue over files of its own."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _delete(spark, path)


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches as they are; before each, and at the end, a worker gives back to the system what it has freed.

    Workers are used again and again, and what their allocators keep would count against the executor.
    """
    for batch in batches:
        yield batch
        del batch
        trim()


def trim() -> None:
    """Give what the allocators of this process hold free back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if give_back:
            give_back(0)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 2 modulo 4; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_list(text: Column) -> Column:
    """The words of a text as an array; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_CLASS + "+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


#: Rows of one key that a join leaves to one task, however few rows there are in all.
HOT_ROWS = 1024


def hot_keys(counts: DataFrame, *keys: str, n: str = "n") -> DataFrame | None:
    """``keys`` of the rows of ``counts`` that count more rows than one task should join, or None.

    They are fewer than ``BROADCAST_ROWS`` whatever is counted, as each has more than that part of all rows.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    hot = counts.where(F.col(n) > max(HOT_ROWS, total // BROADCAST_ROWS)).select(*keys)
    return None if hot.isEmpty() else hot


def spread_join(rows: DataFrame, table: DataFrame, key: str | list[str], hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """``rows.join(table, key, how)`` where ``table`` has a row a key and ``hot`` the keys that many rows have.

    Rows of hot keys stay where they are and meet the few rows of ``table`` that they need; only the others are
    shuffled. ``hot`` is from ``hot_keys``, which bounds what is broadcast.
    """
    if hot is None:
        return rows.join(table, key, how)
    hot = F.broadcast(hot)
    apart = rows.join(hot, key, "left_semi").join(F.broadcast(table.join(hot, key, "left_semi")), key, how)
    return apart.unionByName(rows.join(hot, key, "left_anti").join(table, key, how))


#: Bits of the filter that ``narrow`` sends to every executor: 32 MB at most, whatever the tables.
FILTER_BITS = 1 << 28
_BUCKET = 1 << 15  # bits of one bitmap


def narrow(rows: DataFrame, members: DataFrame, col: str = "doc_id") -> DataFrame:
    """``rows`` without most of those whose id isn't in ``members``, decided where they are read.

    A bitmap of id hashes, eight bits a member, is broadcast, so a join that follows shuffles little but what it
    keeps. Some other rows pass: the join decides. With more members than the largest bitmap tells apart, all
    rows pass.
    """
    n = members.select(col).count()
    if 2 * n > FILTER_BITS:
        return rows
    size = min(FILTER_BITS, max(_BUCKET, 1 << (8 * n).bit_length()))

    def keyed(df: DataFrame) -> DataFrame:
        slot = F.pmod(F.xxhash64(F.col(col)), F.lit(size))
        return df.withColumn("_bucket", F.floor(slot / _BUCKET).cast("int")).withColumn("_bit", (slot % _BUCKET).cast("int"))

    bits = keyed(members.select(col)).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    passed = F.expr("shiftright(cast(conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int), _bit % 8) & 1 = 1")
    return keyed(rows).join(F.broadcast(bits), "_bucket").where(passed).select(*rows.columns)
