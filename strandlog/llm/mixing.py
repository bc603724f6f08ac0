"""Mixing sources to target weights: Efraimidis-Spirakis sampling in DataFrame operations only.

Targets. The budget is shared among the sources by weight; a source never gets more than ``max_epochs``
times its size, and the excess is shared again by weight until none is above. That fixed point is
min(max_epochs * size, level * weight) with one level for all, found by one ordered pass over the table of
sources.

Selection. A source whose target is e whole epochs and a rest takes every document e times, then documents
in the order of their keys -ln(u) / w until their running sum of words meets the rest: u is uniform, from a
hash of the id and the seed, and w is the document's quality weight. The document at the end is taken if
that brings the source nearer to its target.

A source may hold most rows, so no window runs over a source. Rows are dealt to *cells*, ranges of (source, key) that
Spark cuts at measured quantiles, so they hold about as many rows each whatever the weights do to the keys;
the sizes of a source's cells are summed first, and only rows of one cell are ordered together.

Defined cases: a null source is a source of its own, last in order; a null or blank text has size 0 and is
taken only in whole epochs, none of which shows; repeated rows are separate documents; of rows of one id, or
without one, each has a key of its own, from its text; rows alike in both are told apart by their place only,
which doesn't show; ties go by id and size; texts of any length count whole; an empty table gives an empty
result; other columns of the input are ignored. Reruns agree: nothing random is drawn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlog.llm import common

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 42


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes``: source, source_size, n_docs, a row a source. Adds weight and target."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    # A table of sources, one row each: the aggregate that made it has shrunk the documents to it.
    ranked = sizes.withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), (F.row_number().over(order) - 1) % len(weights) + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn("fill", F.col("cap") / F.col("weight"))
    by_fill = W.orderBy("fill", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    from_here = by_fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.orderBy("fill").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = ranked.withColumn("budget", F.sum("source_size").over(everything) * F.lit(share)).withColumn(
        "level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    )
    # The first source that the level of it and those after it doesn't fill sets the level for all.
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level"))).over(everything)["level"]
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return levels.withColumn("target", target).select("source", "source_size", "n_docs", "weight", "target")


def cells(sized: DataFrame) -> DataFrame:
    """``sized`` (source, key, doc_id, size, tie) with ``cell``, a range of them in that order."""
    order = (F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size"), F.col("tie"))
    return sized.repartitionByRange(*order).withColumn("cell", F.spark_partition_id())


def quality_weight(text: Column) -> Column:
    """Weight of a document between 0.25 and 1: the share of its characters that are not symbols or capitals.

    A plain measure that needs no model; a table that has a better one passes its column to ``mix``.
    """
    text = F.coalesce(text, F.lit(""))
    n = F.length(text)
    odd = n - F.length(F.translate(text, "#*$%&|<>!ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return F.greatest(F.lit(0.25), F.lit(1.0) - F.lit(2.0) * odd / F.greatest(n, F.lit(1)))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, quality: Column | None = None, row_col: str | None = None, scores: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, epochs (times taken), taken (words).

    ``quality`` is the weight of each document; ``row_col`` names a column that is passed through as ``row``, and
    ``scores`` (row, score) has the weights by row instead, a table that the texts needn't meet.
    """
    at_least = lambda w: F.greatest(F.coalesce(w, F.lit(0.0)).cast("double"), F.lit(1e-6))
    weight = at_least(F.lit(1.0) if scores is not None else quality if quality is not None else quality_weight(F.col("text")))
    u = (F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text"), F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    sized = docs.select(
        "doc_id",
        "source",
        F.size(common.word_list(F.col("text"))).cast("long").alias("size"),
        (-F.log(u) / weight).alias("key"),
        F.monotonically_increasing_id().alias("tie"),
        *([F.col(row_col).alias("row")] if row_col else []),
    )
    if scores is not None:
        sized = sized.join(scores.select("row", "score"), "row", "left").withColumn("key", F.col("key") / at_least(F.col("score"))).drop("score")
    sized = common.materialize(sized, "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = source_targets(sizes, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(max_epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(F.lit(0))
    targets = targets.withColumn("whole", whole.cast("int")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = targets.withColumnRenamed("source", "t_source").drop("n_docs", "weight")
    few = targets.limit(common.BROADCAST_ROWS + 1).count() <= common.BROADCAST_ROWS
    rows = common.materialize(cells(sized), "mix-cells")

    # Sums of whole cells, a row for each cell and source in it, then of the rows of a cell.
    sums = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    earlier = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("c_source"), F.col("cell").alias("c_cell"), F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("cells_before"))
    small = sums.limit(common.BROADCAST_ROWS + 1).count() <= common.BROADCAST_ROWS
    inside = W.partitionBy("cell", "source").orderBy("key", "doc_id", "size", "tie").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("in_cell", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(F.broadcast(sums) if small else sums, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell")), "left")
    rows = rows.join(F.broadcast(targets) if few else targets, F.col("source").eqNullSafe(F.col("t_source")), "left")
    before = F.col("cells_before") + F.col("in_cell")
    more = (F.col("whole") < max_epochs) & (F.col("rest") > 0) & (before + F.col("size") / F.lit(2.0) <= F.col("rest"))
    epochs = F.col("whole") + F.when(more, F.lit(1)).otherwise(F.lit(0))
    return rows.select("doc_id", "source", "size", "source_size", "target", epochs.cast("int").alias("epochs"), (epochs * F.col("size")).cast("long").alias("taken"), *(["row"] if row_col else []))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(common.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "epochs")
