"""Line dedup: suffix order of line-ID sequences by distributed prefix doubling, in DataFrame operations only.

A text is the sequence of its lines that hold a word. Each line has an ID; the suffixes that start at each
line are ranked by prefix doubling: the rank of 2k lines comes from the pair of ranks of k lines here and k
lines further on. Ranks of pairs are dealt to *different pairs*, range-partitioned and numbered partition by
partition, so a line that a third of all texts share is one row there, not a hot task. Suffixes whose rank
is theirs alone leave the doubling: they share no longer prefix with any other, and their place in the
suffix array is settled. The doubling ends when all have left, after about log2(longest repeat) rounds.

The suffixes of one rank at depth d are a longest-common-prefix interval of d lines or more. From depth
``min_run`` on, every suffix of an interval but the first in (doc_id, line) order is a later copy and
spans d lines; the spans of all depths, merged, are the maximal repeated runs, and their lines are deleted.
The first copy of each run stays, and so do lines without a word.

Defined cases: null and empty texts have no lines and stay as they are (null becomes empty); a repeated
row or id is a further copy and is ordered by its text (equal ones by nothing that shows); a null id comes
last; a text of any length is cut into all its lines, and its list of runs is no longer than it; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlog.llm import common

MIN_RUN = 2


def _inked(text: Column) -> Column:
    """The lines of a text that hold a word, in order, as structs (at: line number in the text, line)."""
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    return F.filter(numbered, lambda s: F.length(F.translate(s["line"], " \t\n\u000b\f\r", "")) > 0)


def _lines(docs: DataFrame) -> DataFrame:
    """doc, pos (line number among lines with a word) and the line's ID, two hashes a and b."""
    every = docs.select("doc", F.posexplode(_inked(F.col("text"))).alias("pos", "s"))
    return every.select("doc", "pos", F.xxhash64("s.line").alias("a"), F.xxhash64(F.lit(1), F.reverse("s.line")).alias("b"))


def _ranked(pairs: DataFrame, name: str) -> DataFrame:
    """Different pairs a, b, with other columns -> the same with ``rank``, their place in (a, b) order.

    Sorted by range, numbered within each partition, and shifted by the sizes of the partitions before:
    a short list of counts, one for each partition.
    """
    pairs = common.materialize(pairs.repartitionByRange("a", "b").sortWithinPartitions("a", "b").withColumn("part", F.spark_partition_id()), name)
    counts = pairs.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    shift = counts.select("part", F.coalesce(F.sum("c").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("shift"))
    inside = F.row_number().over(W.partitionBy("part").orderBy("a", "b"))
    numbered = pairs.withColumn("k", inside).join(F.broadcast(shift), "part")
    return numbered.withColumn("rank", F.col("k") + F.col("shift")).drop("part", "k", "shift")


def suffix_levels(lines: DataFrame, min_run: int) -> Iterator[tuple[int, DataFrame]]:
    """(depth, table of doc, pos, rank, later) for depth ``min_run`` and each doubling of it.

    A table holds the suffixes that share their first ``depth`` lines with another; ranks are equal where
    these lines are, in the order of line IDs, and ``later`` marks all but the first of each rank. ``lines``
    has doc, pos and the line's ID as a and b. Ends when no two suffixes share that many lines.
    """
    have, here = 1, lines
    at, first = F.struct("doc", "pos"), F.min(F.struct("doc", "pos")).alias("first")
    while True:
        asked = have >= min_run
        distinct = here.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), *([first] if asked else [])).where("n > 1").drop("n")
        ranked = _ranked(distinct, f"line-ranks-{have}")
        # A hot pair is many rows on one side and one on the other; skewed joins are split at run time.
        level = here.join(ranked, ["a", "b"]).select("doc", "pos", "rank", *([(at != F.col("first")).alias("later")] if asked else []))
        level = common.materialize(level, f"line-suffixes-{have}")
        if level.isEmpty():
            return
        if asked:
            yield have, level
        step = have if asked else min(have, min_run - have)
        after = level.select("doc", (F.col("pos") - step).alias("pos"), F.col("rank").alias("b"))
        here = level.select("doc", "pos", F.col("rank").alias("a")).join(after, ["doc", "pos"])
        have += step


def repeated_runs(lines: DataFrame, min_run: int) -> DataFrame | None:
    """doc, lo, hi: the maximal runs of lines [lo, hi) of a text that later copies cover; None if there are none."""
    spans = None
    for depth, level in suffix_levels(lines, min_run):
        found = level.where("later").select("doc", F.col("pos").alias("lo"), (F.col("pos") + depth).alias("hi"))
        spans = found if spans is None else spans.unionByName(found)
    if spans is None:
        return None
    spans = spans.groupBy("doc", "lo").agg(F.max("hi").alias("hi"))
    order = W.partitionBy("doc").orderBy("lo")
    reach = F.max("hi").over(order.rowsBetween(W.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.when(F.col("lo") <= reach, 0).otherwise(1))
    spans = spans.withColumn("run", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return spans.groupBy("doc", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def dedup_lines(docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, n_runs, longest_run and the kept text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # A row's own number: rows are told apart even where ids repeat. Order of copies is that of (doc_id, line).
    ordered = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id())
    rows = common.materialize(rows.withColumn("doc", ordered), "line-docs")
    runs = repeated_runs(common.materialize(_lines(rows), "lines"), min_run)
    n_lines = F.size(_inked(F.col("text"))).cast("long").alias("n_lines")
    if runs is None:
        return rows.select("doc_id", n_lines, *(F.lit(0).cast("long").alias(c) for c in ("n_removed", "n_runs", "longest_run")), "text")
    n = F.col("hi") - F.col("lo")
    # The list has a run of one text each: no longer than the text that it is for.
    gone = runs.groupBy("doc").agg(F.sum(n).alias("n_removed"), F.count(F.lit(1)).alias("n_runs"), F.max(n).alias("longest_run"), F.collect_list(F.struct("lo", "hi")).alias("runs"))
    text = F.split("text", "\n")

    def without(places: Column) -> Column:
        lost = F.flatten(F.transform("runs", lambda r: F.slice(places, r["lo"] + 1, r["hi"] - r["lo"])))
        return F.array_join(common.let(text, lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), lost), lambda i: x[i])), "\n")

    kept = F.when(F.col("runs").isNull(), F.col("text")).otherwise(common.let(_inked(F.col("text"))["at"], without))
    return rows.join(gone, "doc", "left").select("doc_id", n_lines, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_removed", "n_runs", "longest_run")), kept.alias("text"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(common.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op9_line_dedup_from_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with runs from one line on: later copies of any line go, and of one-line documents."""
    out = dedup_lines(common.read(spark, sf_dir, "documents"), min_run=1)
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, ln, line, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS pos FROM
       (SELECT doc_id, unnest(range(0, len(x))) AS ln, unnest(x) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))
     WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, pos, line AS a, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM l),
k AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, pos) AS nth FROM w WHERE b IS NOT NULL),
c AS (SELECT DISTINCT doc_id, pos + s AS pos FROM k, (VALUES (0), (1)) AS v(s) WHERE nth > 1),
r AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM c),
g AS (SELECT doc_id, sum(n) AS n_removed, count(*) AS n_runs, max(n) AS longest_run FROM (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL) GROUP BY doc_id),
x AS (SELECT doc_id, unnest(range(0, len(x))) AS ln, unnest(x) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
t AS (SELECT x.doc_id, string_agg(line, chr(10) ORDER BY x.ln) AS kept FROM x LEFT JOIN (SELECT l.doc_id, l.ln FROM l JOIN c USING (doc_id, pos)) d USING (doc_id, ln) WHERE d.ln IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, CAST((SELECT count(*) FROM l WHERE l.doc_id = d.doc_id) AS BIGINT) AS n_lines,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(coalesce(longest_run, 0) AS BIGINT) AS longest_run,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN g USING (doc_id) LEFT JOIN t USING (doc_id)
"""

#: A line goes if an earlier one equals it.
ORACLE_SQL_FROM_ONE = r"""
WITH x AS (SELECT doc_id, unnest(range(0, len(x))) AS ln, unnest(x) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
l AS (SELECT doc_id, ln, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, ln) AS nth
      FROM x WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
r AS (SELECT doc_id, ln, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM l WHERE nth > 1),
g AS (SELECT doc_id, sum(n) AS n_removed, count(*) AS n_runs, max(n) AS longest_run FROM (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL) GROUP BY doc_id),
t AS (SELECT x.doc_id, string_agg(line, chr(10) ORDER BY x.ln) AS kept FROM x ANTI JOIN r USING (doc_id, ln) GROUP BY x.doc_id),
n AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs,
  CAST(coalesce(longest_run, 0) AS BIGINT) AS longest_run, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN g USING (doc_id) LEFT JOIN t USING (doc_id)
"""
