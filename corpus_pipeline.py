"""The corpus pipeline: documents to packed token rows in five stages, each an operator of its own.

Every stage is a function of (spark, docs, sf_dir). ``run`` writes each stage's rows as Parquet in the shared
folder and reads them back as the next one's documents. All but the last return the columns of documents.

Stages decide on rows, not on ids: a row is known by its id and two hashes of its text, or by a number of its own,
and travels as one struct, so that other columns may have any name.

The quality stage leaves its scores by row in the shared folder, and the mixing stage takes its weights from there, so
the classifier is learned once and mixing is DataFrame operations only. The table is named by the session and by the
files of documents and labels. Where it is missing or lacks a row, as when mixing runs by itself, mixing learns.

Defined cases: rows with a null id or text are judged as any other by the quality, decontamination and mixing
stages; near-duplicates keeps rows with a null id, as its operator does; of rows given twice, near-duplicates keeps
one; where ids repeat, each text is judged for itself; ties are settled by the operators; texts of any length are
taken whole; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlog.llm import common, decontaminate, mixing, near_dedup, packing, quality_classifier
from strandlog.sources.scratch import scratch_dir

#: Per cent of shared shingles from which the stage drops a copy; the contract of op10's own query is higher.
NEAR = 80


def _rows(docs: DataFrame) -> DataFrame:
    """Each row as the struct ``doc``, with its ``key``: the id and two hashes of the text."""
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    key = F.struct("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.reverse("text")).alias("b"))
    return docs.select(F.struct(*quoted).alias("doc"), key.alias("key"))


def _documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` again, with its columns."""
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def _without(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose key, null ids too, isn't among the ids of ``rejected``."""
    keys = rejected.select(F.col("doc_id").alias("rejected")).distinct()
    return rows.join(keys, rows["key"] == keys["rejected"], "left_anti")


def _files(spark: SparkSession, sf_dir: str, table: str) -> list[str]:
    """Name, size and time of each file of a table; nothing where there is none."""
    if not common.exists(spark, sf_dir, table):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(path))


def _scores_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the quality stage leaves its scores: another path for another session or other files."""
    told = [spark.sparkContext.applicationId, sf_dir, *_files(spark, sf_dir, "documents"), *_files(spark, sf_dir, "labels")]
    return f"{scratch_dir(spark)}/strandlog/scores-{hashlib.sha256(chr(10).join(told).encode()).hexdigest()}"


def _fs_of(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier predicts to be good."""
    rows = _rows(docs)
    stats = common.materialize(quality_classifier.stats_table(rows, id_col="key", text_col="doc.text"), "quality-stats")
    own = F.col("doc_id.doc_id")
    model = quality_classifier.fit(stats.select(own.alias("doc_id"), common.held_out(own).alias("held_out"), "stats"), common.read(spark, sf_dir, "labels"))
    path = _scores_path(spark, sf_dir)
    fs, hadoop = _fs_of(spark, path)
    scores = quality_classifier.score(stats, model).select("doc_id", "score", "predicted")
    scores.write.mode("overwrite").parquet(path)
    fs.deleteOnExit(hadoop)
    scores = spark.read.schema(scores.schema).parquet(path)
    return _documents(_without(rows, scores.where("predicted = 0")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near copies: the one of smallest id, in one row.

    Rows are compared by a number of their own, so texts that share an id are judged each for itself.
    Rows with a null id stay, as in the operator.
    """
    rows = common.materialize(_rows(docs).drop("key").withColumn("row", F.monotonically_increasing_id()), "near-rows")
    judged = near_dedup.near_duplicates(rows.where("doc.doc_id is not null"), NEAR, id_col="row", text_col="doc.text").select(F.col("doc_id").alias("row"), "component_id")
    first = judged.join(rows.select("row", "doc.doc_id"), "row").groupBy("component_id").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    kept = first.select("first.row").unionByName(rows.where("doc.doc_id is null").select("row"))
    return _documents(rows.join(kept, "row", "left_semi"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    rows = _rows(docs)
    judged = decontaminate.contamination(rows, common.read(spark, sf_dir, "benchmark"), id_col="key", text_col="doc.text")
    return _documents(_without(rows, judged.where("contaminated")), docs)


def _scores(spark: SparkSession, rows: DataFrame, docs: DataFrame, sf_dir: str) -> DataFrame:
    """row and score of all ``rows`` (row, key, doc): those the quality stage has left, else learned anew.

    Learned from the labelled ones of the table of documents, which has the rejected ones too; without such a
    table, from those at hand.
    """
    path = _scores_path(spark, sf_dir)
    fs, hadoop = _fs_of(spark, path)
    kind = rows.schema["key"].dataType
    if fs.exists(hadoop):
        left = spark.read.parquet(path)
        if left.schema["doc_id"].dataType.simpleString() == kind.simpleString():
            left = left.groupBy(F.col("doc_id").alias("of")).agg(F.max("score").alias("score"))  # equal rows have equal scores
            found = common.materialize(rows.select("row", "key").join(left, F.col("key") == F.col("of"), "left").select("row", "score"), "mix-scores")
            if found.where("score is null").isEmpty():
                return found
    every = common.read(spark, sf_dir, "documents") if common.exists(spark, sf_dir, "documents") else docs
    model = quality_classifier.fit_documents(every.select("doc_id", "text"), common.read(spark, sf_dir, "labels"))
    scores = quality_classifier.score(quality_classifier.stats_table(rows, id_col="row", text_col="doc.text"), model)
    return common.materialize(scores.select(F.col("doc_id").alias("row"), "score"), "mix-scores")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix takes it, better ones first: the classifier's score is the weight."""
    rows = common.materialize(_rows(docs).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    scores = _scores(spark, rows, docs, sf_dir)
    taken = mixing.mix(rows.select("doc.doc_id", "doc.text", "doc.source", "row"), row_col="row", scores=scores).where("epochs > 0").select("row", "epochs")
    copies = rows.join(taken, "row").select("doc", F.explode(F.sequence(F.lit(1), F.col("epochs"))))
    return _documents(copies, docs)


def token_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
    ("token-ID output", token_rows),
]

#: Trained scores, sketches and a tokenizer are not expressible in SQL; the tests run a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
