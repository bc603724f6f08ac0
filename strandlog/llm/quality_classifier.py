"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic calibration.

1. ``document_stats`` turns each whole text into a fixed vector of statistics (one pass over the texts,
   written once as a small table).
2. The labelled rows give mean and spread of each statistic, then, per partition, Z'Z and Z'y of the
   random Fourier features Z of a Gaussian kernel. The partial sums have a fixed size; they are added up in
   ``SUMMED_TOGETHER`` tasks, whose sums go to the driver, which solves the ridge system.
3. Raw scores of a part of the labelled rows that the ridge has not seen (``CALIBRATION_SHARE``) are counted
   into ``BINS`` bins; pool-adjacent-violators on the bins gives the calibration, interpolated between bins.
4. Every row is scored from its statistics.

Defined cases: a null text counts as empty and gets the score of an empty text; rows with a null label
or without a document are not learned from; a document labelled twice counts twice; without labels of
both kinds every score is the share of 1 among them, or 0.5; repeated rows get equal scores; null ids are
scored and never held out; texts of any length count whole, those of over a block by themselves; an empty table
of documents gives an empty result, and what is learned from it is a constant; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlog.llm import common, kernels

N_FEATURES = 192
GAMMA = 0.04
RIDGE = 1.0
THRESHOLD = 0.7
BINS = 512
CALIBRATION_SHARE = 4  # one labelled row in so many calibrates, the others fit
SUMMED_TOGETHER = 16  # partial sums of all partitions meet in so many tasks, and theirs on the driver
SEED = 7

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#*$%&<>@^~=+_\\",
    "pipe": b"|",
    "stop": b".",
    "comma": b",;:",
    "bang": b"!?",
    "bracket": b"()[]{}\"'",
    "line": b"\n",
    "space": b" \t\r\x0b\x0c",
}
STATS = (*_CLASSES, "high", "n_words", "word_bytes", "dup_words", "same_as_last", "long_words", "short_words", "dup_pairs", "dup_lines")


def _lut() -> np.ndarray:
    kind = np.full(256, 255, np.uint8)
    for k, chars in enumerate(_CLASSES.values()):
        kind[list(chars)] = k
    kind[128:192] = 255
    kind[192:] = len(_CLASSES)
    return kind


_KIND = _lut()


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """How many different values each text has."""
    if not len(h):
        return np.zeros(n)
    order = np.argsort(h ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    k, d = h[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=n).astype(float)


def document_stats(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of statistics for each text: logarithm of its length, then ratios."""
    n = len(offs) - 1
    doc_of = lambda at: np.searchsorted(offs, at, "right") - 1
    out = np.zeros((n, len(STATS)))
    kind = _KIND[data]
    for k in range(len(_CLASSES) + 1):
        c = np.concatenate(([0], np.cumsum(kind == k, dtype=np.int32)))
        out[:, k] = c[offs[1:]] - c[offs[:-1]]
    start, end, wo = kernels.words(data, offs)
    count = np.diff(wo).astype(float)
    h = kernels.spans_hash(kernels.prefix_hash(data), start, end)
    doc = np.repeat(np.arange(n), np.diff(wo))
    size = end - start
    total = lambda x: np.bincount(doc, weights=x, minlength=n)
    inside = np.zeros(len(h), bool)
    inside[1:] = doc[1:] == doc[:-1]
    same = inside.copy()
    same[1:] &= h[1:] == h[:-1]
    pair, po = kernels.windows(h, wo, 2)
    pair_doc = np.repeat(np.arange(n), np.diff(po))
    # lines: the hash between two line feeds, of lines that hold a word
    feeds = np.flatnonzero(data == 10)
    edge = np.unique(np.concatenate((offs[:-1], feeds + 1, offs[-1:]))) if len(data) else np.zeros(1, np.int64)
    a, b = edge[:-1], edge[1:]
    inked = np.searchsorted(start, b) > np.searchsorted(start, a) if len(a) else np.zeros(0, bool)
    a, b = a[inked], b[inked]
    b = b - (data[b - 1] == 10) if len(b) else b
    c = kernels.prefix_hash(data)
    line_doc = doc_of(a)
    lines = np.bincount(line_doc, minlength=n).astype(float)
    # Ratios are shrunk, so that a text of a few words isn't judged by the chance of a few characters.
    out[:, : len(_CLASSES) + 1] /= np.diff(offs)[:, None] + 60.0
    w = count + 10.0
    rest = [
        np.log1p(count),
        np.minimum((total(size) + 60.0) / w, 40) / 10,
        (count - _distinct(h, doc, n)) / w,
        total(same) / w,
        total(size > 16) / w,
        total(size < 4) / w,
        (np.diff(po) - _distinct(pair, pair_doc, n)) / w,
        (lines - _distinct(kernels.spans_hash(c, a, b), line_doc, n)) / (lines + 3.0),
    ]
    out[:, len(_CLASSES) + 1 :] = np.stack(rest, 1)
    return out


def stats_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out and the statistics of each row's text."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), T.StructField("stats", T.BinaryType())])

    def run(batch: pa.RecordBatch):
        data, offs = kernels.text_buffer(batch.column(2))
        rows = []
        for a, b in kernels.blocks(offs):
            x = document_stats(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]).astype("<f4")
            rows += [r.tobytes() for r in x]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["doc_id", "held_out", "stats"])

    picked = docs.select(F.col(id_col).alias("doc_id"), common.held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return common.map_arrow(picked, run, schema)


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<f4").reshape(len(col), -1).astype(float)


@dataclass
class Model:
    """A fitted classifier: a few arrays of fixed size, whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray
    constant: float | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        rff = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / N_FEATURES)
        return np.concatenate([rff, np.ones((len(x), 1))], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return np.interp(self.raw(x), self.edges, self.levels)


def isotonic(centre: np.ndarray, ones: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins with counts: (centres, non-decreasing shares)."""
    pool: list[list[float]] = []
    for x, a, n in zip(centre, ones, total, strict=True):
        if n:
            pool.append([x * n, a, n, 1])
            while len(pool) > 1 and pool[-2][1] * pool[-1][2] >= pool[-1][1] * pool[-2][2]:
                last = pool.pop()
                pool[-1] = [p + q for p, q in zip(pool[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pool]), np.array([p[1] / p[2] for p in pool])


def _summed(rows: DataFrame, fn, size: int) -> np.ndarray:
    """Sum over rows of ``fn(stats matrix, labels)``, a vector of ``size`` numbers, by partition and then here."""

    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += fn(_matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sum"])

    def add(batches):
        total = np.zeros(size)
        for b in batches:
            for x in b.column(0).to_pylist():
                total += np.frombuffer(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sum"])

    each = rows.select("stats", "quality").mapInArrow(run, "sum binary")
    parts = each.repartition(SUMMED_TOGETHER).mapInArrow(add, "sum binary").collect()  # so many rows of a fixed size
    return np.sum([np.frombuffer(p["sum"]) for p in parts], 0) if parts else np.zeros(size)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows of ``stats`` that are not held out."""
    known = labels.select(F.col("doc_id"), F.col("quality")).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    train = stats.where(~F.col("held_out")).join(known, "doc_id").select("doc_id", "stats", "quality")
    train = common.materialize(train, "quality-train")
    d = len(STATS)
    sums = _summed(train, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * d)
    n, ones = sums[:2]
    mean = sums[2 : 2 + d] / max(n, 1)
    spread = np.sqrt(np.maximum(sums[2 + d :] / max(n, 1) - mean**2, 0))
    rng = np.random.Generator(np.random.PCG64(SEED))
    model = Model(mean, np.where(spread > 1e-6, spread, 1.0), rng.normal(0, np.sqrt(2 * GAMMA), (d, N_FEATURES)), rng.uniform(0, 2 * np.pi, N_FEATURES), np.zeros(N_FEATURES + 1), np.array([0.0]), np.array([0.5]))
    if not 0 < ones < n:
        model.constant = ones / n if n else 0.5
        return model

    k = N_FEATURES + 1
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION_SHARE)) == 0

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _summed(train.where(~mark), normal, k * k + k)
    gram, right = sums[: k * k].reshape(k, k), sums[k * k :]
    ridge = np.eye(k) * RIDGE
    ridge[-1, -1] = 1e-6
    model.weights = np.linalg.solve(gram + ridge, right)

    width = 2.0 / BINS

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        r = model.raw(x)
        at = np.clip(((r + 0.5) / width).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, w, BINS) for w in (y, np.ones(len(y)), r)])

    a, total, r = _summed(train.where(mark), binned, 3 * BINS).reshape(3, BINS)
    if not 0 < a.sum() < total.sum():  # too few rows to keep some for calibration alone
        a, total, r = _summed(train, binned, 3 * BINS).reshape(3, BINS)
    model.edges, model.levels = isotonic(r / np.maximum(total, 1), a, total)
    return model


def fit_documents(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents, reading the statistics of no others."""
    known = docs.join(labels.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    return fit(stats_table(known), labels)


def score(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``stats``."""
    kind = stats.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batch: pa.RecordBatch):
        s = np.clip(model.score(_matrix(batch.column(2))), 0.0, 1.0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return common.map_arrow(stats.select("doc_id", "held_out", "stats"), run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled documents and score all: one row per input row."""
    stats = common.materialize(stats_table(docs), "quality-stats")
    return score(stats, fit(stats, labels))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
