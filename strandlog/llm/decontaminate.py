"""Benchmark decontamination by seeds of two neighbouring tokens.

A token is a run of letters, marks and digits of any script, in lower case; in scripts that are written without
spaces (Han, kana, Thai, Lao, Khmer, Myanmar) every character is one. Pairs of neighbouring tokens of the texts that
equal a pair of a benchmark item give (text, item, diagonal) hits; the item is then laid along its diagonal over
the whole text and compared token by token. An overlap counts if it holds

* at least ``COVER`` of the item's tokens, and ``LEAST`` of them or all but one, or
* a stretch whose equal tokens outnumber the different ones by ``STRETCH``.

No overlap that counts is missed. Tokens replaced in b places leave a equal ones in at most b + 1 runs, and so
at least a - b - 1 equal pairs: ``sure`` of them in an overlap of the first kind, ``STRETCH`` - 1 in one of the
second. An item may therefore leave out its commonest pairs, one fewer than these.

Items of fewer than ``SHORTEST`` tokens, but ``EXACT_FROM``, are too short to differ in one: they are sought exactly, from
their first token to their last with what stands between, in any case.

The benchmark is the stated query set: it is read in order in blocks of ``BLOCK_TOKENS`` tokens, or one item where
that is longer, and each block meets all texts in one pass without a shuffle. Only hits are shuffled.

Defined cases: null and empty texts are clean; benchmark rows with a null id or text, or with fewer than
``EXACT_FROM`` tokens, are not searched for; repeated rows and ids each get a row, and rows with one id share what
any of them has; null ids are one id; ids of both tables keep their types; very long texts are searched whole, as a
block by themselves; an empty table of either kind gives a clean or empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strandlog.llm import common, kernels

SHORTEST, EXACT_FROM = 5, 2
COVER, LEAST, STRETCH = 0.6, 9, 12
BLOCK_TOKENS = 1_000_000

_FILTER_BITS = 20
HITS_AT_ONCE, COMPARED_AT_ONCE = 1 << 16, 1 << 20  # hits of a block of texts, and their tokens

#: All ASCII but letters and digits.
_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Blocks of scripts that are written without spaces.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x20000, 0x3FFFF),
)


@functools.cache
def _kinds() -> np.ndarray:
    """For each code point: 0 between tokens, 1 in a token, 2 a token by itself."""
    kind = np.fromiter((unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)), np.uint8, 0x110000)
    for a, b in UNSPACED:
        kind[a : b + 1] *= 2
    return kind


def _spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past byte of every token, and n + 1 offsets of each text's tokens."""
    if not len(data) or data.max() < 128:
        return kernels.words(data, offs, _BETWEEN)
    first = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(first) or first[0]:
        first = np.concatenate(([0], first))
    # Code points of up to four bytes; text that is no UTF-8 gets some code or other, the same on both sides.
    lead, pad = data[first].astype(np.int64), np.concatenate((data, np.zeros(3, np.uint8))).astype(np.int64)
    width = np.select([lead < 0xC0, lead < 0xE0, lead < 0xF0], [1, 2, 3], 4)
    code = np.where(width == 1, lead, lead & (0x7F >> width))
    for k in range(1, 4):
        code = np.where(width > k, code << 6 | pad[first + k] & 0x3F, code)
    kind = _kinds()[np.minimum(code, 0x10FFFF)]
    opens = np.isin(first, offs)
    joined = (kind[1:] == 1) & (kind[:-1] == 1) & ~opens[1:]
    starts = kind > 0
    starts[1:] &= ~joined
    stops = kind > 0
    stops[:-1] &= ~joined
    start, end = first[starts], np.append(first[1:], len(data))[stops]
    return start, end, np.searchsorted(start, offs)


@dataclass
class Tokens:
    """Tokens of a block of texts: hashes, n + 1 offsets of each text's, the first row, and where they stand."""

    h: np.ndarray
    offs: np.ndarray
    row: int
    start: np.ndarray
    end: np.ndarray
    prefix: np.ndarray

    def exact(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First tokens of the runs of so many tokens in a text, and hashes of all from their first byte to their last."""
        at = np.arange(max(len(self.h) - length + 1, 0))
        at = at[np.searchsorted(self.offs, at, "right") == np.searchsorted(self.offs, at + length - 1, "right")]
        return at, kernels.spans_hash(self.prefix, self.start[at], self.end[at + length - 1])


def tokens(col: pa.Array):
    """``Tokens`` of blocks of texts, which are in lower case."""
    data, offs = kernels.text_buffer(col)
    for a, b in kernels.blocks(offs):
        part, own = data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        start, end, wo = _spans(part, own)
        prefix = kernels.prefix_hash(part, lower=True)
        yield Tokens(kernels.spans_hash(prefix, start, end), wo, a, start, end, prefix)


def need(n: int) -> int:
    """Equal tokens from which an overlap with an item of n tokens counts."""
    return max(int(np.ceil(COVER * n - 1e-9)), min(LEAST, n - 1))


def sure(n: int) -> int:
    """Equal pairs in every overlap of ``need`` tokens, wherever the others stand."""
    return 2 * need(n) - n - 1


def seeds(h: np.ndarray) -> np.ndarray:
    """The seed of each token and the next."""
    return kernels.mix(h[:-1] * kernels.WORD_KEYS[0] + h[1:] * kernels.WORD_KEYS[1])


class Index:
    """Seeds of a block of benchmark items."""

    def __init__(self, ids: list[int], items: list[np.ndarray]):
        self.ids, self.items = ids, items
        self.size = np.array([len(h) for h in items])
        self.first = np.cumsum(self.size) - self.size
        self.need = np.array([need(n) for n in self.size])
        self.all = np.concatenate(items)
        pairs = [seeds(h) for h in items]
        _, code, n = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
        _, token, m = np.unique(self.all, return_inverse=True, return_counts=True)
        often, tokens_often = n[code], m[token]
        seed, item, at, done = [], [], [], 0
        for i, s in enumerate(pairs):
            of_token = tokens_often[self.first[i] : self.first[i] + len(s) + 1]
            # Commonest last, by pairs of the benchmark, then by the rarer token of the two.
            order = np.lexsort((np.minimum(of_token[:-1], of_token[1:]), often[done : done + len(s)]))
            kept = order[: len(s) - (min(sure(len(s) + 1), STRETCH - 1) - 1)]
            seed.append(s[kept])
            item.append(np.full(len(kept), i))
            at.append(kept)
            done += len(s)
        seed, item, at = (np.concatenate(x) for x in (seed, item, at))
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.at = seed[order], item[order], at[order]
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[seed >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, h: np.ndarray, wo: np.ndarray):
        """Arrays (text, item, diagonal) of the different hits in a block of texts, some at a time."""
        if len(h) < 2:
            return
        s = seeds(h)
        p = np.flatnonzero(self.seen[s >> np.uint64(64 - _FILTER_BITS)])
        lo, hi = np.searchsorted(self.seed, s[p], "left"), np.searchsorted(self.seed, s[p], "right")
        doc = np.searchsorted(wo, p, "right") - 1
        real = (hi > lo) & (p + 1 < wo[doc + 1])
        p, lo, hi, doc = (x[real] for x in (p, lo, hi, doc))
        total = np.cumsum(hi - lo)
        a = 0
        while a < len(p):
            b = max(a + 1, int(np.searchsorted(total, total[a] - (hi[a] - lo[a]) + HITS_AT_ONCE, "right")))
            n = hi[a:b] - lo[a:b]
            j = np.repeat(lo[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            text, item, diagonal = np.repeat(doc[a:b], n), self.item[j], np.repeat(p[a:b], n) - self.at[j]
            order = np.lexsort((diagonal, item, text))
            text, item, diagonal = text[order], item[order], diagonal[order]
            new = np.concatenate(([True], (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1])))
            yield text[new], item[new], diagonal[new]
            a = b

    def overlaps(self, h: np.ndarray, wo: np.ndarray):
        """(text, item, equal tokens) of the overlaps that count, some perhaps more than once."""
        for texts, items, diagonals in self.hits(h, wo):
            first, past = np.maximum(wo[texts], diagonals), np.minimum(wo[texts + 1], diagonals + self.size[items])
            total = np.cumsum(past - first)
            a = 0
            while a < len(texts):
                b = max(a + 1, int(np.searchsorted(total, total[a] - (past[a] - first[a]) + COMPARED_AT_ONCE, "right")))
                n = past[a:b] - first[a:b]
                start = np.cumsum(n) - n
                at = np.repeat(first[a:b] - start, n) + np.arange(n.sum())
                same = h[at] == self.all[at + np.repeat(self.first[items[a:b]] - diagonals[a:b], n)]
                equal = np.add.reduceat(same, start, dtype=np.int64)
                enough = equal >= self.need[items[a:b]]
                for k in np.flatnonzero(enough | (equal >= STRETCH)):
                    if enough[k] or self._stretch(same[start[k] : start[k] + n[k]]):
                        yield int(texts[a + k]), int(items[a + k]), int(equal[k])
                a = b

    @staticmethod
    def _stretch(same: np.ndarray) -> bool:
        run = np.concatenate(([0], np.cumsum(np.where(same, 1, -1))))
        return bool((run - np.minimum.accumulate(run)).max() >= STRETCH)


class Exact:
    """Short items of a block: by their number of tokens, hashes of all that they are, and whose they are."""

    def __init__(self, ids: list, lengths: list[int], hashes: list[int]):
        self.by = {}
        for n in sorted(set(lengths)):
            mine = [(h, i) for h, i, k in zip(hashes, ids, lengths, strict=True) if k == n]
            mine.sort(key=lambda x: x[0])
            self.by[n] = np.array([h for h, _ in mine], np.uint64), [i for _, i in mine]

    def overlaps(self, t: Tokens):
        """(text, item id, tokens) of the items found."""
        for n, (known, ids) in self.by.items():
            at, h = t.exact(n)
            lo, hi = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
            for k in np.flatnonzero(hi > lo):
                text = int(np.searchsorted(t.offs, at[k], "right")) - 1
                for j in range(int(lo[k]), int(hi[k])):
                    yield text, ids[j], n


def _lower(docs: DataFrame, *cols: str) -> DataFrame:
    return docs.select(*cols, F.lower("text").alias("text"))


def _hits(docs: DataFrame, block: tuple[Index | None, Exact], item_type: T.DataType) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)  # of one block: BLOCK_TOKENS bounds it
    schema = T.StructType([docs.schema["doc_id"], T.StructField("item_id", item_type), T.StructField("matched", T.IntegerType())])

    def run(batch: pa.RecordBatch):
        (ix, short), rows, items, equal = shared.value, [], [], []
        for t in tokens(batch.column(1)):
            for doc, item, n in ix.overlaps(t.h, t.offs) if ix else ():
                rows.append(t.row + doc)
                items.append(ix.ids[item])
                equal.append(n)
            for doc, item, n in short.overlaps(t):
                rows.append(t.row + doc)
                items.append(item)
                equal.append(n)
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(items, to_arrow_type(item_type)), pa.array(equal, pa.int32())], ["doc_id", "item_id", "matched"])

    out = common.materialize(common.map_arrow(_lower(docs, "doc_id"), run, schema), "benchmark-hits")
    shared.destroy()
    return out


def _blocks(benchmark: DataFrame):
    """(index, short items) of blocks of the benchmark of up to BLOCK_TOKENS tokens, or one longer item."""
    items = benchmark.where("item_id is not null and text is not null").select("item_id", F.col("text").cast("string").alias("text")).distinct()
    ids, hashes, held, few = [], [], 0, ([], [], [])

    def block():
        return (Index(ids, hashes) if ids else None), Exact(*few)

    # Read a partition at a time: neither the table nor a list of its items is gathered.
    for r in _lower(items, "item_id").orderBy("item_id", "text").toLocalIterator():
        (t,) = tokens(pa.array([r["text"]], pa.string()))
        n = len(t.h)
        if held and held + n > BLOCK_TOKENS:
            yield block()
            ids, hashes, held, few = [], [], 0, ([], [], [])
        if n >= SHORTEST:
            ids.append(r["item_id"])
            hashes.append(t.h.copy())
        elif n >= EXACT_FROM:
            for x, y in zip(few, (r["item_id"], n, int(t.exact(n)[1][0])), strict=True):
                x.append(y)
        held += n if n >= EXACT_FROM else 0
    if ids or few[0]:
        yield block()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, contaminated, n_items, item_ids, matched (most tokens) and kept."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    item_type = benchmark.schema["item_id"].dataType
    found = docs.sparkSession.createDataFrame([], T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("item_id", item_type), T.StructField("matched", T.IntegerType())]))
    for k, block in enumerate(_blocks(benchmark)):
        hits = _hits(docs, block, item_type)
        found = found.unionByName(hits) if k else hits
    by = found.groupBy(F.col("doc_id").alias("h_id")).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("matched").alias("matched"))
    flagged = F.col("item_ids").isNotNull()
    return docs.select("doc_id").join(by, F.col("doc_id").eqNullSafe(F.col("h_id")), "left").select(
        "doc_id",
        flagged.alias("contaminated"),
        F.when(flagged, F.size("item_ids")).otherwise(0).alias("n_items"),
        F.coalesce("item_ids", F.array().cast(T.ArrayType(item_type))).alias("item_ids"),
        F.coalesce("matched", F.lit(0)).alias("matched"),
        (~flagged).alias("kept"),
    )


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))
