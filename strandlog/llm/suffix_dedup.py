"""Exact substring dedup: suffix order by difference cover, built one bucket of suffixes at a time.

A byte is removed if it lies in a string of ``DEPTH`` bytes that also starts in a document of smaller id. Only
suffixes that may share so many bytes are sorted:

1. Equal texts are one class, told by a 128-bit fingerprint; only the class's smallest id goes on. Its texts are
   packed into *batches* of about ``BATCH_BYTES``, written once as a table bucketed by batch number: what later
   steps find out about a batch joins it there, and texts are never shuffled.
2. Every window of ``DEPTH`` bytes names its anchor: the ``GRAM``-byte gram of least hash in it. Equal windows
   have equal anchors at equal distance, so windows are told apart by anchor first. Hashes of anchors are
   dealt to suffix buckets, each batch sending a hash once; each batch gets back a bit for each of its hashes:
   whether another batch has it, or the batch itself more than once.
3. The stretch of text that an anchor's windows cover is its *context*. Contexts of marked anchors, each once
   a batch, are dealt to suffix buckets by anchor. A bucket is one suffix bucket of the construction: its
   different contexts are laid into blocks, a difference-cover sample of a block's suffixes is ranked by prefix
   doubling, windows are sorted by their first ``PERIOD`` bytes, in parts of bounded size, and longer ties are
   resolved by cover ranks: of two suffixes, those at the shift that leads both into the cover. Neighbours that
   share ``DEPTH`` bytes form intervals; each window gets the smallest id of its interval.
4. Each batch learns the smallest ids of its contexts and cuts the bytes of windows that a smaller id has.

Steps 2 to 4 each read the batches once. Suffix buckets stand for about ``BUCKET_BYTES`` of text each and are worked off
one by one by a number of tasks that the session sets; the rows between them are sorted by Spark, which spills.
Nothing is broadcast or gathered by passage or document: a passage that a third of all texts share is one
context a batch. The contexts of a single anchor, however many, are one block.

Defined cases: a null text is empty; texts of fewer than DEPTH bytes are kept; a null id counts as larger
than any other, and equal ids are not smaller than each other; rows with equal ids and texts get equal
results; an empty table gives an empty result; other columns of the input are ignored. Ids are whole numbers, as
the order of ids is asked for; a column of another type raises a TypeError. A text may be as long as a Spark
string; it is hashed in pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlog.llm import common, kernels

DEPTH, GRAM = 50, 20
SPAN = DEPTH - GRAM + 1  # grams in a window
PERIOD = 21
#: A perfect difference set, so any two residues modulo 21 meet in it after one shift below 21.
COVER = np.array([3, 6, 7, 12, 14])
BUCKET_BYTES = 8 << 20  # text that a bucket stands for
BATCH_BYTES = 4 << 20  # text that sends its hashes and contexts together
BLOCK_TEXT = 512 << 10  # contexts sorted together, unless one anchor has more
SORT_ROWS = 1 << 20
MARKED_AT_ONCE = 1 << 17  # occurrences of contexts
PIECE = 512 << 10  # bytes whose anchors are found together
_POS_BITS = np.uint64(28)  # of a place in a piece
_LATE = 2**63 - 1  # the order of a null id


def anchors(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of every anchor, in order, and the prefix hash of the block."""
    n = len(data)
    c = kernels.prefix_hash(data)
    none = np.zeros(0, np.int64)
    if n < DEPTH:
        return np.zeros(0, np.uint64), none, none, none, c
    _, down = kernels.powers(n + 1)
    h = kernels.mix((c[GRAM:] - c[:-GRAM]) * down[: n - GRAM + 1])
    key = (h & ~((np.uint64(1) << _POS_BITS) - np.uint64(1))) | np.arange(len(h), dtype=np.uint64)
    least, width = key, 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(h) - SPAN + 1], least[SPAN - width : SPAN - width + len(h) - SPAN + 1])
    # Windows inside one text.
    size = np.diff(offs)
    many = np.maximum(size - DEPTH + 1, 0)
    s = np.arange(many.sum()) + np.repeat(offs[:-1] - (np.cumsum(many) - many), many)
    if not len(s):
        return np.zeros(0, np.uint64), none, none, none, c
    p = (least[s] & ((np.uint64(1) << _POS_BITS) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
    last = np.append(new[1:], len(p)) - 1
    return h[p[new]], p[new], s[new], s[last], c


def pieces(offs: np.ndarray):
    """(first byte, past byte, own text offsets, first text) of pieces of about PIECE bytes that cover every window once.

    Short texts share a piece; of a longer text, a piece ends DEPTH - 1 bytes after the next one starts.
    """
    for a, b in kernels.blocks(offs, PIECE):
        lo, past = int(offs[a]), int(offs[b])
        if b - a > 1 or past - lo <= PIECE:
            yield lo, past, offs[a : b + 1] - lo, a
            continue
        for at in range(lo, past - DEPTH + 1, PIECE):
            to = min(past, at + PIECE + DEPTH - 1)
            yield at, to, np.array([0, to - at]), a


def _grouped(batches, fn):
    """``fn`` of the rows of each value of the first column, which is sorted: a value ends where the next starts."""
    held: list[pa.RecordBatch] = []
    for batch in common.trimmed(batches):
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        if held and key[0] != held[0].column(0)[0].as_py():
            yield from fn(pa.Table.from_batches(held))
            held = []
        for a, b in zip(edge, np.append(edge[1:], len(key)), strict=True):
            if a:
                yield from fn(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield from fn(pa.Table.from_batches(held))


def _cat(col: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of packed arrays, and how many each row has."""
    raw = [np.frombuffer(x, kind) for x in col.to_pylist()]
    return np.concatenate(raw) if raw else np.zeros(0, kind), np.array([len(x) for x in raw], np.int64)


def _own_hashes(data: np.ndarray, offs: np.ndarray, buckets: int):
    """Different anchor hashes of a batch by bucket: (hashes, whether met twice, buckets, first of each and past)."""
    found = [anchors(data[lo:to], own)[0] for lo, to, own, _ in pieces(offs)]
    h, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
    unit = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(unit, kind="stable")
    some, first = np.unique(unit[order], return_index=True)
    return h[order], n[order] > 1, some, np.append(first, len(h))


def _texts(batch: pa.RecordBatch):
    """(batch number, orders, fingerprints, bytes, offsets) of rows of the batch table."""
    for k in range(batch.num_rows):
        ords, fps, offs, text = (np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in ((1, "<i8"), (2, "<i8"), (3, "<i8"), (4, np.uint8)))
        yield batch.column(0)[k].as_py(), ords, fps, text, offs


_BATCHES = "batch long, ords binary, fps binary, offs binary, text binary"


def pack_batches(reps: DataFrame) -> tuple[DataFrame, str, str]:
    """The texts (ord, fp, text) in batches, as a table bucketed by batch; also its name and path."""
    def run(batches):
        number, held, size = 0, [], 0

        def packed():
            data, offs = kernels.text_buffer(pa.chunked_array([h.column(2) for h in held]))
            ords, fps = (np.concatenate([h.column(k).to_numpy() for h in held]).astype("<i8").tobytes() for k in (0, 1))
            row = [[(TaskContext.get().partitionId() << 32) + number], [ords], [fps], [offs.astype("<i8").tobytes()], [data.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if k else pa.int64()) for k, x in enumerate(row)], ["batch", "ords", "fps", "offs", "text"])

        for batch in common.trimmed(batches):
            _, offs = kernels.text_buffer(batch.column(2))
            for a, b in kernels.blocks(offs, BATCH_BYTES):
                if held and size + offs[b] - offs[a] > BATCH_BYTES:
                    yield packed()
                    number, held, size = number + 1, [], 0
                held.append(batch.slice(a, b - a))
                size += offs[b] - offs[a]
        if held:
            yield packed()

    spark = reps.sparkSession
    name, path = f"strandlog_texts_{uuid.uuid4().hex}", common.scratch_path(spark, "substring-texts")
    made = reps.mapInArrow(run, _BATCHES)
    made.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "batch").format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name).select("batch", "ords", "fps", "offs", "text"), name, path


def _by_batch(rows: DataFrame, name: str) -> DataFrame:
    """Rows (batch, bucket, ...) as one row a batch with the list ``told``: no more rows than the batch has sent."""
    fields = [c for c in rows.columns if c != "batch"]
    return common.materialize(rows.groupBy("batch").agg(F.collect_list(F.struct(*fields)).alias("told")), name)


def repeated_anchors(texts: DataFrame, buckets: int, tasks: int) -> DataFrame:
    """batch, told (bucket, bits): for the batch's hashes of each bucket, whether another window elsewhere has it."""
    schema = T.StructType.fromDDL("bucket int, batch long, h binary, many binary")

    def send(batch: pa.RecordBatch):
        for number, _, _, data, offs in _texts(batch):
            h, many, some, edge = _own_hashes(data, offs, buckets)
            if len(h):
                parts = [slice(a, b) for a, b in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([number] * len(some), pa.int64()), pa.array([h[x].tobytes() for x in parts], pa.binary()), pa.array([np.packbits(many[x]).tobytes() for x in parts], pa.binary())], schema.names)

    def meet(table: pa.Table):
        h, size = _cat(table["h"], "<u8")
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table["many"].to_pylist(), size.tolist(), strict=True)]).astype(bool)
        order = np.argsort(h)
        new = np.concatenate(([True], h[order][1:] != h[order][:-1]))
        start = np.flatnonzero(new)
        twice = (np.diff(np.append(start, len(h))) > 1) | np.logical_or.reduceat(many[order], start)
        bit = np.empty(len(h), bool)
        bit[order] = twice[np.cumsum(new) - 1]
        cut = np.cumsum(size)
        some = [k for k in range(len(size)) if bit[cut[k] - size[k] : cut[k]].any()]
        bits = [np.packbits(bit[cut[k] - size[k] : cut[k]]).tobytes() for k in some]
        pick = table.select(["batch", "bucket"]).take(pa.array(some, pa.int64())).combine_chunks()
        yield pa.RecordBatch.from_arrays([pick["batch"].combine_chunks(), pick["bucket"].combine_chunks(), pa.array(bits, pa.binary())], ["batch", "bucket", "bits"])

    sent = common.map_arrow(texts, send, schema).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return _by_batch(sent.mapInArrow(lambda it: _grouped(it, meet), "batch long, bucket int, bits binary"), "substring-marks")


class Contexts:
    """The contexts of a batch's marked anchors, each once, and where they stand; ``told``: its bits by bucket."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, ords: np.ndarray, told: list, buckets: int):
        h, _, some, edge = _own_hashes(data, offs, buckets)
        marked = np.zeros(len(h), bool)
        for t in told:
            k = int(np.searchsorted(some, t["bucket"]))
            n = edge[k + 1] - edge[k]
            marked[edge[k] : edge[k + 1]] = np.unpackbits(np.frombuffer(t["bits"], np.uint8), count=n)
        marks = np.sort(h[marked])
        got = []
        for lo, to, own, row in pieces(offs):
            h, p, first, last, c = anchors(data[lo:to], own)
            at = np.minimum(np.searchsorted(marks, h), max(len(marks) - 1, 0))
            keep = marks[at] == h if len(marks) else np.zeros(len(h), bool)
            h, p, first, last = h[keep], p[keep], first[keep], last[keep]
            end = last + DEPTH
            name = kernels.spans_hash(c, first, end) ^ kernels.mix((p - first).astype(np.uint64) * np.uint64(64) + (end - first).astype(np.uint64) + np.uint64(1))
            got.append((h, p - first, end - first, first + lo, name, row + np.searchsorted(own, first, "right") - 1))
        if not got:
            got = [(np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        h, self.rel, self.size, self.at, name, self.doc = (np.concatenate(x) for x in zip(*got, strict=True))
        unit = (h % np.uint64(buckets)).astype(np.int64)
        self.order = np.lexsort((ords[self.doc], name, unit))  # occurrences by bucket and context, smallest order first
        u, m = unit[self.order], name[self.order]
        new = np.concatenate(([True], (m[1:] != m[:-1]) | (u[1:] != u[:-1])))[: len(u)]
        self.which = np.cumsum(new) - 1  # the context of each occurrence
        self.first = self.order[new]
        self.buckets = np.unique(u)
        self.edge = np.append(np.searchsorted(unit[self.first], self.buckets), len(self.first))


def ask_contexts(texts: DataFrame, marks: DataFrame, buckets: int) -> DataFrame:
    """Contexts by bucket and batch: rel, len (place of the anchor, and length), bytes end to end, least order."""
    schema = T.StructType.fromDDL("bucket int, batch long, rel binary, len binary, bytes binary, least binary")

    def send(batch: pa.RecordBatch):
        for k, (number, ords, _, data, offs) in enumerate(_texts(batch)):
            x = Contexts(data, offs, ords, batch.column(5)[k].as_py(), buckets)
            rows = []
            for b, a, z in zip(x.buckets.tolist(), x.edge[:-1], x.edge[1:], strict=True):
                f = x.first[a:z]
                n = x.size[f]
                text = data[np.repeat(x.at[f] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                rows.append((b, number, x.rel[f].astype("u1").tobytes(), n.astype("u1").tobytes(), text.tobytes(), ords[x.doc[f]].astype("<i8").tobytes()))
            if rows:
                kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], schema.names)

    # The few bits go to the batches: the table of texts is bucketed, so it stays where it is.
    return common.map_arrow(texts.join(marks.hint("shuffle_hash"), "batch").select("batch", "ords", "fps", "offs", "text", "told"), send, schema)


def cut_texts(texts: DataFrame, marks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """ord, fp, n_removed, n_spans, kept_sha of the texts that lose bytes."""
    schema = T.StructType.fromDDL("ord long, fp long, n_removed long, n_spans long, kept_sha string")

    def cut(batch: pa.RecordBatch):
        for k, (_, ords, fps, data, offs) in enumerate(_texts(batch)):
            x = Contexts(data, offs, ords, batch.column(5)[k].as_py(), buckets)
            delta, smaller = np.zeros(len(data) + 2, np.int32), np.zeros(len(x.first), np.uint32)
            for t in batch.column(6)[k].as_py():
                b = int(np.searchsorted(x.buckets, t["bucket"]))
                smaller[x.edge[b] : x.edge[b + 1]] = np.frombuffer(t["smaller"], "<u4")
            n, least = x.size[x.first] - DEPTH + 1, ords[x.doc[x.first]]
            # Occurrences past the batch's smallest order lose every window, the others those of the answer.
            lost = np.where(ords[x.doc[x.order]] > least[x.which], _windows(n)[x.which], smaller[x.which])
            lose = np.flatnonzero(lost)
            for at in range(0, len(lose), MARKED_AT_ONCE):
                o = lose[at : at + MARKED_AT_ONCE]
                each = n[x.which[o]]
                occ = np.repeat(np.arange(len(o)), each)
                step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                hit = (lost[o][occ] >> step.astype(np.uint32)) & np.uint32(1) == 1
                a = x.at[x.order[o]][occ[hit]] + step[hit]
                low, high = int(a.min()), int(a.max()) + DEPTH + 1
                delta[low:high] += (np.bincount(a - low, minlength=high - low) - np.bincount(a - low + DEPTH, minlength=high - low)).astype(np.int32)
            gone = np.cumsum(delta[:-2]) > 0
            lost = np.concatenate(([0], np.cumsum(gone)))
            rows = []
            for i in np.flatnonzero(lost[offs[1:]] > lost[offs[:-1]]):
                own = gone[offs[i] : offs[i + 1]]
                spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum())
                rows.append((int(ords[i]), int(fps[i]), int(own.sum()), spans, hashlib.sha256(data[offs[i] : offs[i + 1]][~own].tobytes()).hexdigest()))
            if rows:
                kinds = (*[pa.int64()] * 4, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], schema.names)

    asked = texts.join(marks.hint("shuffle_hash"), "batch").join(answers.withColumnRenamed("told", "answers").hint("shuffle_hash"), "batch")
    return common.map_arrow(asked.select("batch", "ords", "fps", "offs", "text", "told", "answers"), cut, schema)


def _words(text: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The first PERIOD bytes at each place as big-endian integers that sort as the bytes do."""
    out = []
    for lo in range(0, PERIOD, 8):
        w = np.zeros(len(at), np.uint64)
        for k in range(lo, min(lo + 8, PERIOD)):
            w = (w << np.uint64(8)) | text[at + k].astype(np.uint64)
        out.append(w)
    return out


def cover_ranks(text: np.ndarray, inside: np.ndarray, longest: int) -> np.ndarray:
    """Rank (from 1) of the suffix at each place of the difference cover, 0 elsewhere.

    ``inside`` marks places that belong to a context; contexts are at least PERIOD zero bytes apart, so a
    suffix ends with its context. Prefix doubling steps by PERIOD, which keeps a place's residue.
    """
    at = np.flatnonzero(inside & np.isin(np.arange(len(inside)) % PERIOD, COVER))
    rank = np.zeros(len(text) + longest + 2 * PERIOD, np.int64)
    outside = np.flatnonzero(~inside)
    left = np.append(outside, len(inside))[np.searchsorted(outside, at)] - at  # bytes to the end of the context
    keys, depth = _words(text, at), PERIOD
    while len(at):
        order = np.lexsort(keys[::-1])
        change = np.zeros(len(at), bool)
        for k in keys:
            change[1:] |= k[order][1:] != k[order][:-1]
        number = np.cumsum(change) + 1
        rank[at[order]] = number
        if number[-1] == len(at) or depth >= longest:
            break
        keys, depth = [rank[at], np.where(left > depth, rank[at + np.minimum(depth, left)], 0)], 2 * depth
    return rank


#: For two residues, the first shift that leads both into the cover.
_BOTH = np.array([[min(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER) for b in range(PERIOD)] for a in range(PERIOD)])


def suffix_order(text: np.ndarray, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The places ``at`` in the order of their suffixes.

    Places are grouped by their first PERIOD bytes. In a group, those of one residue go by the rank of the
    first cover sample behind them. Where a group has several residues, a place comes after its own residue's
    smaller places and, of each other residue, after those that the cover ranks at their common shift put before it.
    """
    res, w = at % PERIOD, _words(text, at)
    order = np.lexsort((rank[at + np.diagonal(_BOTH)[res]], res, *w[::-1]))
    at, res = at[order], res[order]
    change = np.zeros(len(at), bool)
    for k in w:
        change[1:] |= k[order][1:] != k[order][:-1]
    change[:1] = True
    group, start = np.cumsum(change) - 1, np.flatnonzero(change)
    last = np.append(start[1:], len(at)) - 1
    mixed = np.flatnonzero((res[start] != res[last])[group])  # sorted by residue in a group, so its ends tell
    if not len(mixed):
        return at
    at_m, res_m, group_m = at[mixed], res[mixed], group[mixed]
    # Places of one residue and group before each, and then those of the other residues.
    head = np.concatenate(([True], (res_m[1:] != res_m[:-1]) | (group_m[1:] != group_m[:-1])))
    place = np.arange(len(mixed)) - np.maximum.accumulate(np.where(head, np.arange(len(mixed)), 0))
    many = np.int64(len(rank) + 1)
    rows = [np.flatnonzero(res_m == r) for r in range(PERIOD)]
    for r, mine in enumerate(rows):
        for s, other in enumerate(rows):
            if r != s and len(mine) and len(other):
                key = group_m[other] * many + rank[at_m[other] + _BOTH[r, s]]
                asked = group_m[mine] * many
                smaller = np.searchsorted(key, asked + rank[at_m[mine] + _BOTH[r, s]], "right" if s < r else "left")
                place[mine] += smaller - np.searchsorted(key, asked, "left")
    out = at.copy()
    out[start[group_m] + place] = at_m
    return out


def window_order(text: np.ndarray, at: np.ndarray, rank: np.ndarray):
    """Places in suffix order, one part of at most about SORT_ROWS at a time; parts split between first bytes."""
    lead = text[at]
    order = np.argsort(lead, kind="stable")
    edge = np.searchsorted(lead[order], np.arange(257))
    a = 0
    for b in range(1, 257):
        if b == 256 or edge[b + 1] - edge[a] > SORT_ROWS:
            part = at[order[edge[a] : edge[b]]]
            a = b
            if len(part):
                yield suffix_order(text, part, rank)


def least_orders(rel: np.ndarray, size: np.ndarray, data: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The smallest order that each window of the contexts has anywhere among them, contexts end to end.

    Contexts are laid so that their anchors stand at multiples of PERIOD: most suffixes that are alike have
    equal residues then, which makes few mixed groups; the order doesn't depend on it.
    """
    rel, size = rel.astype(np.int64), size.astype(np.int64)
    room = (-(-(size + 2 * PERIOD + PERIOD) // PERIOD)) * PERIOD
    base = np.cumsum(room) - room + (-rel) % PERIOD
    text = np.zeros(int(room.sum()) + 3 * PERIOD, np.uint8)
    put = np.repeat(base - (np.cumsum(size) - size), size) + np.arange(size.sum())
    text[put] = data
    inside = np.zeros(len(text), bool)
    inside[put] = True
    rank = cover_ranks(text, inside, int(size.max()))
    many = size - DEPTH + 1
    at = np.repeat(base - (np.cumsum(many) - many), many) + np.arange(many.sum())
    order_of = np.zeros(len(text), np.int64)
    order_of[at] = np.repeat(least, many)
    out = np.zeros(len(text), np.int64)
    for part in window_order(text, at, rank):
        same = np.ones(len(part), bool)  # longest common prefix with the one before is DEPTH or more
        same[0] = False
        for k in range(DEPTH):
            live = np.flatnonzero(same)
            same[live] = text[part[live] + k] == text[part[live - 1] + k]
        start = np.flatnonzero(~same)
        low = np.minimum.reduceat(order_of[part], start)
        out[part] = np.repeat(low, np.diff(np.append(start, len(part))))
    return out[at]


def _windows(n: np.ndarray) -> np.ndarray:
    """The n lowest bits: SPAN at most, so 32 are enough."""
    return ((np.uint64(1) << n.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)


def _solve(table: pa.Table):
    """For each row of a bucket and each of its contexts, which windows a smaller order has."""
    rel, count = _cat(table["rel"], "u1")
    size, least = _cat(table["len"], "u1")[0].astype(np.int64), _cat(table["least"], "<i8")[0]
    past, first = np.cumsum(size), np.concatenate(([0], np.cumsum(count)))
    # Hashes of anchors and contexts are made again here: they would not compress on the way.
    raw, anchor, name = table["bytes"].to_pylist(), np.empty(len(size), np.uint64), np.empty(len(size), np.uint64)
    for r, x in enumerate(raw):
        own = slice(first[r], first[r + 1])
        c, end = kernels.prefix_hash(np.frombuffer(x, np.uint8)), np.cumsum(size[own])
        at = end - size[own] + rel[own]
        anchor[own] = kernels.spans_hash(c, at, at + GRAM)
        name[own] = kernels.spans_hash(c, end - size[own], end) ^ kernels.mix(rel[own].astype(np.uint64) * np.uint64(256) + size[own].astype(np.uint64))
    data = np.frombuffer(b"".join(raw), np.uint8)
    # Different contexts, and the smallest order of each.
    order = np.lexsort((least, name, anchor))
    new = np.concatenate(([True], (name[order][1:] != name[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])))
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    one = order[new]
    low = least[one]
    owner = anchor[one]
    alone = np.ones(len(one), bool)
    alone[1:] &= owner[1:] != owner[:-1]
    alone[:-1] &= owner[:-1] != owner[1:]
    mixed = np.flatnonzero(~alone)
    many = size[one] - DEPTH + 1
    values, at = np.zeros(0, np.int64), np.full(len(one), -1, np.int64)
    if len(mixed):
        # Different anchors have no window in common: blocks split between anchors.
        begins = np.concatenate(([True], owner[mixed][1:] != owner[mixed][:-1]))
        volume = (np.cumsum(size[one[mixed]]) // BLOCK_TEXT)[np.maximum.accumulate(np.where(begins, np.arange(len(mixed)), 0))]
        cuts = np.flatnonzero(np.concatenate(([True], volume[1:] != volume[:-1])))
        parts = []
        for x, y in zip(cuts, np.append(cuts[1:], len(mixed)), strict=True):
            pick = one[mixed[x:y]]
            n = size[pick]
            text = data[np.repeat(past[pick] - size[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            parts.append(least_orders(rel[pick], n, text, low[mixed[x:y]]))
        values = np.concatenate(parts)
        at[mixed] = np.cumsum(many[mixed]) - many[mixed]
    # One number a context: a bit for each of its windows, set if a smaller id than the batch's own has it.
    out = []
    for r in range(len(count)):
        mine = slice(first[r], first[r + 1])
        k, own = kind[mine], least[mine]
        bits = np.where(low[k] < own, _windows(many[k]), np.uint32(0))
        pick = np.flatnonzero(at[k] >= 0)
        if len(pick):
            n = many[k[pick]]
            start = np.cumsum(n) - n
            step = np.arange(n.sum()) - np.repeat(start, n)
            smaller = values[np.repeat(at[k[pick]], n) + step] < np.repeat(own[pick], n)
            bits[pick] = np.bitwise_or.reduceat(smaller.astype(np.uint32) << step.astype(np.uint32), start)
        out.append(bits.astype("<u4").tobytes())
    yield pa.RecordBatch.from_arrays([table["bucket"].combine_chunks(), table["batch"].combine_chunks(), pa.array(out, pa.binary())], ["bucket", "batch", "smaller"])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be a column of whole numbers, by which earlier and later texts are told")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LATE)).alias("ord"), text.alias("text"))
    rows = rows.select("doc_id", "ord", "text", F.xxhash64("text").alias("fp"))
    info = rows.select("doc_id", "ord", "fp", F.xxhash64(F.lit(7), F.reverse("text")).alias("fp2"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    info = common.materialize(info, "substring-rows")
    classes = common.materialize(info.groupBy("fp", "fp2", "n_bytes").agg(F.min("ord").alias("rep")), "substring-classes")
    total = classes.agg(F.sum("n_bytes")).collect()[0][0] or 0
    buckets, tasks = int(total // BUCKET_BYTES) + 4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = info.join(classes, ["fp", "fp2", "n_bytes"]).where("ord > rep").select("ord", "fp").distinct()
    few = copies.limit(common.BROADCAST_ROWS + 1).count() <= common.BROADCAST_ROWS
    reps = rows.join(F.broadcast(copies) if few else copies, ["ord", "fp"], "left_anti").where(F.octet_length("text") >= DEPTH).select("ord", "fp", "text")

    texts, name, path = pack_batches(reps)
    marks = repeated_anchors(texts, buckets, tasks)
    asked = ask_contexts(texts, marks, buckets).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    answers = _by_batch(asked.mapInArrow(lambda it: _grouped(it, _solve), "bucket int, batch long, smaller binary"), "substring-answers")
    changed = common.materialize(cut_texts(texts, marks, answers, buckets).distinct(), "substring-cut")
    common.free(marks, answers)
    common.drop_table(docs.sparkSession, name, path)
    whole = (F.col("ord") > F.col("rep")) & (F.col("n_bytes") >= DEPTH)
    out = info.join(classes, ["fp", "fp2", "n_bytes"]).join(changed, ["ord", "fp"], "left")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(common.read(spark, sf_dir, "documents"))
