"""MinHash near-dedup with HyperMinHash sketches.

1. ``sketch_table``: each text's distinct 5-word shingles fall into ``REGISTERS`` buckets, equal ranges of
   a 64-bit hash; a register is the leading-zero count and the next mantissa bits of its bucket's smallest
   hash. Texts with equal shingle sets are equal in a 128-bit fingerprint and are one class from then on.
2. Bands of ``ROWS`` registers are keys. Empty registers borrow from other buckets in a fixed order, so a
   band of a short text is as selective as one of a long text.
3. Every member of a bucket is asked against the bucket's first one: by size and by registers (the share of equal
   ones, less the expected number of chance collisions of the compressed registers, estimates similarity), and,
   if these may reach the threshold (``MARGIN`` standard errors below it), on the full sets. That is an edge a
   member, and what it links are components already, a large group of near copies as a rule one.
4. What is left are pairs of a bucket in different components. Buckets that have such pairs are gone through by
   their registers, ``BUCKET_ROWS`` members by as many others in a task, and a spanning forest of the pairs that may
   link makes clusters. A cluster's members are laid into blocks of up to ``BLOCK`` texts or ``BLOCK_SHINGLES``
   shingles, those of one component together, and each pair of blocks that holds two components meets in a task.
   Intersections of all sets of a block pair are counted exactly, and a spanning forest of the links goes out.
5. Connected components of the confirmed links are the result.

Links are confirmed on full sets only, so the sketch decides what is compared and never what is linked. At
the threshold a pair shares no band with a probability of about 3e-7. There is no cap on members or partners.

Defined cases: null and empty texts have no shingles, are linked with nothing and are kept; a text of fewer
than five words is one shingle, the whole sequence; equal texts are one class and repeated ids are one
document whose sets are linked if any of their texts is; rows with a null id have a null component and are
kept; ids may be of any type that has an order; very long texts are hashed whole, and a text of over a block of
shingles meets others in a block of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlog.llm import common, components, kernels

SHINGLE = 5
THRESHOLD = 85  # per cent
ROWS, BANDS = 6, 32
REGISTERS = ROWS * BANDS
MANTISSA = 10
MARGIN = 6.0
BUCKET_ROWS = 2048  # rows of a bucket that are compared with as many others in one task
BLOCK, BLOCK_SHINGLES = 256, 1 << 21  # texts, and their shingles, of one side of a meeting
STAR = 1024  # texts that meet one hub in a task
COUNTED_AT_ONCE = 1 << 20  # shingles of a block pair that are sorted together

#: For register j: the bucket it is filled from is the first of this order that isn't empty.
_PROBES = 64


def _probe_order() -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(99))
    return np.stack([np.concatenate(([j], rng.permutation(REGISTERS)[:_PROBES])) for j in range(REGISTERS)]).astype(np.int64)


_ORDER = _probe_order()
_EDGES = (np.arange(REGISTERS, dtype=np.float64) * (2.0**64 / REGISTERS)).astype(np.uint64)


def registers(mins: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """Leading zeros (high 6 bits) and mantissa (low 10) of each bucket's smallest hash; 0 where empty."""
    # The place inside a bucket, stretched to the whole 64-bit range.
    x = np.maximum(((mins - _EDGES).astype(np.float64)) * REGISTERS, 1.0)
    mantissa, exponent = np.frexp(x)  # x = mantissa * 2**exponent, 0.5 <= mantissa < 1
    zeros = np.clip(64 - exponent, 0, 62)
    low = ((mantissa - 0.5) * 2 * (1 << MANTISSA)).astype(np.int64)
    return np.where(empty, 0, ((zeros + 1) << MANTISSA) | low).astype(np.uint16)


def sketch(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(registers, band keys) of a sorted array of distinct shingle hashes that isn't empty."""
    at = np.searchsorted(shingles, _EDGES)
    past = np.append(at[1:], len(shingles))
    empty = at == past
    mins = shingles[np.minimum(at, len(shingles) - 1)]
    regs = registers(mins, empty)
    if empty.any():
        full = ~empty
        first = full[_ORDER].argmax(1)
        donor = _ORDER[np.arange(REGISTERS), first]
        if not full[donor].all():  # all probes empty: the next full register in circular order
            idx = np.flatnonzero(full)
            lost = ~full[donor]
            donor[lost] = idx[np.searchsorted(idx, np.flatnonzero(lost)) % len(idx)]
        filled = regs[donor].astype(np.uint64) + (donor.astype(np.uint64) << np.uint64(16))
    else:
        filled = regs.astype(np.uint64) + (np.arange(REGISTERS, dtype=np.uint64) << np.uint64(16))
    lanes = kernels.mix(filled).reshape(BANDS, ROWS)
    keys = np.zeros(BANDS, np.uint64)
    for r in range(ROWS):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + lanes[:, r]
    return regs, kernels.mix(keys + np.arange(BANDS, dtype=np.uint64))


def shingle_sets(text: pa.Array):
    """The sorted distinct shingle hashes of every text, block by block."""
    data, offs = kernels.text_buffer(text)
    for a, b in kernels.blocks(offs):
        part, own = data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        start, end, wo = kernels.words(part, own)
        h = kernels.spans_hash(kernels.prefix_hash(part, lower=True), start, end)
        g, go = kernels.windows(h, wo, SHINGLE)
        for i in range(b - a):
            yield np.unique(g[go[i] : go[i + 1]])


def estimate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimated similarity, registers that either has) of rows of registers, corrected for collisions.

    Two different minima agree in a register if they have the same leading zeros and mantissa: with
    m mantissa bits the chance is about 2**-m / 3 * (1 + small) for registers that both have.
    """
    both = (x != 0) & (y != 0)
    either = ((x != 0) | (y != 0)).sum(1)
    same = ((x == y) & both).sum(1)
    chance = both.sum(1) * (2.0**-MANTISSA / 3)
    return np.maximum(same - chance, 0) / np.maximum(either, 1), either


def may_link(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the estimate is within MARGIN standard errors of the threshold."""
    j, n = estimate(x, y)
    return j >= threshold - MARGIN * np.sqrt(threshold * (1 - threshold) / np.maximum(n, 1))


def sketch_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fp_a, fp_b (fingerprint of the set), regs, bands, of rows doc_id, text."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind), *(T.StructField(c, T.LongType()) for c in ("n_shingles", "fp_a", "fp_b")), T.StructField("regs", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    )

    def run(batch: pa.RecordBatch):
        n, a, b, regs, bands = [], [], [], [], []
        for s in shingle_sets(batch.column(1)):
            n.append(len(s))
            if len(s):
                r, k = sketch(s)
                regs.append(r.tobytes())
                bands.append(k.view(np.int64))
                a.append(int(np.add.reduce(kernels.mix(s)).view(np.int64)))
                b.append(int(np.add.reduce(kernels.mix(s ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)))
            else:
                regs.append(None)
                bands.append(None)
                a.append(0)
                b.append(0)
        flat = np.concatenate([k for k in bands if k is not None]) if any(k is not None for k in bands) else np.zeros(0, np.int64)
        offsets = np.concatenate(([0], np.cumsum([0 if k is None else BANDS for k in bands]))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(regs, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            ["doc_id", "n_shingles", "fp_a", "fp_b", "regs", "bands"],
        )

    return common.map_arrow(docs.select("doc_id", "text"), run, schema)


class _Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def _may(regs: np.ndarray, size: np.ndarray, x, y, threshold: float) -> np.ndarray:
    """Whether rows x and y may link: their sizes allow it, and so do their registers."""
    near = np.minimum(size[x], size[y]) >= threshold * np.maximum(size[x], size[y]) - 1e-6
    return near & may_link(regs[x], regs[y], threshold)


def bucket_links(key: np.ndarray, regs: np.ndarray, size: np.ndarray, label: np.ndarray, side: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of one key that may link, for rows sorted by key.

    Pairs of one label are linked already. Rows have the side 0 or 1, and only pairs of both are asked,
    or -1, and then all are. Small groups are compared at every distance at once, over all keys; in a
    large one each row is compared with the rows that the forest hasn't joined to it yet.
    """
    n = len(key)
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    count = np.repeat(np.diff(new), np.diff(new))
    forest, links = _Forest(n), []
    differ = lambda i, j: (label[i] != label[j]) & ((side[i] < 0) | (side[i] != side[j]))
    small = np.flatnonzero(count <= 32)
    lag = 1
    while len(small):
        small = small[small + lag < n]
        small = small[key[small] == key[small + lag]]
        ask = small[differ(small, small + lag)]
        for at in range(0, len(ask), 8192):
            i = ask[at : at + 8192]
            for x in i[_may(regs, size, i, i + lag, threshold)]:
                if forest.join(int(x), int(x) + lag):
                    links.append((int(x), int(x) + lag))
        lag += 1
    for a, b in zip(new[:-1], new[1:], strict=True):
        if b - a > 32:
            tree = np.arange(a, b)
            for i in range(a, b):
                other = a + np.flatnonzero((tree != tree[i - a]) & differ(np.arange(a, b), i))
                if len(other):
                    hit = other[_may(regs, size, other, np.full(len(other), i), threshold)]
                    for t in np.unique(tree[hit - a]):
                        links.append((i, int(hit[tree[hit - a] == t][0])))
                        tree[tree == t] = tree[i - a]
    return links


def _whole_keys(batches, fn):
    """``fn`` of tables that hold whole keys (the first column, sorted): the last key of a batch waits for the next."""
    held: list[pa.RecordBatch] = []
    for batch in common.trimmed(batches):
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1], "left"))
        if cut:
            yield fn(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = []
        elif held and key[0] != held[-1].column(0)[0].as_py():
            yield fn(pa.Table.from_batches(held))
            held = []
        held.append(batch.slice(cut))
    if held:
        yield fn(pa.Table.from_batches(held))


def _pair_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("a", kind), T.StructField("b", kind)])


def hub_links(docs: DataFrame, reps: DataFrame, met: DataFrame, threshold: int) -> DataFrame:
    """a, b: confirmed links of bucket members (band, doc_id, first, n) with the first of their buckets."""
    edges = common.materialize(met.where("doc_id != first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct(), "near-hub-asked")
    asked = common.materialize(edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "near-hubs")
    hot = common.hot_keys(asked, "a")
    if hot is not None:  # of a hub that repeats with several texts, each is to be asked: it takes the plain join
        hubs = reps.select(F.col("doc_id").alias("a")).join(F.broadcast(hot), "a", "left_semi")
        hot = common.materialize(hubs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("a"), "near-hot-hubs")
    side = lambda x: reps.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}"))
    both = common.spread_join(edges.join(side("b"), "b"), side("a"), "a", hot)
    both = both.where(100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")).select("a", "b", "n_b", "regs_a", "regs_b")

    def run(batch: pa.RecordBatch):
        x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (3, 4))
        yield batch.filter(pa.array(may_link(x, y, threshold / 100))).select(["a", "b"])

    kind = docs.schema["doc_id"].dataType
    likely = common.materialize(common.map_arrow(both, run, _pair_schema(kind)).distinct(), "near-hub-edges")
    # A hub meets its partners in as many tasks as they need.
    tasks = likely.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(STAR)).cast("int").alias("tasks"))
    known = common.spread_join(likely, tasks, "a", hot).withColumn("task", F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int"))
    partners = known.select(F.xxhash64("a", "task").alias("meeting"), F.lit(True).alias("right"), F.col("b").alias("doc_id"))
    hubs = known.select("a", "task").distinct().select(F.xxhash64("a", "task").alias("meeting"), F.lit(False).alias("right"), F.col("a").alias("doc_id"))
    seats = common.materialize(hubs.unionByName(partners), "near-hub-seats")
    sent = seats.join(common.narrow(docs, seats), "doc_id").repartition("meeting").sortWithinPartitions("meeting", "right", "doc_id").select("meeting", "right", "doc_id", "text")

    def meet(batches):
        now, hubs = None, []
        for batch in common.trimmed(batches):
            meeting, right, names = (batch.column(k).to_pylist() for k in range(3))
            a, b = [], []
            for k, s in enumerate(shingle_sets(batch.column(3))):
                if meeting[k] != now:
                    now, hubs = meeting[k], []
                if not right[k]:
                    hubs.append((names[k], s))
                    continue
                for name, h in hubs:
                    if enough(shared(h, s), len(h), len(s), threshold):
                        a.append(name)
                        b.append(names[k])
                        break
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.field(2).type), pa.array(b, batch.schema.field(2).type)], ["a", "b"])

    out = common.materialize(sent.mapInArrow(meet, _pair_schema(kind)), "near-hub-links")
    common.free(edges, asked, likely, seats)
    return out


def candidate_links(reps: DataFrame, rows: DataFrame, threshold: float, hot: DataFrame | None = None) -> DataFrame:
    """a, b: a forest of the pairs of rows (band, doc_id, label) of one band and two labels that may link.

    ``hot``: the bands that many rows have.
    """
    size = rows.groupBy("band").agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    size = size.select("band", F.ceil(F.col("rows") / F.lit(BUCKET_ROWS)).cast("int").alias("parts"))
    rows = common.spread_join(rows, size, "band", hot).join(reps.select("doc_id", F.col("n_shingles").alias("size"), "regs"), "doc_id")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(F.col("part"), o).alias("x"), F.greatest(F.col("part"), o).alias("y")))
    rows = rows.withColumn("pair", F.explode(pairs))
    side = F.when(F.col("pair.x") == F.col("pair.y"), F.lit(-1)).otherwise((F.col("part") == F.col("pair.y")).cast("int"))
    rows = rows.select(F.xxhash64("band", "pair.x", "pair.y").alias("meeting"), "doc_id", "label", side.alias("side"), "size", "regs")
    rows = rows.repartition("meeting").sortWithinPartitions("meeting", "label", "doc_id")

    def links(batch: pa.Table):
        key, ids, size, side = (batch[c].to_numpy() for c in ("meeting", "doc_id", "size", "side"))
        label = batch["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        regs = np.frombuffer(b"".join(batch["regs"].to_pylist()), np.uint16).reshape(len(key), REGISTERS)
        found = np.array(bucket_links(key, regs, size, label, side, threshold), np.int64).reshape(-1, 2)
        kind = batch.schema.field("doc_id").type
        return pa.RecordBatch.from_arrays([pa.array(ids[found[:, 0]], kind), pa.array(ids[found[:, 1]], kind)], ["a", "b"])

    return rows.mapInArrow(lambda it: _whole_keys(it, links), _pair_schema(reps.schema["doc_id"].dataType)).distinct()


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0


def enough(both: int, x: int, y: int, threshold: int) -> bool:
    """Whether sets of x and y elements, ``both`` of them shared, reach ``threshold`` per cent, in whole numbers."""
    return both > 0 and 100 * both >= threshold * (x + y - both)


def _add_shared(sets: list[np.ndarray], both: np.ndarray) -> None:
    """Add to ``both`` how many hashes each two sets share."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))[: len(values)]
    group = np.cumsum(new) - 1
    shared = np.bincount(group)[group] > 1
    group, owner = group[shared], owner[shared]
    if not len(group):
        return
    col = np.cumsum(np.concatenate(([0], (group[1:] != group[:-1]).astype(np.int64))))
    step = 4096  # columns at once
    for at in range(0, int(col[-1]) + 1, step):
        lo, hi = np.searchsorted(col, [at, at + step])
        m = np.zeros((len(sets), min(step, int(col[-1]) + 1 - at)), np.float32)
        m[owner[lo:hi], col[lo:hi] - at] = 1
        both += (m @ m.T).astype(np.int64)  # whole numbers up to 4096, which float32 holds exactly


def exact_links(sets: list[np.ndarray], first: int, threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs (i, j) with similarity of at least ``threshold`` per cent.

    With ``first`` > 0 only pairs of one set before and one from ``first`` on are asked. Counts are exact: only
    hashes that two sets share are counted, as products of 0/1 matrices.
    """
    size = np.array([len(s) for s in sets])
    both = np.zeros((len(sets), len(sets)), np.int64)
    # The sets are sorted: equal ranges of hashes are taken from all of them, one range after the other.
    ranges = int(size.sum() // COUNTED_AT_ONCE) + 1
    edges = (np.arange(1, ranges, dtype=np.float64) * (2.0**64 / ranges)).astype(np.uint64)
    cuts = np.stack([np.concatenate(([0], np.searchsorted(s, edges), [len(s)])) for s in sets])
    for k in range(ranges):
        _add_shared([s[a:b] for s, a, b in zip(sets, cuts[:, k], cuts[:, k + 1], strict=True)], both)
    union = size[:, None] + size[None, :] - both
    linked = (100 * both >= threshold * union) & (both > 0)
    forest, out = _Forest(len(sets)), []
    for i, j in np.argwhere(np.triu(linked, 1)):
        if (not first or (i < first <= j)) and forest.join(int(i), int(j)):
            out.append((int(i), int(j)))
    return out


def confirmed_links(docs: DataFrame, members: DataFrame, threshold: int) -> DataFrame:
    """a, b: a spanning forest, for each block pair of a cluster, of the links confirmed on full sets.

    ``members``: doc_id, cluster, label, n_shingles. Block pairs of one label alone are not asked.
    """
    def blocks(what: str):
        many = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES)))
        return many.cast("int").alias(what)

    # A large label has blocks of its own, small ones share blocks; places come from hashes and need no ordering.
    labels = common.materialize(members.groupBy("cluster", "label").agg(blocks("own"), F.count(F.lit(1)).alias("n")), "near-labels")
    known = common.spread_join(members, labels.drop("n"), ["cluster", "label"], common.hot_keys(labels, "cluster", "label"))
    mixed = known.where("own = 1").groupBy("cluster").agg(blocks("mixed"))
    sizes = labels.groupBy("cluster").agg(F.sum("n").alias("n"))
    known = common.spread_join(known, mixed, "cluster", common.hot_keys(sizes, "cluster"), "left")
    pure = F.when(F.col("own") > 1, F.col("label"))
    place = F.when(F.col("own") > 1, F.pmod(F.xxhash64("doc_id"), F.col("own"))).otherwise(F.pmod(F.xxhash64("label"), F.col("mixed")))
    known = common.materialize(known.select("doc_id", "cluster", pure.alias("pure"), F.xxhash64(F.coalesce(pure.cast("string"), F.lit("-")), place).alias("block")), "near-blocks")
    # A row a block, not a text; a cluster of up to BLOCK texts, one or more components, is one.
    table = known.select("cluster", "block", "pure").distinct()
    other = table.select("cluster", F.col("block").alias("y"), F.col("pure").alias("pure_y"))
    pairs = table.withColumnRenamed("block", "x").join(other, "cluster").where("x <= y AND NOT coalesce(pure = pure_y, false)")
    seats = pairs.select("cluster", F.xxhash64("cluster", "x", "y").alias("meeting"), (F.col("x") == F.col("y")).alias("own"), F.explode(F.array_distinct(F.array(F.struct(F.col("x").alias("block"), F.lit(False).alias("right")), F.struct(F.col("y").alias("block"), (F.col("x") != F.col("y")).alias("right"))))).alias("s"))
    seats = known.select("doc_id", "cluster", "block").join(seats.select("cluster", "meeting", "own", "s.block", "s.right"), ["cluster", "block"])
    sent = seats.join(common.narrow(docs, known), "doc_id").select("meeting", "right", "own", "doc_id", "text")
    sent = sent.repartition("meeting").sortWithinPartitions("meeting", "right", "doc_id")

    def run(batches):
        now, ids, sets, right, own, like = None, [], [], 0, False, None

        def links():
            if len(ids) > 1 and (own or 0 < right < len(ids)):
                found = exact_links(sets, 0 if own else right, threshold)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i, _ in found], like), pa.array([ids[j] for _, j in found], like)], ["a", "b"])

        for batch in common.trimmed(batches):
            like = batch.schema.field(3).type
            meeting, side, same, names = (batch.column(k).to_pylist() for k in range(4))
            for k, s in enumerate(shingle_sets(batch.column(4))):
                if meeting[k] != now:
                    yield from links()
                    now, ids, sets, right, own = meeting[k], [], [], 0, same[k]
                if ids and not own and side[k] and not right:
                    right = len(ids)
                ids.append(names[k])
                sets.append(s)
        yield from links()

    kind = docs.schema["doc_id"].dataType
    return sent.mapInArrow(run, _pair_schema(kind))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable) and kept."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketches = common.materialize(sketch_table(docs), "near-sketches")
    known = sketches.where("doc_id is not null and n_shingles > 0")
    # Equal sets: a third of all rows may be one class, so only its smallest id goes on.
    classes = common.materialize(known.groupBy("fp_a", "fp_b", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "near-classes")
    large = common.hot_keys(classes, "fp_a", "fp_b", "n_shingles", "rep")
    prints = ["fp_a", "fp_b", "n_shingles"]
    member = common.spread_join(known.select("doc_id", *prints), classes.drop("n"), prints, None if large is None else large.drop("rep")).select("doc_id", "rep")
    reps = known.join(classes, (known.doc_id == classes.rep) & (known.fp_a == classes.fp_a) & (known.fp_b == classes.fp_b) & (known.n_shingles == classes.n_shingles), "left_semi")
    reps = reps.select("doc_id", "n_shingles", "regs", "bands")
    bands = reps.select("doc_id", F.explode("bands").alias("band"))
    buckets = common.materialize(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).where("n > 1"), "near-buckets")
    hot = common.hot_keys(buckets, "band")
    met = common.materialize(common.spread_join(bands, buckets, "band", hot), "near-bands")
    texts = docs.where("doc_id is not null and text is not null")

    links = hub_links(texts, reps, met, threshold)
    found = common.materialize(components.connected(links), "near-components")
    # Every pair with the first of a bucket has been asked: what is open are the others of different components.
    rest = met.where("n > 2 AND doc_id != first").join(found, F.col("doc_id") == F.col("node"), "left").select("band", "doc_id", F.coalesce("component", "doc_id").alias("label"))
    candidates = common.materialize(candidate_links(reps, rest, threshold / 100, hot), "near-candidates")
    if not candidates.isEmpty():
        clusters = components.connected(candidates).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
        open_ = clusters.join(found, F.col("doc_id") == F.col("node"), "left").select("doc_id", "cluster", F.coalesce("component", "doc_id").alias("label"))
        open_ = open_.join(reps.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles")), "doc_id")
        open_ = common.materialize(open_, "near-open")
        more = common.materialize(confirmed_links(texts, open_, threshold), "near-links")
        if not more.isEmpty():
            # The components that are known stand for the links that made them.
            links = found.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more)
            found = components.connected(links)
    same_id = member.where("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    # A class follows its representative; components of classes are named by their smallest id.
    named = found.withColumnRenamed("node", "rep")
    home = common.spread_join(member, named, "rep", None if large is None else large.select("rep"), "left").select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    repeated = home.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.countDistinct("component_id").alias("homes"))
    if repeated.where("homes > 1").limit(1).count():  # an id with several texts ties their components together
        tie = home.join(repeated.where("homes > 1").select("doc_id", F.col("component_id").alias("low")), "doc_id").select(F.col("low").alias("a"), F.col("component_id").alias("b")).where("a != b")
        found = components.connected(common.materialize(links.unionByName(tie).unionByName(same_id), "near-ties"))
        repeated = member.join(found, F.col("rep") == F.col("node"), "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = sketches.select("doc_id", "n_shingles").join(repeated.select("doc_id", "component_id"), "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.read(spark, sf_dir, "documents"))
