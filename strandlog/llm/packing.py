"""Token-ID output: public tokenizer, best-fit-decreasing packing, binary rows of fixed length.

Texts are tokenised with a byte-level vocabulary read from a file (a parameter). Different chunks of a batch
are tokenised once: a text is cut before single spaces between visible characters, where the
tokenizer's own pattern always cuts, so the ids are those of the whole text. Each document ends with
the first id past the vocabulary; a document longer than a row is split losslessly into full rows and a rest.

Segments are packed within a window of ``WINDOW_TOKENS`` tokens of one partition, longest first, each into the
open row with the least room that is enough: a segment tree over the capacities finds it in logarithmic
time. No shuffle is needed and a task holds one window, so memory is bounded and a lost executor costs its
own partitions.

A row has ``row_len`` ids (little-endian uint16, or int32 for a larger vocabulary, padded with that end), cumulative segment lengths
(cu_seqlens: 0 first, past the last segment last), position ids that start at 0 again in every segment
(uint16 or int32), and doc_id and part number of each segment.

Defined cases: null and empty texts are one end token; bytes that are no UTF-8 are a token each, so that every text
comes back byte by byte; a very long text is tokenised whole and split; ids keep their type; null ids stay null; repeated rows are packed again;
ties are packed in order of input; an empty table gives an empty result; other columns are ignored. Rows of
one partition are numbered by (shard, row), which the same input files give again.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strandlog.llm import common, kernels

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-tokenisation pattern published with that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256  # what ends a document with that vocabulary
ROW_LEN = 2048
WINDOW_TOKENS = 1 << 20
BLOCK_BYTES = 2 << 20  # text whose different chunks are encoded together

_encodings: dict[bytes, object] = {}


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def digest(ranks: dict[bytes, int]) -> bytes:
    """Tells vocabularies apart."""
    return hashlib.sha256(repr(sorted(ranks.items())).encode()).digest()


def encoding(ranks: dict[bytes, int], key: bytes | None = None):
    """The tokenizer of these ranks; made once in a process. ``key``: their digest, where it is known."""
    import tiktoken

    key = key or digest(ranks)
    if key not in _encodings:
        _encodings[key] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def _ink(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that end, and bytes that start, a visible character: ASCII, or one of U+00C0 to U+00FF (C3 xx)."""
    ascii_ink = (data > 0x20) & (data < 0x7F)
    latin = data == 0xC3
    ends = ascii_ink.copy()
    ends[1:] |= latin[:-1]
    return ends, ascii_ink | latin


def chunk_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Places where every text may be cut without changing its tokens, text starts among them."""
    n = len(data)
    if n < 3:
        return np.unique(offs[:-1][np.diff(offs) > 0])
    before, after = _ink(data)
    cut = np.zeros(n, bool)
    cut[1:-1] = (data[1:-1] == 0x20) & before[:-2] & after[2:]
    # A text's first and last byte have no neighbour in it.
    inner = offs[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    cut[inner - 1] = False
    cut[offs[:-1][np.diff(offs) > 0]] = True
    return np.flatnonzero(cut)


def _valid(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


class Tokenizer:
    """Ids of whole columns; different chunks of a block are encoded once."""

    def __init__(self, ranks: dict[bytes, int], key: bytes | None = None):
        self.enc = encoding(ranks, key)
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, i in ranks.items():
            self.width[i] = len(piece)
        self.byte = {b: ranks[bytes([b])] for b in range(256) if bytes([b]) in ranks}

    def encode(self, raw: bytes) -> list[int]:
        """Ids of any bytes: those that are no UTF-8 are a token each, so the ids give the bytes back."""
        try:
            return self.enc.encode_ordinary(raw.decode())
        except UnicodeDecodeError:
            out = []
            for part in re.split("([\udc80-\udcff])", raw.decode("utf-8", "surrogateescape")):
                stray = len(part) == 1 and "\udc80" <= part <= "\udcff"
                out += [self.byte[ord(part) - 0xDC00]] if stray else self.enc.encode_ordinary(part)
            return out

    def _each(self, words: pa.Array) -> list[np.ndarray]:
        return [np.array(self.encode(w), np.int32) for w in words.to_pylist()]

    def _joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each) of chunks that start with a space and end visibly, as one text.

        Such chunks are cut from each other by the pattern, so a running sum of token widths finds them again.
        """
        data, offs = kernels.text_buffer(words)
        ids = self.enc.encode_to_numpy(data.tobytes().decode(), disallowed_special=()).astype(np.int32)
        ends = np.searchsorted(np.cumsum(self.width[ids]), offs[1:], "left") + 1
        return ids, np.diff(np.concatenate(([0], ends)))

    def ids(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts end to end, and n + 1 offsets."""
        start = chunk_starts(data, offs)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        ends = np.append(start, len(data)).astype(np.int64)
        flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
        coded = flat.dictionary_encode()
        raw, at = kernels.text_buffer(coded.dictionary)
        before, after = _ink(raw)
        plain = (np.diff(at) > 1) & (raw[at[:-1]] == 0x20) & after[np.minimum(at[:-1] + 1, len(raw) - 1)] & before[at[1:] - 1]
        if plain.any():
            try:
                raw.tobytes().decode()
            except UnicodeDecodeError:  # chunks that are no UTF-8 are encoded by themselves
                plain[[i for i, w in enumerate(coded.dictionary.to_pylist()) if not _valid(w)]] = False
        one, one_size = self._joined(coded.dictionary.filter(pa.array(plain))) if plain.any() else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        rest = self._each(coded.dictionary.filter(pa.array(~plain)))
        size = np.empty(len(plain), np.int64)
        size[plain], size[~plain] = one_size, [len(x) for x in rest]
        base = np.empty(len(plain), np.int64)
        base[plain] = np.cumsum(one_size) - one_size
        base[~plain] = len(one) + np.cumsum(size[~plain]) - size[~plain]
        table = np.concatenate([one, *rest])
        code = coded.indices.to_numpy()
        n = size[code]
        past = np.cumsum(n)
        out = table[np.repeat(base[code] - (past - n), n) + np.arange(past[-1])]
        return out, np.concatenate(([0], past))[np.searchsorted(start, offs)]


class BestFit:
    """Open rows by room left, with a segment tree that finds the least room of at least a size."""

    def __init__(self, row_len: int):
        self.leaves = 1 << (row_len).bit_length()
        self.tree = np.zeros(2 * self.leaves, np.int64).tolist()  # open rows under a node
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.tree[at] += by
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the open row with the least room of ``size`` or more, removed; None if there is none."""
        tree, at = self.tree, size + self.leaves
        if not tree[at]:
            while True:  # up, until a right neighbour has rows
                if at == 1:
                    return None
                if not at & 1 and tree[at + 1]:
                    at += 1
                    break
                at >>= 1
            while at < self.leaves:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._count(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(sizes: np.ndarray, row_len: int) -> tuple[np.ndarray, int]:
    """Row of each segment, and the number of rows; longest first, ties in order."""
    row = np.empty(len(sizes), np.int64)
    fit, n = BestFit(row_len), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = fit.take(size) if size < row_len else None
        if found is None:
            room, at, n = row_len, n, n + 1
        else:
            room, at = found
        row[i] = at
        if room > size:
            fit.add(room - size, at)
    return row, n


def pack(docs: DataFrame, ranks: dict[bytes, int] | None = None, row_len: int = ROW_LEN, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per packed sequence: shard, row, n_tokens, input_ids, cu_seqlens, position_ids, doc_ids, parts.

    ``vocabulary`` is the path of a byte-level vocabulary for ``PATTERN``, read by the driver; ``ranks`` one already read.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranks = ranks or load_ranks(vocabulary)
    end = max(ranks.values()) + 1
    shared = docs.sparkSession.sparkContext.broadcast((ranks, digest(ranks)))  # a fixed public vocabulary
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType.fromDDL("shard int, row int, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<long>, parts array<int>")
    schema["doc_ids"].dataType = T.ArrayType(kind)
    id_type, pos_type = np.dtype("<u2" if end < 1 << 16 else "<i4"), np.dtype("<u2" if row_len < 1 << 16 else "<i4")

    def rows(names: list, ids: list[np.ndarray], first: int, shard: int) -> pa.RecordBatch:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        parts = np.maximum(1, -(-size // row_len))
        doc = np.repeat(np.arange(len(ids)), parts)
        part = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        length = np.minimum(size[doc] - part * row_len, row_len)
        row, n = best_fit_decreasing(length, row_len)
        order = np.argsort(row, kind="stable")
        edge = np.searchsorted(row[order], np.arange(n + 1))
        out, pos = np.full((n, row_len), end, id_type), np.zeros((n, row_len), pos_type)
        count, cu, owners, numbers = [], [], [], []
        ramp = np.arange(row_len, dtype=pos_type)
        for r in range(n):
            at, cuts = 0, [0]
            for s in order[edge[r] : edge[r + 1]]:
                k, lo = int(length[s]), int(part[s]) * row_len
                out[r, at : at + k] = ids[doc[s]][lo : lo + k]
                pos[r, at : at + k] = ramp[:k]
                at += k
                cuts.append(at)
            mine = order[edge[r] : edge[r + 1]]
            count.append(at)
            cu.append(cuts)
            owners.append([names[d] for d in doc[mine]])
            numbers.append(part[mine].tolist())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * n, pa.int32()),
                pa.array(range(first, first + n), pa.int32()),
                pa.array(count, pa.int32()),
                pa.array([x.tobytes() for x in out], pa.binary()),
                pa.array(cu, pa.list_(pa.int32())),
                pa.array([x.tobytes() for x in pos], pa.binary()),
                pa.array(owners, pa.list_(to_arrow_type(kind))),
                pa.array(numbers, pa.list_(pa.int32())),
            ],
            schema.names,
        )

    def run(batches):
        tok, shard = Tokenizer(*shared.value), TaskContext.get().partitionId()
        names, ids, held, first = [], [], 0, 0
        for batch in common.trimmed(batches):
            data, offs = kernels.text_buffer(batch.column(1))
            owner = batch.column(0).to_pylist()
            for a, b in kernels.blocks(offs, BLOCK_BYTES):
                flat, to = tok.ids(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                for i in range(b - a):
                    names.append(owner[a + i])
                    ids.append(np.append(flat[to[i] : to[i + 1]], end).astype(id_type))
                    held += len(ids[-1])
                del flat
                common.trim()
                if held >= WINDOW_TOKENS:
                    out = rows(names, ids, first, shard)
                    first += out.num_rows
                    names, ids, held = [], [], 0
                    yield out
        if names:
            yield rows(names, ids, first, shard)

    return docs.mapInArrow(run, schema)


def unpack(row: dict, id_type: str = "<u2") -> list[tuple[int, int, np.ndarray]]:
    """(doc_id, part, ids) of the segments of a packed row."""
    ids = np.frombuffer(row["input_ids"], id_type)
    cu = row["cu_seqlens"]
    return [(d, p, ids[a:b]) for d, p, a, b in zip(row["doc_ids"], row["parts"], cu[:-1], cu[1:], strict=True)]


def op4_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.read(spark, sf_dir, "documents"))
