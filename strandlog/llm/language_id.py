"""Language identification by unigram pieces, marginalised over all segmentations.

A language is a probability for each piece of a fixed public vocabulary. The likelihood of a word is the
sum, over every way to cut its bytes into pieces, of the product of the pieces' probabilities: a forward
pass over the bytes. Probabilities are learned by expectation-maximisation, with the backward pass giving
expected piece counts, on about ``FIT_DOCS`` different documents a language (those of smallest hash of id and text;
the bound is that parameter). A text's score is the posterior of the best language, each with the same prior.
The vocabulary is used whole: pieces of up to 8 bytes are looked up as integers, longer ones by their first 8.

All words of every text count. Words are scored once per block of ``SCORE_BYTES`` of text, all languages at a time, in numpy.

Defined cases: null texts and texts without a letter are ``und`` with score 0; a null language is not
learned; with nothing to learn from, all is ``und``; of equal languages the first by name is given; a text
in no piece's alphabet falls back on single bytes; repeated rows get equal results and are learned from
once; null ids are scored and learned from; words and texts of any length count whole; an empty table gives an
empty result; more than ``MAX_LANGS`` languages raise a ValueError; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlog.llm import common, kernels

#: Public vocabulary file; a parameter of ``identify``.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FIT_DOCS = 600  # a language
ROUNDS = 3
KEY_BYTES = 8  # bytes of a piece that fit one 64-bit integer
MAX_LANGS = 2000  # languages of one model, whose size is theirs times the vocabulary
UND = "und"
SCORE_BYTES = 4 << 20  # text scored together
_SLOT_BITS = 18


def load_pieces(path: str = VOCABULARY) -> list[bytes]:
    """The vocabulary's pieces, lower case, and every single byte."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            piece = sp.id_to_piece(i).replace("▁", " ").encode()
            if piece and b"\0" not in piece and (piece.strip(b" ") or piece == b" "):
                found.add(bytes(c + 32 if 65 <= c <= 90 else c for c in piece))
    return sorted(found)


class Pieces:
    """Look-up of byte strings: two tables of integers, each key in its place in one of them.

    A piece of up to 8 bytes is a key itself. The first 8 bytes of longer pieces are keys of a table of their own,
    which gives the pieces that start with them, longest last.
    """

    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces)
        self.longest = max(map(len, pieces), default=0)
        self.short = _Keys([(self.key(p), i) for i, p in enumerate(pieces) if len(p) <= KEY_BYTES])
        self.long: list[list[tuple[bytes, int]]] = []
        heads: dict[bytes, int] = {}
        for i, p in sorted(enumerate(pieces), key=lambda x: len(x[1])):
            if len(p) > KEY_BYTES:
                head = heads.setdefault(p[:KEY_BYTES], len(heads))
                if head == len(self.long):
                    self.long.append([])
                self.long[head].append((p[KEY_BYTES:], i))
        self.heads = _Keys([(self.key(h), k) for h, k in heads.items()])

    @staticmethod
    def key(piece: bytes) -> int:
        return int.from_bytes(piece, "little") + (len(piece) << 56 if len(piece) < KEY_BYTES else 0)


class _Keys:
    """64-bit keys to numbers."""

    def __init__(self, items: list[tuple[int, int]]):
        size = 1 << _SLOT_BITS
        self.at = [np.zeros(size, np.uint64), np.zeros(size, np.uint64)]
        self.id = [np.full(size, -1, np.int32), np.full(size, -1, np.int32)]
        for k, i in items:
            item, which = (np.uint64(k), i), 0
            for _ in range(500):  # each newcomer takes the place; who was there moves to the other table
                slot = int(self._slot(np.array([item[0]]), which)[0])
                old = (self.at[which][slot], int(self.id[which][slot]))
                self.at[which][slot], self.id[which][slot] = item
                if old[1] < 0:
                    break
                item, which = old, 1 - which
            else:
                raise ValueError("the vocabulary doesn't fit the table")

    @staticmethod
    def _slot(keys: np.ndarray, which: int) -> np.ndarray:
        mult = np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[which])
        k = keys ^ (keys >> np.uint64(31))
        return (k * mult) >> np.uint64(64 - _SLOT_BITS)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys; -1 where there is none."""
        at = self._slot(keys, 0)
        out = np.where(self.at[0][at] == keys, self.id[0][at], -1)
        miss = np.flatnonzero(out < 0)
        at = self._slot(keys[miss], 1)
        out[miss] = np.where(self.at[1][at] == keys[miss], self.id[1][at], -1)
        return out


@dataclass
class Lattice:
    """Words, longest first, and every place where a piece stands in one: (word, first byte, length, piece)."""

    size: np.ndarray
    longest: int
    n_pieces: int
    word: np.ndarray
    first: np.ndarray
    length: np.ndarray
    piece: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], pieces: Pieces, before: bytes = b" ") -> tuple[Lattice, np.ndarray]:
        """The lattice of the words, each after a space, and the order they came to be in."""
        size = np.fromiter((len(w) + len(before) for w in words), np.int64, len(words))
        order = np.argsort(-size, kind="stable")
        raw = b"".join(before + words[i] for i in order)
        size = size[order]
        end = np.cumsum(size)
        n = len(raw)
        data = np.frombuffer(raw + bytes(KEY_BYTES), np.uint8)
        left = np.repeat(end, size) - np.arange(n)
        eight = np.zeros(n, np.uint64)
        for k in range(KEY_BYTES):
            eight |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
        at, length, piece = [], [], []
        for k in range(1, KEY_BYTES + 1):
            fits = np.flatnonzero(left >= k)
            key = eight[fits] & np.uint64((1 << 8 * k) - 1) | np.uint64(k << 56) if k < KEY_BYTES else eight[fits]
            ids = pieces.short.find(key)
            hit = np.flatnonzero(ids >= 0)
            at.append(fits[hit])
            length.append(np.full(len(hit), k, np.int64))
            piece.append(ids[hit])
        fits = np.flatnonzero(left > KEY_BYTES)
        head = pieces.heads.find(eight[fits])
        far = []
        for i, h in zip(fits[head >= 0].tolist(), head[head >= 0].tolist(), strict=True):
            for tail, piece_id in pieces.long[h]:
                if len(tail) + KEY_BYTES <= left[i] and raw.startswith(tail, i + KEY_BYTES):
                    far.append((i, len(tail) + KEY_BYTES, piece_id))
        far = np.array(far, np.int64).reshape(-1, 3)
        at, length, piece = (np.concatenate([*x, y]) for x, y in zip((at, length, piece), far.T, strict=True))
        word = np.repeat(np.arange(len(size)), size)[at]
        return cls(size, max(pieces.longest, 1), pieces.n, word, at - (end - size)[word], length, piece.astype(np.int64)), order

    def _runs(self, step: np.ndarray):
        """(step, length, places) of places of one step and length, steps rising: a word is among them once."""
        order = np.lexsort((self.length, step))
        s, k = step[order], self.length[order]
        edge = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (k[1:] != k[:-1])))) if len(s) else []
        for a, b in zip(edge, np.append(edge[1:], len(s)) if len(s) else [], strict=True):
            yield int(s[a]), int(k[a]), order[a:b]

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Log of the summed probability of each word; p: (n + 1) x languages, 0 in the last row."""
        words, langs = len(self.size), p.shape[1]
        room = self.longest + 1
        ring = np.zeros((room, words, langs))
        ring[0] = 1.0
        log, out = np.zeros((words, langs)), np.zeros((words, langs))

        def close(j: int) -> None:
            """The state after j bytes is complete."""
            n = int(np.searchsorted(-self.size, -j, "right"))  # words of at least j bytes
            done = int(np.searchsorted(-self.size[:n], -j, "left"))
            out[done:n] = np.log(np.maximum(ring[j % room, done:n], 1e-300)) + log[done:n]
            if j % 16 == 0 and done:  # keep clear of underflow in long words
                top = np.maximum(ring[:, :done].max(0), 1e-280)
                ring[:, :done] /= top
                log[:done] += np.log(top)
            ring[(j + 1) % room, :done] = 0.0

        now = 0
        if words:
            ring[1 % room] = 0.0
        for j, k, at in self._runs(self.first + self.length):
            while now < j - 1:
                now += 1
                close(now)
            w = self.word[at]
            ring[j % room, w] += ring[(j - k) % room, w] * p[self.piece[at]]
        for j in range(now + 1, int(self.size[0]) + 1 if words else 1):
            close(j)
        return out

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece under one language's p, words weighing ``weight``."""
        # One more cell than bytes for each word: states before, between and after its bytes.
        base = np.cumsum(self.size + 1) - (self.size + 1)
        a, b = np.zeros(int((self.size + 1).sum())), np.zeros(int((self.size + 1).sum()))
        a[base], b[base + self.size] = 1.0, 1.0
        start, end = base[self.word] + self.first, base[self.word] + self.first + self.length
        for _, _, at in self._runs(self.first + self.length):
            a[end[at]] += a[start[at]] * p[self.piece[at]]
        for _, _, at in self._runs(self.size[self.word] - self.first):
            b[start[at]] += b[end[at]] * p[self.piece[at]]
        scale = weight / np.maximum(a[base + self.size], 1e-300)
        return np.bincount(self.piece, a[start] * p[self.piece] * b[end] * scale[self.word], self.n_pieces)


def count_words(text: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words of a column (A-Z lower-cased), each text's word numbers, and n + 1 offsets."""
    data, offs = kernels.text_buffer(text)
    lower = data.copy()
    big = (data >= 65) & (data <= 90)
    lower[big] += 32
    start, end, wo = kernels.words(lower, offs)
    if not len(start):
        return [], np.zeros(0, np.int64), wo
    ink = np.zeros(len(lower) + 1, np.int8)
    np.add.at(ink, start, 1)
    np.add.at(ink, end, -1)
    kept = lower[np.cumsum(ink[:-1]).astype(bool)]
    ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    coded = flat.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), wo


@dataclass
class Model:
    langs: list[str]
    pieces: Pieces
    p: np.ndarray  # (n + 1) x languages

    def log_likelihood(self, words: list[bytes]) -> np.ndarray:
        lattice, order = Lattice.of(words, self.pieces)
        out = np.empty((len(words), len(self.langs)))
        out[order] = lattice.forward(self.p)
        return out


#: Bytes of a word learned together in expectation-maximisation, where states of all bytes are kept unscaled.
_FIT_WORD = 48


def fit_parts(word: bytes) -> list[bytes]:
    """A word in successive parts of up to _FIT_WORD bytes that end between characters."""
    out, at = [], 0
    while len(word) - at > _FIT_WORD:
        to = at + _FIT_WORD
        while to > at + _FIT_WORD - 4 and word[to] & 0xC0 == 0x80:
            to -= 1
        out.append(word[at:to])
        at = to
    return [*out, word[at:]]


def fit_sample(known: DataFrame, sizes: DataFrame, fit_docs: int) -> DataFrame:
    """lang, text of about ``fit_docs`` of the different rows (lang, text, h) of each language, by their hash."""
    share = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.join(F.broadcast(sizes), "lang").where(share < F.lit(float(fit_docs)) / F.col("n"))
    return picked.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, pieces: list[bytes], fit_docs: int = FIT_DOCS, rounds: int = ROUNDS) -> Model:
    """Learn from rows with text and language that are not held out: about ``fit_docs`` different ones a language."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~common.held_out(F.col("doc_id"))).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    langs = sorted(r["lang"] for r in sizes.limit(MAX_LANGS + 1).collect())
    look = Pieces(pieces)
    if not langs:
        return Model([], look, np.zeros((look.n + 1, 0)))
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    sample = fit_sample(known, sizes, fit_docs)

    def run(batch: pa.RecordBatch):
        lang, text = batch.column(0), batch.column(1)
        for name in pc.unique(lang).to_pylist():
            words, at, _ = count_words(text.filter(pc.equal(lang, name)))
            n = np.bincount(at, minlength=len(words))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(words)), pa.array(words, pa.binary()), pa.array(n)], ["lang", "word", "n"])

    counted = common.map_arrow(sample, run, T.StructType.fromDDL("lang string, word binary, n long")).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    table = counted.toPandas()  # words of the bounded sample
    p = np.zeros((look.n + 1, len(langs)))
    for k, name in enumerate(langs):
        mine = table[table["lang"] == name].sort_values("word")
        parts = [fit_parts(bytes(w)) for w in mine["word"]]
        n = mine["n"].to_numpy(float)
        # First parts come after a space, the others follow them.
        later = [w for x in parts for w in x[1:]]
        lattices = []
        for words, weight, before in (([x[0] for x in parts], n, b" "), (later, np.repeat(n, [len(x) - 1 for x in parts]), b"")):
            if words:
                lattice, order = Lattice.of(words, look, before)
                lattices.append((lattice, weight[order]))
        # Start: how often each piece stands in the words, longer pieces preferred.
        seen = np.zeros(look.n + 1)
        for lattice, weight in lattices:
            seen += np.bincount(lattice.piece, weight[lattice.word] * lattice.length**2, look.n + 1)
        seen = seen[:-1] + 0.01
        for _ in range(rounds):
            p[:-1, k] = seen / seen.sum()
            seen = sum((lattice.expected(p[:, k], weight) for lattice, weight in lattices), np.full(look.n, 0.01))
        p[:-1, k] = seen / seen.sum()
    return Model(langs, look, p)


def identify(docs: DataFrame, vocabulary: str = VOCABULARY, fit_docs: int = FIT_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred and score."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    model = fit(docs, load_pieces(vocabulary), fit_docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed vocabulary times the languages
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batch: pa.RecordBatch):
        m = shared.value
        _, offs = kernels.text_buffer(batch.column(3))
        for a, b in kernels.blocks(offs, SCORE_BYTES):
            yield score(m, batch.slice(a, b - a))

    def score(m: Model, batch: pa.RecordBatch) -> pa.RecordBatch:
        words, at, wo = count_words(batch.column(3))
        n, langs = batch.num_rows, len(m.langs)
        total = np.zeros((n, max(langs, 1)))
        if words and langs:
            each = m.log_likelihood(words)
            for k in range(langs):
                c = np.concatenate(([0.0], np.cumsum(each[at, k])))
                total[:, k] = c[wo[1:]] - c[wo[:-1]]
        best = total.argmax(1)
        post = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        letter = batch.column(2).to_numpy(zero_copy_only=False) & (langs > 0)
        names = np.array([*m.langs, UND], object)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(names[np.where(letter, best, langs)], pa.string()), pa.array(np.where(letter, post, 0.0))],
            ["doc_id", "held_out", "lang_pred", "score"],
        )

    text = F.coalesce("text", F.lit(""))
    return common.map_arrow(docs.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), text.rlike(r"\p{L}").alias("letter"), text.alias("text")), run, schema)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(common.read(spark, sf_dir, "documents"))
