import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlog.llm import catalogue as llm_catalogue
from strandlog.llm import decontaminate, language_id, line_dedup, mixing, packing, quality_classifier, quality_rules, url_filters

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int"
ODD = [
    (1, None, None, None, None, 0.0, 1),
    (2, "", "en", "a", 0, 0.0, 1),
    (2, "", "en", "a", 0, 0.0, 1),
    (3, " \n\t ", "en", "a", 4, 0.0, 1),
    (None, "the same text of some words that is here", "en", None, 9, 0.0, 1),
    (5, "the same text of some words that is here", None, "b", 9, 0.0, 1),
    (6, "x" * 300_000, "de", "b", 9, 0.0, 1),
    (7, "eins zwei drei vier " * 5000, "de", "b", 9, 0.0, 1),
    (8, "çà et là ½ \U0001f600\u00a0é", "fr", "c", 9, 0.0, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_rules(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen, hit = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit.update(i + k for i in at for k in range(8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_rules(spark, odd, none):
    extra = [(20 + k, t) for k, t in enumerate(["a b c d e f g h " * 3, "x # | y\nx # | y\n\nz", "one two three four five six seven eight nine one two three four five six seven eight"])]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = quality_rules.apply_rules(docs).collect()
    texts = [r["text"] for r in docs.collect()]
    for r, text in zip(got, texts, strict=True):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_rules(text)
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"]) and r["kept"] == (r["broken_rules"] == [])
    assert quality_rules.apply_rules(none).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://COM/en/1", "https://a.example.com/en/7?x", "http://xcom/en/", "ftp://x.example.net/de/8#f", "http://example.net/de/9", "http://org/es", "http://b.org/es/\n2", "a://b://com/en/"]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge_urls(pages, url_filters.rule_table(spark)).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("com", "/en/1", "com/en/", "block") and got[4] == ("a.example.com", "/en/7", "example.com/en/7", "allow")
    assert got[5] == ("xcom", "/en/", None, "allow") and got[6][2:] == ("example.net/de/8", "block") and got[7][2:] == ("net/de/", "allow")
    assert got[8][2:] == (None, "allow") and got[9] == ("b.org", "/es/\n2", "org/es/", "block") and got[10][0] == "b:"
    empty = spark.createDataFrame([], "action string, host string, path string")
    assert {r["verdict"] for r in url_filters.judge_urls(pages, empty).collect()} == {"allow"}
    assert url_filters.judge_urls(pages.limit(0), url_filters.rule_table(spark)).count() == 0


def test_mix(spark, odd, none):
    docs = [(i, "w " * (1 + i % 17), "s%d" % (i % 3) if i % 10 else None) for i in range(6000)] + [(9000 + i, "w " * 11, "hot") for i in range(6000)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(table).collect()
    again = mixing.mix(table.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    # Targets by resharing, as the contract words it.
    names = sorted([s for s in by if s is not None]) + [None]
    size = {s: sum(r["size"] for r in by[s]) for s in names}
    weight = dict(zip(names, [3, 1, 2, 3, 1, 2], strict=False))
    want, free, left = {}, set(names), 1.5 * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 2.0 * size[s]
            left -= want[s]
            free.discard(s)
    for s in names:
        assert by[s][0]["source_size"] == size[s] and by[s][0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in by[s]) - want[s]) <= 17
    assert {r["taken"] for r in mixing.mix(odd).collect() if r["size"] == 0} == {0}
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(none).count() == 0


def test_heavier_documents_come_first(spark):
    table = spark.createDataFrame([(i, "w", "s", 1.0 if i % 2 else 0.1) for i in range(4000)], "doc_id long, text string, source string, q double")
    rows = mixing.mix(table, weights=(1.0,), share=0.4, quality=F.col("q")).where("taken > 0").collect()
    assert sum(r["doc_id"] % 2 for r in rows) > 0.75 * len(rows)


def brute_lines(docs, run):
    text = {i: [x for x in t.split("\n")] for i, t in docs}
    own = {i: [k for k, x in enumerate(v) if words(x)] for i, v in text.items()}
    first, gone = {}, {i: set() for i in text}
    for i in sorted(text):
        for p in range(len(own[i]) - run + 1):
            at = own[i][p : p + run]
            if first.setdefault(tuple(text[i][k] for k in at), (i, p)) != (i, p):
                gone[i].update(at)
    return {i: (len(own[i]), len(gone[i]), "\n".join(x for k, x in enumerate(v) if k not in gone[i])) for i, v in text.items()}


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_lines(spark, run):
    rng = np.random.default_rng(run)
    docs = [(i, "\n".join(rng.choice(["a", "b", "", "c d", " ", "e"], rng.integers(0, 14)))) for i in range(60)] + [(100, "x\ny\nz"), (101, "x\ny\nz"), (102, "q\nx\ny\nz\nx\ny\nz")]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), run).collect()
    want = brute_lines(docs, run)
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in got} == want


def test_lines_from_one(spark, tmp_path):
    long = " ".join(f"w{k}" for k in range(75))
    docs = [(1, long), (2, f"a\n{long}\nb"), (3, long), (4, "c\nd"), (5, "e\nf")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = llm_catalogue.QUERIES["op9_line_dedup_from_one"](spark, str(tmp_path)).collect()
    want = {i: (n, hashlib.sha256(t.encode()).hexdigest()) for i, (_, n, t) in brute_lines(docs, 1).items()}
    assert {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in got} == want
    assert [want[i][0] for i in range(1, 6)] == [0, 1, 1, 0, 0]


def test_lines_odd(odd, none):
    got = line_dedup.dedup_lines(odd).collect()
    assert len(got) == len(ODD) and {r["text"] for r in got if r["doc_id"] in (1, 2)} == {""} and line_dedup.dedup_lines(none).count() == 0


def test_classifier(spark, odd, none):
    rng = np.random.default_rng(0)
    good = [(i, " ".join(rng.choice(["the", "river", "runs", "down", "to", "sea", "slowly"], 60)) + ".", 1) for i in range(300)]
    bad = [(1000 + i, " ".join("%s%s" % (w, "***") for w in rng.choice(["BUY", "NOW", "$$$", "|"], 60)), 0) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in good + bad], "doc_id long, text string, stats string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality_classifier.classify(docs, labels).collect()
    kind = {i: q for i, _, q in good + bad}
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and np.mean([r["predicted"] == kind[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    got = quality_classifier.classify(odd.select("doc_id", "text"), labels).collect()
    assert len(got) == len(ODD) and all(r["score"] is not None for r in got)
    assert quality_classifier.classify(none, labels).count() == 0
    assert {r["score"] for r in quality_classifier.classify(odd, labels.limit(0)).collect()} == {0.5}


def test_isotonic():
    x, y = quality_classifier.isotonic(np.arange(4.0), np.array([0, 5, 2, 9.0]), np.array([10, 10, 0, 10.0]))
    assert list(y) == sorted(y) and list(y) == [0, 0.5, 0.9]
    _, y = quality_classifier.isotonic(np.arange(3.0), np.array([3, 1, 9.0]), np.array([10, 10, 10.0]))
    assert list(y) == [0.2, 0.9]


def test_held_out(spark):
    import zlib

    got = spark.range(50).select("id", quality_classifier.common.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


def test_forward_sums_all_segmentations():
    pieces = sorted([bytes([b]) for b in b" abc"] + [b"ab", b" a", b"bc", b"abc", b" ab"])
    look = language_id.Pieces(pieces)
    rng = np.random.default_rng(1)
    p = np.vstack([rng.random((len(pieces), 2)), np.zeros((1, 2))])
    prob = {w: p[i] for i, w in enumerate(pieces)}

    def total(s):
        return np.ones(2) if not s else sum((prob[s[:k]] * total(s[k:]) for k in range(1, len(s) + 1) if s[:k] in prob), np.zeros(2))

    words_ = [b"abc", b"a", b"cab", b"abcabcabc", b"bb"]
    lattice, order = language_id.Lattice.of(words_, look)
    out = np.empty((len(words_), 2))
    out[order] = lattice.forward(p)
    for w, got in zip(words_, out, strict=True):
        assert np.allclose(got, np.log(total(b" " + w)))
    # Expected counts: each segmentation's counts, weighted by its share.
    one = lattice.expected(p[:, 0], np.ones(len(words_)))

    def counts(s):
        if not s:
            yield 1.0, []
        for k in range(1, len(s) + 1):
            if s[:k] in prob:
                for q, rest in counts(s[k:]):
                    yield prob[s[:k]][0] * q, [s[:k], *rest]

    want = np.zeros(len(pieces))
    for w in words_:
        every = list(counts(b" " + w))
        z = sum(q for q, _ in every)
        for q, cut in every:
            for x in cut:
                want[pieces.index(x)] += q / z
    assert np.allclose(one, want)


def test_long_words_do_not_underflow():
    look = language_id.Pieces(sorted(bytes([b]) for b in range(1, 256)))
    p = np.vstack([np.full((255, 1), 1e-3), [[0.0]]])
    lattice, _ = language_id.Lattice.of([b"x" * 5000], look)
    assert np.allclose(lattice.forward(p), 5001 * np.log(1e-3))


def test_long_words_are_learned_whole(spark):
    rng = np.random.default_rng(3)
    start = "語" * 20
    kind = {"xa": "山川水火", "xb": "日月木金"}  # the languages differ beyond 48 bytes only
    text = lambda k: start + "".join(rng.choice(list(kind[k]), 30))
    docs = [(i, text(k), k) for i, k in enumerate(["xa", "xb"] * 60)]
    got = language_id.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    want = {i: k for i, _, k in docs}
    assert all(r["lang_pred"] == want[r["doc_id"]] for r in got)
    word = "aé語\U0001f600".encode() * 40
    parts = language_id.fit_parts(word)
    assert b"".join(parts) == word and all(x.decode() and len(x) <= 48 for x in parts) and language_id.fit_parts(b"") == [b""]


def test_languages(spark, odd, none):
    rng = np.random.default_rng(2)
    vocab = {"en": "the and with this river house water bright".split(), "de": "der und mit dieser fluss haus wasser hell".split()}
    docs = [(i, " ".join(rng.choice(vocab[k], 30)), k) for i, k in enumerate(["en", "de"] * 150)]
    got = language_id.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    kind = {i: k for i, _, k in docs}
    assert np.mean([r["lang_pred"] == kind[r["doc_id"]] for r in got if r["held_out"]]) == 1.0
    rows = language_id.identify(odd).collect()
    assert len(rows) == len(ODD) and {(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (1, 2, 3)} == {("und", 0.0)}
    assert all(r["lang_pred"] in ("en", "de", "fr") and 0 <= r["score"] <= 1 for r in rows if r["doc_id"] in (5, 6, 7, 8))
    assert language_id.identify(none).count() == 0


def test_decontamination(spark, odd, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    other = "one two three four five six".split()
    swap = [w if k % 5 else "changed" for k, w in enumerate(item)]
    fill = [f"filler{k}" for k in range(200)]
    docs = [
        (1, " ".join(fill + item + fill)), (2, " ".join(fill + swap)), (3, "! ".join(x.upper() for x in item)), (4, " ".join(fill + item[3:9] + fill)),
        (5, " ".join(fill)), (6, "so " + " ".join(other)), (7, None), (8, ""), (9, " ".join(item[:14])), (None, " ".join(item)),
    ]
    bench = spark.createDataFrame([(10, " ".join(item)), (11, " ".join(other)), (12, None), (13, "too short"), (10, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {1: [10], 2: [10], 3: [10], 4: [], 5: [], 6: [11], 7: [], 8: [], 9: [10], None: [10]}
    assert decontaminate.contamination(none, bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(odd, bench.limit(0)).collect())


def overlaps_that_count(text, item):
    """Most equal tokens of an overlap that counts, tried at every offset; 0 if there is none."""
    best = 0
    for d in range(1 - len(item), len(text)):
        same = [0 <= d + k < len(text) and text[d + k] == w for k, w in enumerate(item)]
        most = now = 0
        for k, x in enumerate(same):
            if 0 <= d + k < len(text):
                now = max(0, now + (1 if x else -1))
                most = max(most, now)
        if sum(same) * 10 >= 6 * len(item) and sum(same) >= min(9, len(item) - 1) or most >= 12:
            best = max(best, sum(same))
    return best


def test_no_overlap_that_counts_is_missed():
    assert all(decontaminate.sure(n) >= 1 for n in range(decontaminate.SHORTEST, 2000))
    rng = np.random.default_rng(5)
    for _ in range(1500):
        n = int(rng.integers(5, 60))
        items = [rng.integers(1, (40, 10**6)[rng.integers(0, 2)], n).astype(np.uint64) for _ in range(2)]
        index = decontaminate.Index([1, 2], items)
        text = items[0].copy()
        spoilt = np.arange(n) % rng.integers(2, 6) == 0 if rng.random() < 0.4 else rng.permutation(n) < rng.integers(0, n // 2 + 1)
        text[spoilt] = rng.integers(10**7, 10**8, spoilt.sum())
        text = np.concatenate((rng.integers(1, 40, rng.integers(0, 9)).astype(np.uint64), text[int(rng.integers(0, 4)) :]))
        got = {}
        for _, item, equal in index.overlaps(text, np.array([0, len(text)])):
            got[item] = max(equal, got.get(item, 0))
        want = {i: overlaps_that_count(list(text), list(x)) for i, x in enumerate(items)}
        assert got == {i: k for i, k in want.items() if k}


def test_every_fourth_token_replaced(spark):
    item = [f"t{k}" for k in range(40)]
    short = [[f"s{k}x{j}" for j in range(k)] for k in range(5, 10)]
    bench = spark.createDataFrame([(0, " ".join(item)), *((len(s), " ".join(s)) for s in short)], "item_id long, text string")
    docs = [(0, " ".join("new" if k % 4 == 0 else w for k, w in enumerate(item)))]
    docs += [(len(s), " ".join(["a", "b", *s[:2], "new", *s[3:], "c"])) for s in short]
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {k: [k] for k in (0, 5, 6, 7, 8, 9)}


def test_benchmark_in_blocks(spark, monkeypatch):
    items = [(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(40)]
    docs = spark.createDataFrame([(k, f"a b {t} c") for k, t in items], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_TOKENS", 800)
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: r["item_ids"] for r in got} == {k: [k] for k, _ in items}


def test_best_fit_decreasing():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50, 400):
        size = rng.integers(1, 65, n)
        row, rows = packing.best_fit_decreasing(size, 64)
        room, want = [], []
        for i in np.argsort(-size, kind="stable"):
            fits = [r for r in room if r >= size[i]]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - size[i])
            else:
                room.append(64 - size[i])
            want.append(size[i])
        used = np.bincount(row, size, rows) if n else np.zeros(0)
        assert rows == len(room) and (used <= 64).all() and sorted(64 - used) == sorted(room)


def test_packing_round_trip(spark, odd, none):
    ranks = packing.load_ranks()
    enc = packing.encoding(ranks)
    texts = [t for _, t, *_ in ODD] + ["a  b\n c", " lead", "trail ", "x \u00a0y z\u3000w", "it's  we'll\n\n\nend.\n", "ü ö\nä ß é"]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, row int")
    parts = {}
    for r in packing.pack(docs, ranks, row_len=256).collect():
        pos, cu = np.frombuffer(r["position_ids"], "<u2"), r["cu_seqlens"]
        assert len(pos) == 256 and cu[0] == 0 and cu[-1] == r["n_tokens"] <= 256
        for a, b in zip(cu[:-1], cu[1:], strict=True):
            assert (pos[a:b] == np.arange(b - a)).all()
        for doc, part, ids in packing.unpack(r.asDict()):
            assert (doc, part) not in parts
            parts[doc, part] = ids
    for k, t in enumerate(texts):
        mine = [parts[key] for key in sorted(parts) if key[0] == k]
        assert all(len(x) == 256 for x in mine[:-1])
        assert list(np.concatenate(mine)) == [*enc.encode_ordinary(t or ""), packing.END]
    assert packing.pack(none).count() == 0 and hashlib.sha256(b"").hexdigest()


def test_packing_takes_other_vocabularies(spark):
    other = {bytes([b]): b for b in range(256)} | {b" w": 70_000}
    docs = spark.createDataFrame([(1, "a w w b")], "doc_id long, text string")
    for ranks, kind in ((packing.load_ranks(), "<u2"), (other, "<i4")):
        (row,) = packing.pack(docs, ranks, row_len=16).collect()
        ((doc, part, ids),) = packing.unpack(row.asDict(), kind)
        assert len(row["input_ids"]) == 16 * np.dtype(kind).itemsize and (doc, part) == (1, 0)
        assert list(ids) == [*packing.encoding(ranks).encode_ordinary("a w w b"), max(ranks.values()) + 1]
    assert len(ids) == 6


def python_key(doc_id, text, weight, seed=42):
    """The key of a document as the module words it, by the public hash."""
    import xxhash

    h = 42
    for raw in (None if doc_id is None else str(doc_id).encode(), None if text is None else text.encode()):
        h = h if raw is None else xxhash.xxh64(raw, seed=h).intdigest()
    h = xxhash.xxh64(int(seed).to_bytes(4, "little"), seed=h).intdigest()
    return -np.log(((h % (1 << 52)) + 0.5) / (1 << 52)) / weight


def brute_mix(docs, targets):
    """Words taken of each (doc_id, text, source, weight): whole epochs, then by key until the rest is nearest."""
    out = [0] * len(docs)
    for source, target in targets.items():
        mine = [k for k, d in enumerate(docs) if d[2] == source]
        size = {k: len(words(docs[k][1])) for k in mine}
        total = sum(size.values())
        whole = min(2, int(target // total)) if total else 0
        rest, before = target - whole * total, 0
        for k in sorted(mine, key=lambda k: (python_key(docs[k][0], docs[k][1], docs[k][3]), -1 if docs[k][0] is None else docs[k][0], size[k])):
            more = whole < 2 and rest > 0 and before + size[k] / 2 <= rest
            out[k] = (whole + more) * size[k]
            before += size[k]
    return out


def test_mix_selects_by_key(spark):
    rng = np.random.default_rng(41)
    docs = [(int(rng.integers(0, 90)) if rng.random() < 0.9 else None, " ".join(f"w{x}" for x in rng.integers(0, 50, int(rng.integers(0, 30)))), [None, "a", "b", "c"][int(rng.integers(0, 4))], float(rng.choice([1.0, 0.25, 0.01]))) for _ in range(500)]
    table = spark.createDataFrame([(*d, 7, 8) for d in docs], "doc_id long, text string, source string, q double, cell int, tie int")
    rows = mixing.mix(table, quality=F.col("q")).collect()
    targets = {r["source"]: r["target"] for r in rows}
    want = sorted((str(d[0]), str(d[2]), t) for d, t in zip(docs, brute_mix(docs, targets), strict=True))
    assert sorted((str(r["doc_id"]), str(r["source"]), r["taken"]) for r in rows) == want
    # The same by a table of scores.
    numbered = table.withColumn("k", F.monotonically_increasing_id())
    again = mixing.mix(numbered, row_col="k", scores=numbered.select(F.col("k").alias("row"), F.col("q").alias("score"))).collect()
    assert sorted((str(r["doc_id"]), str(r["source"]), r["taken"]) for r in again) == want and len({r["row"] for r in again}) == 500


@pytest.mark.parametrize("weight", [1.0, 0.25, 1e-6])
def test_cells_are_even(spark, weight):
    u = (F.xxhash64("id") % (1 << 40) / F.lit(float(1 << 41))) + F.lit(0.5)
    sized = spark.range(40_000).select(F.lit("hot").alias("source"), (-F.log(u) / weight).alias("key"), F.lit(None).cast("long").alias("doc_id"), F.lit(5).alias("size"), F.col("id").alias("tie"))
    same = sized.withColumn("key", F.lit(1.0))  # rows alike in all but their place
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else small tables are one cell
    try:
        for table in (sized, same):
            n = [r["count"] for r in mixing.cells(table).groupBy("cell").count().collect()]
            assert sum(n) == 40_000 and len(n) >= 4 and max(n) < 1.5 * 40_000 / len(n)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_decontamination_of_any_script(spark):
    zh = "哪个城市是法国的首都并且有一条河流经过"
    ru = "Какой город является столицей Франции и стоит на реке Сена"
    items = [("zh", zh), ("ru", ru), ("sum", "1+1=2"), ("who", "Who wrote it?"), ("hi", "नमस्ते दुनिया यह एक परीक्षण वाक्य है"), ("one", "yes"), (None, zh)]
    fill = " ".join(f"filler{k}" for k in range(60))
    docs = [
        (1, f"{fill} {zh}。{fill}"), (2, f"{fill} {ru.upper()} {fill}"), (3, f"{fill} is 1+1=2 or not"), (4, f"so: WHO wrote it, then {fill}"),
        (5, f"{fill} 1, 1 and 2; who it wrote"), (6, "法国有一条河"), (7, zh[:8] + "镇" + zh[9:]), (8, "yes yes"), (9, items[4][1]), (10, ru.replace("Франции", "Италии")),
    ]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {1: ["zh"], 2: ["ru"], 3: ["sum"], 4: ["who"], 5: [], 6: [], 7: ["zh"], 8: [], 9: ["hi"], 10: ["ru"]}


def test_token_spans():
    import pyarrow as pa
    import unicodedata

    rng = np.random.default_rng(43)
    letters = list("aZ9 ,.-ß语文かไทยéй́ि\U0001f600 　´")
    texts = ["".join(rng.choice(letters, int(rng.integers(0, 40)))) for _ in range(300)] + ["", None, "é", "语"]
    alone = lambda c: any(a <= ord(c) <= b for a, b in decontaminate.UNSPACED)
    for part in (texts, ["plain ASCII only", ""]):
        (t,) = decontaminate.tokens(pa.array(part, pa.string()))
        raw = "".join(x or "" for x in part).encode()
        for k, text in enumerate(part):
            want, now = [], ""
            for c in text or "":
                inside = unicodedata.category(c)[0] in "LMN"
                if now and (not inside or alone(c)):
                    want, now = [*want, now], ""
                if inside and alone(c):
                    want.append(c)
                elif inside:
                    now += c
            want += [now] if now else []
            assert [raw[a:b].decode() for a, b in zip(t.start[t.offs[k] : t.offs[k + 1]], t.end[t.offs[k] : t.offs[k + 1]], strict=True)] == want


def test_decontamination_is_the_plain_one(spark):
    rng = np.random.default_rng(44)
    items = [(k, " ".join(f"w{x}" for x in rng.integers(0, 60, int(rng.integers(0, 30))))) for k in range(40)]
    docs = []
    for i in range(200):
        t = items[int(rng.integers(0, 40))][1].split()
        t = [x if rng.random() < 0.75 else f"n{rng.integers(0, 99)}" for x in t]
        docs.append((i if i % 9 else None, " ".join([f"w{x}" for x in rng.integers(0, 60, int(rng.integers(0, 12)))] + t)))
    want = {}
    for i, t in docs:
        mine = {k for k, x in items if len(x.split()) >= 5 and overlaps_that_count(t.split(), x.split())}
        mine |= {k for k, x in items if 2 <= len(x.split()) < 5 and f" {x} " in f" {t} "}
        want[i] = want.get(i, set()) | mine
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")).collect()
    assert len(got) == 200 and {r["doc_id"]: set(r["item_ids"]) for r in got} == want


def test_long_pieces_are_used():
    pieces = sorted([bytes([b]) for b in b" abcdefghijklmnop"] + [b" abcdefghi", b"abcdefghijk", b"abcdefghijklmn", b"bc", b"cdefghijklmnop"])
    look = language_id.Pieces(pieces)
    rng = np.random.default_rng(5)
    p = np.vstack([rng.random((len(pieces), 3)), np.zeros((1, 3))])
    prob = {w: p[i] for i, w in enumerate(pieces)}

    def total(s):
        return np.ones(3) if not s else sum((prob[s[:k]] * total(s[k:]) for k in range(1, len(s) + 1) if s[:k] in prob), np.zeros(3))

    words_ = [b"abcdefghijklmnop", b"abcdefghijkabcdefghi", b"bcdefghi", b"a"]
    lattice, order = language_id.Lattice.of(words_, look)
    out = np.empty((len(words_), 3))
    out[order] = lattice.forward(p)
    assert all(np.allclose(got, np.log(total(b" " + w))) for w, got in zip(words_, out, strict=True))
    known = language_id.load_pieces()
    assert max(map(len, known)) > 20 and set(known) >= {bytes([b]) for b in range(1, 256)}


def test_sample_is_bounded(spark):
    docs = spark.range(6000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    docs = docs.unionByName(spark.range(9000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang")))
    docs = docs.unionByName(spark.range(700).select(F.lit(5).cast("long").alias("doc_id"), F.lit("ein Text").alias("text"), F.lit("de").alias("lang")))
    known = docs.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    got = {r["lang"]: r["count"] for r in language_id.fit_sample(known, sizes, 600).groupBy("lang").count().collect()}
    assert 400 < got["en"] < 800 and got["de"] == 1


def test_packing_gives_any_bytes_back(spark):
    raw = [b"ab \xff\xfe cd", b"\xc3 x", b"a \xc3\x28 b caf\xc3\xa9 \x80", "é ü".encode(), b""]
    docs = spark.createDataFrame([(f"id{k}", bytearray(x)) for k, x in enumerate(raw)], "doc_id string, b binary").selectExpr("doc_id", "CAST(b AS string) AS text")
    enc, got = packing.encoding(packing.load_ranks()), {}
    for r in packing.pack(docs, row_len=64).collect():
        for doc, _, ids in packing.unpack(r.asDict()):
            assert ids[-1] == packing.END
            got[doc] = enc.decode_bytes([int(x) for x in ids[:-1]])
    assert got == {f"id{k}": x for k, x in enumerate(raw)}


def test_ridge_is_the_plain_one(spark):
    """Weights and scores against a plain solver on the same statistics."""
    rng = np.random.default_rng(46)
    docs = [(i, " ".join(rng.choice([f"word{k}" for k in range(40)], int(rng.integers(3, 60)))) + (" ###" * int(rng.integers(0, 9)) if i % 3 else ""), i % 3 == 0) for i in range(900)]
    table = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(q), 0) for i, _, q in docs], "doc_id long, quality int, toxic int")
    stats = quality_classifier.stats_table(table)
    model = quality_classifier.fit(stats, labels)
    rows = [(r["doc_id"], r["held_out"], np.frombuffer(r["stats"], "<f4").astype(float)) for r in stats.collect()]
    mark = {r["doc_id"]: r["m"] for r in table.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(quality_classifier.CALIBRATION_SHARE)) == 0).alias("m")).collect()}
    kind = {i: float(q) for i, _, q in docs}
    known = [(i, x) for i, held, x in rows if not held]
    x = np.stack([v for _, v in known])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale[x.std(0) > 1e-3], x.std(0)[x.std(0) > 1e-3], rtol=1e-4)
    fitted = [(i, v) for i, v in known if not mark[i]]
    z = model.features(np.stack([v for _, v in fitted]))
    y = np.array([kind[i] for i, _ in fitted])
    penalty = np.eye(z.shape[1]) * quality_classifier.RIDGE
    penalty[-1, -1] = 1e-6
    plain = np.linalg.lstsq(np.vstack([z, np.sqrt(penalty)]), np.concatenate([y, np.zeros(z.shape[1])]), rcond=None)[0]
    assert np.allclose(z @ model.weights, z @ plain, atol=1e-4)
    # The features' inner products are the Gaussian kernel, up to chance.
    a = np.clip((x[:60] - model.mean) / model.scale, -6, 6)
    kernel = np.exp(-quality_classifier.GAMMA * ((a[:, None] - a[None]) ** 2).sum(2))
    assert np.abs(model.features(x[:60])[:, :-1] @ model.features(x[:60])[:, :-1].T - kernel).mean() < 0.08
    again = quality_classifier.fit_documents(table, labels)
    assert np.allclose(again.weights, model.weights, atol=1e-6)


def test_many_shapes_of_rules(spark):
    rules = [("block", ".".join(["a"] * (1 + k % 7) + ["com"]), "/" + "x" * (k % 90)) for k in range(630)] + [("allow", "a.com", "/xx")]
    pages = spark.createDataFrame([(k, f"http://{'b.' * k}{'a.' * k}com/{'x' * (9 * k)}") for k in range(9)], "page_id int, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filters.judge_urls(pages, url_filters.rule_table(spark, rules)).collect()}
    for k in range(9):
        host, path = f"{'b.' * k}{'a.' * k}com", "/" + "x" * (9 * k)
        fits = [(len(h) + len(x), len(h), a, h + x) for a, h, x in rules if (host == h or host.endswith("." + h)) and path.startswith(x)]
        assert got[k] == ((max(fits)[3], max(fits)[2]) if fits else (None, "allow"))
