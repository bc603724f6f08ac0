import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlog.llm import common, components, near_dedup, suffix_dedup


def brute_near(docs, threshold=85):
    sets = {}
    for i, t in docs:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split() if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= threshold * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_texts():
    rng = np.random.default_rng(4)
    word = lambda n: [f"w{rng.integers(0, 5000)}" for _ in range(n)]
    docs = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "ONE  two"), (5, "one two three"), (6, "one two three four five"), (7, "one two three four five")]
    for g in range(12):
        base = word(int(rng.integers(8, 160)))
        for _ in range(9):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(0, len(w)))] = f"new{rng.integers(0, 10**6)}"
            if rng.random() < 0.3:
                w = w[: len(w) - int(rng.integers(0, 6))]
            docs.append((len(docs) + 100 * (g % 3), " ".join(w)))
    return list({i: (i, t) for i, t in docs}.values())


def test_near(spark):
    docs = near_texts()
    got = near_dedup.near_duplicates(spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, component int")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_near(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "BUCKET_ROWS", 4)
    docs = near_texts()
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in brute_near(docs).items()}


@pytest.mark.parametrize("hot", [1, 4])
def test_near_of_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    monkeypatch.setattr(near_dedup, "STAR", 3)
    docs = near_texts()
    docs += [(1000 + k, docs[20][1]) for k in range(20)]
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in brute_near(docs).items()}


def test_near_of_hot_hub_with_two_texts(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 1)
    left, right = ([f"{side}{k}" for k in range(80)] for side in "lr")
    rows = [(1, " ".join(left)), (1, " ".join(right))]
    rows += [(2 + k, " ".join([*(left if k % 2 else right), f"own{k}"])) for k in range(10)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {1}


def test_spread_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    rows = spark.createDataFrame([(None, 0), *((k, v) for k in range(6) for v in range(k + 1))], "k long, v long")
    table = spark.createDataFrame([(k, -k) for k in (1, 4, 5, 9)], "k long, w long")
    hot = common.hot_keys(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k")
    assert {r["k"] for r in hot.collect()} == {3, 4, 5}
    for how in ("inner", "left"):
        got, want = (sorted(df.select("k", "v", "w").collect(), key=str) for df in (common.spread_join(rows, table, "k", hot, how), rows.join(table, "k", how)))
        assert got == want
    assert common.hot_keys(rows.where("k < 2").groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k") is None


def test_near_odd(spark):
    long = " ".join(f"t{k}" for k in range(60_000))
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "p q r s t u"), (2, "a b c d e f"), (3, "p q r s t u"), (4, long), (5, long + " x")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(None, None, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False)}
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("at_once", [7, 100, 1 << 20])
def test_exact_links_in_ranges(monkeypatch, at_once):
    monkeypatch.setattr(near_dedup, "COUNTED_AT_ONCE", at_once)
    rng = np.random.default_rng(at_once)
    base = [rng.integers(0, 2**63, 40, dtype=np.uint64) * np.uint64(2) for _ in range(6)]
    sets = [np.unique(np.concatenate((b[rng.random(40) < 0.95], rng.integers(0, 2**63, rng.integers(0, 4), dtype=np.uint64)))) for b in base for _ in range(5)]
    for first in (0, 13):
        up = list(range(len(sets)))
        for i, j in near_dedup.exact_links(sets, first, 85):
            assert (not first or i < first <= j) and up[i] != up[j]
            up = [up[i] if x == up[j] else x for x in up]
        want = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i + 1, len(sets)):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both) and (not first or i < first <= j):
                    want = [want[i] if x == want[j] else x for x in want]
        assert len(set(zip(up, want, strict=True))) == len(set(up)) == len(set(want))


def test_estimate():
    rng = np.random.default_rng(6)
    both, x, y = (rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) for n in (6000, 1000, 1000))
    a, _ = near_dedup.sketch(np.unique(np.concatenate((both, x))))
    b, _ = near_dedup.sketch(np.unique(np.concatenate((both, y))))
    j, n = near_dedup.estimate(a[None], b[None])
    assert n[0] == near_dedup.REGISTERS and abs(j[0] - 0.75) < 0.15


@pytest.mark.parametrize("hot", [2, 1024])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    rng = np.random.default_rng(7)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(1000 + k, 1001 + k) for k in range(40)] + [(2000, 2001 + k) for k in range(60)]
    up = {i: i for e in links for i in e}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: root(i) for a, b in links if a != b for i in (a, b)}


def brute_substrings(docs):
    order = sorted((2**63 - 1 if i is None else i, (t or "").encode()) for i, t in docs)
    first = {}
    for i, b in order:
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    out = {}
    for i, b in order:
        gone = bytearray(len(b) + 1)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out[i, b] = (len(b), sum(gone), sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


def substring_texts():
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdé \n"))
    make = lambda n: "".join(rng.choice(letters, n))
    shared = [make(int(n)) for n in rng.integers(30, 200, 12)]
    docs = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 120), (None, "x" * 70), (6, make(3000)), (6, make(80) + shared[0])]
    for i in range(10, 70):
        parts = [make(int(rng.integers(0, 90))) for _ in range(3)]
        a, b = rng.integers(0, 12, 2)
        cut = int(rng.integers(0, 40))
        docs.append((i, parts[0] + shared[a][cut:] + parts[1] + shared[b] + parts[2]))
    docs += [(80, docs[20][1]), (81, docs[20][1]), (82, "ab" * 200), (83, "z" + "ab" * 100), (84, "ab" * 30 + "c")]
    return docs


def test_substrings(spark):
    docs = substring_texts()
    got = suffix_dedup.dedup_substrings(spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, ord int")).collect()
    want = brute_substrings(docs)
    assert sorted((2**63 - 1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted((2**63 - 1 if i is None else i, *want[2**63 - 1 if i is None else i, (t or "").encode()]) for i, t in docs)


def test_substrings_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SORT_ROWS", 50)
    monkeypatch.setattr(suffix_dedup, "BLOCK_TEXT", 300)
    docs = [(i, t) for i, t in substring_texts() if i is not None]
    got = suffix_dedup.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = brute_substrings(docs)
    assert sorted((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in got) == sorted((i, want[i, (t or "").encode()][1], want[i, (t or "").encode()][3]) for i, t in docs)


def test_substrings_empty(spark):
    assert suffix_dedup.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cover_meets_every_pair():
    for a in range(suffix_dedup.PERIOD):
        for b in range(suffix_dedup.PERIOD):
            assert any((a + d) % suffix_dedup.PERIOD in suffix_dedup.COVER and (b + d) % suffix_dedup.PERIOD in suffix_dedup.COVER for d in range(suffix_dedup.PERIOD))


def test_cover_ranks_are_suffix_order():
    rng = np.random.default_rng(9)
    text, inside = np.zeros(700, np.uint8), np.zeros(700, bool)
    for base in (0, 210, 420):
        text[base : base + 150] = rng.choice([97, 98], 150)
        inside[base : base + 150] = True
    text[430:500] = text[10:80]
    rank = suffix_dedup.cover_ranks(text, inside, 150)
    at = [i for i in np.flatnonzero(inside) if i % suffix_dedup.PERIOD in suffix_dedup.COVER]
    ends = {i: i - i % 210 + 150 for i in at}
    assert sorted(at, key=lambda i: rank[i]) == sorted(at, key=lambda i: bytes(text[i : ends[i]]))


@pytest.mark.parametrize("stage", range(4))
def test_pipeline_stages(spark, stage, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(10)
    words = [f"w{k}" for k in range(900)]
    docs = [(i, " ".join(rng.choice(words, 80)), "en", f"s{i % 4}", 0) for i in range(120)]
    docs += [(200, docs[3][1], "en", "s1", 0), (201, docs[5][1] + " tail", "en", "s1", 0), (None, docs[7][1], None, None, None), (202, None, "en", "s1", 0)]
    folder = str(tmp_path)
    spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, docs[9][1])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.STAGES[stage][1](spark, table, folder)
    assert out.columns == table.columns
    ids = [r["doc_id"] for r in out.collect()]
    everything = {d[0] for d in docs}
    if stage == 0:
        assert set(ids) == everything
    elif stage == 1:
        assert set(ids) == everything - {200, 201} and len(ids) == len(docs) - 2
    elif stage == 2:
        assert set(ids) == everything - {9}
    else:
        assert max(ids.count(i) for i in everything) <= 2 and sum(len(d[1].split()) * ids.count(d[0]) for d in docs if d[1]) == pytest.approx(1.5 * 80 * 123, rel=0.1)
    assert pipeline.STAGES[4][1](spark, out.limit(3), folder).count() >= 1


def test_pipeline_drops_near_copies_from_80(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(12)
    docs = []
    for i in range(12):
        base = [f"w{k}" for k in rng.integers(0, 10**6, 80)]
        near, far = list(base), list(base)
        near[40:43] = ["new1", "new2", "new3"]  # 69 of 83 shingles: 0.83
        far[40:46] = [f"new{k}" for k in range(6)]  # 66 of 86 shingles: 0.77
        docs += [(i, " ".join(base)), (100 + i, " ".join(near)), (200 + i, " ".join(far))]
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in pipeline.near_duplicates(spark, table, "").collect()}
    assert kept == {i for i, _ in docs if not 100 <= i < 200}


def test_pipeline_judges_rows(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(13)
    text = [" ".join(f"w{k}" for k in rng.integers(0, 10**6, 60)) for _ in range(6)]
    spark.createDataFrame([(1, text[0])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = lambda rows: spark.createDataFrame([(i, t, None, None, None) for i, t in rows], kind)
    # A null id with a passage goes and a clean one stays; of one id only the text with the passage goes.
    rows = [(None, "x " + text[0]), (None, text[1]), (1, text[0]), (1, text[2]), (2, text[3]), (2, text[3])]
    out = pipeline.decontamination(spark, docs(rows), str(tmp_path))
    assert out.columns == docs(rows).columns
    assert sorted(r["text"] for r in out.collect()) == sorted([text[1], text[2], text[3], text[3]])
    # A row given twice stays once; a near copy doesn't take another text of its id with it.
    rows = [(5, text[3]), (5, text[3]), (3, text[4]), (7, text[4] + " tail"), (7, text[5]), (None, text[5])]
    out = pipeline.near_duplicates(spark, docs(rows), str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out) == sorted([(5, text[3]), (3, text[4]), (7, text[5]), (0, text[5])])


def test_pipeline_drops_bad_rows_without_id(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(14)
    good = lambda: " ".join(rng.choice([f"word{k}" for k in range(300)], 60))
    bad = lambda: " ".join(rng.choice(["$$$", "###", "|||", "%%"], 60))
    rows = [(i, good() if i % 2 else bad()) for i in range(400)] + [(None, bad()), (None, good())]
    table = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = pipeline.quality(spark, table, str(tmp_path)).collect()
    assert [r["text"] for r in out if r["doc_id"] is None] == [rows[-1][1]] and sum(r["doc_id"] is not None for r in out) == 200


def test_mixing_takes_the_scores_of_the_quality_stage(spark, tmp_path, monkeypatch):
    from strandlog.llm import quality_classifier

    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(15)
    text = lambda k: " ".join(rng.choice(["$$$", "###", "|||"] if k % 5 == 0 else [f"word{n}" for n in range(300)], 60))
    rows = [(i, text(i), None, "ab"[i % 2], None) for i in range(200)] + [(None, text(1), None, "a", None), (3, text(1), None, "b", None), (7, None, None, "a", None)]
    table = spark.createDataFrame([*rows, rows[2]], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet").where("text is not null")
    learned = sorted(map(str, pipeline.mixture(spark, kept, str(tmp_path)).collect()))  # by itself
    pipeline.quality(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).count()
    with monkeypatch.context() as m:
        m.setattr(quality_classifier, "fit_documents", None)  # the scores are there: nothing is learned
        out = pipeline.mixture(spark, kept, str(tmp_path))
        assert sorted(map(str, out.collect())) == learned
        assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
    # A row the quality stage has not seen, or other labels: learned anew.
    other = kept.unionByName(spark.createDataFrame([(900, text(1), None, "a", None)], kept.schema))
    assert any(r["doc_id"] == 900 for r in pipeline.mixture(spark, other, str(tmp_path)).collect())
    before = pipeline._scores_path(spark, str(tmp_path))
    spark.createDataFrame([(5, 0, 0)], "doc_id long, quality int, toxic int").write.mode("append").parquet(f"{tmp_path}/labels.parquet")
    assert pipeline._scores_path(spark, str(tmp_path)) != before


def test_large_sets_are_counted_in_whole_numbers():
    # 671,109 of 789,540 shingles are 85 per cent and a hair; one less is under it. float32 can't tell.
    values = np.arange(1, 789_541, dtype=np.uint64) * np.uint64(2_000_003)
    one, two = values[: 671_109 + 60_000], np.concatenate((values[:671_109], values[671_109 + 60_000 :]))
    assert near_dedup.shared(one, two) == 671_109 and len(np.union1d(one, two)) == 789_540
    assert near_dedup.exact_links([one, two], 0, 85) == [(0, 1)] and near_dedup.enough(671_109, len(one), len(two), 85)
    fewer = np.concatenate((values[:671_108], values[671_109 + 60_000 :], values[:1] - np.uint64(1)))
    fewer.sort()
    assert near_dedup.exact_links([one, fewer], 0, 85) == [] and not near_dedup.enough(671_108, len(one), len(fewer), 85)


def test_near_takes_any_id(spark):
    docs = [(f"id{i:04d}", t) for i, t in near_texts()]
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id string, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {f"id{i:04d}": f"id{c:04d}" for i, (_, c) in brute_near(near_texts()).items()}


def test_bucket_forest():
    """Of rows of one bucket, the forest joins what any chain of pairs of two labels joins."""
    rng = np.random.default_rng(21)
    base = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))
    sets = [np.unique(np.concatenate((base[rng.random(len(base)) < keep], rng.integers(0, 2**63, 3, dtype=np.uint64)))) for keep in rng.choice([0.97, 0.9, 0.6, 0.3], 70)]
    regs, size = np.stack([near_dedup.sketch(s)[0] for s in sets]), np.array([len(s) for s in sets])
    for n in (20, 70):
        for sides in (np.full(n, -1), rng.integers(0, 2, n)):
            label, key = rng.integers(0, 12, n), np.zeros(n, np.int64)
            forest, want = near_dedup._Forest(n), near_dedup._Forest(n)
            for i, j in near_dedup.bucket_links(key, regs[:n], size[:n], label, sides, 0.85):
                assert label[i] != label[j] and forest.join(i, j)
            for i in range(n):
                for j in range(i + 1, n):
                    if label[i] != label[j] and (sides[i] < 0 or sides[i] != sides[j]) and near_dedup._may(regs, size, np.array([i]), np.array([j]), 0.85)[0]:
                        want.join(i, j)
            assert [forest.root(i) for i in range(n)] == [want.root(i) for i in range(n)]


def test_suffix_order_of_any_residues():
    """Cover comparison alone puts suffixes of all residues into their order."""
    rng = np.random.default_rng(31)
    period, gap = suffix_dedup.PERIOD, 2 * suffix_dedup.PERIOD
    for letters in ([97], [97, 98], [97, 98, 99, 100]):
        text, inside, ends, base = np.zeros(4000, np.uint8), np.zeros(4000, bool), np.zeros(4000, np.int64), 3
        shared = rng.choice(letters, 90)
        for k in range(14):
            n = int(rng.integers(50, 160))
            body = rng.choice(letters, n)
            body[5 : 5 + min(90, n - 5)] = shared[: min(90, n - 5)]
            text[base : base + n], inside[base : base + n], ends[base : base + n] = body, True, base + n
            base += n + gap + k
        at = rng.permutation(np.flatnonzero(inside))
        rank = suffix_dedup.cover_ranks(text, inside, 160)
        got = suffix_dedup.suffix_order(text, at, rank)
        key = lambda i: bytes(text[i : ends[i]])  # noqa: E731, B023
        assert [key(i) for i in got] == sorted(key(i) for i in at) and sorted(got) == sorted(at)
        assert len({i % period for i in got}) == period
        parts = np.concatenate(list(suffix_dedup.window_order(text, at, rank)))
        assert [key(i) for i in parts] == [key(i) for i in got]


def test_substrings_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 500)
    monkeypatch.setattr(suffix_dedup, "SORT_ROWS", 50)
    monkeypatch.setattr(suffix_dedup, "BLOCK_TEXT", 300)
    docs = [(i, t) for i, t in substring_texts() if i is not None]
    docs += [(200, "q" * 30 + docs[6][1][100:2500] + "r" * 900), (201, docs[6][1][1000:1060] + "s" * 40)]
    got = suffix_dedup.dedup_substrings(spark.createDataFrame(docs, "doc_id int, text string")).collect()
    want = brute_substrings(docs)
    assert sorted((r["doc_id"], *(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256"))) for r in got) == sorted((i, *want[i, (t or "").encode()]) for i, t in docs)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("strandlog_texts")]
    with pytest.raises(TypeError, match="whole numbers"):
        suffix_dedup.dedup_substrings(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_pieces_cover_every_window_once():
    for sizes in ([0, 10, 49, 50, 51], [3000], [700 * 1024], [suffix_dedup.PIECE, 5, 3 * suffix_dedup.PIECE + 49, 3 * suffix_dedup.PIECE + 50]):
        offs = np.concatenate(([0], np.cumsum(sizes)))
        seen = []
        for lo, to, own, first in suffix_dedup.pieces(offs):
            assert to - lo == own[-1]
            for k in range(len(own) - 1):
                seen += [(first + k, w) for w in (lo + own[k], lo + own[k + 1] - 50) if own[k + 1] - own[k] >= 50] and [(first + k, lo + int(own[k]), lo + int(own[k + 1]) - 49)] if own[k + 1] - own[k] >= 50 else []
        for doc, n in enumerate(sizes):
            mine = sorted(x[1:] for x in seen if x[0] == doc)
            assert not mine if n < 50 else (mine[0][0] == offs[doc] and mine[-1][1] == offs[doc + 1] - 49 and all(a[1] == b[0] for a, b in zip(mine, mine[1:], strict=False)))


ODD_KIND = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, _row int, key int, doc string, epochs int"


def plain_targets(docs):
    """Targets of sources by resharing, as the contract words it."""
    names = sorted({d[2] for d in docs if d[2] is not None}) + ([None] if any(d[2] is None for d in docs) else [])
    size = {s: sum(len((d[1] or "").split()) for d in docs if d[2] == s) for s in names}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    want, free, left = {}, set(names), 1.5 * sum(size.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            return want | share
        for s in over:
            want[s] = 2.0 * size[s]
            left -= want[s]
            free.discard(s)
    return want


def test_pipeline_is_the_plain_one(spark, tmp_path):
    """All five stages through ``run`` against plain Python, on odd rows and labels of both kinds."""
    from collections import Counter

    from strandlog.llm import packing, quality_classifier
    from tests.llm.test_rowwise import brute_mix, overlaps_that_count

    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(51)
    good = lambda n=60: " ".join(f"word{k}" for k in rng.integers(0, 900, n)) + "."
    bad = lambda: " ".join(rng.choice(["$$$", "###", "|||", "%%"], 60))
    source = lambda: [None, "a", "b", "c"][int(rng.integers(0, 4))]
    docs = [(i, bad() if i % 5 == 0 else good(int(rng.integers(30, 90))), source()) for i in range(160)]
    items = [(1, good(30)), (2, good(20)), (3, None)]
    docs += [(200, docs[1][1], "a"), (201, docs[2][1] + " tail", "b"), (3, docs[4][1], "c"), (3, good(), "a"), (6, docs[6][1], docs[6][2])]
    docs += [(None, bad(), "a"), (None, good(), None), (None, good(10) + " " + items[0][1], "b"), (210, good(9) + " " + items[1][1] + " x", "a"), (7, items[0][1], "c")]
    table = spark.createDataFrame([(i, t, "en", s, None, f"x{k}", k, k, "d", 9) for k, (i, t, s) in enumerate(docs)], ODD_KIND).repartition(3)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(160)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    judged = quality_classifier.classify(table.withColumn("doc_id", F.struct("doc_id", "_row")).withColumn("own", F.col("doc_id.doc_id")).select("doc_id", "text"), labels.select(F.struct("doc_id", F.lit(0).alias("_row")).alias("doc_id"), "quality"))
    assert judged.count() == len(docs)
    kept = [d for d in docs if not d[1].startswith(("$$$", "###", "|||", "%%"))]
    near = brute_near([(k, t) for k, (i, t, _) in enumerate(kept) if i is not None], 80)
    first = {}
    for k, (_, c) in near.items():
        first[c] = min(first.get(c, (10**9, 0)), (kept[k][0], k))
    kept = [d for k, d in enumerate(kept) if d[0] is None or (d[0], k) in first.values()]
    tokens = lambda t: t.replace(".", " ").split()
    kept = [d for d in kept if not any(t and overlaps_that_count(tokens(d[1]), tokens(t)) for _, t in items)]
    # The classifier's scores, learned apart from the stages.
    model = quality_classifier.fit(quality_classifier.stats_table(table.select("doc_id", "text")), labels)
    scores = {bytes(r["stats"]): None for r in quality_classifier.stats_table(table.select("doc_id", "text")).collect()}
    for raw in scores:
        scores[raw] = float(model.score(np.frombuffer(raw, "<f4").astype(float)[None])[0])
    of_text = {t: bytes(quality_classifier.document_stats(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])).astype("<f4").tobytes()) for _, t, _ in docs}
    weighted = [(*d, max(scores[of_text[d[1]]], 1e-6)) for d in kept]
    taken = brute_mix(weighted, plain_targets(kept))
    want = Counter()
    for d, n in zip(kept, taken, strict=True):
        want[d[0], d[1]] += n // len(d[1].split())

    enc, parts = packing.encoding(packing.load_ranks()), Counter()
    pieces = {}
    for r in pipeline.run(spark, str(tmp_path)).collect():
        for doc, part, ids in packing.unpack(r.asDict()):
            assert part == 0  # all are shorter than a row
            parts[doc, enc.decode([int(x) for x in ids[:-1]])] += 1
    assert parts == Counter({k: n for k, n in want.items() if n}) and not pieces
    docs_in = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs_in, str(tmp_path)).columns == docs_in.columns
        assert stage(spark, docs_in.limit(0), str(tmp_path)).count() == 0
