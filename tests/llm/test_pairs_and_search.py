"""Near copies, passages, exact search, and the graph they share, against brute force."""

import difflib
import os
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewatch.llm import bitsliced, chains, simhash
from tidewatch.llm.components import components
from tests.llm.conftest import ODD
from tests.llm.test_text_ops import words


def connected(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))]
    pairs += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    real = [(a, b) for a, b in pairs if a != b]
    assert found == connected({n for p in real for n in p}, real)
    assert components(edges.limit(0)).count() == 0


# -- SimHash --------------------------------------------------------------------------


def brute_fingerprint(text):
    w = [x.encode() for x in words((text or "").translate(str.maketrans({c: c.lower() for c in map(chr, range(65, 91))})))]
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(documents):
    rows = [r for r in ODD if r[0]] + [(20, "A b C"), (21, "a b c d"), (22, "a b c d e a b c d e")]
    found = sorted((r.id, r.fp % (1 << 64)) for r in simhash.fingerprints(documents(rows)).collect())
    assert found == sorted((i, brute_fingerprint(t)) for i, t in rows)


@pytest.mark.parametrize("blocks, small, chunk", [(None, 64, 1024), (5, 2, 8), (7, 64, 1024), (8, 0, 4)])
def test_links_find_every_near_pair(spark, blocks, small, chunk):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for f in base[:20]:
        for _ in range(12):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            fps.add(int(f) ^ sum(1 << int(b) for b in flips))
    fps = sorted(np.array(sorted(fps), np.uint64).view(np.int64).tolist())
    near = [
        (a, b) for i, a in enumerate(fps) for b in fps[i + 1 :]
        if bin((a ^ b) & (2**64 - 1)).count("1") <= 4
    ]
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = {r.node: r.component for r in components(simhash.links(rows, 4, blocks, small, chunk)).collect()}
    want = connected({n for p in near for n in p}, near)
    assert found == want


def test_near_duplicates_keep_one(documents):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(9, text), (3, text), (3, text), (5, text + " more"), (7, "quite another text of its own"), (1, None), (2, "")]
    docs = documents(rows)
    found = {(r.id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {(9, 3), (3, 3), (7, 7), (1, 1), (2, 1)} <= found
    kept = sorted(r.doc_id for r in simhash.keep_one(docs).collect())
    assert kept.count(3) == 1 and 9 not in kept and 7 in kept and 1 in kept and 2 not in kept


def test_simhash_odd_rows(odd):
    clash = odd.withColumn("id", F.lit("x")).withColumn("fp", F.lit(0))
    assert simhash.near_duplicates(clash).count() == len(ODD)
    assert simhash.keep_one(clash).columns == clash.columns
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    assert simhash.keep_one(odd.limit(0)).count() == 0


# -- passages -------------------------------------------------------------------------


def test_fenwick_is_a_prefix_maximum():
    rng = np.random.default_rng(2)
    tree, values = chains.Fenwick(50), {}
    for i in range(300):
        key, value = int(rng.integers(50)), float(rng.normal())
        tree.put(key, value, i)
        values.setdefault(key, []).append((value, i))
        at = int(rng.integers(50))
        seen = [v for k, vs in values.items() if k <= at for v in vs]
        assert tree.up_to(at) == (max(seen) if seen else (float("-inf"), -1))


def test_chain_is_the_best_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(2, 9))
        x, y, size = rng.integers(0, 60, n), rng.integers(0, 60, n), rng.integers(3, 9, n)
        rows = np.stack([x, x + size, y, y + size], 1)
        value = {}
        for i in sorted(range(n), key=lambda i: x[i]):
            gains = [
                value[j] - 0.3 * (x[i] - rows[j, 1] + y[i] - rows[j, 3])
                for j in value if rows[j, 1] <= x[i] and rows[j, 3] <= y[i]
            ]
            value[i] = size[i] + max([0.0, *gains])
        best = chains.chain(rows, 0.3)[0]
        got = sum(size[i] for i in best) - 0.3 * sum(
            rows[b, 0] - rows[a, 1] + rows[b, 2] - rows[a, 3] for a, b in zip(best, best[1:])
        )
        assert got == pytest.approx(max(value.values()))


def test_minimizers_meet_in_any_shared_stretch():
    rng = np.random.default_rng(5)
    shared = rng.integers(0, 2**63, 14, dtype=np.uint64)
    for _ in range(50):
        kept = []
        for _ in range(2):
            a, b = (rng.integers(0, 2**63, int(rng.integers(0, 30)), dtype=np.uint64) for _ in "ab")
            h = chains.shingle_hashes(np.concatenate([a, shared, b]), 5)
            kept.append(set(h[chains.minimizers(h, np.zeros(len(h), np.int64), 10)].tolist()))
        assert kept[0] & kept[1]


def test_passages_are_found_and_clean_texts_are_not(documents):
    rng = np.random.default_rng(6)
    text = lambda n: [f"w{int(i)}" for i in rng.integers(0, 10**9, n)]
    passage, far = text(60), text(400)
    fuzzy = list(passage)
    for i in (11, 29, 30, 47):
        fuzzy[i] = "changed"
    del fuzzy[20]
    rows = [
        (10, text(80) + passage + text(70)), (11, text(5) + passage), (12, fuzzy + text(90)),
        (13, text(200)), (14, far), (15, far), (16, text(30) + passage[:20]),
    ]
    docs = documents([(i, " ".join(w)) for i, w in rows])
    found = {(r.id, r.first_id): r for r in chains.passages(docs).collect()}
    assert set(found) == {(11, 10), (12, 10), (15, 14)}
    r = found[11, 10]
    assert (r.begin, r.end, r.first_begin, r.first_end, r.agreeing) == (5, 65, 80, 140, 60)
    r = found[12, 10]
    assert r.end - r.begin >= 50 and r.agreeing >= 0.8 * (r.end - r.begin)
    assert (found[15, 14].begin, found[15, 14].end) == (0, 400)


def test_passages_match_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: words(r.text.lower()) for r in docs.collect()}
    covered = {i: set() for i in texts}
    for r in chains.passages(docs).collect():
        covered[r.id].update(range(r.begin, r.end))
        a, b = texts[r.id][r.begin : r.end], texts[r.first_id][r.first_begin : r.first_end]
        same = sum(m.size for m in difflib.SequenceMatcher(None, a, b, False).get_matching_blocks())
        assert same >= 0.78 * max(len(a), len(b))
    first, missing, shared = {}, 0, 0
    for i in sorted(texts):
        for j in range(len(texts[i]) - 59):
            gram = tuple(texts[i][j : j + 60])
            if first.setdefault(gram, i) != i:
                shared += 1
                missing += not set(range(j + 5, j + 55)) <= covered[i]
    assert shared > 100 and missing <= 0.01 * shared


def test_passages_of_sentences_seen_earlier_elsewhere(documents):
    rng = np.random.default_rng(8)
    text = lambda n: [f"w{int(i)}" for i in rng.integers(0, 10**9, n)]
    rows, wanted, id_ = [], set(), 0
    for sentences in ((35, 35), (39, 39, 39), (30, 30, 30), (20, 20, 20, 20)):
        for _ in range(10):
            parts = [text(n) for n in sentences]
            for part in parts:
                rows.append((id_, text(20) + part + text(20)))
                id_ += 1
            rows += [(id_, text(50) + sum(parts, []) + text(9)), (id_ + 1, text(9) + sum(parts, []) + text(50))]
            wanted.add((id_ + 1, id_))
            id_ += 2
    found = {(r.id, r.first_id) for r in chains.passages(documents([(i, " ".join(w)) for i, w in rows])).collect()}
    assert found == wanted


def test_fuzzy_passages_are_found(documents):
    rng = np.random.default_rng(9)
    text = lambda n: [f"w{int(i)}" for i in rng.integers(0, 10**9, n)]
    rows, kinds = [], {}
    for n in (40, 50, 60, 80, 100):
        for share in (0.05, 0.1, 0.12, 0.15, 0.18, 0.2):
            for _ in range(20):
                passage = text(n)
                # the ends stay: a changed word there only makes the passage shorter
                fuzzy = list(passage)
                for i in rng.choice(np.arange(1, n - 1), int(share * n), replace=False):
                    fuzzy[i] = text(1)[0]
                kinds[len(rows) + 1] = n, share
                rows += [text(30) + passage + text(40), text(60) + fuzzy + text(10)]
    docs = documents([(i, " ".join(w)) for i, w in enumerate(rows)])
    found = {(r.id, r.first_id) for r in chains.passages(docs).collect()}
    assert found <= {(i, i - 1) for i in kinds}
    per = {k: [(i, i - 1) in found for i in kinds if kinds[i] == k] for k in kinds.values()}
    recall = {k: sum(hits) / len(hits) for k, hits in per.items()}
    print(recall)
    assert all(r == 1 for (_, share), r in recall.items() if share <= 0.15), recall
    assert min(recall.values()) >= 0.9, recall


@pytest.mark.parametrize("copies", [1, 15])
def test_passages_whose_parts_were_all_seen_earlier_elsewhere(documents, copies):
    """No document is the first of two runs of the passage that two later ones share."""
    rng = np.random.default_rng(10)
    text = lambda n: [f"w{int(i)}" for i in rng.integers(0, 10**9, n)]
    runs = [text(9) for _ in range(7)]
    rows = [text(20) + run + text(20) for run in runs for _ in range(copies)]
    fuzzy = lambda: text(30) + sum((run + text(1) for run in runs), []) + text(30)
    rows += [fuzzy(), fuzzy()]
    docs = documents([(i, " ".join(w)) for i, w in enumerate(rows)])
    found = {(r.id, r.first_id) for r in chains.passages(docs).collect()}
    assert found == {(len(rows) - 1, len(rows) - 2)}


def test_passages_odd_rows(odd):
    found = {(r.id, r.first_id) for r in chains.passages(odd).collect()}
    assert found == set()
    assert chains.passages(odd.limit(0)).count() == 0


# -- bit-sliced search ----------------------------------------------------------------


def brute_top(rows, k, scale=256):
    fine = [(i, [int(np.floor(x * scale)) for x in v]) for i, v in rows if i is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in dict((i, v) for i, v in fine if i % 50 == 0).items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def test_search_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 9)]) for i in range(300)]
    rows += [(300 + i, list(rows[7][1])) for i in range(20)]  # ties at every query's boundary
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")]), (403, [float("inf")]), (450, []), (451, [0.5]), (None, [0.1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    for blocks in ((8192, 2048), (37, 2)):
        found = bitsliced.top_k(vectors, F.col("id") % 50 == 0, block_rows=blocks[0], block_queries=blocks[1])
        assert {tuple(r) for r in found.collect()} == brute_top(rows, 5)


def test_search_small_tables(spark):
    vectors = spark.createDataFrame([(0, [1.0]), (1, [-2.0])], "vec_id long, embedding array<double>")
    found = [tuple(r) for r in bitsliced.top_k(vectors, F.col("id") % 50 == 0).collect()]
    assert found == [(0, 1, 1, -131072)]
    assert bitsliced.top_k(vectors.limit(0), F.lit(True)).count() == 0
    assert bitsliced.top_k(vectors.where("vec_id = 0"), F.lit(True)).count() == 0


def _with_a_passage(documents):
    rng = np.random.default_rng(11)
    text = lambda n: [f"w{k}" for k in rng.integers(0, 100_000, n)]
    shared = text(60)
    return documents([(i, " ".join(text(400) + shared + text(200))) for i in range(24)])


def test_passages_leave_no_shuffle_behind(spark, documents):
    docs = _with_a_passage(documents)

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}

    def left():  # files go in the background
        return sum(os.path.getsize(f) for f in shuffles() - before if os.path.exists(f))

    before = shuffles()
    found = chains.passages(docs)
    until = time.time() + 10
    while left() > 2_000 and time.time() < until:  # sums of the whole table stay, a row each
        time.sleep(0.2)
    assert left() <= 2_000
    assert found.count() > 0


def test_passages_in_rounds_are_the_same(documents, monkeypatch):
    docs = _with_a_passage(documents)
    once = sorted(map(tuple, chains.passages(docs).collect()))
    monkeypatch.setattr(chains, "_ROUND", 0.3)
    assert sorted(map(tuple, chains.passages(docs).collect())) == once
    assert {r[1] for r in once} >= {0} and {r[0] for r in once} == set(range(1, 24))


@pytest.mark.parametrize("few", [1, 2, 5])
def test_links_of_seeds_by_brute_force(spark, few):
    rng = np.random.default_rng(few)
    rows = []
    for seed in range(12):
        many, seen = bool(rng.random() < 0.3), set()
        n = int(rng.integers(1, 30))
        for id_, pos in sorted(zip(rng.integers(0, 20, n).tolist(), rng.permutation(99)[:n].tolist())):
            rows.append((seed, id_, pos, 1, id_ in seen, many))
            seen.add(id_)
    expect = []
    for seed in range(12):
        mine = sorted((r for r in rows if r[0] == seed), key=lambda r: (r[4], r[1], r[2]))
        for n, r in enumerate(mine):
            firsts = [o for o in mine[:n][: 1 if r[5] else few] if not o[4]]
            firsts = firsts if r[4] or n < few else firsts[:1]
            expect += [(*r[1:4], *o[1:4]) for o in firsts if o[1] < r[1]]
    found = spark.createDataFrame(rows, "seed long, id long, pos int, run int, again boolean, many boolean")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert sorted(map(tuple, chains.linked(found, few).collect())) == sorted(expect)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_text_is_sent_once_for_its_chains(documents, monkeypatch, tmp_path):
    docs = _with_a_passage(documents)
    once = sorted(map(tuple, chains.passages(docs).collect()))
    real = chains._aligned

    def watched(*args):
        run = real(*args)

        def seen(batches):
            for batch in batches:
                if batch.num_rows:
                    (tmp_path / f"{time.time_ns()}").write_text(" ".join(map(str, batch["id"].to_pylist())))
                yield from run([batch])

        return seen

    monkeypatch.setattr(chains, "_aligned", watched)
    for turn, most in ((2_000, 1), (10, 3)):  # a hot first's chains are dealt to turns
        monkeypatch.setattr(chains, "_TURN", turn)
        assert sorted(map(tuple, chains.passages(docs).collect())) == once
        sent = [int(i) for p in tmp_path.iterdir() for i in p.read_text().split()]
        assert sent.count(0) <= most and max(map(sent.count, sent)) <= most
        [p.write_text("") for p in tmp_path.iterdir()]
