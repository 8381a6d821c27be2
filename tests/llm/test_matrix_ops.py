"""Ranked search, sharding, the filter audit and the matrices below, against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import audit, matrix, ranked, sharding
from tests.llm.conftest import DOCUMENTS, LONG, ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def prose(seed, n, words=60, vocabulary=300):
    rng = np.random.default_rng(seed)
    odds = 1 / np.arange(1, vocabulary + 1)
    picks = [rng.choice(vocabulary, rng.integers(1, words), p=odds / odds.sum()) for _ in range(n)]
    return [" ".join(f"w{i}" for i in p) for p in picks]


# -- matrices --------------------------------------------------------------------------


@pytest.mark.parametrize("most", [64, 1 << 20])
def test_matrix_against_counters(documents, most):
    texts = [r[1] for r in ODD] + prose(1, 50)
    docs = documents(list(enumerate(texts)))
    shards = matrix.term_shards(docs, ["doc_id"], most=most)
    codes = matrix.encode(shards, keep_terms=True)
    terms = {r.term_id: r.term for r in codes.where("term IS NOT NULL").collect()}
    assert sorted(terms) == list(range(len(terms)))
    assert len(set(terms.values())) == len(terms)
    found = {}
    for s in matrix.global_shards(shards, codes.drop("term")).collect():
        for i, row in enumerate(s.rows):
            cells = range(s.indptr[i], s.indptr[i + 1])
            assert [s.indices[c] for c in cells] == sorted(s.indices[c] for c in cells)
            found[row.doc_id] = {terms[s.indices[c]]: s.counts[c] for c in cells}
    assert found == {i: dict(Counter(WORD.findall(t or ""))) for i, t in enumerate(texts)}
    rows = {r.doc_id: (r.total, r.nonzero) for r in matrix.matrix_rows(shards).collect()}
    assert rows == {i: (sum(c.values()), len(c)) for i, c in found.items()}


def test_a_long_text_is_counted_in_pieces():
    text = ("aa bb cc ñ😀 " * 1000).encode()
    data = np.frombuffer(text, np.uint8)
    found = matrix.count_terms(data, np.array([0, len(data)]), matrix.BLANKS, 100)
    assert dict(zip(found[0].to_pylist(), found[3].tolist())) == dict.fromkeys(("aa", "bb", "cc", "ñ😀"), 1000)


def test_no_shards_of_no_rows(documents):
    empty = documents([])
    shards = matrix.term_shards(empty, ["doc_id"])
    assert shards.count() == 0
    assert matrix.global_shards(shards, matrix.encode(shards)).count() == 0


# -- operator 11: ranked search ---------------------------------------------------------


def brute_ranked(rows, items, k):
    texts = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in rows]
    texts = [(i, Counter(w), len(w)) for i, w in texts if w]
    n_docs, total = len(texts), sum(n for *_, n in texts)
    held = Counter(t for _, c, _ in texts for t in c)
    out = []
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(LOWER)))
    for item, terms in asked.items():
        scores = []
        for i, c, n in texts:
            m = 50 + (50 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k, block, max_terms", [(50, 32, 200_000), (3, 2, 200_000), (5, 4, 10), (1, 1, 1)])
def test_ranked_against_brute_force(spark, documents, monkeypatch, k, block, max_terms):
    monkeypatch.setattr(matrix, "SHARD_BYTES", 4096)
    texts = prose(2, 300)
    rows = ODD + [(100 + i, t) for i, t in enumerate(texts)] + [(100, texts[0]), (99, texts[0]), (98, "W1 w1, W2;w3")]
    items = [(1, texts[5]), (2, "w1 w2 w3"), (3, None), (4, ""), (5, "never-seen"), (6, "one"), (6, "two words"),
             (None, texts[9]), (7, "the the ñ WORD"), (8, " ".join(f"w{i}" for i in range(300)))]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("extra", F.lit(1))
    found, tally = ranked.search(documents(rows), asked, k, block, max_terms)
    got = [tuple(r) for r in found.collect()]
    assert sorted(got, key=str) == brute_ranked(rows, items, k)
    assert all(0 <= r.skipped <= r.blocks for r in tally.collect())


def test_blocks_below_the_threshold_are_skipped(spark, documents):
    texts = prose(3, 2000)
    query = " ".join(f"w{i}" for i in range(20, 60))
    rows = [(i, t) for i, t in enumerate(texts)] + [(5000 + i, query + f" x{i}") for i in range(20)]
    items = spark.createDataFrame([(1, query)], "item_id long, text string")
    found, tally = ranked.search(documents(rows), items, 10, 16)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_ranked(rows, [(1, query)], 10)
    assert tally.first().blocks > tally.first().skipped > 0


def test_ranked_of_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranked.search(documents([]), items)[0].count() == 0
    assert ranked.search(documents([(1, "one")]), items.limit(0))[0].count() == 0
    assert ranked.search(documents([(1, None)]), items)[0].count() == 0


# -- operator 12: sharding --------------------------------------------------------------


def mixed(key):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        key = (key ^ (key >> shift)) * factor % (1 << 64)
    return key ^ (key >> 31)


def brute_jump(key, shards):
    state, b, j = mixed(key % (1 << 64)), -1, 0
    while j < shards:
        b = j
        state = (state * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (2**31 / ((state >> 33) + 1)))
    return b


def test_jumps_against_brute_force():
    keys = np.concatenate([np.arange(2000), [-1, -(1 << 63), (1 << 63) - 1]]).astype(np.int64)
    for shards in (1, 2, 16, 100):
        now, grown = sharding.jump(keys, shards)
        assert now.tolist() == [brute_jump(int(k), shards) for k in keys]
        assert grown.tolist() == [brute_jump(int(k), shards + 1) for k in keys]
        assert set(grown[grown != now].tolist()) <= {shards}
    moved = (grown != now).mean()
    assert moved < 3 / 100


def test_sharding_of_odd_rows(documents):
    rows = ODD + [(i, f"text {i % 7}") for i in range(20, 400)] + [(7777, "hot")] * 300 + [(None, None)] * 50
    found = sharding.assign(documents(rows)).collect()
    expect = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == expect
    slots = defaultdict(list)
    for r in found:
        key = -(1 << 63) if r.doc_id is None else r.doc_id
        assert (r.law, r.shard, r.grown_shard) == ("key", brute_jump(key, 16), brute_jump(key, 17))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(documents([])).count() == 0


def test_equal_texts_stay_together_if_they_are_the_key(documents):
    docs = documents([(i, f"text {i % 30}") for i in range(300)])
    found = sharding.assign(docs, 8, F.xxhash64("text")).groupBy("text_crc32")
    assert found.agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


# -- operator 13: audit -----------------------------------------------------------------


def brute_audit(rows, labels):
    good, toxic = (defaultdict(bool) for _ in range(2))
    for i, q, t in labels:
        good[i] |= q == 1
        toxic[i] |= t == 1
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    judged = []
    for i, text, lang in rows:
        text = text or ""
        w = WORD.findall(text)
        failed = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > least[text],
        }
        judged.append((lang or "", i, {f for f, x in failed.items() if x}))
    out = {}
    for part in {p for p, *_ in judged}:
        docs = [(i, f) for p, i, f in judged if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, own in enumerate(order, 1):
                gone = [i for i, f in left if own in f]
                before = len([1 for _, f in docs if own in f]) - len(gone)
                left = [(i, f) for i, f in left if own not in f]
                out[part, "".join(order), step] = (
                    len(left), len(gone), before, sum(f == {own} for _, f in docs),
                    sum(i is not None and good[i] for i in gone), sum(i is not None and toxic[i] for i in gone),
                )
                shapley[own] += len(gone)
        for key in [k for k in out if k[0] == part]:
            out[key] += (shapley[key[1][key[2] - 1]],)
    return out


def test_audit_against_brute_force(spark):
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", "short", LONG, long, long + " $", long.upper(), "a b " * 150, long, "", "Ab#", "w " * 199 + "x"]
    rows = [(i, t, ("en", None, "", "de")[i % 4]) for i, t in enumerate(texts * 3)]
    rows += [(None, long, "en"), (3, LONG, "en"), (3, LONG, "de"), (100, long, None)] + [(50, "hot", "en")] * 40
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], DOCUMENTS)
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(30)] + [(3, 1, 1), (None, 1, 1), (7, None, None)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.audit(docs.withColumn("total", F.lit(1)), known).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found} == brute_audit(rows, labels)
    assert len(found) == 600 * 3
    assert audit.audit(docs.limit(0), known).count() == 0
    assert audit.audit(docs, known.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_shards_keep_their_own_dictionary():
    terms, indptr, indices, counts = matrix.count_terms(
        *_buffer(["b a b", "", "a c"]), matrix.BLANKS, 1 << 20
    )
    assert terms.to_pylist() == ["b", "a", "c"]
    assert (indptr.tolist(), indices.tolist(), counts.tolist()) == ([0, 2, 2, 4], [0, 1, 1, 2], [2, 1, 1, 1])


def _buffer(texts):
    from tidewatch.llm.common import text_buffer

    return text_buffer(pa.array(texts))
