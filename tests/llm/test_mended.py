"""Large values, null ids, long runs, and the statistics behind quality, against brute force."""

import re
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import bitsliced, lm, matrix, quality, sentencepiece
from tidewatch.settings import session_settings
from tests.llm.conftest import ODD


def test_large_finite_components_are_scored(spark):
    rows = [(0, [1e10, 1.0]), (1, [1.0, 2.0]), (2, [-1e10, 0.5]), (3, [0.0, 3.0]), (4, [2.0**45, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    found = bitsliced.top_k(vectors, F.col("id").isin(1, 3), k=3).collect()
    for q in (1, 3):
        scores = [(-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q]
        expect = [(i, -s) for s, i in sorted(scores)[:3]]
        assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == expect
    with pytest.raises(Exception, match="does not fit a long"):
        bitsliced.top_k(vectors, F.col("id") == 4).collect()


def test_held_out_is_never_null(spark, tmp_path, documents):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = documents([(None, "a text"), (None, None)])
    docs.unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    scored = quality.op9_quality(spark, str(tmp_path))
    assert scored.where("held_out IS NULL OR score IS NULL").count() == 0
    assert scored.where("doc_id IS NULL").count() == 2


def brute_statistics(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if x]
    solid = sum(c not in " \t\n\x0b\x0c\r" for c in text)
    share = lambda a, b: a / b if b else 0.0
    return {
        "words": float(len(words)),
        "word_length": share(solid, len(words)),
        "distinct_words": share(len(set(words)), len(words)),
        "digits": share(sum(c in "0123456789" for c in text), solid),
        "capitals": share(len(re.findall("[A-Z]", text)), solid),
        "symbols": share(sum(c in quality.COUNTED["symbols"] for c in text), solid),
        **{n: share(sum(c in quality.COUNTED[n] for c in text), len(words)) for n in ("stops", "commas", "shouts")},
        "line_words": share(len(words), len(lines)),
        "distinct_lines": share(len(set(lines)), len(lines)),
    }


def test_statistics_against_brute_force(documents):
    texts = [t for _, t in ODD if t is not None]
    texts += ["One, two! THREE?\n\nOne, two! THREE?\n4 5 6 #$%", "ñandú Ünder\tx\x0by\n", "\n\n", "A-Z 0.5; (b) [c]"]
    rows = documents(list(enumerate(texts))).select("doc_id", "text")
    found = quality.with_statistics(rows, "text").collect()
    assert len(found) == len(texts)
    for r in found:
        expect = brute_statistics(texts[r.doc_id])
        assert {n: r[n] for n in quality.NAMES} == {n: pytest.approx(expect[n]) for n in quality.NAMES}


def test_long_runs_without_a_space_take_seconds():
    """A heap in place of a scan of the whole row per merge; same ids as the library's."""
    import sentencepiece as library

    path = sentencepiece.model_path()
    with open(path, "rb") as f:
        own = sentencepiece.Vocabulary(f.read())
    rng = np.random.default_rng(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/ñé中文😀"
    text = "".join(letters[i] for i in rng.integers(0, len(letters), 300_000)) + "the" * 5000
    start = time.time()
    ids, lengths = own.merge_long(sentencepiece.SPACE + text)
    took = time.time() - start
    assert ids.tolist() == library.SentencePieceProcessor(model_file=path).encode(text)
    assert lengths.tolist() == [len(ids)] and took < 20


def test_average_of_very_many_workers(spark):
    rng = np.random.default_rng(0)
    vectors = rng.random((40, 7)).astype(np.float32)
    n = rng.integers(1, 100, 40)
    rows = [(bytearray(v.tobytes()), int(k)) for v, k in zip(vectors, n)]
    learned = spark.createDataFrame(rows, "w binary, n long").repartition(5)
    assert lm._average(learned, 3) == pytest.approx((vectors * n[:, None]).sum(0) / n.sum(), rel=1e-5)


def test_scoring_a_long_text_beside_short_ones_takes_little_memory():
    rng = np.random.default_rng(0)
    counts = np.arange(3000, 0, -1)
    words = np.arange(10, 3010, dtype=np.uint64)
    rest = {k: (int(counts[k::6].sum()), 500) for k in range(6)}
    options = lm.Options()
    lexicon = lm.Lexicon((words, counts, np.arange(3000) % 6), (int(counts.sum()), 3000), rest, options, 6)
    network = lexicon.network(options.hidden)
    vector = network.start(lexicon.class_logs, lexicon.member_logs)
    lengths = np.array([60_000] + [10] * 600)
    at = rng.integers(0, 3000, lengths.sum())
    part = (words[at], (at % 6).astype(np.int8), lengths)
    tracemalloc.start()
    together = lm._score_batch([part], network, vector, lexicon, options)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    alone = lm._score_batch([(part[0][:60_000], part[1][:60_000], lengths[:1])], network, vector, lexicon, options)
    assert together[3][0] == pytest.approx(alone[3][0], rel=1e-5)


def test_shards_gather_small_batches_and_lie_in_files_of_their_own(spark, documents):
    docs = documents([(i, f"w{i} and w{i + 1} again") for i in range(60)]).coalesce(1)
    with session_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        whole = matrix.term_shards(docs, ["doc_id"])
        cut = matrix.term_shards(docs, ["doc_id"], most=400)
    assert whole.count() == 1  # not one for each Arrow batch
    assert [r.doc_id for r in whole.first().rows] == list(range(60))
    sizes = [sum(len(f"w{r.doc_id} and w{r.doc_id + 1} again") for r in s.rows) for s in cut.orderBy("shard").collect()]
    assert len(sizes) > 2 and max(sizes) <= 400 and min(sizes[:-1]) > 300
    assert cut.select(F.input_file_name()).distinct().count() == len(sizes)
