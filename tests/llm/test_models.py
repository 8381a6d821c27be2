"""SentencePiece against its library, the language model against itself and its base, URLs, the pipeline."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import lm, sentencepiece as pieces, urls
from tidewatch.llm.gru import GRU, laid_out
from tests.llm.conftest import LONG, ODD
from tests.llm.test_text_ops import words

SF = "/root/testdata/sf0.001"

# -- SentencePiece --------------------------------------------------------------------

TEXTS = [
    "", "a", " ", "  ", "\n", "\n\n", "a\n", "\na", "▁", "▁▁ a", "a▁b", "\t\tx", " a  b   c\n  e",
    "日本語テキスト", "😀😀 x", "e\u0301", "\x00", " ", "ﬁ", "a" * 500, "  " * 300, "\r\nx\r\n", " \n \n ",
]


@pytest.fixture(scope="module")
def encoder():
    with open(pieces.model_path(), "rb") as file:
        return pieces._Encoder(file.read())


def test_encodes_as_the_library(encoder):
    rng = random.Random(1)
    alphabet = "abcdefgh  \n\tdeéñ▁日😀.,0123\u0301ＡÀ"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(2000)]
    flat, bounds, agrees = encoder.encode(texts)
    found = [flat[i:j].tolist() for i, j in zip(bounds, bounds[1:])]
    assert found == encoder.vocabulary.library.encode(texts) and all(agrees)
    library = encoder.vocabulary.library
    assert [encoder.vocabulary.decode(i) for i in found] == library.decode(found)


def test_decodes_any_ids_as_the_library(encoder):
    rng = random.Random(2)
    some = [[rng.choice([rng.randrange(32000), rng.randrange(3, 259)]) for _ in range(rng.randint(0, 12))] for _ in range(2000)]
    some += [[0], [0, 1, 2, 29871, 5], [29871, 29871, 5], [1, 29871], [2, 300]]
    library = encoder.vocabulary.library
    assert [encoder.vocabulary.decode(i) for i in some] == [library.decode(i) for i in some]


def test_store_may_be_cleared(encoder, monkeypatch):
    monkeypatch.setattr(pieces, "_STORE", 3)
    library = encoder.vocabulary.library
    for text in ("one two three four", "five six", "one two"):
        flat, _, _ = encoder.encode([text])
        assert flat.tolist() == library.encode(text)


def test_sentencepiece_odd_rows(odd):
    clash = odd.withColumn("ids", F.lit("x")).withColumn("row", F.lit(1))
    found = pieces.encode_decode(clash, pieces.model_path()).collect()
    assert len(found) == len(ODD) and all(r.agrees for r in found)
    texts = sorted((r[0] or 0, r[1] or "") for r in ODD)
    assert sorted((r.doc_id or 0, r.decoded) for r in found) == texts
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    assert all(r.ids == library.encode(r.decoded) and r.n_tokens == len(r.ids) for r in found)
    assert pieces.encode_decode(odd.limit(0), pieces.model_path()).count() == 0
    assert LONG in {r.decoded for r in found}


# -- language model -------------------------------------------------------------------


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    net = GRU(12, [3, 0, 4], 5)
    vector = net.start(np.log([0.3, 0.3, 0.4]), np.log(np.ones(7) / 7)).astype(float)
    vector += rng.normal(0, 0.1, len(vector))
    inputs, classes = rng.integers(0, 12, (6, 3)), rng.integers(-1, 3, (6, 3))
    places = rng.integers(0, 3, (6, 3))
    h = rng.normal(0, 1, (3, 5))
    grad, _ = net.gradient(vector, inputs, classes, places, h)

    def loss(v):
        return -net.logs(v, inputs, classes, places, h)[0].sum() / inputs.size

    for i in rng.integers(0, len(vector), 80):
        step = np.zeros(len(vector))
        step[i] = 1e-3
        assert grad[i] == pytest.approx((loss(vector + step) - loss(vector - step)) / 2e-3, abs=1e-5)


def test_gradient_of_far_biases_and_padding():
    """Bounds that lie far apart, and windows with empty cells, leave finite, equal gradients."""
    rng = np.random.default_rng(3)
    net = GRU(12, [3, 0, 4], 5)
    vector = net.start(np.array([0.0, -200.0, -1.0]), rng.normal(0, 300, 7).astype(np.float32))
    inputs, classes = rng.integers(0, 12, (6, 3)), np.array([[0, 2, 0]] * 6)
    places, h = rng.integers(0, 3, (6, 3)), np.zeros((3, 5), np.float32)
    grad, _ = net.gradient(vector, inputs, classes, places, h)
    assert np.isfinite(grad).all() and np.abs(grad).max() <= 1
    padded = [np.concatenate([x, np.full((6, 1), fill)], 1) for x, fill in ((inputs, 11), (classes, -1), (places, 0))]
    wide, _ = net.gradient(vector, *padded, np.zeros((4, 5), np.float32))
    assert wide == pytest.approx(grad * 3 / 4, abs=1e-6)


def test_windows_carry_the_state():
    rng = np.random.default_rng(1)
    net = GRU(9, [2, 3, 0], 4)
    vector = rng.normal(0, 0.5, net.n).astype(np.float32)
    inputs, classes = rng.integers(0, 9, (40, 2)), rng.integers(0, 3, (40, 2))
    places = rng.integers(0, 2, (40, 2))
    whole, _ = net.logs(vector, inputs, classes, places, np.zeros((2, 4), np.float32))
    h, parts = np.zeros((2, 4), np.float32), []
    for at in range(0, 40, 7):
        part, h = net.logs(vector, inputs[at : at + 7], classes[at : at + 7], places[at : at + 7], h)
        parts.append(part)
    assert np.allclose(whole, np.concatenate(parts), atol=1e-5)


def test_lanes_hold_every_token_once():
    lengths = np.array([5, 1, 9, 3, 3, 7])
    row, lane, heights = laid_out(lengths, 3)
    cells = set(zip(row.tolist(), lane.tolist()))
    assert len(cells) == lengths.sum() == heights.sum() and max(row) < heights[0]
    assert (np.diff(heights) <= 0).all()
    assert all(row[lane == k].max() == heights[k] - 1 for k in range(3))
    first = np.cumsum(lengths) - lengths
    assert all((np.diff(row[a : a + n]) == 1).all() for a, n in zip(first, lengths))


def test_probabilities_sum_to_one():
    """Over all words known and one unseen word of each kind, from any state."""
    counts = np.array([50, 30, 20, 9, 9, 4, 4, 1, 1])
    kinds = np.array([0, 0, 1, 1, 0, 1, 0, 1, 0])
    words_ = np.arange(10, 19, dtype=np.uint64)
    rest = {k: (int(counts[kinds == k].sum()), int((kinds == k).sum())) for k in (0, 1)}
    options = lm.Options(shortlist=4, class_size=2, hidden=3)
    lexicon = lm.Lexicon((words_, counts, kinds), (int(counts.sum()), 9), rest, options, 2)
    net = lexicon.network(3)
    vector = np.random.default_rng(2).normal(0, 1, net.n).astype(np.float32)
    tokens = np.append(words_, [np.uint64(98), np.uint64(99)])
    looks = np.append(kinds, [0, 1])
    c, _, classes, within = lexicon.look_up(tokens, looks)
    h = np.random.default_rng(3).normal(0, 1, (1, 3)).astype(np.float32)
    inputs = np.zeros((1, len(tokens)), np.int64) + 1
    logs, _ = net.logs(vector, inputs, classes[None], within[None], np.repeat(h, len(tokens), 0))
    p = np.exp(logs[0])
    other = classes >= lexicon.first_rest
    own = (np.maximum(c, 0) + 0.5) / lexicon.rest_total[np.maximum(classes - lexicon.first_rest, 0)]
    p[other] *= own[other]
    assert p.sum() == pytest.approx(1, abs=1e-5)


def test_base_is_exact_and_the_model_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    options = lm.Options(head=2000, shortlist=500, share=2)
    found = lm.score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 1, options=options)
    found = {r.id: r for r in found.collect()}
    tokens = {r.doc_id: [*words(r.text.translate(str.maketrans({c: c.lower() for c in map(chr, range(65, 91))}))), None] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    gain = total = 0
    for i, t in tokens.items():
        r = found[i]
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(t), n)
        assert r.n_known == sum(w in counts for w in t)
        if held[i]:
            gain, total = gain + r.score - base, total + len(t)
    assert gain / total > 0.1


def test_every_training_document_is_learned_from(documents):
    """Texts whose hash is not 0 modulo 16 teach the network as any others do."""
    rows = [(i, f"begin{i} " + "left right up down " * 40) for i in range(40)]
    hashed = F.pmod(F.xxhash64("text"), F.lit(16)) != 0
    docs = documents(rows).where(hashed).limit(12)
    docs = docs.union(documents([(100, "left right up down " * 20)]))
    found = {r.id: r for r in lm.score_texts(docs, F.col("doc_id") == 100).collect()}
    held = found[100]
    assert held.held_out and held.n_tokens == 81
    # known orders are worth far more than frequencies: 0.6 of 4 words' log10(4) at least
    assert (held.score - held.base_score) / held.n_tokens > 0.36


def test_lm_odd_rows(odd):
    held = F.col("doc_id") == 6
    found = lm.score_texts(odd.withColumn("key", F.lit("x")), held).collect()
    assert len(found) == len(ODD) and all(np.isfinite(r.score) and r.score < 0 for r in found)
    assert {r.n_tokens for r in found if r.id in (1, 2, 3)} == {1}
    nothing = lm.score_texts(odd, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, round(r.base_score, 6) + 0.0) for r in nothing} == {(0, 0, 0.0)}
    assert lm.score_texts(odd.limit(0), held).count() == 0
    assert lm.score_texts(odd.drop("lang"), held).count() == len(ODD)


# -- URLs -----------------------------------------------------------------------------

URLS = {
    "http://a.org/": ("a.org", "/", "org/", "allow"),
    "http://a.org": ("a.org", "", None, None),
    "HTTPS://WWW.Example.ORG/en/1x?q": ("www.example.org", "/en/1x", "example.org/en/1", "block"),
    "http://example.org/es/": ("example.org", "/es/", "example.org/es/", "block"),
    "http://example.org/es": ("example.org", "/es", "org/", "allow"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "x://b.com/de/#t": ("b.com", "/de/", "com/de/", "block"),
    "x://b.com#/de/": ("b.com", "", None, None),
    "http://h.com/fr/a://b": ("h.com", "/fr/a://b", "com/fr/", "allow"),
    "no scheme": ("", "", None, None),
    "": ("", "", None, None),
}


def test_hosts_paths_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(99, None)]
    found = {r.id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    for i, (u, want) in enumerate(URLS.items()):
        r = found[i]
        assert (r.host, r.path, r.rule) == want[:3], u
        assert r.verdict == want[3] if want[3] else r.verdict in ("allow", "block")
    assert (found[99].host, found[99].path, found[99].rule) == ("", "", None)


def test_models_tell_urls_apart(spark):
    rng = random.Random(3)
    good = lambda: "".join(rng.choices("aeiou", k=9))
    bad = lambda: "".join(rng.choices("xyzqk", k=9))
    rows = [(i, f"http://{good()}.org/{good()}") for i in range(150)]
    rows += [(200 + i, f"http://{bad()}.com/de/{bad()}") for i in range(150)]
    rows += [(1000 + i, f"http://{good()}.net/{good()}") for i in range(40)]
    rows += [(2000 + i, f"http://{bad()}.net/{bad()}") for i in range(40)]
    found = {r.id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    right = [sum(found[at + i].verdict == v for i in range(40)) for at, v in ((1000, "allow"), (2000, "block"))]
    assert min(right) >= 36


def test_urls_odd_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")] * 3 + [(None, "http://b.org/")], "page_id long, url string")
    found = urls.filter_urls(pages.withColumn("rule", F.lit(0)).withColumn("host", F.lit(0))).collect()
    assert len(found) == 4 and {r.verdict for r in found} == {"allow"}
    assert urls.filter_urls(pages.limit(0)).count() == 0


# -- pipeline -------------------------------------------------------------------------


def test_stages_follow_one_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns, name
        seen.append(docs.count())
    assert seen[0] >= seen[1] >= seen[2] >= seen[3] > 0
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    last = corpus_pipeline.tokenize(spark, docs, SF).collect()
    want = Counter((r.doc_id, len(library.encode(r.text))) for r in docs.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in last) == want
    run = corpus_pipeline.run(spark, SF).collect()
    assert Counter(map(tuple, run)) == Counter(map(tuple, last))


def test_near_copies_and_rejects_are_gone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.classify(spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality IS NOT NULL")
    kept = {r.doc_id for r in good.collect()}
    marks = [(r.quality, r.doc_id in kept) for r in labels.collect()]
    assert np.mean([k == bool(q) for q, k in marks]) > 0.95
    one = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    assert len({re.sub(r"\s+", " ", r.text.lower()) for r in one}) == len(one)
