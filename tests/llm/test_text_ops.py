"""Operators that judge or rewrite texts row by row, and what they count over the corpus."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import hosts, lines, mixing, quality
from tidewatch.llm.common import table, text_buffer, word_hashes, word_spans
from tests.llm.conftest import LONG, ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


# -- words as arrays ------------------------------------------------------------------


def test_word_spans_and_hashes():
    texts = [None, "", "a b", "Ab a", " é  x\n", "b"]
    data, bounds = text_buffer(pa.array(texts))
    begins, ends, counts = word_spans(data, bounds)
    assert counts.tolist() == [len(words(t)) for t in texts]
    flat = [w.lower() for t in texts for w in words(t)]
    hashes = word_hashes(data, begins, ends, lower=True).tolist()
    assert len({(w, h) for w, h in zip(flat, hashes)}) == len(set(flat)) == len(set(hashes))


def test_adjacent_texts_do_not_join():
    data, bounds = text_buffer(pa.array(["ab", "cd"]))
    begins, ends, counts = word_spans(data, bounds)
    assert begins.tolist() == [0, 2] and ends.tolist() == [2, 4] and counts.tolist() == [1, 1]


# -- mixing ---------------------------------------------------------------------------


def test_mix_meets_targets(spark, documents):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(1, 40)), f"s{i % 4}" if i % 3 else "hot") for i in range(3000)]
    found = mixing.taken(documents(rows)).toPandas()
    assert (found.taken <= 2 * found["size"]).all()
    per = found.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(per.taken - per.target) <= 40).all()
    assert per.target.sum() == pytest.approx(1.5 * found["size"].sum())
    again = mixing.taken(documents(rows[::-1])).toPandas()
    key = ["doc_id", "taken"]
    assert found[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


def test_targets_stop_and_are_reshared(spark):
    sizes = spark.createDataFrame([("b", 100), ("a", 10), (None, 100)], "source string, size long")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    # a (weight 3) stops at 20; b (1) and null (2) share the other 295
    assert found == {"a": 20.0, "b": 295 / 3, None: 2 * (295 / 3)}
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 10)], "source string, size long")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert found == {"a": 140.0, "b": 20.0, "c": 20.0}


def test_mix_repeats_rows_with_all_columns(documents):
    docs = documents([(i, "a b c", "x") for i in range(10)]).withColumn("size", F.lit("mine"))
    rows = mixing.mix(docs).collect()
    assert len(rows) == 15 and {r.size for r in rows} == {"mine"}
    assert max(Counter(r.doc_id for r in rows).values()) <= 2


def test_mix_odd_rows(odd):
    found = mixing.taken(odd).toPandas()
    assert len(found) == len(ODD)
    assert found[found["size"] == 0].taken.eq(0).all()
    assert mixing.taken(odd.limit(0)).count() == 0
    assert mixing.mix(odd.limit(0)).count() == 0


# -- line dedup -----------------------------------------------------------------------

SHARED = "Posted by {} on our site today for readers"


def test_recurring_templates_go_from_all_but_the_first(documents):
    own = [" ".join("abcde"[i] * (k + 1) for k in range(9)) for i in range(5)]
    rows = [(i, own[i] + "\n" + SHARED.format(i)) for i in range(5)]
    found = {r.doc_id: r for r in lines.dedup_lines(documents(rows)).collect()}
    assert [found[i].lines_dropped for i in range(5)] == [0, 1, 1, 1, 1]
    assert found[0].text == rows[0][1]
    assert all(found[i].text == rows[i][1].split("\n")[0] for i in range(1, 5))


def test_variable_field_is_generalised(documents):
    names = ["ann", "bob", "cyd", "dan"]
    rows = [(i, f"the reader of this page today is {n} as ever before") for i, n in enumerate(names)]
    found = lines.dedup_lines(documents(rows)).orderBy("doc_id").collect()
    assert [r.lines_dropped for r in found] == [0, 1, 1, 1]
    assert lines.drop_emptied(lines.dedup_lines(documents(rows))).count() == 1


def test_few_documents_or_short_lines_stay(documents):
    rows = [(1, "a line that two documents have in common"), (2, "a line that two documents have in common")]
    rows += [(i, "short line here") for i in range(3, 9)]
    rows += [(9, "one document may repeat this line often\n" * 5)]
    docs = documents(rows)
    assert lines.dedup_lines(docs).agg(F.sum("lines_dropped")).first()[0] == 0


def test_one_template_over_ten_thousand_documents(documents):
    """Two fields of 300 values each, every value in many documents: all but one line go."""
    names = ["".join(chr(97 + (i // 26**k) % 26) for k in range(3)) for i in range(300)]
    rows = [
        (i, f"the good reader {names[i % 300]} of this town is called {names[i * 7 // 11 % 300]} by all friends")
        for i in range(10_000)
    ]
    rows += [(20_000 + i, f"written by {names[i % 300]} in his house at {names[i * 7 // 11 % 300]} this year") for i in range(9_000)]
    found = lines.dedup_lines(documents(rows)).groupBy(F.col("doc_id") < 20_000).agg(F.sum("lines_dropped"))
    # a field among the leading tokens keeps a line of each value
    assert dict(found.collect()) == {True: 9_999, False: 9_000 - 300}


def test_datelines_share_lines_and_footers_go(documents):
    rows = [(i, f"own {'x' * (i + 1)} words\n" + line) for i in range(60) for line in [
        (f"Posted on {i % 28 + 1} May 20{i % 10 + 10} at 10:{i % 50 + 10} by admin", "Share this article on Facebook",
         "Tel 020 7946 0958 Fax 020 7946 0959")[i % 3]
    ]]
    found = lines.dedup_lines(documents(rows)).collect()
    assert sum(r.lines_dropped for r in found) == 57
    assert all(r.text.startswith("own x") for r in found)


def test_numbers_that_differ_stay(documents):
    rows = [(i, f"{i} {i * 7} {i * 13} a {i * 17} {i * 23}") for i in range(50)]
    assert lines.dedup_lines(documents(rows)).agg(F.sum("lines_dropped")).first()[0] == 0


def test_lines_odd_rows(odd):
    found = lines.dedup_lines(odd.withColumn("lines", F.lit("x"))).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in found) == sorted((r[0] or 0, r[1] or "") for r in ODD)
    assert lines.drop_emptied(lines.dedup_lines(odd)).count() == len(ODD)
    assert lines.dedup_lines(odd.limit(0)).count() == 0


# -- host rules -----------------------------------------------------------------------


def brute_base(text):
    text = text or ""
    w = words(text)
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = Counter(wins)
    covered = {i + k for i, x in enumerate(wins) if twice[x] > 1 for k in range(5)}
    with_word = [x for x in text.split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
        len(with_word) - len(set(with_word)), len(covered),
    )


def test_base_columns_match_brute_force(documents):
    texts = [r[1] for r in ODD] + ["a b c d e a b c d e f", "a a a a a a a", "x\nx\n\n x\nx", "#1 *|<>& $%", "é" * 9]
    texts.append("p q r s t u " * 3 + "v w x y z")
    rows = [(i, t) for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in hosts.base_columns(documents(rows), [F.col("doc_id")]).collect()}
    for i, t in rows:
        r = found[i]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute_base(t), t


def test_bad_host_is_rejected_and_small_host_spared(documents):
    good = " ".join(f"w{i}" for i in range(20))
    rows = [(i, "too short", "bad") for i in range(60)] + [(100, good, "bad")]
    rows += [(200 + i, good, f"fine{i % 8}") for i in range(160)]
    rows += [(500, "too short", "small"), (501, good, "small")]
    found = {r.id: r for r in hosts.host_rules(documents(rows)).collect()}
    assert not found[100].kept and not found[100].base_failed
    assert found[501].kept and not found[500].kept and found[200].kept


def test_hosts_odd_rows(odd):
    assert hosts.host_rules(odd).count() == len(ODD)
    assert hosts.host_rules(odd.limit(0)).count() == 0
    null_host = odd.withColumn("source", F.lit(None).cast("string"))
    assert hosts.host_rules(null_host).where("kept IS NULL").count() == 0


# -- quality classifier ---------------------------------------------------------------


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = quality.op9_quality(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    held = scored.where("held_out AND quality IS NOT NULL").toPandas()
    assert len(held) > 80 and (held.predicted == held.quality).mean() > 0.95
    assert held.score.between(0, 1).all()


def test_compiled_rules_score_as_numpy_does(spark, documents):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(400):
        bad = bool(rng.integers(2))
        rows.append((i, " ".join(("WORD!!" if bad else "word.") + str(k) for k in range(rng.integers(3, 30)))))
        labels.append((i, int(not bad)))
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = documents(rows)
    model = quality.fit(docs, labels)
    values, y = quality.sample_of(docs, labels, "quality", "doc_id", "text", 1000, None)
    margin = model.intercept + sum(
        w * np.logical_and.reduce([t.on(values) for t in rule]) for rule, w in model.rules
    )
    scores = sorted(r.score for r in model.score(docs).collect())
    assert np.allclose(scores, sorted(1 / (1 + np.exp(-margin))))
    assert ((margin > 0) == (y == 1)).mean() > 0.97
    assert len(model.rules) < 60


def test_quality_odd_rows(spark, odd):
    none = spark.createDataFrame([(1, None), (4, 1)], "doc_id long, quality int")
    model = quality.fit(odd, none)
    clash = odd.withColumn("words", F.lit("mine")).withColumn("score", F.lit(9))
    found = model.score(clash).collect()
    assert len(found) == len(ODD) and {r.words for r in found} == {"mine"}
    assert all(0 < r.score < 1 for r in found)
    empty = quality.fit(odd.limit(0), none.limit(0))
    assert {r.score for r in empty.score(odd).collect()} == {0.5}
    assert empty.score(odd.limit(0)).count() == 0
    assert LONG in {r.text for r in found}
