"""Ranked lexical search (operator 11) by posting lists cut into geometric blocks.

Documents are cut into shards with a sparse matrix of their terms (`matrix`).  For a
block of items the matrix is narrowed to their terms and every shard gets an index:

* **Blocks.**  The list of a term's documents is clustered by similarity: every
  ``block``-th document is a representative, the others join the one whose sketch (a
  random projection of the weighted vector) is nearest.
* **Summaries.**  A block keeps, for each term that is asked for together with the
  list's, the greatest saturation any of its documents has.  An item's weights times
  these are a bound that no document of the block exceeds, in the same integers as
  scores, so comparisons are exact.
* **Search.**  An item enters its lists block by block, the best bound first, and scores
  the documents of a block in full unless the bound is below the score that ``k``
  documents are known to reach.

**What is known beforehand.**  First each item adds up its rarest terms alone and scores
the documents that are best by them in full; the k-th best of these scores over all
shards is reached by k documents, so it is a threshold.  Terms
whose greatest contributions in a shard together stay below it cannot carry a document
there: their lists are not entered (and so not clustered); they still count in bounds
and scores.  Words as common as "the" thus cost a coordinate, not a list of everything.

**Size.**  A shard has a few megabytes of text whatever its words, so a list in a shard
is bounded.  Items are taken in blocks of about ``max_terms`` terms, and only a block
(checked, a single item at least) is broadcast.  Documents travel never, candidates at
or above the threshold once.

Defined results: a null or empty text has no term and is not ranked; items without terms
have no rows; rows of one item id are one item with all their terms; a document's rows
are ranked each; a null doc_id comes after others of its score; empty tables give no
rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import ascii_lower, table, whole
from tidewatch.llm.matrix import NOT_ALPHANUMERIC, ONE_A_FILE, SMALL_BATCHES, one_list, term_shards
from tidewatch.settings import session_settings, settle

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 50
#: Documents of a block, dimensions of a sketch, terms of the items taken at once.
BLOCK, SKETCH, MAX_TERMS = 32, 32, 200_000


def item_blocks(items: DataFrame, max_terms: int = MAX_TERMS) -> tuple[DataFrame, list[int]]:
    """``(block, item_id, terms)`` of items with terms, settled, and the blocks that have some."""
    terms = F.explode(F.regexp_extract_all(ascii_lower(whole()), F.lit(TERM), F.lit(0)))
    per_item = items.select("item_id", terms.alias("term")).groupBy("item_id")
    per_item = settle(per_item.agg(F.array_sort(F.collect_set("term")).alias("terms")), "items")
    n_items, n_terms = per_item.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = math.ceil(n_terms / max_terms)
    while True:
        dealt = per_item.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1))))
        sizes = dealt.groupBy("block").agg(F.sum(F.size("terms")).alias("n")).collect()
        if max((r.n for r in sizes), default=0) <= 2 * max_terms or blocks >= 4 * n_items:
            return dealt, sorted(r.block for r in sizes)
        blocks *= 2


def _lists(batch: pa.RecordBatch, k: int, *names: str) -> list[np.ndarray]:
    return [batch[n].slice(k, 1).flatten().to_numpy(zero_copy_only=False) for n in names]


def _entries(indptr: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all entries of ``docs``, and which of ``docs`` each belongs to."""
    sizes = indptr[docs + 1] - indptr[docs]
    owner = np.repeat(np.arange(len(docs)), sizes)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + (indptr[docs] - ends + sizes)[owner], owner


def _beside(df: DataFrame, one: DataFrame) -> DataFrame:
    """``df`` with the columns of the table ``one``, which has one row."""
    row = one.select(F.struct(*one.columns).alias("one")).scalar()
    return df.withColumn("one", row).select("*", "one.*").drop("one")


def narrow(shards: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(shard, doc_ids, lengths, indptr, terms, tf)`` of documents that have a term of the
    ``vocabulary`` (one row, an array): its positions there in place of the terms."""
    schema = (
        "shard long, doc_ids array<long>, lengths array<long>, indptr array<int>, "
        "terms array<int>, tf array<int>"
    )

    def cut(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                words = batch["terms"].slice(k, 1).flatten()
                place = pc.index_in(words, value_set=batch["vocabulary"].slice(k, 1).flatten())
                place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False)
                indptr, indices, counts = _lists(batch, k, "indptr", "indices", "counts")
                sums = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
                lengths = sums[indptr[1:]] - sums[indptr[:-1]]
                found = place[indices]
                here = found >= 0
                seen = np.concatenate(([0], np.cumsum(here)))
                sizes = seen[indptr[1:]] - seen[indptr[:-1]]
                docs = np.flatnonzero(sizes)
                ids = batch["rows"].slice(k, 1).flatten().field("doc_id").take(pa.array(docs))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["shard"].slice(k, 1),
                        one_list(ids),
                        one_list(lengths[docs]),
                        one_list(np.append(0, np.cumsum(sizes[docs])), pa.int32()),
                        one_list(found[here], pa.int32()),
                        one_list(counts[here], pa.int32()),
                    ],
                    [x.split()[0] for x in schema.split(", ")],
                )

    return _beside(shards, vocabulary).mapInArrow(cut, schema)


def _saturation(lengths, indptr, tf, n_docs: int, n_terms: int) -> np.ndarray:
    """What a weight is multiplied with, for each entry."""
    m = 50 + (50 * lengths * n_docs) // n_terms
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, np.diff(indptr)))


class _Shard:
    """A shard's narrowed matrix, what is asked of it, and its columns as lists."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.indptr, self.terms, tf, lengths = _lists(batch, k, "indptr", "terms", "tf", "lengths")
        self.weights, self.item_ptr, self.item_terms = _lists(batch, k, "weights", "item_ptr", "item_terms")
        n_docs, n_terms = batch["n_docs"][k].as_py(), batch["n_terms"][k].as_py()
        self.saturation = _saturation(lengths, self.indptr, tf, n_docs, n_terms)
        self.n = len(lengths)
        order = np.argsort(self.terms, kind="stable")
        self.by_term = order
        self.starts = np.searchsorted(self.terms[order], np.arange(len(self.weights) + 1))
        self.doc_of = np.repeat(np.arange(self.n), np.diff(self.indptr))
        self.greatest = np.zeros(len(self.weights), np.int64)
        np.maximum.at(self.greatest, self.terms, self.saturation)

    def items(self):
        for i in range(len(self.item_ptr) - 1):
            yield i, self.item_terms[self.item_ptr[i] : self.item_ptr[i + 1]]

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Full scores of documents; ``weights`` holds those of the item's terms, else 0."""
        at, owner = _entries(self.indptr, docs)
        sums = np.concatenate(([0], np.cumsum(weights[self.terms[at]] * self.saturation[at])))
        ends = np.searchsorted(owner, np.arange(len(docs) + 1))
        return sums[ends[1:]] - sums[ends[:-1]]

    def entry_terms(self, terms: np.ndarray, least: int) -> np.ndarray:
        """Terms one of which every document with a score of ``least`` or more has: all
        but those whose greatest contributions add up to less."""
        most = self.weights[terms] * self.greatest[terms]
        order = np.argsort(most, kind="stable")
        terms, most = terms[order], most[order]
        return terms[(np.cumsum(most) >= least) & (most > 0)]


def first_scores(asked: DataFrame, k: int) -> DataFrame:
    """``(item, score)``: each shard's ``k`` best full scores among the documents that are
    best by the item's rarest terms alone."""

    def add(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard = _Shard(batch, row)
                (held,) = _lists(batch, row, "held")
                few = 64 * k + batch["n_docs"][row].as_py() // 16
                weights = np.zeros(len(held), np.int64)
                items, best = [], []
                for i, terms in shard.items():
                    rare = terms[np.argsort(held[terms], kind="stable")]
                    rare = rare[np.cumsum(held[rare]) <= few + held[rare[0]]]
                    sums = np.zeros(shard.n, np.int64)
                    for t in rare.tolist():
                        at = shard.by_term[shard.starts[t] : shard.starts[t + 1]]
                        sums[shard.doc_of[at]] += shard.weights[t] * shard.saturation[at]
                    docs = np.flatnonzero(sums)
                    if len(docs) > 2 * k:
                        docs = docs[np.argpartition(sums[docs], -2 * k)[-2 * k :]]
                    weights[terms] = shard.weights[terms]
                    scores = np.sort(shard.scores(docs, weights))[-k:]
                    weights[terms] = 0
                    items.append(np.full(len(scores), i))
                    best.append(scores)
                columns = [pa.array(np.concatenate(x), pa.int64()) for x in (items, best)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "score"])

    return asked.mapInArrow(add, "item long, score long")


def _clusters(sketches: np.ndarray, block: int) -> np.ndarray:
    """A block number for each of a list's documents: that of the nearest representative."""
    step = sketches[::block]
    nearest = np.argmax(sketches @ step.T, axis=1)
    # of a cluster of very many documents each two blocks' worth is a block of its own
    order = np.argsort(nearest, kind="stable")
    starts = np.searchsorted(nearest[order], np.arange(len(step)))
    turn = np.empty(len(nearest), np.int64)
    turn[order] = (np.arange(len(nearest)) - starts[nearest[order]]) // (2 * block)
    return np.unique(nearest * len(nearest) + turn, return_inverse=True)[1]


_INDEX = (
    "shard long, block_term array<int>, block_ptr array<int>, block_docs array<int>, "
    "sum_ptr array<int>, sum_terms array<int>, sum_most array<long>"
)


def build_index(asked: DataFrame, block: int = BLOCK) -> DataFrame:
    """The blocks of each shard: documents (rows of its matrix) and greatest saturations."""

    def build(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard = _Shard(batch, row)
                (least,) = _lists(batch, row, "least")
                yield pa.RecordBatch.from_arrays(
                    [batch["shard"].slice(row, 1), *map(one_list, _blocks(shard, least, block))],
                    [x.split()[0] for x in _INDEX.split(", ")],
                )

    return asked.mapInArrow(build, _INDEX)


def _blocks(shard: _Shard, least: np.ndarray, block: int) -> list[pa.Array]:
    partners: dict[int, list] = {}
    for i, terms in shard.items():
        for t in shard.entry_terms(terms, int(least[i])).tolist():
            partners.setdefault(t, []).append(terms)
    rng = np.random.default_rng(0)
    axes = rng.standard_normal((len(shard.weights), SKETCH)).astype(np.float32)
    sketches = np.zeros((shard.n, SKETCH), np.float32)
    value = (shard.weights[shard.terms] * shard.saturation).astype(np.float32)
    for d in range(SKETCH):
        sketches[:, d] = np.bincount(shard.doc_of, axes[shard.terms, d] * value, shard.n)
    sketches /= np.maximum(np.linalg.norm(sketches, axis=1, keepdims=True), 1e-9)
    wanted = np.zeros(len(shard.weights), bool)
    out = {n: [] for n in ("term", "size", "docs", "sums", "terms", "most")}
    for t in sorted(partners):
        docs = shard.doc_of[shard.by_term[shard.starts[t] : shard.starts[t + 1]]]
        of = np.zeros(len(docs), np.int64) if len(docs) <= block else _clusters(sketches[docs], block)
        order = np.argsort(of, kind="stable")
        docs, of = docs[order], of[order]
        for terms in partners[t]:
            wanted[terms] = True
        at, owner = _entries(shard.indptr, docs)
        kept = wanted[shard.terms[at]]
        wanted[np.concatenate(partners[t])] = False
        at, cell = at[kept], of[owner[kept]]
        cell = cell * len(wanted) + shard.terms[at]
        order = np.argsort(cell, kind="stable")
        starts = np.flatnonzero(np.diff(cell[order], prepend=-1))
        cells = cell[order][starts]
        n = int(of[-1]) + 1
        out["term"].append(np.full(n, t))
        out["size"].append(np.bincount(of, minlength=n))
        out["docs"].append(docs)
        out["sums"].append(np.bincount(cells // len(wanted), minlength=n))
        out["terms"].append(cells % len(wanted))
        out["most"].append(np.maximum.reduceat(shard.saturation[at][order], starts))
    flat = {n: np.concatenate(x) if x else np.zeros(0, np.int64) for n, x in out.items()}
    return [
        pa.array(flat["term"], pa.int32()),
        pa.array(np.append(0, np.cumsum(flat["size"])), pa.int32()),
        pa.array(flat["docs"], pa.int32()),
        pa.array(np.append(0, np.cumsum(flat["sums"])), pa.int32()),
        pa.array(flat["terms"], pa.int32()),
        pa.array(flat["most"], pa.int64()),
    ]


def enter(asked: DataFrame, k: int) -> DataFrame:
    """``(item, doc_id, score)``: in each shard what may be among the ``k`` best of all,
    and ``(item, blocks, skipped)`` counts in the rows without a score."""
    schema = "item long, doc_id long, score long, blocks long, skipped long"

    def search(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield _search(batch, row, k)

    return asked.mapInArrow(search, schema)


def _search(batch: pa.RecordBatch, row: int, k: int) -> pa.RecordBatch:
    shard = _Shard(batch, row)
    (least,) = _lists(batch, row, "least")
    ids = batch["doc_ids"].slice(row, 1).flatten()
    block_term, block_ptr, block_docs, sum_ptr, sum_terms, sum_most = _lists(
        batch, row, "block_term", "block_ptr", "block_docs", "sum_ptr", "sum_terms", "sum_most"
    )
    first = np.searchsorted(block_term, np.arange(len(shard.weights) + 1))
    weights = np.zeros(len(shard.weights), np.int64)
    found = {n: [] for n in ("item", "doc", "score")}
    tally = []
    for i, terms in shard.items():
        floor = max(int(least[i]), 1)
        entered = shard.entry_terms(terms, int(least[i]))
        blocks = np.concatenate([np.arange(first[t], first[t + 1]) for t in entered] or [np.zeros(0, int)])
        if not len(blocks):
            continue
        weights[terms] = shard.weights[terms]
        at, owner = _entries(sum_ptr, blocks)
        # sums of integers stay exact in doubles only to 2**53, so they are added as integers
        sums = np.concatenate(([0], np.cumsum(weights[sum_terms[at]] * sum_most[at])))
        ends = np.searchsorted(owner, np.arange(len(blocks) + 1))
        bounds = sums[ends[1:]] - sums[ends[:-1]]
        order = np.argsort(-bounds, kind="stable")
        seen = np.zeros(shard.n, bool)
        docs, scores, read = [], [], 0
        while read < len(order):
            some = order[read : read + 16]
            some = some[bounds[some] >= floor]
            if not len(some):
                break
            read += len(some)
            places, _ = _entries(block_ptr, blocks[some])
            new = np.unique(block_docs[places])
            new = new[~seen[new]]
            if not len(new):
                continue
            seen[new] = True
            docs.append(new)
            scores.append(shard.scores(new, weights))
            have = np.concatenate(scores)
            if len(have) >= k:
                floor = max(floor, int(np.partition(have, -k)[-k]))
        weights[terms] = 0
        tally.append((i, len(blocks), len(blocks) - read))
        if docs:
            docs, scores = np.concatenate(docs), np.concatenate(scores)
            best = np.flatnonzero(scores >= floor)
            found["item"].append(np.full(len(best), i))
            found["doc"].append(docs[best])
            found["score"].append(scores[best])
    flat = {n: np.concatenate(x) if x else np.zeros(0, np.int64) for n, x in found.items()}
    n, m = len(flat["item"]), len(tally)
    counts = np.array(tally, np.int64).reshape(m, 3)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([flat["item"], counts[:, 0]]), pa.int64()),
            pa.concat_arrays([ids.take(pa.array(flat["doc"])), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.array(flat["score"], pa.int64()), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([none, pa.array(counts[:, 1])]),
            pa.concat_arrays([none, pa.array(counts[:, 2])]),
        ],
        ["item", "doc_id", "score", "blocks", "skipped"],
    )


def _one_row(df: DataFrame, **arrays: str) -> DataFrame:
    """A row of arrays: columns ``arrays`` in the order of the first column of ``df``."""
    kept = F.array_sort(F.collect_list(F.struct(*df.columns)))
    return df.agg(kept.alias("kept")).select(*(F.col("kept")[c].alias(n) for n, c in arrays.items()))


def _search_block(shards: DataFrame, totals: tuple, items: DataFrame, k: int, block: int) -> DataFrame:
    """Rows of `enter` with the items' ids, for one block of items."""
    terms = items.select(F.explode("terms").alias("term")).distinct()
    vocabulary = settle(_one_row(terms, vocabulary="term"), "vocabulary")
    with session_settings(shards.sparkSession, ONE_A_FILE):
        forward = settle(narrow(shards, vocabulary), "narrowed")
    held = forward.select(F.explode("terms").alias("place")).groupBy("place").agg(F.count("*").alias("n"))
    places = vocabulary.select(F.posexplode("vocabulary").alias("place", "term"))
    n_docs, n_terms = totals
    ratio = F.lit(2.0 * n_docs + 2) / (2 * F.col("held") + 1)
    weighed = settle(
        places.join(held, "place", "left")
        .select("place", "term", F.coalesce("n", F.lit(0)).alias("held"))
        .withColumn("weight", F.floor(1000 * F.log(ratio)).cast("long")),
        "weighed",
    )
    numbered = items.select(
        F.xxhash64("item_id").alias("hash"), "item_id", F.posexplode("terms").alias("i", "term")
    ).join(weighed, "term")
    per_item = numbered.groupBy("hash", "item_id").agg(F.array_sort(F.collect_list("place")).alias("places"))
    asked = _one_row(per_item, item_ids="item_id", item_places="places")
    ends = F.aggregate(
        "item_places",
        F.array(F.lit(0)),
        lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.size(p))),
    )
    asked = asked.select("item_ids", F.flatten("item_places").alias("item_terms"), ends.alias("item_ptr"))
    weights = _one_row(weighed.select("place", "held", "weight"), held="held", weights="weight")
    asked = _beside(asked, weights).select(
        "*", F.lit(n_docs).cast("long").alias("n_docs"), F.lit(n_terms).cast("long").alias("n_terms")
    )
    asked = settle(asked, "asked")
    sums = first_scores(_beside(forward.drop("doc_ids"), asked.drop("item_ids")), k)
    by_score = Window.partitionBy("item").orderBy(F.desc("score"))
    least = sums.withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k)
    each = asked.select(F.posexplode("item_ids").alias("item", "item_id"))
    least = each.join(least, "item", "left").select("item", F.coalesce("score", F.lit(1)).alias("score"))
    least = settle(_one_row(least, least="score"), "least")
    ready = _beside(_beside(forward, asked.drop("item_ids", "held")), least)
    index = settle(build_index(ready.drop("doc_ids"), block), "index")
    return settle(
        enter(ready.join(index, "shard"), k).join(F.broadcast(each), "item").drop("item"), "entered"
    )


def search(
    docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK, max_terms: int = MAX_TERMS
) -> tuple[DataFrame, DataFrame]:
    """``(item_id, rank, doc_id, score)`` of the ``k`` best, and ``(item_id, blocks, skipped)``."""
    shards = term_shards(docs.select("doc_id", "text"), ["doc_id"], NOT_ALPHANUMERIC, lower=True)
    asked, blocks = item_blocks(items, max_terms)
    totals = shards.agg(
        F.sum(F.size(F.array_distinct("indptr")) - 1),
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)),
    ).first()
    totals = (totals[0] or 0, max(totals[1] or 0, 1))
    with session_settings(docs.sparkSession, SMALL_BATCHES):  # a batch is a shard
        parts = [
            _search_block(shards, totals, asked.where(F.col("block") == b), k, block) for b in blocks
        ]
    if not parts:
        empty = items.select("item_id").limit(0)
        found = empty.select("*", *(F.lit(None).cast("long").alias(c) for c in ("doc_id", "score", "blocks", "skipped")))
    else:
        found = reduce(DataFrame.unionByName, parts)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    ranked = found.where("score > 0").withColumn(
        "rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    )
    tally = found.where("score IS NULL").groupBy("item_id")
    return (
        ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"),
        tally.agg(F.sum("blocks").alias("blocks"), F.sum("skipped").alias("skipped")),
    )


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all ``documents`` for every item of ``benchmark``."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))[0]


OP11_SQL = r"""
WITH doc_terms AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), totals AS (
    SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc_terms WHERE len(terms) > 0
), postings AS (
    SELECT r, doc_id, n, term, count(*) AS tf
    FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc_terms)
    GROUP BY r, doc_id, n, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * held + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS held FROM postings GROUP BY term), totals
), asked AS (
    SELECT DISTINCT item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, r, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term), totals
    GROUP BY item_id, r, doc_id
), ranked AS (
    SELECT item_id, doc_id, score,
           (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
