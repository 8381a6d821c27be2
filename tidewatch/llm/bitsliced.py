"""Exact top-k search (operator 6), on a bit-sliced index.

Components are quantised to whole numbers.  A block of rows keeps every attribute as
slices: bitmap ``s`` of an attribute has a bit per row, the bit ``s`` of its value
(two's complement, so the last slice counts negatively).  For a query the scores of
all rows of a block are again slices: the sum of the attributes' slices (of the negated
attribute, for a negative component) shifted by the set bits of the query's component,
added with carries by bitmap arithmetic alone.

The best rows are read off from the most significant slice downwards: with G the rows
surely chosen and E those still equal, a slice splits E into ones and zeros; if G and
the ones are too many, only the ones remain in E, else the ones join G and the zeros
remain.  The rows left in E after the last slice tie on the boundary; their scores are
equal, and ties go to the smaller id exactly.

**Plan.**  Rows and queries are dealt into blocks of about fixed size by a hash of the
id; every block of rows meets every block of queries in a group of its own, and sends
on ``k`` rows per query.  Query blocks are large, so a row is sent to few groups.  No
task gets more than a block, whatever id or vector is frequent.

Defined results: vectors that are null or hold a null or non-finite component take no
part, nor do those with a null id.  Shorter vectors count missing components as zero.
Components of 2**63 quanta or more, which are no longs, are refused with an error; so is a
score among a query's best that does not fit a long, but not a table that has such pairs.
Rows that repeat an id are candidates each, but never for a query of the same id; a
repeated query is answered once per distinct vector, ranks running over all rows of
its id.  Fewer than ``k`` candidates give fewer rows; empty tables give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import table
from tidewatch.settings import settle

K, SCALE = 5, 256
#: Rows and queries that meet in a group.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(id, v)`` with whole components, of the vectors that take part."""
    v = F.col(vector_col)
    fine = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    checked = F.when(
        F.forall(v, lambda x: F.abs(x.cast("double") * scale) < float(1 << 63)), whole
    ).otherwise(F.raise_error(F.lit("a component is no long")).cast("array<bigint>"))
    rows = vectors.where(v.isNotNull() & F.col(id_col).isNotNull() & fine)
    return rows.select(F.col(id_col).cast("long").alias("id"), checked.alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """List values as rows of a matrix, missing components zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(int(lengths.max(initial=0)), 1) if width is None else width
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as bitmaps of 64-bit words."""
    n = -len(bits) % 64
    return np.packbits(np.append(bits, np.zeros(n, bool)), bitorder="little").view(np.uint64)


def _plus(a: np.ndarray, b: np.ndarray, carry: np.ndarray) -> np.ndarray:
    """Slices of a + b, the carry going from slice to slice."""
    out = np.empty_like(a)
    for k in range(len(a)):
        x = a[k] ^ b[k]
        out[k] = x ^ carry
        carry = (a[k] & b[k]) | (x & carry)
    return out


class Index:
    """The bit-sliced index of one block of rows, with room for products by ``most`` quanta."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, most: int):
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        largest = max(int(values.max(initial=0)), -int(values.min(initial=0)))
        self.width = (largest * most).bit_length() + 2  # of two's complement sums
        words = -(-len(ids) // 64)
        self.present = _packed(np.ones(len(ids), bool))
        # slices[attribute, s]: bitmap of bit s of the value, and of the negated value
        self.slices = np.empty((values.shape[1], self.width, words), np.uint64)
        for d in range(values.shape[1]):
            for s in range(self.width):
                self.slices[d, s] = _packed((values[:, d] >> min(s, 63)) & 1 == 1)
        ones, none = np.full(words, ~np.uint64(0)), np.zeros((self.width, words), np.uint64)
        self.negated = np.stack([_plus(~v, none, ones) for v in self.slices])

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Slices of all rows' inner products with the query.

        Carries are kept as slices of their own and are added in the end, so an
        addition is a handful of operations on whole bitmaps.
        """
        total, carries = np.zeros((2, self.width, len(self.present)), np.uint64)
        for d in np.flatnonzero(query):
            weight = abs(int(query[d]))
            value = self.slices[d] if query[d] > 0 else self.negated[d]
            for shift in range(weight.bit_length()):
                if weight >> shift & 1:
                    a, c, b = total[shift:], carries[shift:], value[: self.width - shift]
                    x = a ^ b
                    carried = (a & b) | (x & c)
                    np.bitwise_xor(x, c, out=a)
                    c[1:], c[0] = carried[:-1], 0
        return _plus(total, carries, np.zeros_like(self.present))

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows other than the query's own."""
        total = self.scores(query)
        sure, equal = np.zeros_like(self.present), self.present.copy()
        same = np.arange(np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, "right"))
        for i in same:
            equal[i // 64] &= ~np.uint64(1 << (int(i) % 64))
        n_sure = 0
        for s in range(len(total) - 1, -1, -1):
            ones = equal & (total[s] if s < len(total) - 1 else ~total[s])  # the sign: zeros are more
            n = int(np.bitwise_count(ones).sum())
            if n_sure + n > k:
                equal = ones
            else:
                sure |= ones
                equal &= ~ones
                n_sure += n
            if n_sure == k:
                break
        chosen = self._rows(sure)
        if n_sure < k:  # rows are in order of ids: the first of the ties
            chosen = np.append(chosen, self._rows(equal)[: k - n_sure])
        # the chosen rows' scores, read from their slices
        word, bit = chosen // 64, (chosen % 64).astype(np.uint64)
        bits = ((total[:, word] >> bit) & np.uint64(1)).astype(np.int64)
        kind = np.int64 if len(total) < 63 else object  # slices beyond a long: whole numbers of any size
        weights = np.array([1 << s for s in range(len(total))], kind)
        weights[-1] = -weights[-1]
        scores = weights @ bits.astype(kind)
        if len(scores) and not -(1 << 63) <= min(scores) <= max(scores) < 1 << 63:
            raise OverflowError(f"a score of row {own} does not fit a long")
        return self.ids[chosen], scores.astype(np.int64)

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _search(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if len(rows) and len(queries):
            values, wanted = _matrix(rows["v"]), _matrix(queries["v"])
            width = min(values.shape[1], wanted.shape[1])  # beyond it one side is zero
            # an upper bound; a sum of longs may exceed one
            most = int(np.abs(wanted.astype(np.float64)).sum(axis=1).max() * 1.001) + 1
            index = Index(rows["id"].to_numpy(), values[:, :width], most)
            for own, query in zip(queries["id"].to_pylist(), wanted[:, :width]):
                ids, scores = index.top(query, own, k)
                found.append((np.full(len(ids), own), ids, scores))
        parts = [np.concatenate(p) for p in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), parts)))

    return run


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
    vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for every row that ``is_query`` (over ``id``) chooses."""
    rows = settle(quantised(vectors, id_col, vector_col, scale), "quantised")
    queries = rows.where(is_query).distinct()
    n_rows, n_queries = _blocks(rows.count(), block_rows), _blocks(queries.count(), block_queries)
    # rows are read from a written table, so their places in it do not change
    dealt = lambda n: F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n)).cast("int")
    by_vector = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("id", "v", dealt(n_rows).alias("rb"), every(n_queries).alias("qb"))
    right = queries.select("id", "v", every(n_rows).alias("rb"), by_vector(n_queries).alias("qb"))
    near = (
        left.groupBy("rb", "qb")
        .cogroup(right.groupBy("rb", "qb"))
        .applyInArrow(_search(k), "query_id long, vec_id long, score long")
    )
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_bitsliced(spark, sf_dir):
    """The five best partners of every fiftieth vector of embeddings."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


# The products are of doubles, exact while scores stay below 2**53.
OP6_SQL = """
WITH rows AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, r.vec_id,
           CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
    FROM rows q JOIN rows r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
