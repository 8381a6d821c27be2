"""Sparse document-term matrices in shards of compressed rows (CSR).

`term_shards` cuts texts into terms and writes each few megabytes of text as one shard
with a dictionary of its own: ``indptr``, ``indices`` and ``counts`` are those of a CSR
matrix whose columns are the shard's ``terms``.  `encode` numbers the terms of all
shards together, and `global_shards` puts these numbers in place of the local ones.

A term travels once per shard that has it, never once per occurrence.  So no term, not
even one that every text holds, is more than one in the size of a shard's dictionary of
the rows shuffled, and nothing has to be salted.

Defined results: a null text is empty; an empty text is a row without entries; a text
longer than a shard is a shard of its own, read in pieces; an empty table has no shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import SPACES, byte_slices, dense_numbers, text_buffer
from tidewatch.settings import session_settings, settle

#: Bytes of text in a shard.
SHARD_BYTES = 8 << 20
#: While shards are made and read: what an Arrow batch holds beside a task's own memory, and
#: a file for each shard, so that writers and readers hold one shard at a time.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "1m"}
ONE_A_FILE = {"spark.sql.files.maxRecordsPerFile": "1"}


def _gaps(codes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*codes]] = True
    return out


#: Bytes that are no part of a term: white space; or all of ASCII but letters and digits.
BLANKS = _gaps(SPACES.encode())
NOT_ALPHANUMERIC = _gaps(b for b in range(128) if not chr(b).isalnum())


def _terms(data: np.ndarray, bounds: np.ndarray, gaps: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, and how many each text has."""
    solid = ~gaps[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = bounds[:-1][np.diff(bounds) > 0]
    first[edges] = solid[edges]
    offsets = np.append(np.flatnonzero(first[solid]), np.count_nonzero(solid))
    kept = [pa.py_buffer(offsets.astype(np.int64, copy=False)), pa.py_buffer(data[solid])]
    terms = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, *kept])
    return terms, np.diff(np.searchsorted(np.flatnonzero(first), bounds))


def _pieces(data: np.ndarray, gaps: np.ndarray, most: int):
    """A long text in pieces that end where a term ends."""
    begin = 0
    while begin < len(data):
        end = min(begin + most, len(data))
        while end < len(data) and not gaps[data[end]]:
            end += 1
        yield data[begin:end]
        begin = end


def count_terms(data: np.ndarray, bounds: np.ndarray, gaps: np.ndarray, most: int):
    """``(terms, indptr, indices, counts)`` of texts: entries by text, then by local term."""
    n = len(bounds) - 1
    if n == 1 and len(data) > 2 * most:
        parts = [
            pa.table(pa.RecordBatch.from_struct_array(_terms(p, np.array([0, len(p)]), gaps)[0].value_counts()))
            for p in _pieces(data, gaps, most)
        ]
        whole = pa.concat_tables(parts).group_by("values").aggregate([("counts", "sum")])
        terms = whole["values"].combine_chunks()
        counts = whole["counts_sum"].to_numpy().astype(np.int32)
        return terms, np.array([0, len(counts)]), np.arange(len(counts)), counts
    terms, sizes = _terms(data, bounds, gaps)
    coded = terms.dictionary_encode()
    del terms
    width = max(1, len(coded.dictionary))
    cells = np.repeat(np.arange(n) * width, sizes)
    cells += coded.indices.to_numpy(zero_copy_only=False)
    cells.sort()
    starts = np.flatnonzero(np.diff(cells, prepend=-1))
    entries = cells[starts]
    rows = entries // width
    counts = np.diff(starts, append=len(cells)).astype(np.int32)
    return coded.dictionary, np.searchsorted(rows, np.arange(n + 1)), entries - rows * width, counts


def gathered(batches, most: int):
    """Texts of Arrow batches in batches of up to ``most`` bytes of text (a longer text alone)."""
    kept, size = [], 0
    for batch in batches:
        for piece in byte_slices(batch, most=most):
            n = int(text_buffer(piece["text"])[1][-1])
            if kept and size + n > most:
                yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                kept, size = [], 0
            kept.append(piece)
            size += n
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def one_list(values, kind=None) -> pa.Array:
    """A column of one row, which holds all ``values``."""
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def byte_class(codes) -> np.ndarray:
    """A table of bytes for `term_shards` to count."""
    return _gaps(codes)


def term_shards(
    docs: DataFrame,
    carry: list[str],
    gaps: np.ndarray = BLANKS,
    lower: bool = False,
    most: int | None = None,
    tallies: dict[str, np.ndarray] | None = None,
) -> DataFrame:
    """``(shard, rows, indptr, indices, counts, terms)`` of the column ``text``, settled.

    ``rows`` has the columns ``carry`` of the texts, in order, and for each of the
    ``tallies`` how many bytes of its class the text has.  With ``lower``, A-Z are
    lower-cased.
    """
    most, tallies = most or SHARD_BYTES, tallies or {}
    kept = [docs.schema[c] for c in carry] + [T.StructField(c, T.LongType()) for c in tallies]
    carried = T.ArrayType(T.StructType(kept))
    schema = T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("rows", carried),
            T.StructField("indptr", T.ArrayType(T.IntegerType())),
            T.StructField("indices", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
            T.StructField("terms", T.ArrayType(T.StringType())),
        ]
    )
    letters = np.arange(256, dtype=np.uint8)
    if lower:
        letters[65:91] += 32

    def cut(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 33
        for piece in gathered(batches, most):
            data, bounds = text_buffer(piece["text"])
            found = count_terms(letters[data] if lower else data, bounds, gaps, most)
            terms, indptr, indices, counts = found
            columns = piece["row"].flatten() + [
                pa.array(np.diff(np.searchsorted(np.flatnonzero(c[data]), bounds)), pa.int64())
                for c in tallies.values()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()),
                    one_list(pa.StructArray.from_arrays(columns, [f.name for f in kept])),
                    one_list(indptr, pa.int32()),
                    one_list(indices, pa.int32()),
                    one_list(counts, pa.int32()),
                    one_list(terms.cast(pa.string())),
                ],
                schema.names,
            )
            shard += 1

    rows = docs.select("text", F.struct(*carry).alias("row"))
    with session_settings(docs.sparkSession, {**SMALL_BATCHES, **ONE_A_FILE}):
        return settle(rows.mapInArrow(cut, schema), "term-shards")


def encode(shards: DataFrame, keep_terms: bool = False) -> DataFrame:
    """``(shard, code, term_id)``: the number of each local term among all terms, from 0 on.

    Equal terms meet in one partition, side by side, and are counted there; the partitions'
    counts are then added up, so that the numbers have no gaps.  With ``keep_terms``
    there is a column ``term``, set on one row of each term: the dictionary.
    """
    entries = shards.select("shard", F.posexplode("terms").alias("code", "term"))
    schema = "part int, rank long, shard long, code int" + (", term string" if keep_terms else "")

    def rank(batches):
        from pyspark import TaskContext

        part, at, last = TaskContext.get().partitionId(), -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch["term"].dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            new = np.diff(codes, prepend=codes[0]) != 0
            new[0] = coded.dictionary[0].as_py() != last
            ranks = at + np.cumsum(new)
            at, last = int(ranks[-1]), coded.dictionary[int(codes[-1])].as_py()
            columns = [pa.array(np.full(len(codes), part, np.int32)), pa.array(ranks)]
            columns += [batch["shard"], batch["code"]]
            if keep_terms:
                columns.append(pa.compute.if_else(pa.array(new), batch["term"], None))
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    met = entries.repartition("term").sortWithinPartitions(F.xxhash64("term"), "term")
    ranked = met.mapInArrow(rank, schema)
    return dense_numbers(settle(ranked, "terms"), "part", "rank", "term_id")


def global_shards(shards: DataFrame, codes: DataFrame) -> DataFrame:
    """`term_shards` with the numbers of `encode` as their indices, ascending in each row."""
    schema = T.StructType(
        [*shards.drop("terms", "indices").schema, T.StructField("indices", T.ArrayType(T.LongType()))]
    )

    def renumber(shard: pa.Table, codes: pa.Table) -> pa.Table:
        numbers = np.zeros(codes.num_rows, np.int64)
        numbers[codes["code"].to_numpy()] = codes["term_id"].to_numpy()
        out = []
        for row in shard.to_batches(max_chunksize=1):
            indices = numbers[row["indices"].flatten().to_numpy()]
            sizes = np.diff(row["indptr"].flatten().to_numpy())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(owner * (indices.max(initial=0) + 1) + indices)
            counts = row["counts"].flatten().to_numpy()[order]
            out.append(
                pa.RecordBatch.from_arrays(
                    [row["shard"], row["rows"], row["indptr"], one_list(counts), one_list(indices[order])],
                    schema.names,
                )
            )
        return pa.Table.from_batches(out) if out else pa.table({f.name: [] for f in schema})

    left = shards.drop("terms").groupBy("shard")
    return left.cogroup(codes.groupBy("shard")).applyInArrow(renumber, schema)


def matrix_rows(shards: DataFrame) -> DataFrame:
    """The carried columns of each row with ``total``, the sum of its counts, and ``nonzero``,
    how many entries it has."""
    carried = shards.schema["rows"].dataType.elementType
    schema = T.StructType(
        [*carried, T.StructField("total", T.LongType()), T.StructField("nonzero", T.LongType())]
    )

    def count(batches):
        for batch in batches:
            for shard in range(batch.num_rows):
                rows, indptr, counts = (batch[c].slice(shard, 1).flatten() for c in ("rows", "indptr", "counts"))
                indptr = indptr.to_numpy()
                sums = np.concatenate(([0], np.cumsum(counts.to_numpy(), dtype=np.int64)))
                totals = pa.array(sums[indptr[1:]] - sums[indptr[:-1]])
                nonzero = pa.array(np.diff(indptr).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*rows.flatten(), totals, nonzero], schema.names)

    return shards.select("rows", "indptr", "counts").mapInArrow(count, schema)
