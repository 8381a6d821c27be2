"""What several operators of this subpackage share: words, tables, hashes of words."""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for an empty text."""
    return F.array_remove(F.split(text, SPACE), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % n


# -- words of many texts at once, as numpy arrays ------------------------------------

_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_FACTOR, -1, 1 << 64)


@cache
def _is_space() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*SPACES.encode()]] = True
    return out


@cache
def _lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, kept and grown as needed."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, factor in enumerate((_FACTOR, _INVERSE)):
            column = np.full(size, factor, np.uint64)
            column[0] = 1
            _POWERS[k] = np.cumprod(column, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_buffer(texts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column, and where each text begins and ends.

    Null texts are empty.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word in ``data``, and how many words each text has."""
    solid = np.concatenate(([False], ~_is_space()[data], [False]))
    # a text's end also ends its last word
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    return begins, ends, np.diff(np.searchsorted(begins, bounds))


def word_hashes(
    data: np.ndarray, begins: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of its bytes, from running sums."""
    if lower:
        data = _lower()[data]
    powers, inverses = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * inverses[begins])


def byte_slices(batch, column: str = "text", most: int = 1 << 21):
    """Slices of an Arrow batch with about ``most`` bytes of text each (a longer text alone)."""
    _, bounds = text_buffer(batch[column])
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(bounds, bounds[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


# -- numbers without gaps -------------------------------------------------------------


def dense_numbers(
    df: DataFrame, part: str, rank: str, name: str, within: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with ``name`` in place of ``part`` and ``rank``: numbers from 0, without gaps.

    ``df`` is settled; in each part (and group ``within``) its ranks are gapless, from
    wherever they begin, and may repeat.  The parts follow one another.  The table of
    where each part begins has a row per part and group, so it is broadcast.
    """
    cells = df.groupBy(*within, part).agg(
        F.min(rank).alias("_first"), (F.max(rank) - F.min(rank) + 1).alias("_n")
    )
    before = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        *within, part, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    return (
        df.join(F.broadcast(starts), [*within, part])
        .withColumn(name, F.col("_start") + F.col(rank) - F.col("_first"))
        .drop(part, rank, "_first", "_start")
    )
