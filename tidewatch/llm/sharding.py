"""Shards by jump consistent hashing (operator 12).

A key is mixed to 64 bits and seeds a linear congruential sequence whose jumps lead from
shard to higher shard; the last one below the number of shards is the key's.  No ring
table exists and nothing is shared between tasks.  Going from n to n + 1 shards, a row
stays or goes to the new shard, and an expected 1 / (n + 1) of the keys go.

A shard's rows are numbered without gaps by sorting all rows by range (shard, key and a
random number, so that rows of one key can be split), counting in each partition and
adding up the partitions' counts: no task holds a shard.  Only the numbers travel, never
the texts.

The key alone decides the shard, so equal texts with different ids part; with
``key=F.xxhash64("text")`` they stay together.

Defined results: a null key is a key like any other; a null text has size 1 and the
CRC-32 of no bytes, 0; equal rows get different slots of one shard; an empty table gives
an empty result.  Other columns of the table are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import dense_numbers, table
from tidewatch.settings import settle

SHARDS = 16

# fixed values: the multiplier of the jumps' sequence (Lamping and Veach), and the shifts
# and multipliers of the 64-bit finaliser that mixes a key
_JUMP = 2862933555777941757
_MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))
_LAST_SHIFT = 31

#: What stands for a null key.
_NO_KEY = -(1 << 63)


def jump(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each 64-bit key among ``shards``, and among one more."""
    state = keys.astype(np.uint64)
    for shift, factor in _MIX:
        state = (state ^ (state >> np.uint64(shift))) * np.uint64(factor)
    state ^= state >> np.uint64(_LAST_SHIFT)
    now, grown, at = np.zeros((3, len(keys)), np.int64)
    moving = np.arange(len(keys))
    while len(moving):  # each round moves a key up by one shard or more
        grown[moving] = at[moving]
        inside = moving[at[moving] < shards]
        now[inside] = at[inside]
        state[moving] = state[moving] * np.uint64(_JUMP) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1
        at[moving] = ((at[moving] + 1) * ((1 << 31) / draw)).astype(np.int64)
        moving = moving[at[moving] <= shards]
    return now.astype(np.int32), grown.astype(np.int32)


def shard_of(key: Column, shards: int = SHARDS) -> Column:
    """A struct of ``shard`` and ``grown_shard``, its place with one shard more."""

    @F.pandas_udf("struct<shard: int, grown_shard: int>")
    def jumped(keys: pd.Series) -> pd.DataFrame:
        now, grown = jump(keys.to_numpy(np.int64), shards)
        return pd.DataFrame({"shard": now, "grown_shard": grown})

    return jumped(F.coalesce(key.cast("long"), F.lit(_NO_KEY)))


def assign(docs: DataFrame, shards: int = SHARDS, key: Column | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row.

    Slots follow the id (null last), then the CRC-32, then the size.
    """
    text = F.coalesce("text", F.lit(""))
    placed = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(F.col("doc_id") if key is None else key, shards).alias("to"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
    )
    placed = settle(placed.select("doc_id", "size", "text_crc32", "salt", "to.*"), "placed")
    order = ["shard", F.col("doc_id").asc_nulls_last(), "text_crc32", "size", "salt"]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    at = F.monotonically_increasing_id()
    ranged = settle(
        ranged.withColumn("at", at).select(
            "*",
            F.shiftrightunsigned("at", 33).cast("int").alias("part"),
            F.col("at").bitwiseAND((1 << 33) - 1).alias("rank"),
        ).drop("at"),
        "ranged",
    )
    numbered = dense_numbers(ranged, "part", "rank", "slot", ("shard",))
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` on 16 shards by their ids, and where they are with 17."""
    return assign(table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
            CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
        FROM range(256) AS r(i))
), texts AS (
    SELECT text, list_transform(regexp_extract_all(hex(encode(text)), '..'),
                                lambda h: ('0x' || h)::BIGINT) AS bytes
    FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)
), digests AS (
    SELECT text, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x:
        xor(c // 256, t[1 + xor(c, x) % 256])), 4294967295) AS text_crc32
    FROM texts, crc_table
), keys AS (
    SELECT DISTINCT doc_id,
           ((coalesce(doc_id, -9223372036854775808)::HUGEINT + 18446744073709551616)
            % 18446744073709551616)::UBIGINT AS k0
    FROM documents
), mixed1 AS (
    SELECT doc_id, ((xor(k0, k0 >> 30)::HUGEINT % 4294967296 * {_MIX[0][1]}
                     + (xor(k0, k0 >> 30)::HUGEINT // 4294967296 * {_MIX[0][1]} % 4294967296)
                       * 4294967296) % 18446744073709551616)::UBIGINT AS k1 FROM keys
), mixed2 AS (
    SELECT doc_id, ((xor(k1, k1 >> 27)::HUGEINT % 4294967296 * {_MIX[1][1]}
                     + (xor(k1, k1 >> 27)::HUGEINT // 4294967296 * {_MIX[1][1]} % 4294967296)
                       * 4294967296) % 18446744073709551616)::UBIGINT AS k2 FROM mixed1
), jumps AS (
    SELECT doc_id, xor(k2, k2 >> 31) AS state, NULL::BIGINT AS b, 0::BIGINT AS j FROM mixed2
    UNION ALL
    SELECT doc_id, next, j, floor((j + 1) * (2147483648::DOUBLE / ((next >> 33) + 1)::DOUBLE))::BIGINT
    FROM (SELECT doc_id, j, ((state::HUGEINT * {_JUMP} + 1)
                             % 18446744073709551616)::UBIGINT AS next FROM jumps WHERE j < 17)
), placed AS (
    SELECT doc_id, (max(b) FILTER (b < 16))::INTEGER AS shard, max(b)::INTEGER AS grown_shard
    FROM jumps GROUP BY doc_id
)
SELECT d.doc_id, (strlen(coalesce(d.text, '')) + 1)::BIGINT AS size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS LAST, text_crc32,
                          strlen(coalesce(d.text, ''))) - 1 AS slot, grown_shard
FROM documents d JOIN digests g ON g.text = coalesce(d.text, '')
JOIN placed p ON p.doc_id IS NOT DISTINCT FROM d.doc_id
"""
