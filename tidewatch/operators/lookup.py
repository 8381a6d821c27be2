"""Joining facts to a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import settle, size_in_bytes


def look_up(
    facts: DataFrame,
    dimension: DataFrame,
    on: str,
    spread_by: str,
    max_broadcast_rows: int = 100_000,
    salts: int = 32,
    max_broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """Left join of facts to a dimension with one row per ``on``.

    The dimension is settled, so that the rows and bytes measured are those
    joined.  If both are within their bounds it is broadcast; bytes are the larger
    of the optimizer's figure for the files and the length of the values, since
    files may be packed a thousand times.  A larger one is joined by shuffle, each
    key spread over ``salts`` tasks by a hash of ``spread_by``, because a third of
    the facts may share one key.
    """
    dimension = settle(dimension, "dimension")
    rows, width = dimension.agg(F.count(F.lit(1)), F.coalesce(F.sum(_width(dimension)), F.lit(0))).first()
    if rows <= max_broadcast_rows and max(width, size_in_bytes(dimension)) <= max_broadcast_bytes:
        return facts.join(F.broadcast(dimension), on, "left")
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [on, "_salt"], "left").drop("_salt")


def _width(df: DataFrame) -> Column:
    """Bytes of a row's values: texts by their length, nested ones as JSON, others 16."""
    out = F.lit(0).cast("long")
    for field in df.schema:
        kind = field.dataType.typeName()
        value = F.to_json(F.struct(field.name)) if kind in ("array", "map", "struct") else F.col(field.name)
        long = kind in ("array", "map", "struct", "string", "binary")
        out = out + (F.coalesce(F.octet_length(value), F.lit(0)) if long else F.lit(0)) + 16
    return out
