"""Mixing sources to target weights (operator 3), by Pareto order sampling.

Each source gets a target in words: its weight's share of the mix, at most
``most`` times what it has; what that leaves over is shared out again by weight.

With ``rate`` = target / words of a source, every document is taken ``floor(rate)``
times for certain.  The words still missing come from a Pareto order sample: each
document draws random odds u / (1 - u) and is ranked by them divided by its inclusion
odds, f / (1 - f) times its size over the source's mean size, with f the fraction of
the rate.  Documents are taken in that order until the missing words are reached, to
the nearest document.  Draws are hashes of the id, so reruns agree.

**No source is ever gathered.**  Whether a document is taken depends on its own rank
and on its source's threshold alone.  Thresholds come from sums over ``bins`` slices
of the rank and an exact running sum inside the one slice that crosses, so neither
texts nor whole sources are shuffled; the plan has one row per source.

Defined results: a null text has size 0; texts of size 0 are taken for certain only.
A null source is a source, the last one.  Rows that repeat an id and a size share the
draw and are taken or left together; a null id draws as an empty one.  An empty table
gives an empty result.  Other columns, whatever their names, are kept by `mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import table, whole, words_of
from tidewatch.settings import fits, settle

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BINS = 4096
#: Up to so many sources the plan is broadcast; beyond, it is joined by a shuffle.
BROADCAST_SOURCES = 100_000


def size_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 by code point, null last, over any number of them."""
    order = F.col("source").asc_nulls_last()
    parts = settle(
        sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources"
    )
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per partition
    offsets = offsets.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    number = F.row_number().over(W.partitionBy("part").orderBy(order)) - 1
    return (
        parts.withColumn("number", number)
        .join(F.broadcast(offsets), "part")
        .select("source", "n", "source_size", (F.col("number") + F.col("before")).alias("rank"))
    )


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``(source, n, source_size, target)`` per source, from rows of ``(source, size)``."""
    sources = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = settle(
        _ranked(sources)
        .withColumn("weight", weight.cast("long"))
        .withColumn("top", F.col("source_size") * most),
        "weighed",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, None
    while True:  # each turn stops the targets that are above; the level only rises
        over = F.lit(False) if full is None else F.col("weight") * F.lit(full) > F.col("top")
        stopped, open_weight, n_stopped = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("top"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count(F.when(over, 1)),
        ).first()
        if not open_weight:
            level = float("inf")
            break
        level = (share * total - stopped) / open_weight
        if full is not None and level == full:
            break
        full = level
    target = F.least(F.col("weight") * F.lit(level), F.col("top").cast("double"))
    return sources.select("source", "n", "source_size", target.alias("target"))


def _rank(doc_id: Column, size: Column, seed: str) -> Column:
    """Random odds over inclusion odds, from 0 to 1; null for what is never drawn.

    Needs the columns ``mean`` and ``part`` of the source.
    """
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed)))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    u = (draw + 0.5) / F.lit(float(1 << 52))
    odds = u / (1 - u)
    inclusion = F.col("part") / (1 - F.col("part")) * (size / F.col("mean"))
    rank = odds / inclusion
    return F.when((size > 0) & (F.col("part") > 0), rank / (1 + rank))


def _bin(bins: int) -> Column:
    return F.least(F.floor(F.col("rank") * bins), F.lit(bins - 1)).cast("int")


def _small(plan: DataFrame) -> DataFrame:
    return F.broadcast(plan) if fits(plan, BROADCAST_SOURCES) else plan


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    named = _small(plan).withColumnRenamed("source", "__source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def plan_mix(sizes: DataFrame, seed: str = "mix", bins: int = BINS, **sharing) -> DataFrame:
    """One row per source: target, certain copies, and the rank up to which a copy is added.

    ``sizes`` has ``doc_id, source, size`` and is read several times.
    """
    rate = F.col("target") / F.col("source_size")
    certain = F.when(F.col("source_size") > 0, F.floor(rate)).otherwise(0).cast("long")
    plan = settle(
        targets(sizes, **sharing)
        .withColumn("certain", certain)
        .withColumn("missing", F.col("target") - F.col("certain") * F.col("source_size"))
        .withColumn("mean", F.col("source_size") / F.col("n"))
        .withColumn(
            "part",
            F.when(F.col("source_size") > 0, F.col("missing") / F.col("source_size")).otherwise(0.0),
        ),
        "plan",
    )
    ranked = _with_plan(sizes, plan).select(
        "source", "doc_id", "size", "missing", _rank(F.col("doc_id"), F.col("size"), seed).alias("rank")
    )
    ranked = ranked.where("rank IS NOT NULL").withColumn("bin", _bin(bins))
    summed = ranked.groupBy("source", "bin", "missing").agg(F.sum("size").alias("words"))
    running = W.partitionBy("source").orderBy("bin")  # at most ``bins`` rows of a source
    crossing = (
        summed.withColumn("until", F.sum("words").over(running))
        .where("until > missing")
        .groupBy("source")
        .agg(F.min(F.struct("bin", (F.col("until") - F.col("words")).alias("before"))).alias("c"))
        .select("source", F.col("c.bin").alias("cross"), F.col("c.before").alias("before"))
    )
    crossing = settle(crossing, "crossing")
    inside = _with_plan(ranked, crossing).where("bin = cross")
    inside = inside.groupBy("source", "rank", "doc_id", "size", "missing", "before").agg(F.sum("size").alias("words"))
    order = W.partitionBy("source").orderBy("rank", F.col("doc_id"), "size")
    last = (
        inside.withColumn("until", F.col("before") + F.sum("words").over(order))
        .where("until - words / 2 <= missing")
        .groupBy("source")
        .agg(F.max(F.struct("rank", "doc_id", "size")).alias("last"))
    )
    for side in (crossing.drop("before"), last):
        side = side.withColumnRenamed("source", "__source")
        plan = plan.join(side, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    return settle(plan, "plan")


def _copies(bins: int, seed: str) -> Column:
    """How often a row is taken; over ``doc_id``, ``size`` and the plan's columns."""
    rank = _rank(F.col("doc_id"), F.col("size"), seed)
    bin_ = F.least(F.floor(rank * bins), F.lit(bins - 1)).cast("int")
    mine = F.struct(rank.alias("rank"), F.col("doc_id").alias("doc_id"), F.col("size").alias("size"))
    added = F.col("cross").isNull() | (bin_ < F.col("cross")) | (
        (bin_ == F.col("cross")) & F.col("last").isNotNull() & (mine <= F.col("last"))
    )
    return F.col("certain") + F.when(rank.isNotNull() & added, 1).otherwise(0)


def _sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size_of(whole(text_col)).alias("size")
    )


def taken(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    seed: str = "mix", bins: int = BINS, **sharing,
) -> DataFrame:
    """Per row: its size, its source's size and target, and the words the mix takes of it."""
    sizes = settle(_sizes(docs, id_col, source_col, text_col), "sizes")
    planned = _with_plan(sizes, plan_mix(sizes, seed, bins, **sharing))
    words = F.col("size") * _copies(bins, seed)
    return planned.select("doc_id", "size", "source_size", "target", words.alias("taken"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    seed: str = "mix", bins: int = BINS, **sharing,
) -> DataFrame:
    """The mix itself: each row as often as it is taken, all columns as they were."""
    sizes = settle(_sizes(docs, id_col, source_col, text_col), "sizes")
    plan = plan_mix(sizes, seed, bins, **sharing)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    rows = docs.select(
        row, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        size_of(whole(text_col)).alias("size"),
    )
    copies = F.array_repeat(F.lit(0), _copies(bins, seed).cast("int"))
    return _with_plan(rows, plan).select("__row", F.explode(copies)).select("__row.*")


def op3_mixing(spark, sf_dir):
    """Size, target and words taken for every row of documents."""
    return taken(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH sizes AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
    FROM documents),
sources AS (
    SELECT source, count(*) AS n, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM sizes GROUP BY source),
weighed AS (
    SELECT *, CAST([3, 1, 2][CAST(rank % 3 AS INT) + 1] AS BIGINT) AS weight, source_size * 2 AS top
    FROM sources),
levels AS (
    SELECT source, weight, top,
           (1.5::DOUBLE * (SELECT sum(source_size) FROM weighed)::DOUBLE
            - coalesce(sum(top) OVER before, 0)::DOUBLE) / (sum(weight) OVER rest)::DOUBLE AS level,
           row_number() OVER turn AS turn
    FROM weighed
    WINDOW turn AS (ORDER BY top / weight, source NULLS LAST),
           before AS (turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           rest AS (turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT arg_min(level, turn) AS level FROM levels WHERE weight * level <= top),
planned AS (
    SELECT source, n, source_size,
           least(weight * coalesce((SELECT level FROM level), 'inf'::DOUBLE), top::DOUBLE) AS target
    FROM weighed),
plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS certain,
           source_size / n AS mean
    FROM planned),
drawn AS (
    SELECT s.*, p.source_size, p.target, p.certain, p.mean,
           p.target - p.certain * p.source_size AS missing,
           CASE WHEN p.source_size > 0 THEN (p.target - p.certain * p.source_size) / p.source_size ELSE 0 END AS part,
           (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 13) AS BIGINT)::DOUBLE + 0.5)
             / 4503599627370496.0::DOUBLE AS u
    FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
ranked AS (
    SELECT *, CASE WHEN size > 0 AND part > 0
                   THEN (u / (1 - u)) / (part / (1 - part) * (size / mean)) END AS odds
    FROM drawn),
running AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds / (1 + odds), doc_id, size) AS until,
           sum(size) OVER (PARTITION BY source, odds / (1 + odds), doc_id, size) AS tied
    FROM ranked WHERE odds IS NOT NULL),
added AS (
    SELECT doc_id, source, size, 1 AS one FROM running WHERE until - tied / 2 <= missing
    GROUP BY ALL)
SELECT r.doc_id, r.size, r.source_size, r.target,
       CAST(r.size * (r.certain + coalesce(a.one, 0)) AS BIGINT) AS taken
FROM ranked r LEFT JOIN added a
  ON r.doc_id IS NOT DISTINCT FROM a.doc_id AND r.source IS NOT DISTINCT FROM a.source AND r.size = a.size
"""
