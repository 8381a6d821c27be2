"""Which filter removes what, and in which order (operator 13): a filter interaction audit.

The words of all texts are encoded by one global dictionary and the texts become rows of
a sparse document-term matrix in CSR shards (`matrix`).  The sum of a row is a text's
number of words (filter A), its number of nonzero entries that of its different words
(filter B).  The flags of the other filters travel with the rows.  A text's failures
then are one of 32 sets, and everything the audit reports follows from how many texts,
good texts and toxic texts of a part have each set.

Filters, by what fails them: A under ``min_words`` words; B fewer different words than
``min_distinct`` percent of the words; C more capitals (A-Z) than ``max_capitals``
percent of the code points; D any of ``#$%&*|``; E identical to the text of a row with a
smaller id.  Texts are told apart by SHA-256.

**Large groups.**  Texts that repeat are one row of the table of first ids, written
before it is joined, so a hot text's rows can be split.  Rows of one id are added up
before labels are joined.  A part is 32 numbers before it becomes 600 rows.

Defined results: a null text is empty and equals other empty texts; an empty text fails
A only (and E).  A null language is the empty string.  A row without an id fails E never
and has no label; rows of one id with one text do not fail E through each other.  A
document is good (toxic) if any label row of its id says so.  An empty table gives no
rows.  Other columns of the table are not read.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import table, whole
from tidewatch.llm.matrix import SMALL_BATCHES, byte_class, encode, global_shards, matrix_rows, term_shards
from tidewatch.settings import session_settings, settle

FILTERS = "ABCDE"
#: Bytes counted in each text: capitals, and symbols that fail filter D.
TALLIES = {"capitals": byte_class(range(65, 91)), "symbols": byte_class(b"#$%&*|")}


def document_flags(
    docs: DataFrame, min_words: int = 200, min_distinct: int = 50, max_capitals: int = 3
) -> DataFrame:
    """``(doc_id, part, failed)`` of every row; ``failed`` has bit k set if filter k fails."""
    given = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), whole().alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    given = given.select("text", "doc_id", "part", digest.alias("digest"), F.length("text").alias("points"))
    shards = term_shards(given, ["doc_id", "part", "digest", "points"], tallies=TALLIES)
    codes = encode(shards)
    with session_settings(docs.sparkSession, SMALL_BATCHES):
        rows = settle(matrix_rows(global_shards(shards, codes)), "matrix-rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    first = settle(first.where("n > 1").drop("n"), "first-ids")
    fails = [
        F.col("total") < min_words,
        100 * F.col("nonzero") < min_distinct * F.col("total"),
        100 * F.col("capitals") > max_capitals * F.col("points"),
        F.col("symbols") > 0,
        F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)),
    ]
    failed = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return rows.join(first, "digest", "left").select("doc_id", "part", failed.alias("failed"))


def failure_sets(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, failed, n, good, toxic)``: documents by the set of filters they fail."""
    labelled = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    counted = flags.groupBy("doc_id", "part", "failed").agg(F.count("*").alias("n"))
    return (
        counted.join(labelled, "doc_id", "left")
        .groupBy("part", "failed")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )


def _orders() -> list[dict]:
    """Every step of every order: the bits of the filters before it, and its own."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            name = "".join(FILTERS[f] for f in order)
            out.append({"filter_order": name, "step": step, "before": before, "own": 1 << k})
            before |= 1 << k
    return out


def interactions(sets: DataFrame) -> DataFrame:
    """The report of each part, order and step from `failure_sets`."""
    cells = sets.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets"))
    steps = F.from_json(
        F.lit(json.dumps(_orders())),
        "array<struct<filter_order: string, step: int, before: int, own: int>>",
    )
    rows = cells.select("part", "sets", F.explode(steps).alias("at")).select("part", "sets", "at.*")
    before, own = F.col("before"), F.col("own")

    def total(which, of: str = "n") -> Column:
        return F.aggregate(
            F.filter("sets", lambda s: which(s["failed"])), F.lit(0).cast("long"), lambda a, s: a + s[of]
        )

    def fails(s: Column, bits: Column) -> Column:
        return s.bitwiseAND(bits) != 0

    def removed(s: Column) -> Column:
        return fails(s, own) & ~fails(s, before)

    # a document that fails k filters meets its own first in 120 / k of the orders
    share = F.aggregate(
        F.filter("sets", lambda s: fails(s["failed"], own)),
        F.lit(0).cast("long"),
        lambda a, s: a + s["n"] * F.floor(F.lit(120) / F.bit_count(s["failed"])),
    )
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda s: ~fails(s, before.bitwiseOR(own))).alias("kept"),
        total(removed).alias("removed"),
        total(lambda s: fails(s, own) & fails(s, before)).alias("redundant"),
        total(lambda s: s == own).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        share.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    return interactions(failure_sets(document_flags(docs, **bounds), labels))


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders over whole ``documents``, per language."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), firsts AS (
    SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text
), counted AS (
    SELECT doc_id, part, text, first_id,
           list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM texts JOIN firsts USING (text)
), flags AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN coalesce(doc_id > first_id, false) THEN 'E' ELSE '' END AS failed
    FROM counted
), marks AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), judged AS (
    SELECT part, failed, count(*) AS n,
           count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM flags LEFT JOIN marks USING (doc_id) GROUP BY part, failed
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step, filter_order[step] AS own, filter_order[:step - 1] AS before
    FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)
), report AS (
    SELECT part, filter_order, step, own, n, good, toxic,
           contains(failed, own) AS fails_own, failed = own AS only_own,
           before <> '' AND regexp_matches(failed, '[' || before || '_]') AS gone
    FROM judged, steps
), summed AS (
    SELECT part, filter_order, step, any_value(own) AS own,
           coalesce(sum(n) FILTER (NOT gone AND NOT fails_own), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (NOT gone AND fails_own), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (gone AND fails_own), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (only_own), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (NOT gone AND fails_own), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (NOT gone AND fails_own), 0)::BIGINT AS toxic_lost
    FROM report GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM summed
"""
