"""Quality rules at host level (operator 10).

1. Each document is judged by base rules over its whole text (`base_columns`).
2. Failures are counted per host.  A host's rate is shrunk towards the rate of all
   hosts with a beta prior whose two parameters are fitted to the hosts' own rates by
   moments: a host with few documents is judged mostly by the prior, one with many by
   its own record.
3. A host whose shrunk rate is above ``worst`` is rejected; its verdict is joined back,
   and documents stay if they pass the base rules and their host is not rejected.

**Plan.**  The base columns are written once, so texts are read once; counting
combines before its shuffle, and a host of any size is one row in the join.

Defined results: a null text has no words.  A null host is a host of its own.  Rows
that repeat an id each count and each keep a row.  With one host only, or hosts that
all have the same rate, the prior is as strong as the hosts' mean size.  An empty
table gives an empty result; other columns are neither read nor needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACES, WORD, table, whole, words_of
from tidewatch.settings import fits, settle

SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
#: A host is rejected if more of its documents than this fail, after shrinking.
WORST = 0.5
#: Up to so many hosts their verdicts are broadcast.
BROADCAST_HOSTS = 100_000


def _windows(words: Column, width: int) -> Column:
    """All windows of a text as (hash, place), sorted: equal ones become neighbours."""
    return F.sort_array(
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (width - 1)),
            lambda i: F.struct(
                F.xxhash64(*(F.element_at(words, i + k) for k in range(width))).alias("h"),
                i.alias("i"),
            ),
        )
    )


def _twins(ordered: Column) -> Column:
    """The places of windows that have an equal neighbour, in order."""

    def twin(pair: Column, k: Column) -> Column:
        before, after = F.get(ordered, k - 1)["h"], F.get(ordered, k + 1)["h"]
        return F.coalesce(before == pair["h"], F.lit(False)) | F.coalesce(
            after == pair["h"], F.lit(False)
        )

    return F.sort_array(F.transform(F.filter(ordered, twin), lambda pair: pair["i"]))


def _covered(places: Column, width: int) -> Column:
    """How many words lie in windows at these places."""

    def own(i: Column, k: Column) -> Column:
        to_next = F.coalesce(F.get(places, k + 1) - i, F.lit(width))
        return F.least(F.lit(width), to_next)

    return F.aggregate(F.transform(places, own), F.lit(0), lambda a, b: a + b)


def base_columns(docs: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    kept = F.struct(F.lit(1).alias("__"), *keep)
    text = F.col("__text")
    solid = F.translate(text, SPACES, "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    words = F.col("__words")
    staged = docs.select(kept.alias("__kept"), whole(text_col).alias("__text"))
    # what is used more than once is made in a step of its own (a generator keeps steps apart)
    staged = staged.select(
        "__kept",
        F.explode(
            F.array(
                F.struct(
                    words_of(text).alias("__words"),
                    F.length(solid).cast("long").alias("word_chars"),
                    (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                    lines.alias("__lines"),
                )
            )
        ).alias("s"),
    ).select("__kept", "s.*")
    staged = staged.select(
        "__kept", "word_chars", "n_symbols",
        F.size(words).cast("long").alias("n_words"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.explode(F.array(F.when(F.size(words) > WINDOW, _windows(words, WINDOW)))).alias("__ordered"),
    )
    staged = staged.withColumn("__places", F.explode(F.array(_twins(F.col("__ordered")))))
    covered = _covered(F.col("__places"), WINDOW)
    return staged.select(
        "__kept.*", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    ).drop("__")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def host_rates(judged: DataFrame, host_col: str = "host", failed_col: str = "base_failed") -> DataFrame:
    """``(host, docs, failed, rate)``: the share of failures, shrunk by a fitted beta prior.

    The prior's strength M and mean p come from the moments of the hosts' rates, each
    host weighed by its documents: with k hosts of n_i documents and N in all,
    between-host variance v = (S - (k-1) p (1-p)) / (N - sum n_i^2 / N), where S is the
    weighted square sum around p, and M = p (1-p) / v - 1.
    """
    hosts = settle(
        judged.groupBy(F.col(host_col).alias("host")).agg(
            F.count(F.lit(1)).alias("docs"),
            F.sum(F.col(failed_col).cast("long")).alias("failed"),
        ),
        "hosts",
    )
    row = hosts.agg(
        F.count(F.lit(1)).alias("k"),
        F.coalesce(F.sum("docs"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("f"),
        F.coalesce(F.sum(F.col("docs").cast("decimal(38,0)") * F.col("docs")), F.lit(0)).cast("double").alias("n2"),
    ).first()
    p = row.f / row.n if row.n else 0.0
    around = hosts.agg(F.sum(F.col("docs") * F.pow(F.col("failed") / F.col("docs") - p, 2))).first()[0] or 0.0
    spread = row.n - row.n2 / row.n if row.n else 0.0
    v = (around - (row.k - 1) * p * (1 - p)) / spread if spread > 0 else 0.0
    strength = p * (1 - p) / v - 1 if v > 0 else row.n / max(row.k, 1)
    strength = max(strength, 1e-9)
    rate = (F.col("failed") + strength * p) / (F.col("docs") + strength)
    return hosts.withColumn("rate", rate)


def host_rules(
    docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
    worst: float = WORST,
) -> DataFrame:
    """Per row: id, host, base columns, ``base_failed`` and ``kept``."""
    keep = [F.col(id_col).alias("id"), F.col(host_col).alias("host")]
    judged = settle(base_columns(docs, keep, text_col).withColumn("base_failed", base_failed()), "judged")
    bad = host_rates(judged).where(F.col("rate") > worst).select(F.col("host").alias("__host"))
    bad = settle(bad.withColumn("__bad", F.lit(True)), "bad-hosts")
    bad = F.broadcast(bad) if fits(bad, BROADCAST_HOSTS) else bad
    joined = judged.join(bad, F.col("host").eqNullSafe(F.col("__host")), "left")
    kept = ~F.col("base_failed") & F.col("__bad").isNull()
    return joined.select(*judged.columns, kept.alias("kept"))


def op10_hosts(spark, sf_dir):
    """Base rules and verdict for every row of documents; the host is its source."""
    ruled = host_rules(table(spark, sf_dir, "documents"))
    return ruled.select(F.col("id").alias("doc_id"), *(c for c in ruled.columns if c not in ("id", "host")))


OP10_SQL = r"""
WITH w AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           row_number() OVER () AS r
    FROM documents),
windows AS (
    SELECT r, i, words[i:i + 4] AS win
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) > 4)),
twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows) WHERE c > 1),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
lines AS (
    SELECT r, count(*) - count(DISTINCT line) AS n
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
    SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN lines l USING (r) LEFT JOIN covered c USING (r)),
judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
hosts AS (
    SELECT source, count(*)::DOUBLE AS docs, count(*) FILTER (WHERE base_failed)::DOUBLE AS failed
    FROM judged GROUP BY source),
whole AS (
    SELECT count(*) AS k, sum(docs) AS n, sum(failed) / sum(docs) AS p, sum(docs * docs) AS n2 FROM hosts),
spread AS (
    SELECT any_value(k) AS k, any_value(n) AS n, any_value(p) AS p,
           (sum(docs * (failed / docs - p) ** 2) - (any_value(k) - 1) * any_value(p) * (1 - any_value(p)))
             / nullif(any_value(n) - any_value(n2) / any_value(n), 0) AS v
    FROM hosts, whole),
prior AS (
    SELECT p, greatest(CASE WHEN v > 0 THEN p * (1 - p) / v - 1 ELSE n / k END, 1e-9) AS m FROM spread),
rates AS (SELECT source, (failed + m * p) / (docs + m) AS rate FROM hosts, prior)
SELECT j.doc_id, j.n_words, j.word_chars, j.n_symbols, j.n_dup_lines, j.n_repeat_words, j.base_failed,
       NOT j.base_failed AND coalesce(r.rate, 0) <= 0.5 AS kept
FROM judged j LEFT JOIN rates r ON j.source IS NOT DISTINCT FROM r.source
"""
