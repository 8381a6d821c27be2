"""URL filters (operator 5): host and path rules, then a character language-model ratio.

Where a rule fits, it decides (`rule_of`; the longest that fits).  All other URLs are
judged by two character models, one of accepted and one of rejected URLs:

1. URLs that a rule decided are the examples.  A fifth of them (by md5) is held out.
2. Each class has a Markov model over a fixed alphabet, of order two, one or zero per
   character: the longest context seen decides, mixed with the shorter ones by
   Witten-Bell weights, so that no character has probability zero.
3. A URL's score is the mean over its characters of the difference of log-likelihoods.
4. The threshold separates the held-out examples best, both classes counting alike, in
   the middle between the scores on its two sides (0 if a class is missing there).

Log-likelihood differences are kept as whole millionths and thresholds as hundredths,
so sums are exact and reruns agree.

**Plan.**  The alphabet is fixed, so a model has at most ``len(ALPHABET) ** 3`` rows
whatever the input: it may be broadcast.  Counting combines before its shuffle.
Distinct URLs are scored once and joined back; a URL that very many rows repeat is one
row on the other side of that join.

Defined results: a null URL, or one without ``://``, has an empty host and path and is
scored as the text it is (null: empty).  Without examples of both classes every URL
without a rule is allowed.  Rows that repeat an id or a URL keep one row each; other
columns are neither read nor needed; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ascii_lower, table
from tidewatch.settings import settle

#: Rules as (host and path, verdict); fixed values of the contract.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Characters of the models; digits are 0, all others ~; ^ begins and $ ends a URL.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-?=#_:&~$^"
_OTHERS = r"[^a-z0/.\-?=#_:&]"
HELD_OUT = 5


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(rest, F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    at = rule.index("/")
    return ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null.  A rule is a host, a slash and the path's begin."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        out = F.when(_fits(rule, host, path), rule).otherwise(out)
    return out


def _verdict_of(rule: Column, rules=RULES) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules:
        out = F.when(rule == name, verdict).otherwise(out)
    return out


def _spelled(url: Column) -> Column:
    plain = F.translate(ascii_lower(F.coalesce(url, F.lit(""))), "123456789", "000000000")
    return F.concat(F.lit("^^"), F.regexp_replace(plain, _OTHERS, "~"), F.lit("$"))


def _grams(spelled: str = "spelled") -> Column:
    """Every character after the two that precede it."""
    column = F.col(spelled)
    return F.transform(F.sequence(F.lit(1), F.length(column) - 2), lambda i: F.substring(column, i, F.lit(3)))


def _logs(grams: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    """``grams`` (distinct, column g) with the natural log of each last character's probability.

    ``counts``: ``(g, c)`` of one class; both are bounded by the alphabet.
    """
    a, b, c = (F.substring("g", i, 1) for i in (1, 2, 3))
    parts = counts.select("c", F.concat(a, b).alias("ab"), b.alias("b"), c.alias("z"), F.concat(b, c).alias("bz"))

    def contexts(key: str, seen: str) -> DataFrame:
        # how often a context was seen, and before how many different characters
        return parts.groupBy(key).agg(
            F.sum("c").alias(f"n_{key}"), F.count_distinct(seen).alias(f"t_{key}")
        )

    total = parts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()[0]
    keyed = grams.select("g", F.concat(a, b).alias("ab"), b.alias("b"), c.alias("z"), F.concat(b, c).alias("bz"))
    for side, key in (
        (counts.select("g", F.col("c").alias("n_g")), "g"),
        (contexts("ab", "z"), "ab"),
        (parts.groupBy("bz").agg(F.sum("c").alias("n_bz")), "bz"),
        (contexts("b", "z"), "b"),
        (parts.groupBy("z").agg(F.sum("c").alias("n_z")), "z"),
    ):
        keyed = keyed.join(F.broadcast(side), key, "left")
    n = lambda x: F.coalesce(F.col(x), F.lit(0)).cast("double")
    p0 = (n("n_z") + 1.0) / F.lit(float(total + len(ALPHABET)))
    p1 = F.when(n("n_b") > 0, (n("n_bz") + n("t_b") * p0) / (n("n_b") + n("t_b"))).otherwise(p0)
    p2 = F.when(n("n_ab") > 0, (n("n_g") + n("t_ab") * p1) / (n("n_ab") + n("t_ab"))).otherwise(p1)
    return keyed.select("g", F.log(p2).alias(name))


def _ratio(urls: DataFrame, examples: DataFrame) -> DataFrame:
    """``(g, d)``: the difference of log-likelihoods of each character, in millionths."""
    grams = settle(urls.select(F.explode(_grams()).alias("g")).distinct(), "grams")
    counts = examples.select("verdict", F.explode(_grams()).alias("g")).groupBy("verdict", "g")
    counts = settle(counts.agg(F.count(F.lit(1)).alias("c")), "counts")
    of = lambda verdict: counts.where(F.col("verdict") == verdict).select("g", "c")
    both = _logs(grams, of("allow"), "yes").join(F.broadcast(_logs(grams, of("block"), "no")), "g")
    return settle(both.select("g", F.round((F.col("yes") - F.col("no")) * 1_000_000).cast("long").alias("d")), "ratio")


def _threshold(held_out: DataFrame) -> int:
    """The bin of scores that separates the classes best, from rows of ``(verdict, bin)``.

    Bins are hundredths of a log-likelihood per character: a few thousand at most.
    """
    rows = held_out.groupBy("bin").agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("yes"),
        F.count(F.when(F.col("verdict") == "block", 1)).alias("no"),
    ).orderBy("bin").collect()
    all_yes, all_no = sum(r.yes for r in rows), sum(r.no for r in rows)
    if not all_yes or not all_no:
        return 0
    best, at, yes, no, before = -1, 0, 0, 0, rows[0].bin
    for r in rows:  # the accepted from this bin on, and the rejected below it
        right = (all_yes - yes) * all_no + no * all_yes
        if right > best:
            best, at = right, (before + r.bin + 1) // 2  # in the middle of the gap
        yes, no, before = yes + r.yes, no + r.no, r.bin
    return at


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """Per row: ``id, url, host, path, rule, verdict`` and ``score`` (null where a rule decided)."""
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("ruled", _verdict_of(F.col("rule"), rules))
    urls = settle(
        rows.select(F.coalesce("url", F.lit("")).alias("url"), F.col("ruled").alias("verdict"))
        .distinct()
        .withColumn("spelled", _spelled(F.col("url")))
        .withColumn("held_out", F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("long") % HELD_OUT == 0),
        "urls",
    )
    examples = urls.where("verdict IS NOT NULL")
    ratio = _ratio(urls, examples.where("NOT held_out"))
    per = F.sum("d") / F.count(F.lit(1))
    scored = settle(
        urls.select("url", "verdict", "held_out", F.explode(_grams()).alias("g"))
        .join(F.broadcast(ratio), "g")
        .groupBy("url", "verdict", "held_out")
        .agg(F.floor(per / 10_000).cast("long").alias("bin"), (per / 1_000_000).alias("score")),
        "scored",
    )
    kinds = {r.verdict for r in examples.where("NOT held_out").select("verdict").distinct().collect()}
    at = _threshold(scored.where("held_out AND verdict IS NOT NULL"))
    good = F.col("bin") >= at if kinds >= {"allow", "block"} else F.lit(True)
    judged = settle(
        scored.where("verdict IS NULL").select(
            F.col("url").alias("__url"), "score", F.when(good, "allow").otherwise("block").alias("judged")
        ),
        "judged",
    )
    columns = ["id", "url", "host", "path", "rule"]
    open_ = rows.where("ruled IS NULL").join(
        judged, F.coalesce("url", F.lit("")) == F.col("__url"), "left"
    )
    decided = rows.where("ruled IS NOT NULL").select(
        *columns, F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("score")
    )
    return decided.unionByName(open_.select(*columns, F.col("judged").alias("verdict"), "score"))


def op5_urls(spark, sf_dir):
    """Host, path, rule and verdict for every row of pages."""
    found = filter_urls(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


OP5_SQL = r"""
WITH parsed AS (
    SELECT page_id, coalesce(url, '') AS url,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
ruled AS (
    SELECT *, CASE WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                   WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
                   WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
                   WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
                   WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM parsed),
decided AS (
    SELECT *, CASE rule WHEN 'org/' THEN 'allow' WHEN 'com/fr/' THEN 'allow'
                        WHEN 'example.org/en/1' THEN 'block' WHEN 'example.org/es/' THEN 'block'
                        WHEN 'com/de/' THEN 'block' END AS verdict
    FROM ruled),
urls AS (
    SELECT DISTINCT url, verdict, CAST('0x' || substr(md5(url), 1, 8) AS BIGINT) % 5 = 0 AS held_out,
           '^^' || regexp_replace(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
               'abcdefghijklmnopqrstuvwxyz000000000'), '[^a-z0/.\-?=#_:&]', '~', 'g') || '$' AS spelled
    FROM decided),
grams AS (
    SELECT url, verdict, held_out, unnest([substr(spelled, i, 3) FOR i IN range(1, length(spelled) - 1)]) AS g
    FROM urls),
kinds AS (SELECT unnest(['allow', 'block']) AS verdict),
counts AS (
    SELECT verdict, g, count(*) AS c FROM grams WHERE verdict IS NOT NULL AND NOT held_out GROUP BY ALL),
n0 AS (SELECT k.verdict, coalesce(sum(c), 0) AS n FROM kinds k LEFT JOIN counts USING (verdict) GROUP BY 1),
nz AS (SELECT verdict, substr(g, 3, 1) AS z, sum(c) AS n FROM counts GROUP BY ALL),
nb AS (SELECT verdict, substr(g, 2, 1) AS b, sum(c) AS n, count(DISTINCT substr(g, 3, 1)) AS t FROM counts GROUP BY ALL),
nbz AS (SELECT verdict, substr(g, 2, 2) AS bz, sum(c) AS n FROM counts GROUP BY ALL),
nab AS (SELECT verdict, substr(g, 1, 2) AS ab, sum(c) AS n, count(*) AS t FROM counts GROUP BY ALL),
p0 AS (
    SELECT g, k.verdict, (coalesce(nz.n, 0)::DOUBLE + 1.0) / (n0.n + 39)::DOUBLE AS p
    FROM (SELECT DISTINCT g FROM grams) CROSS JOIN kinds k JOIN n0 USING (verdict)
    LEFT JOIN nz ON nz.verdict = k.verdict AND nz.z = substr(g, 3, 1)),
p1 AS (
    SELECT g, p0.verdict, CASE WHEN nb.n > 0 THEN (coalesce(nbz.n, 0)::DOUBLE + nb.t::DOUBLE * p) / (nb.n::DOUBLE + nb.t::DOUBLE) ELSE p END AS p
    FROM p0 LEFT JOIN nb ON nb.verdict = p0.verdict AND nb.b = substr(g, 2, 1)
    LEFT JOIN nbz ON nbz.verdict = p0.verdict AND nbz.bz = substr(g, 2, 2)),
p2 AS (
    SELECT p1.g, p1.verdict, CASE WHEN nab.n > 0 THEN (coalesce(c.c, 0)::DOUBLE + nab.t::DOUBLE * p) / (nab.n::DOUBLE + nab.t::DOUBLE) ELSE p END AS p
    FROM p1 LEFT JOIN nab ON nab.verdict = p1.verdict AND nab.ab = substr(p1.g, 1, 2)
    LEFT JOIN counts c ON c.verdict = p1.verdict AND c.g = p1.g),
ratio AS (
    SELECT y.g, CAST(round((ln(y.p) - ln(n.p)) * 1000000) AS BIGINT) AS d
    FROM p2 y JOIN p2 n ON y.g = n.g AND y.verdict = 'allow' AND n.verdict = 'block'),
scored AS (
    SELECT url, verdict, held_out, CAST(floor(sum(d)::DOUBLE / count(*) / 10000) AS BIGINT) AS bin
    FROM grams JOIN ratio USING (g) GROUP BY ALL),
bins AS (
    SELECT bin, count(*) FILTER (WHERE verdict = 'allow') AS yes, count(*) FILTER (WHERE verdict = 'block') AS no
    FROM scored WHERE held_out AND verdict IS NOT NULL GROUP BY bin),
cuts AS (
    SELECT bin, CAST(floor((coalesce(lag(bin) OVER (ORDER BY bin), bin) + bin + 1) / 2) AS BIGINT) AS middle,
           (sum(yes) OVER () - coalesce(sum(yes) OVER before, 0)) * sum(no) OVER ()
           + coalesce(sum(no) OVER before, 0) * sum(yes) OVER () AS good,
           sum(yes) OVER () AS all_yes, sum(no) OVER () AS all_no
    FROM bins WINDOW before AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
threshold AS (
    SELECT coalesce((SELECT middle FROM cuts WHERE all_yes > 0 AND all_no > 0 ORDER BY good DESC, bin LIMIT 1), 0) AS at_bin),
judged AS (
    SELECT url, CASE WHEN bin >= (SELECT at_bin FROM threshold)
                       OR (SELECT count(DISTINCT verdict) FROM counts) < 2 THEN 'allow' ELSE 'block' END AS verdict
    FROM scored WHERE verdict IS NULL)
SELECT d.page_id, d.host, d.path, d.rule, coalesce(d.verdict, j.verdict) AS verdict
FROM decided d LEFT JOIN judged j ON d.verdict IS NULL AND d.url = j.url
"""
