"""Line dedup (operator 4), by a tree of log templates of fixed depth.

A line is cut into tokens; tokens with a digit are masked, unless they are more than half
of the line.  The tree has one level for the number of tokens and ``depth`` levels for
the leading tokens.  Below a node of the tree, a token is a constant of its position if
it stands there in at least one in ``rare`` of the node's lines (counted once per
document) and in ``min_docs`` at least, and a variable field otherwise.  So a field whose
values each recur is generalised however large the corpus is; one among the leading
tokens makes a node, and so a template, of each of its values.  A line's template is its
tokens with the variable fields generalised.  A template recurs if at least ``min_docs``
documents have it, at least ``steady`` of its tokens are constants or masked, and a
quarter of them, two at least, are constants.  A recurring template stays in the first
document that has it (least id) and its lines are dropped from all others.

A line that many documents have word for word (masked alike) recurs by that alone, in
whatever node it is.  Lines of ``min_tokens`` tokens and more need ``min_docs`` documents;
each token less doubles the number, because short lines coincide by chance.

Nothing is left out: lines of any length and any number of documents count.

**Plan.**  Nodes are counted by hash first, which leaves few lines; only those carry
their text through a shuffle.  What a join needs of a hot node (its count, a token's
support, a template's or a line's fate) is one row, written before the join, so the
join's other side can be split however many lines the node has.  Which lines a text
loses comes back as flags by position, so rewriting it is linear in its lines.

Defined results: null and empty texts are returned as they are.  Blank lines and the
order of the rest stay.  Lines are told apart by 64-bit hashes.  Rows that repeat an id count as one document, and each is
rewritten by its own text; rows with a null id likewise form one document.  A
document all of whose words were in dropped lines has an empty text (`dedup_lines`
keeps the row; `drop_emptied` removes it).  All columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACE, table, whole, words_of
from tidewatch.settings import settle

DEPTH, MIN_DOCS, MIN_TOKENS, STEADY, RARE = 3, 3, 6, 0.8, 5
FIELD = "<*>"
#: A token that holds a digit.
_NUMBERED = r"[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
#: What a line has if its tokens need masking, or more than one space stands between them.
_UNEVEN = r"[0-9\x09-\x0D]|  "


def _made(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``df`` with a column that is worked out once, however often it is used (a generator
    keeps steps apart)."""
    return df.withColumn("__made", F.explode(F.array(column))).withColumn(name, F.col("__made")).drop("__made")


def _masked(df: DataFrame) -> DataFrame:
    """``line`` as its tokens, those with a digit masked, one space between them; a line that
    is mostly such tokens stands for itself."""
    raw, masked = F.col("raw"), F.col("line")
    tokens = F.trim(F.regexp_replace(F.regexp_replace(raw, _NUMBERED, FIELD), SPACE, " "))
    df = _made(df, "line", F.when(raw.rlike(_UNEVEN), tokens).otherwise(F.trim(raw)))
    plain = F.trim(F.regexp_replace(raw, SPACE, " "))
    mostly = masked.contains(FIELD) & (2 * _n_fields(masked) > _n_tokens(masked)) & raw.rlike("[0-9]")
    return _made(df, "line", F.when(mostly, plain).otherwise(masked)).drop("raw")


def _n_tokens(line: Column) -> Column:
    """Of a masked line that is not empty."""
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _n_fields(line: Column) -> Column:
    """How often the mask stands in a line."""
    return ((F.length(line) - F.length(F.replace(line, F.lit(FIELD), F.lit("")))) / len(FIELD)).cast("int")


def _lines(docs: DataFrame, id_col: str, text_col: str, depth: int) -> DataFrame:
    """``(id, key, at, line, n, node)`` of every line; it is masked, n is 0 if it is blank.

    ``key`` tells the texts of one id apart.
    """
    text = whole(text_col)
    lines = _masked(
        docs.select(
            F.col(id_col).alias("id"), F.xxhash64(text).alias("key"),
            F.posexplode(F.split(text, "\n")).alias("at", "raw"),
        )
    )
    n = F.when(F.col("line") == "", 0).otherwise(_n_tokens(F.col("line")))
    return lines.withColumn("n", n).withColumn(
        "node", F.xxhash64("n", F.substring_index("line", " ", depth))
    )


def same_lines(places: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``(line_id, same_first)``: lines that enough documents have, and the first of these."""
    held = places.where("n > 0").select("id", "line_id", "n").distinct().groupBy("line_id", "n").agg(
        F.count(F.lit(1)).alias("docs"), F.min("id").alias("same_first")
    )
    need = min_docs * F.pow(F.lit(2.0), F.greatest(min_tokens - F.col("n"), F.lit(0)))
    return settle(held.where(F.col("docs") >= need).select("line_id", "same_first"), "same-lines")


def recurring(
    lines: DataFrame, places: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS,
    steady: float = STEADY, rare: int = RARE,
) -> DataFrame:
    """``(id, line_id)``: hashes of the lines that each document loses to templates."""
    lines = lines.where(F.col("n") >= min_tokens).select("id", "line", "node")
    nodes = places.where(F.col("n") >= min_tokens).groupBy("node").count()
    nodes = settle(nodes.where(F.col("count") >= min_docs), "nodes")
    busy = lines.join(nodes.select("node"), "node").withColumn("line_id", F.xxhash64("line"))
    busy = settle(busy.groupBy("id", "node", "line_id").agg(F.min("line").alias("line")), "lines")

    distinct = busy.groupBy("node", "line_id").agg(
        F.count(F.lit(1)).alias("docs"), F.min("line").alias("line")
    )
    distinct = settle(distinct, "distinct")
    sizes = settle(distinct.groupBy("node").agg(F.sum("docs").alias("of")), "sizes")
    tokens = distinct.select(
        "node", "line_id", "docs", F.posexplode(F.split("line", " ")).alias("at", "token")
    )
    support = tokens.where(F.col("token") != FIELD).groupBy("node", "at", "token").agg(F.sum("docs").alias("docs"))
    support = support.where(F.col("docs") >= min_docs).join(sizes, "node")
    support = settle(support.where(rare * F.col("docs") >= F.col("of")), "support")
    constant = tokens.select("node", "line_id", "at", "token").join(
        support.select("node", "at", "token"), ["node", "at", "token"]
    )
    constants = constant.groupBy("node", "line_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "token"))).alias("fixed")
    )
    constants = constants.join(
        distinct.select(
            "node", "line_id", _n_tokens(F.col("line")).alias("n"), _n_fields(F.col("line")).alias("fields")
        ),
        ["node", "line_id"],
    )
    fixed = F.size("fixed")
    enough = (fixed + F.col("fields") >= steady * F.col("n")) & (4 * fixed >= F.col("n")) & (fixed >= 2)
    templates = settle(
        constants.where(enough).select("node", "line_id", F.xxhash64("node", "n", "fixed").alias("template")),
        "templates",
    )
    named = settle(busy.select("id", "node", "line_id").join(templates, ["node", "line_id"]), "named")
    fate = (
        named.select("template", "id").distinct().groupBy("template")
        .agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first"))
        .where(F.col("docs") >= min_docs)
    )
    fate = settle(fate.select("template", "first"), "recurring")
    lost = named.join(fate, "template").where(~F.col("id").eqNullSafe(F.col("first")))
    return lost.select("id", "line_id").distinct()


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH, **options,
) -> DataFrame:
    """``docs`` without the recurring lines, with ``lines`` and ``lines_dropped`` added.

    These two names replace columns of the same name.
    """
    lines = _lines(docs, id_col, text_col, depth)
    line_id = F.when(F.col("n") > 0, F.xxhash64("line")).alias("line_id")
    places = settle(lines.select("id", "key", "at", "n", "node", line_id), "places")
    lost = settle(recurring(lines, places, min_docs, min_tokens, **options), "lost")
    lost = lost.withColumnsRenamed({"id": "lost_id", "line_id": "lost_line"})
    same = same_lines(places, min_docs, min_tokens)
    key = F.xxhash64(whole(text_col))
    places = places.select("id", "key", "at", "line_id")
    # a line of one document is a row of its own here: a frequent line's rows can be split
    places = places.join(same, "line_id", "left").join(
        lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("line_id") == F.col("lost_line")), "left"
    )
    first = F.col("same_first").isNotNull() & ~F.col("id").eqNullSafe(F.col("same_first"))
    places = places.select("id", "key", "at", (first | F.col("lost_line").isNotNull()).alias("gone"))
    flags = (
        places.groupBy("id", "key")
        .agg(F.max("gone").alias("any"), F.array_sort(F.collect_set(F.struct("at", "gone"))).alias("flags"))
        .where("any")
        .select(F.col("id").alias("__flag_id"), F.col("key").alias("__flag_key"), "flags")
    )
    kept = [c for c in docs.columns if c not in ("lines", "lines_dropped")]
    row = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("__row")
    joined = docs.select(row, F.col(id_col).alias("__id"), key.alias("__key")).join(
        flags, F.col("__id").eqNullSafe(F.col("__flag_id")) & (F.col("__key") == F.col("__flag_key")), "left"
    )
    text = F.col(f"__row.`{text_col}`")
    lines = F.split(whole(text), "\n")
    left = F.filter(lines, lambda line, i: ~F.col("flags")[i]["gone"])
    staged = joined.select(
        "__row", F.size(lines).alias("lines"), F.when(F.col("flags").isNotNull(), left).alias("left")
    )
    rewritten = F.coalesce(F.array_join("left", "\n"), text).alias(text_col)
    dropped = F.coalesce(F.col("lines") - F.size("left"), F.lit(0)).alias("lines_dropped")
    columns = [rewritten if c == text_col else F.col(f"__row.`{c}`") for c in kept]
    return staged.select(*columns, "lines", dropped)


def drop_emptied(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """From the result of `dedup_lines`: without documents that lost all their words."""
    empty = F.size(words_of(whole(text_col))) == 0
    return docs.where(~(empty & (F.col("lines_dropped") > 0))).drop("lines", "lines_dropped")


def op4_lines(spark, sf_dir):
    """Every row of documents: its text without recurring lines, and how many went."""
    deduped = dedup_lines(table(spark, sf_dir, "documents"))
    return deduped.select("doc_id", "lines", "lines_dropped", "text")


OP4_SQL = r"""
WITH raw_lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
both_ways AS (
    SELECT doc_id, pos, raw, trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')) AS plain,
           trim(regexp_replace(regexp_replace(raw,
               '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS masked
    FROM raw_lines),
lines AS (
    SELECT doc_id, pos, raw, line, len(string_split(line, ' ')) AS n,
           array_to_string(string_split(line, ' ')[1:3], ' ') AS path
    FROM (SELECT doc_id, pos, raw,
                 CASE WHEN 2 * ((len(masked) - len(replace(masked, '<*>', ''))) // 3) > len(string_split(masked, ' '))
                           AND regexp_matches(raw, '[0-9]')
                      THEN plain ELSE masked END AS line
          FROM both_ways)),
same AS (
    SELECT line, min(doc_id) AS first FROM lines WHERE line <> '' GROUP BY line, n
    HAVING count(DISTINCT doc_id) >= 3 * pow(2, greatest(6 - n, 0))),
busy AS (
    SELECT DISTINCT doc_id, line, n, path FROM lines
    JOIN (SELECT n, path FROM lines WHERE line <> '' GROUP BY n, path HAVING count(*) >= 3) USING (n, path)
    WHERE line <> '' AND n >= 6),
unique_lines AS (SELECT line, n, path, count(*) AS docs FROM busy GROUP BY ALL),
sizes AS (SELECT n, path, sum(docs) AS of FROM unique_lines GROUP BY ALL),
tokens AS (
    SELECT line, n, path, docs, unnest(string_split(line, ' ')) AS token,
           generate_subscripts(string_split(line, ' '), 1) AS pos
    FROM unique_lines),
support AS (
    SELECT n, path, pos, token FROM tokens JOIN sizes USING (n, path) WHERE token <> '<*>'
    GROUP BY n, path, pos, token, of HAVING sum(docs) >= 3 AND 5 * sum(docs) >= of),
templates AS (
    SELECT t.line, t.n, t.path, list(t.pos || ' ' || t.token ORDER BY t.pos) AS fixed
    FROM tokens t JOIN support s ON t.n = s.n AND t.path = s.path AND t.pos = s.pos AND t.token = s.token
    GROUP BY t.line, t.n, t.path
    HAVING count(*) + (len(t.line) - len(replace(t.line, '<*>', ''))) // 3 >= 0.8 * t.n
       AND 4 * count(*) >= t.n AND count(*) >= 2),
named AS (
    SELECT b.doc_id, b.line, t.n, t.path, t.fixed FROM busy b JOIN templates t USING (line)),
fate AS (
    SELECT n, path, fixed, min(doc_id) AS first FROM named GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3),
lost AS (
    SELECT doc_id, line FROM named JOIN fate USING (n, path, fixed) WHERE doc_id <> first
    UNION
    SELECT doc_id, line FROM lines JOIN same USING (line) WHERE doc_id <> first)
SELECT l.doc_id, CAST(count(*) AS INT) AS lines, CAST(count(x.line) AS INT) AS lines_dropped,
       coalesce(string_agg(l.raw, chr(10) ORDER BY l.pos) FILTER (WHERE x.line IS NULL), '') AS text
FROM lines l LEFT JOIN lost x ON l.doc_id = x.doc_id AND l.line = x.line
GROUP BY l.doc_id
"""
