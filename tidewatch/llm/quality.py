"""Quality classifier (operator 9): a sparse ensemble of rules over text statistics.

1. Statistics of every text are Spark columns (`with_statistics`).
2. Shallow boosted trees are grown on a bounded sample of labelled rows; every path
   from a root to a node is a conjunctive rule (`grow_rules`).
3. A lasso logistic regression weighs the rules; most get no weight (`lasso`).
4. The rules that keep one are compiled to Spark column expressions, so scoring is
   a projection inside the scan: no Python, no shuffle (`RuleModel.score`).

The sample is the ``max_rows`` labelled rows with the least crc32 of the id; that
bound is the only one, and scoring reads every text whole.

Defined results: a null text is empty, and an empty text has all statistics zero and
a score like any other.  Rows without a label (or a null one) teach nothing; labels
of one kind only, or none, give a constant score (their smoothed share, 0.5 without
any).  A row that repeats an id is scored by its own text and teaches once per label.
Other columns are neither read nor needed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACES, fold, table, whole, words_of

SYMBOLS = "#*$%&|<>{}[]~^=\\@+"
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
COUNTED = {
    "spaces": SPACES,
    "symbols": SYMBOLS,
    "digits": DIGITS,
    "capitals": LETTERS.upper(),
    "stops": ".",
    "commas": ",",
    "shouts": "!?",
}
_OWN = ("__row", "__id", "__y")


NAMES = (
    "words word_length distinct_words symbols digits capitals stops commas shouts line_words "
    "distinct_lines"
).split()


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns so that each is made once per row, however often it is used later.

    A generator in the plan keeps the optimizer from copying what it makes upwards.
    """
    made = F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("__made")
    return df.select("*", made).select("*", "__made.*").drop("__made")


def with_statistics(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the statistics that rules may test, each a number, in place of its text."""
    t = F.col(text)
    # most characters are small letters: counts of others look at what is left without them
    df = _once(
        df.where(t.isNotNull()),
        __n=F.length(t),
        __rest=F.translate(t, LETTERS, ""),
        __words=words_of(t),
        __lines=F.filter(F.split(t, "\n"), lambda line: line != ""),
    ).drop(text)
    left = lambda characters: F.length(F.translate("__rest", characters, ""))
    df = _once(
        df,
        __all=F.length("__rest"),
        **{f"__{name}": left(characters) for name, characters in COUNTED.items()},
        __n_words=F.size("__words"),
        __n_distinct=F.size(F.array_distinct("__words")),
        __n_lines=F.size("__lines"),
        __distinct_lines=F.size(F.array_distinct("__lines")),
    )
    count = lambda name: F.col("__all") - F.col(f"__{name}")
    solid = F.col("__n") - count("spaces")
    words, lines = F.col("__n_words"), F.col("__n_lines")
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    made = {
        "words": words.cast("double"),
        "word_length": share(solid, words),
        "distinct_words": share(F.col("__n_distinct"), words),
        **{name: share(count(name), solid) for name in ("symbols", "digits", "capitals")},
        **{name: share(count(name), words) for name in ("stops", "commas", "shouts")},
        "line_words": share(words, lines),
        "distinct_lines": share(F.col("__distinct_lines"), lines),
    }
    kept = [c for c in df.columns if not c.startswith("__") or c in _OWN]
    return df.select(*kept, *(made[n].alias(n) for n in NAMES))


@dataclass(frozen=True)
class Test:
    """One condition of a rule: a statistic at most, or above, a threshold."""

    name: str
    at_most: bool
    threshold: float

    def on(self, values: dict[str, np.ndarray]) -> np.ndarray:
        column = values[self.name]
        return column <= self.threshold if self.at_most else column > self.threshold

    def column(self) -> Column:
        column = F.col(self.name)
        return column <= self.threshold if self.at_most else column > self.threshold


Rule = tuple[Test, ...]


def _best_split(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, n_bins: int, least: int):
    """The statistic and bin whose split gains most, or None."""
    total_g, total_h, n = gradient.sum(), hessian.sum(), len(gradient)
    best = (1e-6, None, None)
    for k in range(bins.shape[1]):
        g, h, c = (
            np.cumsum(np.bincount(bins[:, k], w, n_bins))[:-1] for w in (gradient, hessian, None)
        )
        gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
        gain[(c < least) | (n - c < least)] = 0
        b = int(gain.argmax())
        if gain[b] > best[0]:
            best = (gain[b], k, b)
    return best[1:] if best[1] is not None else None


def grow_rules(
    values: dict[str, np.ndarray], y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3,
    n_bins: int = 64, least: int = 10,
) -> list[Rule]:
    """Boost shallow trees on the logistic loss; the paths to all their nodes, each once."""
    names = list(values)
    edges = [np.unique(np.quantile(values[n], np.linspace(0, 1, n_bins + 1)[1:-1])) for n in names]
    bins = np.stack([np.searchsorted(e, values[n], "left") for e, n in zip(edges, names)], 1)
    margin = np.zeros(len(y))
    rules: dict[Rule, None] = {}

    def grow(rows: np.ndarray, path: Rule, gradient, hessian) -> None:
        if path:
            rules.setdefault(path)
        split = None
        if len(path) < depth and len(rows) >= 2 * least:
            split = _best_split(bins[rows], gradient[rows], hessian[rows], n_bins, least)
        if split is None:
            margin[rows] -= rate * gradient[rows].sum() / (hessian[rows].sum() + 1)
            return
        k, b = split
        left = bins[rows, k] <= b
        for side, at_most in ((left, True), (~left, False)):
            grow(rows[side], (*path, Test(names[k], at_most, float(edges[k][b]))), gradient, hessian)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), (), p - y, p * (1 - p))
    return list(rules)


def lasso(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 600) -> tuple[float, np.ndarray]:
    """Logistic regression with an absolute penalty, by accelerated proximal steps."""
    x1 = np.concatenate([np.ones((len(x), 1)), x], 1)
    step = 4.0 * len(x1) / np.linalg.norm(x1, 2) ** 2
    w = v = np.zeros(x1.shape[1])
    t = 1.0
    for _ in range(rounds):
        grad = x1.T @ (1 / (1 + np.exp(-np.clip(x1 @ v, -500, 500))) - y) / len(y)
        new = v - step * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


@dataclass(frozen=True)
class RuleModel:
    """Rules with their weights; scoring is one column expression."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def margin(self) -> Column:
        """Over the columns of `NAMES`."""
        out = F.lit(self.intercept)
        for rule, weight in self.rules:
            condition = rule[0].column()
            for test in rule[1:]:
                condition = condition & test.column()
            out = out + F.when(condition, weight).otherwise(0.0)
        return out

    def score(self, docs: DataFrame, text_col: str = "text", out: str = "score") -> DataFrame:
        """``docs`` with the probability that a text is of the better kind, 0 to 1."""
        kept = [F.col(f"`{c}`") for c in docs.columns if c != out]
        staged = docs.select(F.struct(*kept).alias("__row"), whole(F.col(f"`{text_col}`")).alias("__t"))
        return with_statistics(staged, "__t").select(
            "__row.*", (1 / (1 + F.exp(-self.margin()))).alias(out)
        )


def sample_of(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, max_rows: int,
    learn: Column | None,
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Statistics and labels of at most ``max_rows`` labelled rows, those with the least hash."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if learn is not None:
        known = known.where(learn)
    order = [F.xxhash64(F.col("__id").cast("string")), F.col("__id"), F.col("__y")]
    known = known.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
    known = known.distinct().orderBy(*order).limit(max_rows)  # so small that it may be broadcast
    texts = docs.select(F.col(id_col).alias("__id"), whole(text_col).alias("__t"))
    rows = with_statistics(texts.join(F.broadcast(known), "__id"), "__t")
    rows = rows.orderBy(*order, *NAMES).limit(max_rows).toPandas()
    return {n: rows[n].to_numpy(float) for n in NAMES}, rows["__y"].to_numpy(float)


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
    text_col: str = "text", max_rows: int = 20_000, learn: Column | None = None,
    penalty: float = 1e-3, **growing,
) -> RuleModel:
    """Fit on labelled rows; ``learn`` (over the labels' columns) says which may be used."""
    values, y = sample_of(docs, labels, label_col, id_col, text_col, max_rows, learn)
    share = (y.sum() + 1) / (len(y) + 2)
    constant = RuleModel(float(np.log(share / (1 - share))), ())
    if len(np.unique(y)) < 2:
        return constant
    rules = grow_rules(values, y, **growing)
    if not rules:
        return constant
    x = np.stack([np.logical_and.reduce([t.on(values) for t in r]) for r in rules], 1).astype(float)
    intercept, weights = lasso(x, y, penalty)
    kept = tuple((r, float(w)) for r, w in zip(rules, weights) if w)
    return RuleModel(intercept, kept)


#: Of three folds by crc32 of the id, the one that teaches nothing.
HELD_OUT = 1


def fit_quality(spark, docs: DataFrame, sf_dir: str) -> RuleModel:
    return fit(docs, table(spark, sf_dir, "labels"), learn=fold("doc_id", 3) != HELD_OUT)


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject; the columns of ``docs``."""
    scored = fit_quality(spark, docs, sf_dir).score(docs, out="__score")
    return scored.where(F.col("__score") >= 0.5).drop("__score")


def op9_quality(spark, sf_dir):
    """Score and decision for every row of documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = fit_quality(spark, docs, sf_dir).score(docs)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
