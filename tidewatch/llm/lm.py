"""Language-model scoring (operator 7): a gated recurrent model over all whole texts.

A text's tokens are its words, A-Z in lower case, and one end.

**What is counted.**  Tokens of all training documents are counted (`count_tokens`),
combined within batches and before the shuffle.  Pairs of bytes are counted per kind of
text (a column such as the language), and tell the kind that a word looks like; a word
of any frequency has one (`Kinds`).

**The model.**  ``P(word | past) = P(class | state) P(word | class, state)``.  The
``shortlist`` most frequent tokens are put in classes of one kind and like frequency,
with a softmax within each class.  All other words of a kind are one class, in which a
word has its share of counts, ``(c + 0.5) / (sum of (c + 0.5) + 0.5)``; the last half
is that of a word never seen.  So every text has a probability, and it sums to one over
words as the base score's does.  The state is a GRU's.

**Training.**  All training documents (``share`` above 1: one in so many, by a hash of
the text) are dealt to workers of about ``worker_tokens`` tokens.  In each round every
worker runs truncated backpropagation over its texts, starting from the common
parameters; the new common parameters are the workers' mean, taken in levels.

**Scoring.**  Texts lie end to end in lanes of a numpy batch; the state goes on from
window to window until a text ends, so a text is scored whole whatever its length.
Counts of the ``head`` most frequent words travel with the task (a bounded table); all
rarer words are looked up by a join, so no vocabulary is ever broadcast whole.

Words are known by 64-bit hashes.  Defined results: a null or empty text has the end
alone.  Without training documents nothing is known, N and V are 0.  Rows that repeat an
id count and are scored each by itself; a null id trains (its fold is not the held-out
one) and keeps its row.  Other columns are neither read nor needed, the kind may be
null or absent.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import (
    byte_slices,
    fold,
    table,
    text_buffer,
    whole,
    word_hashes,
    word_spans,
)
from tidewatch.llm.gru import GRU, Adam, laid_out
from tidewatch.settings import settle

#: The end of a text; words get other hashes.
END = np.uint64(1)
N_KINDS = 6
HELD_OUT = 1


@dataclass(frozen=True)
class Options:
    """Sizes of the model and of its training; all independent of the input's size."""

    shortlist: int = 1000
    head: int = 1 << 17
    class_size: int = 24
    hidden: int = 16
    share: int = 1  # one in so many training documents is learned from; 1: all
    worker_tokens: int = 2_000_000
    rounds: int = 2
    rate: float = 0.01
    steps: int = 300  # that a worker takes in a round at least, going over its texts again
    window: int = 32  # of backpropagation
    train_lanes: int = 256  # texts a worker learns from side by side
    fan: int = 32  # workers whose parameters are averaged at once, about
    lanes: int = 512  # texts scored side by side


def _tokens(batch, kinds: Kinds | None):
    """Hashes of a batch's tokens, their kinds, and how many each text has.

    Ends are put in after each text's words; an end has kind 0.
    """
    data, bounds = text_buffer(batch["text"])
    begins, ends, counts = word_spans(data, bounds)
    hashes = np.maximum(word_hashes(data, begins, ends, lower=True), END + np.uint64(1))
    after = np.cumsum(counts)
    tokens = np.insert(hashes, after, END)
    looks = None
    if kinds is not None:
        looks = np.insert(kinds.of(data, begins, ends), after, 0)
    return tokens, looks, counts + 1


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Kinds:
    """Which kind of text a word looks like, from pairs of bytes; whole-number arithmetic."""

    def __init__(self, counts: np.ndarray):
        """``counts[kind, first * 256 + second]``; the first byte of a word follows a space."""
        table_ = counts.reshape(len(counts), 256, 256) + 0.1
        logs = np.log(table_ / table_.sum(axis=2, keepdims=True))
        self.weights = np.round(logs * 1000).astype(np.int32).reshape(len(counts), -1)

    @staticmethod
    def pairs(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        small = _LOWER[data].astype(np.int32)
        before = np.empty_like(small)
        before[:1], before[1:] = 32, small[:-1]
        before[begins] = 32
        return before * 256 + small

    def of(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(begins):
            return np.zeros(0, np.int8)
        pairs = self.pairs(data, begins)
        best, kind = None, np.zeros(len(begins), np.int8)
        for k, weights in enumerate(self.weights):
            sums = np.zeros(len(data) + 1, np.int64)
            np.cumsum(weights[pairs], out=sums[1:])
            score = sums[ends] - sums[begins]
            if best is None:
                best = score
                continue
            more = score > best
            kind[more], best = k, np.maximum(best, score)
        return kind


def learn_kinds(train: DataFrame, n_kinds: int = N_KINDS) -> Kinds:
    """Count pairs of bytes of all training texts per value of ``kind``.

    The most frequent values are kinds; all others are one more.  At most 65,536 counts
    a kind come back.
    """
    top = [
        r.kind
        for r in train.groupBy("kind").count().orderBy(F.col("count").desc(), "kind").limit(n_kinds - 1).collect()
    ]
    number = {k: i for i, k in enumerate(top)}

    def run(batches):
        for batch in batches:
            counts = np.zeros((n_kinds, 65536), np.int64)
            for part in byte_slices(batch):
                data, bounds = text_buffer(part["text"])
                begins, ends, _ = word_spans(data, bounds)
                kinds = np.array([number.get(k, n_kinds - 1) for k in part["kind"].to_pylist()], np.int64)
                inside = np.zeros(len(data) + 1, np.int64)
                np.add.at(inside, begins, 1)
                np.add.at(inside, ends, -1)
                solid = np.cumsum(inside[:-1]) > 0
                key = np.repeat(kinds, np.diff(bounds)) * 65536 + Kinds.pairs(data, begins)
                counts += np.bincount(key[solid], minlength=n_kinds * 65536).reshape(n_kinds, -1)
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts.ravel()[seen])], ["key", "c"])

    rows = train.select("text", "kind").mapInArrow(run, "key long, c long")
    found = rows.groupBy("key").agg(F.sum("c").alias("c")).toPandas()
    counts = np.zeros(n_kinds * 65536)
    counts[found["key"].to_numpy(np.int64)] = found["c"].to_numpy(float)
    return Kinds(counts.reshape(n_kinds, -1))


def count_tokens(train: DataFrame, kinds: Kinds) -> DataFrame:
    """``(word, c, kind)`` of every token of the training texts; written once."""

    def combined(parts):
        words = np.concatenate([p[0] for p in parts])
        counts = np.concatenate([p[1] for p in parts])
        looks = np.concatenate([p[2] for p in parts])
        unique, first, inverse = np.unique(words, return_index=True, return_inverse=True)
        return unique, np.bincount(inverse, counts).astype(np.int64), looks[first]

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            for piece in byte_slices(batch):
                tokens, looks, _ = _tokens(piece, kinds)
                parts.append((tokens, np.ones(len(tokens), np.int64), looks))
                n += len(tokens)
                if n > 2_000_000:
                    parts = [combined(parts)]
                    n = len(parts[0][0])
                    if n > 1_000_000:
                        yield rows(parts[0])
                        parts, n = [], 0
        if parts:
            yield rows(combined(parts))

    def rows(part):
        columns = [pa.array(part[0].view(np.int64)), pa.array(part[1]), pa.array(part[2].astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["word", "c", "kind"])

    made = train.select("text").mapInArrow(run, "word long, c long, kind int")
    return settle(made.groupBy("word").agg(F.sum("c").alias("c"), F.min("kind").alias("kind")), "counts")


class Lexicon:
    """The bounded part of the counts that travels with tasks, and the classes.

    ``words`` are the head's hashes, sorted; ``place`` is a word's place in the
    shortlist or -1.  Inputs of the network are the places, then one per kind, then
    the begin of a text.
    """

    def __init__(self, head, totals, rest: dict[int, tuple[int, int]], options: Options, n_kinds: int):
        """``head``: (word, c, kind) by falling count; ``totals``: N and V; ``rest``: per
        kind, counts and number of all words (those of the head included)."""
        words, counts, kinds = head
        self.n, self.v = totals
        short = min(options.shortlist, len(words))
        place = np.full(len(words), -1, np.int32)
        place[:short] = np.arange(short)
        self.class_of, self.within = np.zeros(short, np.int32), np.zeros(short, np.int32)
        members, member_logs, class_logs = [], [], []
        for k in range(n_kinds):
            mine = np.flatnonzero(kinds[:short] == k)
            for at in range(0, len(mine), options.class_size):
                part = mine[at : at + options.class_size]
                self.class_of[part], self.within[part] = len(members), np.arange(len(part))
                share = counts[part] + 0.5
                member_logs.append(np.log(share / share.sum()))
                class_logs.append(share.sum())
                members.append(len(part))
        self.first_rest = len(members)
        self.rest_total = np.zeros(n_kinds)
        for k in range(n_kinds):
            c, v = rest.get(k, (0, 0))
            mine = kinds[:short] == k
            self.rest_total[k] = c - counts[:short][mine].sum() + 0.5 * (v - mine.sum()) + 0.5
            class_logs.append(self.rest_total[k])
            members.append(0)
        logs = np.array(class_logs)
        self.class_logs, self.members = np.log(logs / logs.sum()), members
        self.member_logs = np.concatenate([*member_logs, np.zeros(0)])
        order = np.argsort(words)
        self.words, self.counts, self.place = words[order], counts[order], place[order]
        self.short, self.n_kinds = short, n_kinds

    @property
    def number(self) -> type:
        """The least type for inputs, classes and members; none exceeds the first two's number."""
        return np.int16 if max(self.short + self.n_kinds, len(self.members)) < 1 << 15 else np.int32

    def grid(self, inputs, classes, within, lengths, n_lanes: int):
        """Inputs before the targets, classes and members by row and lane, with each token's
        place in them and the lanes' heights."""
        row, lane, heights = laid_out(lengths, n_lanes)
        grid = np.zeros((3, int(heights[0]), n_lanes), self.number)
        grid[0], grid[1] = self.short + self.n_kinds, -1
        for k, x in enumerate((self.before(inputs, lengths), classes, within)):
            grid[k][row, lane] = x
        return grid, row, lane, heights

    def network(self, hidden: int) -> GRU:
        return GRU(self.short + self.n_kinds + 1, self.members, hidden)

    def look_up(self, tokens: np.ndarray, kinds: np.ndarray):
        """Of each token: its count (-1: not in the head), input, class and member."""
        if not len(self.words):
            head = np.zeros(len(tokens), bool)
            at = np.zeros(len(tokens), np.int64)
            place = np.full(len(tokens), -1, np.int32)
            counts = place
        else:
            at = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
            head = self.words[at] == tokens
            place = np.where(head, self.place[at], -1)
            counts = np.where(head, self.counts[at], -1)
        kinds = kinds.astype(np.int32)
        short = place >= 0
        inputs = np.where(short, place, self.short + kinds)
        if self.short:
            classes = np.where(short, self.class_of[place], self.first_rest + kinds)
            within = np.where(short, self.within[place], np.int32(0))
        else:
            classes, within = self.first_rest + kinds, np.zeros(len(tokens), np.int32)
        return counts, inputs, classes, within

    def before(self, inputs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The input before each target: the token before it, or the begin of a text."""
        out = np.empty_like(inputs)
        out[1:] = inputs[:-1]
        out[np.cumsum(lengths) - lengths] = self.short + self.n_kinds
        return out


def build_lexicon(counts: DataFrame, options: Options, n_kinds: int) -> Lexicon:
    # the most frequent words, at most options.head: whole sixteenths of a power of two
    level = F.floor(F.log2("c") * 16)
    least, n = None, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        if n + r["count"] > options.head:
            break
        least, n = r.level, n + r["count"]
    head = counts.where(F.lit(False) if least is None else level >= least).toPandas()
    head = head.sort_values(["c", "word"], ascending=[False, True])
    rest = {
        r.kind: (r.c, r.v)
        for r in counts.groupBy("kind").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    }
    totals = (sum(c for c, _ in rest.values()), sum(v for _, v in rest.values()))
    arrays = (
        head["word"].to_numpy(np.int64).view(np.uint64),
        head["c"].to_numpy(np.int64),
        head["kind"].to_numpy(np.int64),
    )
    return Lexicon(arrays, totals, rest, options, n_kinds)


def train_network(train: DataFrame, kinds: Kinds, lexicon: Lexicon, options: Options) -> np.ndarray:
    """Parameters after ``rounds`` rounds of local training and averaging."""
    spark = train.sparkSession
    network = lexicon.network(options.hidden)
    vector = network.start(lexicon.class_logs, lexicon.member_logs)
    shared = spark.sparkContext.broadcast((kinds, lexicon))  # bounded by the options

    number = lexicon.number
    kind = "short" if number is np.int16 else "int"

    def encode(batches):
        kinds, lexicon = shared.value
        for batch in batches:
            for part in byte_slices(batch):
                tokens, looks, lengths = _tokens(part, kinds)
                _, inputs, classes, within = lexicon.look_up(tokens, looks)
                bounds = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
                lists = [
                    pa.ListArray.from_arrays(bounds, pa.array(x.astype(number)))
                    for x in (inputs, classes, within)
                ]
                yield pa.RecordBatch.from_arrays([*lists, pa.array(lengths)], ["i", "c", "m", "n"])

    part = train.select("text")
    if options.share > 1:
        part = part.where(F.pmod(F.xxhash64("text"), F.lit(options.share)) == 0)
    columns = f"i array<{kind}>, c array<{kind}>, m array<{kind}>, n long"
    texts = settle(part.mapInArrow(encode, columns), "texts")
    tokens = texts.agg(F.sum("n")).first()[0] or 0
    if not tokens:
        return vector
    workers = -(-tokens // options.worker_tokens)
    # texts are read from a written table, so their places in it do not change
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(workers)).cast("int")

    def learn(sent):
        def run(group: pa.Table) -> pa.Table:
            _, lexicon = shared.value
            network, vector = lexicon.network(options.hidden), np.frombuffer(sent.value, np.float32).copy()
            group = group.combine_chunks()
            lengths = group["n"].to_numpy()
            inputs, classes, within = (group[x].combine_chunks().flatten().to_numpy() for x in "icm")
            # so few lanes that the longest text does not run on beside empty ones
            n_lanes = int(np.clip(lengths.sum() // max(lengths.max(), options.window), 1, options.train_lanes))
            grid = lexicon.grid(inputs, classes, within, lengths, n_lanes)[0]
            height = grid.shape[1]
            adam = Adam(network.n, options.rate)
            while adam.t < options.steps:
                h = np.zeros((n_lanes, options.hidden), np.float32)
                for at in range(0, height, options.window):
                    grad, h = network.gradient(vector, *grid[:, at : at + options.window], h)
                    norm = float(np.sqrt((grad * grad).sum()))
                    adam.step(vector, grad * np.float32(min(1.0, 1.0 / max(norm, 1e-9))))
            return pa.table({"w": [vector.tobytes()], "n": [int(lengths.sum())]})

        return run

    for _ in range(options.rounds):
        sent = spark.sparkContext.broadcast(vector.tobytes())
        learned = texts.withColumn("worker", dealt).groupBy("worker").applyInArrow(learn(sent), "w binary, n long")
        vector = _average(learned, options.fan)
    return vector


def _average(learned: DataFrame, fan: int) -> np.ndarray:
    """The mean of ``(w, n)``, parameters weighed by tokens, in levels of about ``fan`` rows."""

    def mean(group: pa.Table) -> pa.Table:
        n = group["n"].to_numpy()
        total = sum(np.frombuffer(w.as_py(), np.float32) * float(k) for w, k in zip(group["w"], n))
        return pa.table({"w": [(total / n.sum()).astype(np.float32).tobytes()], "n": [int(n.sum())]})

    while True:
        # written first: a lost executor must not cost what all workers have learned
        learned = settle(learned.select("w", "n"), "learned")
        rows = learned.count()
        if rows == 1:
            return np.frombuffer(learned.first().w, np.float32).copy()
        groups = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-rows // fan)))
        learned = learned.withColumn("g", groups).groupBy("g").applyInArrow(mean, "w binary, n long")


def _score_batch(parts, network: GRU, vector, lexicon: Lexicon, options: Options):
    """Scores of some texts given as (tokens, kinds, lengths): all but the rare words' counts."""
    tokens = np.concatenate([p[0] for p in parts])
    looks = np.concatenate([p[1] for p in parts])
    lengths = np.concatenate([p[2] for p in parts])
    counts, inputs, classes, within = lexicon.look_up(tokens, looks)
    # so few lanes that a long text does not make most of the grid empty
    n_lanes = int(np.clip(4 * lengths.sum() // lengths.max(), 1, min(options.lanes, len(lengths))))
    grid, row, lane, heights = lexicon.grid(inputs, classes, within, lengths, n_lanes)
    del inputs, within
    height = grid.shape[1]
    logs, h = np.empty((height, n_lanes), np.float32), np.zeros((n_lanes, options.hidden), np.float32)
    at = 0
    while at < height:
        used = int((heights > at).sum())  # the longest texts run on in a few lanes
        part = slice(at, at + max(options.window, (1 << 14) // used))
        logs[part, :used], h = network.logs(vector, *grid[:, part, :used], h[:used])
        at = part.stop
    logs = logs[row, lane]
    del grid, row, lane
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)

    def per_text(which, values):
        return np.bincount(doc[which], values, len(lengths)).astype(np.float64)

    score = per_text(slice(None), logs.astype(np.float64)) / np.log(10)
    head = counts >= 0
    known = np.log10(np.where(head, counts, 0) + 0.5)
    rest = classes >= lexicon.first_rest
    # within the class of a kind's other words: a word's own count, over the class
    score -= per_text(rest, np.log10(lexicon.rest_total)[classes[rest] - lexicon.first_rest])
    own = rest & head
    score += per_text(own, known[own])
    base = per_text(head, known[head])
    n_known = np.bincount(doc[head & (counts > 0)], minlength=len(lengths))
    rare = tokens[~head].view(np.int64)
    n_rare = np.bincount(doc[~head], minlength=len(lengths))
    return lengths, n_known, base, score, rare, n_rare


def score_texts(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    kind_col: str | None = "lang", options: Options = Options(),
) -> DataFrame:
    """Per row: ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    kind = F.col(kind_col).cast("string") if kind_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), whole(text_col).alias("text"), kind.alias("kind"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    train = rows.where("NOT held_out")
    kinds = learn_kinds(train)
    counts = count_tokens(train, kinds)
    lexicon = build_lexicon(counts, options, N_KINDS)
    vector = train_network(train, kinds, lexicon, options)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((kinds, lexicon, vector))  # bounded by the options

    def run(batches):
        from pyspark import TaskContext

        kinds, lexicon, vector = shared.value
        network = lexicon.network(options.hidden)
        key = TaskContext.get().partitionId() << 40

        def out(ids, flags, parts):
            nonlocal key
            lengths, n_known, base, score, rare, n_rare = _score_batch(parts, network, vector, lexicon, options)
            keys = key + np.arange(len(lengths))
            key += len(lengths)
            bounds = pa.array(np.concatenate(([0], np.cumsum(n_rare))).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys), pa.concat_arrays(ids), pa.concat_arrays(flags), pa.array(lengths),
                    pa.array(n_known), pa.array(base), pa.array(score),
                    pa.ListArray.from_arrays(bounds, pa.array(rare)),
                ],
                ["key", "id", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
            )

        ids, flags, parts, n = [], [], [], 0
        for batch in batches:
            for piece in byte_slices(batch):
                ids.append(piece["id"])
                flags.append(piece["held_out"])
                parts.append(_tokens(piece, kinds))
                n += len(parts[-1][0])
                if n >= 2_000_000:
                    yield out(ids, flags, parts)
                    ids, flags, parts, n = [], [], [], 0
        if parts:
            yield out(ids, flags, parts)

    id_type = rows.schema["id"].dataType.simpleString()
    scored = settle(
        rows.select("id", "text", "held_out").mapInArrow(
            run,
            f"key long, id {id_type}, held_out boolean, n_tokens long, n_known long, "
            "base double, score double, rare array<long>",
        ),
        "scored",
    )
    found = F.coalesce("c", F.lit(0))
    rare = (
        scored.select("key", F.explode("rare").alias("word"))
        .join(counts.select("word", "c"), "word", "left")
        .groupBy("key")
        .agg(F.sum(F.log10(found + 0.5)).alias("own"), F.count("c").alias("more"))
    )
    unit = float(np.log10(lexicon.n + 0.5 * (lexicon.v + 1)))
    own = F.coalesce("own", F.lit(0.0))
    return scored.drop("rare").join(rare, "key", "left").select(
        "id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(lexicon.n)).cast("long").alias("train_tokens"),
        (F.col("base") + own - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("score") + own).alias("score"),
    )


def op7_lm(spark, sf_dir):
    """Base score and model score of every whole text of documents."""
    scored = score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 5) == HELD_OUT)
    return scored.withColumnRenamed("id", "doc_id")
