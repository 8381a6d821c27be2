"""SimHash near-duplicates (operator 8), by the pigeonhole of fingerprint blocks.

A text is lower-cased (A-Z), cut into words and 4-word shingles; each of the 64 bits
of its fingerprint is the majority of that bit in the shingles' XXH64.  Fingerprints
that differ in at most ``distance`` bits link.

**Finding links.**  The 64 bits are cut into ``blocks`` blocks.  At most ``distance``
of them can hold a difference, so two near fingerprints agree in at least
``blocks - distance`` whole blocks: every such choice of blocks is a key, near
fingerprints share one of the keys, and what shares a key is verified by counting the
bits.  No pair is lost.

**Large groups.**  Equal fingerprints are one node, however many documents have them.
Below one key, fingerprints are compared in blocks of fixed size (numpy), and of the
links found in a comparison only a spanning forest leaves the task: components stay
the same, and the rows made are linear in the fingerprints.

Defined results: a null text is empty; a text without words has fingerprint zero and
links like any other; with fewer words than a shingle the whole sequence is the one
shingle.  Rows that repeat an id keep one row each and count as one node if their
fingerprints agree.  A null id keeps its row; it names a component only if no row of
the component has an id.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, table, whole
from tidewatch.llm.components import components
from tidewatch.settings import settle

#: Texts whose shingles are hashed together, and shingles whose bits are counted together.
_ROWS, _SHINGLES = 512, 1 << 16


def _fingerprint(text: str, shingle: int, find, digest) -> int:
    words = find(text.encode().lower())
    if not words:
        return 0
    if len(words) <= shingle:
        return digest(b" ".join(words), 42)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(begins[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.array([digest(line[i:j], 42) for i, j in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _SHINGLES):
        part = np.unpackbits(
            hashes[k : k + _SHINGLES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        ones += part.sum(axis=0, dtype=np.int64)
    over = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(over.view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4
) -> DataFrame:
    """``(id, fp)`` of every row; the fingerprint's 64 bits as a signed long."""

    def run(batches):
        import xxhash

        find, digest = re.compile(WORD.encode()).findall, xxhash.xxh64_intdigest
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                made = [_fingerprint(t, shingle, find, digest) for t in part["text"].to_pylist()]
                fps = pa.array(np.array(made, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([part["id"], fps], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def _widths(blocks: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each block; together the 64 bits."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    return [(i, j - i) for i, j in zip(cuts, cuts[1:])]


def _blocks_for(n: int, distance: int) -> int:
    """The fewest blocks whose keys are long enough for ``n`` fingerprints.

    More blocks make longer keys (fewer chance meetings) but more of them; the links
    found are the same for any number.
    """
    for blocks in range(distance + 2, 2 * distance + 1):
        bits = sum(sorted(w for _, w in _widths(blocks))[: blocks - distance])
        if n <= 8 << bits:
            return blocks
    return max(2 * distance, distance + 1)


def _keyed(fps: DataFrame, distance: int, blocks: int) -> DataFrame:
    """``(key, fp)`` for every choice of blocks that may be equal."""
    cuts = _widths(blocks)
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        parts = [
            F.shiftrightunsigned("fp", cuts[b][0]).bitwiseAND(F.lit((1 << cuts[b][1]) - 1))
            for b in chosen
        ]
        keys.append(F.struct(F.lit(number).alias("choice"), F.xxhash64(*parts).alias("bits")))
    return fps.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.*", "fp")


def _forest(distance: int):
    """For a group of fingerprints: each one with the least it is connected to in the group."""

    def run(group: pa.Table) -> pa.Table:
        fps = np.unique(group["fp"].to_numpy())
        bits = fps.view(np.uint64)
        near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= distance
        label = np.arange(len(fps))
        while True:
            least = np.where(near, label[None, :], len(fps)).min(axis=1)
            if (least == label).all():
                break
            label = least
        moved = label != np.arange(len(fps))
        return pa.table({"a": fps[moved], "b": fps[label[moved]]})

    return run


def links(fps: DataFrame, distance: int = 4, blocks: int | None = None, small: int = 64, chunk: int = 1024) -> DataFrame:
    """``(a, b)`` between distinct fingerprints, with the components of all near pairs.

    Keys with at most ``small`` fingerprints are compared in place by Spark; larger
    ones in pairs of chunks of about ``chunk``.
    """
    fps = settle(fps.select("fp").distinct(), "fingerprints")
    keyed = _keyed(fps, distance, blocks or _blocks_for(fps.count(), distance))
    key = ["choice", "bits"]
    sizes = settle(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "keys")
    shared = keyed.join(sizes, key)
    few = (
        shared.where(F.col("n") <= small)
        .groupBy(*key)
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps", F.explode("fps").alias("a"))
        .select(
            "a",
            F.explode(
                F.filter(
                    "fps",
                    lambda b: (b > F.col("a"))
                    & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= distance),
                )
            ).alias("b"),
        )
    )
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    many = (
        shared.where(F.col("n") > small)
        .withColumn("chunks", chunks)
        .select(*key, "fp", "chunks", mine.alias("mine"))
        .select(*key, "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select(*key, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp")
        .groupBy(*key, "i", "j")
        .applyInArrow(_forest(distance), "a long, b long")
    )
    return few.unionByName(many).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    distance: int = 4,
    blocks: int | None = None,
) -> DataFrame:
    """``(id, fp, component_id)`` of every row; the component is named by its least id."""
    rows = settle(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    named = components(links(rows, distance, blocks)).withColumnRenamed("node", "fp")
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    reached = settle(
        least.join(named, "fp", "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("component")
        ),
        "classes",
    )
    classes = reached.groupBy("component").agg(F.min("least").alias("component_id"))
    named = settle(reached.join(settle(classes, "names"), "component").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with the least id of each component; all columns.

    Of rows that repeat such an id one stays, the least by all its columns.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    stay = found.where(F.col("id").eqNullSafe(F.col("component_id")))
    stay = stay.select(F.col("id").alias("__stays")).distinct()
    kept = docs.join(stay, F.col(id_col).cast("long").eqNullSafe(F.col("__stays")), "left_semi")
    one = F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("row")
    return kept.groupBy(F.col(id_col).alias("__id")).agg(one).select("row.*")


def op8_simhash(spark, sf_dir):
    """Fingerprint and component of every row of documents."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
