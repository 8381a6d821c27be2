"""SentencePiece encoding and decoding (operator 1) for merge-type vocabularies.

A text's symbols are its characters.  Every adjacent pair of symbols that makes a piece
stands on an agenda; the pair with the best score is merged, the leftmost of equals,
and its new neighbours' pairs are put on the agenda, until it is empty.  Symbols that
are no piece are spelled in bytes, or are unknown if the vocabulary has no bytes.

**In batches.**  No piece of such a vocabulary continues past the space that begins
the next word, and none holds a line end, so a text is cut there and each distinct cut
is encoded once.  The agendas of many cuts are kept as one table, a row of pair scores
each, and popped in step with numpy.  Cuts met again come from a bounded store.

**Checked.**  Each newly encoded cut and each decoded text is held against the
sentencepiece library within its Arrow batch; ``agrees`` tells the result.

The model's bytes travel with the task, so only the driver needs the file.  Texts are
rows of a scan: nothing is shuffled.

Defined results: a null text is empty; an empty text has no ids and decodes to an
empty text.  Line ends, runs of spaces and any characters come back as they were.  An
empty table gives an empty result.  Columns other than the text are kept, except
those named like the results (``n_tokens, ids, decoded, agrees``), which are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import table, whole

SPACE = "▁"
#: Cuts kept by a worker; texts and cuts encoded together.
_STORE, _ROWS, _TOGETHER = 300_000, 256, 16_384
#: Cuts of more characters have an agenda of their own, a heap.  No symbol.
_LONG, _GONE = 4_096, -1
_RESULTS = ("n_tokens", "ids", "decoded", "agrees")


class Vocabulary:
    """A merge-type model: its pieces, their scores, and which symbol pairs merge."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        self.unknown = lib.unk_id()
        special = {i for i in range(n) if lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)}
        self.bytes = {int(pieces[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.id_of = {
            p: i for i, p in enumerate(pieces) if i not in special and i not in self.byte_of
        }
        self.score = np.array([lib.get_score(i) for i in range(n)], np.float32)
        # what each id reads as; None: a byte
        self.surface = [
            None if i in self.byte_of
            else "" if lib.is_control(i)
            else " \u2047 " if i == self.unknown
            else p.replace(SPACE, " ")
            for i, p in enumerate(pieces)
        ]
        self._check_kind(lib, pieces)
        self._pair_table(n)
        long = [p for p in self.id_of if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in long):
            self.cuts = re.compile(r"(?s).+")
        else:
            self.cuts = re.compile(rf"\n+|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")

    def _check_kind(self, lib, pieces) -> None:
        """Merge-type, identity normalisation with a space put before the text: else refuse."""
        probe = "a  béﬁ"
        if lib.normalize(probe) != (SPACE + probe.replace(" ", SPACE)):
            raise ValueError("only models that keep the text and put a space before it")
        if lib.encode(probe, out_type=str) and "".join(lib.encode("ab", out_type=str)) != SPACE + "ab":
            raise ValueError("only models whose pieces spell the text")

    def _pair_table(self, n: int) -> None:
        """Sorted keys (left, right) with the piece they make; characters without an id get one."""
        self.symbol_of = {p: i for p, i in self.id_of.items() if len(p) == 1}
        self.n_ids = n
        for p in self.id_of:
            for c in p:
                self.symbol_of.setdefault(c, n + len(self.symbol_of))
        self.symbol_at = -np.arange(0x110000, dtype=np.int64) - 2  # by code point
        for c, i in self.symbol_of.items():
            self.symbol_at[ord(c)] = i
        self.character = {i: c for c, i in self.symbol_of.items()}
        symbol = dict(self.id_of) | self.symbol_of
        keys, made = [], []
        for p, i in self.id_of.items():
            for k in range(1, len(p)):
                left, right = symbol.get(p[:k]), symbol.get(p[k:])
                if left is not None and right is not None:
                    keys.append((left << 32) | right)
                    made.append(i)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.made = np.append(np.array(made, np.int64)[order], -1)
        self.table: dict | None = None  # the same by key, made when a long cut comes

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that two symbols make (-1: none), and its score (-inf)."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        piece = np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)
        return piece, np.where(piece >= 0, self.score[piece], -np.inf)

    def merge(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids that are left of all cuts when their agendas are empty, and how many of each."""
        width, n = max(map(len, cuts)), len(cuts)
        lengths = np.fromiter(map(len, cuts), np.int64, n)
        flat = self.symbol_at[np.frombuffer("".join(cuts).encode("utf-32-le"), np.uint32)]
        symbols = np.full((n, width + 1), -1, np.int64)  # the last column stays empty
        symbols[np.arange(width + 1) < lengths[:, None]] = flat
        left = np.tile(np.arange(-1, width), (n, 1))
        right = np.tile(np.arange(1, width + 2), (n, 1))
        right[:, -1] = width
        piece, agenda = self._pairs(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(n)
        while len(rows):
            at = agenda[rows].argmax(1)  # the best score, the leftmost of equals
            go = agenda[rows, at] > -np.inf
            rows, at = rows[go], at[go]
            if not len(rows):
                break
            gone = right[rows, at]
            after = right[rows, gone]
            symbols[rows, at] = piece[rows, at]
            symbols[rows, gone] = -1
            agenda[rows, np.minimum(gone, width - 1)] = -np.inf
            right[rows, at] = after
            left[rows, np.minimum(after, width)] = at
            piece[rows, at], agenda[rows, at] = self._pairs(symbols[rows, at], symbols[rows, after])
            before = left[rows, at]
            has = before >= 0
            r, b = rows[has], before[has]
            piece[r, b], agenda[r, b] = self._pairs(symbols[r, b], symbols[r, at[has]])
        kept = symbols[:, :-1] != -1
        return self._spelled(symbols[:, :-1][kept], kept.sum(1))

    def merge_long(self, cut: str) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long cut, its agenda a heap: entries of pairs that are gone by
        the time they come up are passed over."""
        if self.table is None:
            self.table = {k: (m, -float(self.score[m])) for k, m in zip(self.keys[:-1].tolist(), self.made[:-1].tolist())}
        found, n = self.table, len(cut)
        symbols = self.symbol_at[np.frombuffer(cut.encode("utf-32-le"), np.uint32)].tolist()
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []

        def put(a: int, b: int) -> None:
            if symbols[a] >= 0 and symbols[b] >= 0:
                made = found.get((symbols[a] << 32) | symbols[b])
                if made and made[1] < np.inf:
                    heappush(agenda, (made[1], a, b, symbols[a], symbols[b], made[0]))

        for a in range(n - 1):
            put(a, a + 1)
        while agenda:  # the best score, the leftmost of equals
            _, a, b, was_a, was_b, piece = heappop(agenda)
            if symbols[a] != was_a or symbols[b] != was_b or right[a] != b:
                continue
            symbols[a], symbols[b] = piece, _GONE
            right[a] = right[b]
            if right[a] < n:
                left[right[a]] = a
                put(a, right[a])
            if left[a] >= 0:
                put(left[a], a)
        kept = np.array([s for s in symbols if s != _GONE], np.int64)
        return self._spelled(kept, np.array([len(kept)]))

    def _spelled(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece as bytes, or as the unknown piece, in rows that have any."""
        odd = (flat < 0) | (flat >= self.n_ids)
        if not odd.any():
            return flat, lengths
        ends = np.cumsum(lengths)
        out, done, lengths = [], 0, lengths.copy()
        for row in np.unique(np.searchsorted(ends, np.flatnonzero(odd), "right")):
            begin = ends[row] - lengths[row]
            ids: list[int] = []
            for s in flat[begin : ends[row]].tolist():
                if 0 <= s < self.n_ids:
                    ids.append(s)
                elif self.bytes:
                    c = chr(-s - 2) if s < 0 else self.character[s]
                    ids.extend(self.bytes[b] for b in c.encode())
                elif not ids or ids[-1] != self.unknown:  # unknown characters in a row are one
                    ids.append(self.unknown)
            out += [flat[done:begin], np.array(ids, np.int64)]
            done, lengths[row] = ends[row], len(ids)
        return np.concatenate([*out, flat[done:]]), lengths

    def encode_cuts(self, cuts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The cuts by length, their ids in a row, and how many each has."""
        cuts = sorted(cuts, key=len)
        flats, lengths, at = [], [], 0
        short = bisect_right(cuts, _LONG, key=len)
        while at < len(cuts):
            if at >= short:
                for out, made in zip((flats, lengths), self.merge_long(cuts[at])):
                    out.append(made)
                at += 1
                continue
            longest = len(cuts[min(at + _TOGETHER, short) - 1])
            # a table of about a million cells at most
            part = cuts[at : min(short, at + max(1, min(_TOGETHER, (1 << 20) // longest)))]
            for out, made in zip((flats, lengths), self.merge(part)):
                out.append(made)
            at += len(part)
        return cuts, np.concatenate(flats), np.concatenate(lengths)

    def library_ids(self, cuts: list[str]) -> list[list[int]]:
        """What the library makes of each cut, itself putting a space before the text."""
        plain = [c[1:] if c[0] == SPACE else "\n" + c for c in cuts]
        nothing = [self.id_of.get(SPACE, self.unknown)]
        skip = len(self.library.encode("\n", num_threads=1))
        found = self.library.encode([p.replace(SPACE, " ") for p in plain], num_threads=1)
        return [
            (ids if p else nothing) if c[0] == SPACE else ids[skip:]
            for c, p, ids in zip(cuts, plain, found)
        ]

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; bytes that are no UTF-8 read as U+FFFD, one each."""
        parts = list(map(self.surface.__getitem__, ids))
        if None in parts:
            parts = self._with_bytes(ids, parts)
        text = "".join(parts)
        return text[1:] if text[:1] == " " and ids and self._spaced(ids) else text

    def _spaced(self, ids: list[int]) -> bool:
        """Whether the first piece with a text begins with the space put before it."""
        first = next((i for i in ids if self.surface[i] != ""), None)
        if first is None or first == self.unknown or self.surface[first] is None:
            return False
        return self.surface[first][0] == " "

    def _with_bytes(self, ids: list[int], parts: list) -> list[str]:
        out: list[str] = []
        run = bytearray()
        for i, part in zip(ids, parts):
            if part is None:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            out.append(part)
        out.append(_utf8(bytes(run)))
        return out


def _utf8(run: bytes) -> str:
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = "", 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out += run[at : at + n].decode()
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out += "�"
                at += 1
        return out


class _Encoder:
    """Encodes batches of texts; remembers cuts as codes into one array of ids."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat, self.begins = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.wrong: set[int] = set()

    def _learn(self, cuts: list[str]) -> None:
        cuts, flat, lengths = self.vocabulary.encode_cuts(cuts)
        first = len(self.codes)
        self.codes.update(zip(cuts, range(first, first + len(cuts))))
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        ends = np.cumsum(lengths)
        self.begins = np.concatenate([self.begins, self.begins[-1] + ends])
        theirs = self.vocabulary.library_ids(cuts)
        same = np.fromiter(map(len, theirs), np.int64, len(theirs)) == lengths
        if not same.all() or (np.fromiter(chain.from_iterable(theirs), np.int64) != flat).any():
            mine = np.split(flat, ends[:-1])
            self.wrong.update(
                first + k for k, (a, b) in enumerate(zip(mine, theirs)) if a.tolist() != b
            )

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """All ids in a row, where each text's begin and end, and whether the library agrees."""
        if len(self.codes) > _STORE:
            self.clear()
        find = self.vocabulary.cuts.findall
        cuts = [find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        fresh = list(set().union(*cuts).difference(self.codes))
        if fresh:
            self._learn(fresh)
        counts = np.fromiter(map(len, cuts), np.int64, len(cuts))
        get = self.codes.__getitem__
        codes = np.fromiter((k for c in cuts for k in map(get, c)), np.int64, counts.sum())
        begins, lengths = self.begins[codes], self.begins[codes + 1] - self.begins[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total) + np.repeat(begins - (ends - lengths), lengths)
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        agrees = [True] * len(texts)
        if self.wrong:
            agrees = [self.wrong.isdisjoint(map(get, c)) for c in cuts]
        return self.flat[index], bounds, agrees


@lru_cache(maxsize=2)
def _encoder(model: bytes) -> _Encoder:
    return _Encoder(model)


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens, ids, decoded, agrees`` of every whole text."""
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())  # its size is the model's

    def run(batches):
        encoder = _encoder(model.value)
        vocabulary = encoder.vocabulary
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                texts = part["text"].to_pylist()
                flat, bounds, agrees = encoder.encode(texts)
                lists = [flat[i:j].tolist() for i, j in zip(bounds, bounds[1:])]
                decoded = [vocabulary.decode(ids) for ids in lists]
                theirs = vocabulary.library.decode(lists) if lists else []
                agrees = [a and d == t for a, d, t in zip(agrees, decoded, theirs)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["row"],
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat)),
                        pa.array(decoded, pa.string()),
                        pa.array(agrees, pa.bool_()),
                    ],
                    ["row", *_RESULTS],
                )

    kept = [c for c in docs.columns if c not in (*_RESULTS, text_col)]
    rows = docs.select(
        F.struct(F.lit(1).alias("__"), *(F.col(f"`{c}`") for c in kept)).alias("row"),
        whole(F.col(f"`{text_col}`")).alias("text"),
    )
    row_type = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(
        run, f"row {row_type}, n_tokens long, ids array<int>, decoded string, agrees boolean"
    )
    return out.select(*(F.col(f"row.`{c}`") for c in kept), *_RESULTS)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: its id, the number of ids, and digests of the ids and of the decoded text."""
    made = encode_decode(docs.select("doc_id", "text"), path or model_path())
    return made.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("agrees").alias("library_agrees"),
    )


def op1_sentencepiece(spark, sf_dir):
    """Ids and decoded text of every row of documents, as digests."""
    return digests(table(spark, sf_dir, "documents"))
