"""
Packing token pieces into sequences by vector best fit.

A sequence has a capacity of tokens, of pieces and of attention cost (the sum of squared piece
lengths). Pieces are placed longest first. Among the open sequences that have room in every
dimension one is chosen, by the weighted dot product of the piece's demand with the residual
capacities, or by the smallest weighted norm of what would remain; if none has room, a new one is
opened. (Panigrahy and others, "Heuristics for vector bin packing", 2011.)

Every task packs the documents that it has tokenised, so token ids are not shuffled for that.
Sequences that stay under FULL are taken apart and packed once more, gathered from all tasks into
groups of a bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, pre_tokenizers

from rollcall.llm.words import buffers, give_back
from rollcall.session import materialise

FULL = 0.98
# A task packs so many tokens together, and a group of the second pass about as many.
BATCH_TOKENS = 2_000_000
WORDS_KEPT = 400_000            # up to some 100 bytes each, twice, in a worker


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence, the weight of each, and the rule of choice."""

    tokens: int = 4096
    pieces: int = 4096
    cost: float = 4096.0 ** 2
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"           # or "dot"


def best_fit(lengths: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """
    (sequence, offset) of each piece; sequences are numbered from 0, pieces in one are gapless.

    Pieces go longest first, equal ones in the given order; of equally good sequences the oldest
    is chosen. A piece that is above a capacity by itself is an error.
    """
    capacity = np.array([limits.tokens, limits.pieces, limits.cost], float)
    weights = np.array(limits.weights) / capacity ** (2 if limits.rule == "norm" else 1)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room = np.zeros((3, 64))
    ids = np.zeros(64, np.int64)
    count = opened = 0
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    for place, i in enumerate(order):
        n = float(lengths[i])
        need = np.array([n, 1.0, n * n])
        if (need > capacity).any():
            raise ValueError(f"a piece of {int(n)} tokens is above a sequence's capacity")
        left = room[:, :count] - need[:, None]
        fits = np.flatnonzero((left >= 0).all(0))
        if len(fits):
            if limits.rule == "norm":
                best = fits[np.argmin(weights @ (left[:, fits] ** 2))]
            else:
                best = fits[np.argmax((weights * need / capacity) @ room[:, fits])]
        else:
            if count == room.shape[1]:
                room = np.concatenate([room, np.zeros_like(room)], 1)
                ids = np.concatenate([ids, np.zeros_like(ids)])
            best, room[:, count], ids[count] = count, capacity, opened
            count, opened = count + 1, opened + 1
        sequence[i], offset[i] = ids[best], limits.tokens - int(room[0, best])
        room[:, best] -= need
        if room[0, best] < sizes[-1] or room[1, best] < 1 or room[2, best] < sizes[-1] ** 2:
            # Not even the shortest piece fits: the sequence is closed.
            count -= 1
            room[:, best:count] = room[:, best + 1:count + 1].copy()
            ids[best:count] = ids[best + 1:count + 1].copy()
    return sequence, offset


# Words of ASCII and Latin letters, marks and digits, whose parts are plain to see: for them the
# tokenizer's own normaliser does no more than lower-case.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class _Parts(dict):
    """Token ids of the parts that the tokenizer's model sees one at a time."""

    def __init__(self, tokenizer: Tokenizer, kept: int):
        super().__init__()
        self.kept = kept
        self.model = tokenizer.model
        self.four = [n.to_bytes(4, "little") for n in range(tokenizer.get_vocab_size())]
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spell = lambda part: letters.pre_tokenize_str(part)[0][0]

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.kept:
            self.clear()
        tokens = self.model.tokenize(part if part.isascii() else self.spell(part))
        ids = self[part] = b"".join([self.four[t.id] for t in tokens])
        return ids


class _Vocabulary(dict):
    """
    Token ids of words between white space, as bytes: those met lately, in two generations of up
    to `kept` words. A word of the older one that is met again moves to the newer one.
    """

    def __init__(self, path: str, kept: int):
        super().__init__()
        self.kept = kept
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = _Parts(self.tokenizer, kept)
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.kept:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            text = word.decode()
            if _PLAIN.fullmatch(text) and b"<|" not in word:
                ids = b"".join([self.parts[p] for p in _PART.findall(text.lower())])
            else:
                found = self.tokenizer.encode(text, add_special_tokens=False)
                ids = np.array(found.ids, "<u4").tobytes()
        self[word] = ids
        return ids


@lru_cache(maxsize=1)
def _vocabulary(path: str, kept: int) -> _Vocabulary:
    return _Vocabulary(path, kept)


def token_ids(text: bytes, path: str, words_kept: int = WORDS_KEPT) -> bytes:
    """
    Token ids of a whole text, little-endian unsigned 32-bit.

    The tokenizer drops white space, lower-cases, and never joins what stands on either side of
    white space, so a text's ids are those of its words; their A-Z may be lower-cased before,
    except where that could write the name of a special token.
    """
    words = (text if b"<|" in text else text.lower()).split()
    return b"".join(map(_vocabulary(path, words_kept).__getitem__, words))


PIECES = ("doc_id long, piece int, start long, length long, ids binary, sequence_id long, "
          "offset long, used long")


def _batch(columns: dict[str, list], limits: Limits, first: int) -> tuple[pa.RecordBatch, int]:
    lengths = np.array(columns["length"], np.int64)
    sequence, offset = best_fit(lengths, limits)
    used = np.bincount(sequence, weights=lengths).astype(np.int64)
    return pa.record_batch({
        "doc_id": pa.array(columns["doc_id"], pa.int64()),
        "piece": pa.array(columns["piece"], pa.int32()),
        "start": pa.array(columns["start"], pa.int64()), "length": pa.array(lengths),
        "ids": pa.array(columns["ids"], pa.binary()),
        "sequence_id": pa.array(sequence + first), "offset": pa.array(offset),
        "used": pa.array(used[sequence])}), len(used)


def _packer(limits: Limits, space: int):
    """
    Packs rows of pieces, BATCH_TOKENS at a time; a group of rows gets sequence numbers of the
    task's own.
    """
    def pack(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "piece", "start", "length", "ids")
        first = (space << 60) + (TaskContext.get().partitionId() << 36)
        columns, tokens = {n: [] for n in names}, 0
        give_back()
        for row in rows:
            for n, x in zip(names, row):
                columns[n].append(x)
            tokens += row[3]
            if tokens >= BATCH_TOKENS:
                batch, used = _batch(columns, limits, first)
                columns, tokens = {n: [] for n in names}, 0
                yield batch
                del batch
                give_back()
                first += used
        if tokens:
            batch, _ = _batch(columns, limits, first)
            del columns
            yield batch
            del batch
        give_back()
    return pack


def _tokenising(limits: Limits, path: str, end_id: int, words_kept: int):
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            docs = batch.column("doc_id").to_pylist()
            for doc, low, high in zip(docs, offsets[:-1].tolist(), offsets[1:].tolist()):
                ids = token_ids(data[low:high].tobytes(), path, words_kept) + end
                total = len(ids) // 4
                for k in range(0, total, limits.tokens):
                    n = min(limits.tokens, total - k)
                    yield doc, k // limits.tokens, k, n, ids[4 * k:4 * (k + n)]

    pack = _packer(limits, 0)
    return lambda batches: pack(pieces(batches))


def _again(limits: Limits):
    pack = _packer(limits, 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist()
                             for c in ("doc_id", "piece", "start", "length", "ids")))
    return lambda batches: pack(rows(batches))


def pack_documents(docs: DataFrame, tokenizer_path: str, limits: Limits = Limits(),
                   end_id: int = 1, words_kept: int = WORDS_KEPT) -> DataFrame:
    """
    (doc_id, piece, start, length, ids, sequence_id, offset), one row per piece of docs (doc_id,
    text, ...).

    A document's tokens are those of its whole text, then `end_id`; a null text is an empty one,
    so every row gives a piece. Documents longer than a sequence are cut at its capacity, others
    never. Rows that repeat a doc_id, or have none, are packed like any other. Other columns are
    not looked at; an empty table gives no rows. ids are little-endian unsigned 32-bit numbers.
    A Python worker remembers the ids of up to twice `words_kept` words, which changes its speed
    and memory but no result.
    """
    first = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                        .mapInArrow(_tokenising(limits, tokenizer_path, end_id, words_kept),
                                    PIECES),
                        "packed")
    small = first.where(F.col("used") < FULL * limits.tokens).drop("sequence_id", "offset", "used")
    tokens = small.agg(F.sum("length")).first()[0] or 0
    groups = int(-(-tokens // BATCH_TOKENS)) or 1
    group = F.pmod(F.xxhash64("doc_id", "piece", "start", "length"), F.lit(groups))
    # Rows arrive in any order, which decides their places: what is packed is stored, so that a
    # lost executor cannot have it packed otherwise under a reader.
    again = materialise(small.repartition(groups, group).mapInArrow(_again(limits), PIECES),
                        "packed_again")
    return first.where(F.col("used") >= FULL * limits.tokens).unionByName(again).drop("used")
