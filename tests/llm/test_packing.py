import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hard import documents
from rollcall.llm import packing
from rollcall.llm.packing import Limits, best_fit

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_pieces(rows, size):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out += [(doc, k // size, k, len(ids[k:k + size]), zlib.crc32(ids[k:k + size].tobytes()))
                for k in range(0, len(ids), size)]
    return out


def check_places(rows, size):
    """Pieces lie gapless from 0 in their sequences, none of which is above `size`."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


@pytest.mark.parametrize("size", [4096, 64])
def test_pieces_and_places(hard, size):
    rows = packing.pack_documents(hard(), PATH, Limits(tokens=size, pieces=size, cost=size ** 2)) \
        .collect()
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_pieces(
        [(r[0], r[1]) for r in documents()], size)))
    used = check_places(rows, size)
    total = sum(r["length"] for r in rows)
    assert used <= -(-total // size) * 1.02 + 1


def test_small_batches_are_packed_again(hard, monkeypatch):
    monkeypatch.setattr(packing, "BATCH_TOKENS", 700)
    rows = packing.pack_documents(hard(), PATH, Limits(tokens=256, pieces=256, cost=256 ** 2))
    assert len(check_places(rows.collect(), 256) and rows.collect()) == len(
        brute_pieces([(r[0], r[1]) for r in documents()], 256))


def test_empty_table(hard):
    assert packing.pack_documents(hard([]), PATH).collect() == []


def test_token_ids_of_odd_texts():
    odd = ["it's can't. x's. ’s, a.\n b,c., d", "É, Ü. ÀB", "<|endoftext|> <|ENDOFTEXT|> X",
           "a\x0b b\x1c.c d, é. f", "", " \n", "e\u0301 \u0301x A\u030a", "İstanbul ǅ ſ", "漢字 한국어 😀"]
    tokenizer = Tokenizer.from_file(PATH)
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t in odd]
    assert [packing.token_ids(t.encode(), PATH) for t in odd] == want


def test_forgotten_words_are_learnt_again():
    texts = [" ".join(f"w{(k * 7 + j) % 90}" for j in range(20)) for k in range(30)]
    tokenizer = Tokenizer.from_file(PATH)
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t in texts]
    assert [packing.token_ids(t.encode(), PATH, 30) for t in texts] == want


def slow_best_fit(lengths, limits):
    """The same rules without closing sequences."""
    capacity = [limits.tokens, limits.pieces, limits.cost]
    rooms, where = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = float(lengths[i])
        need = [n, 1.0, n * n]
        fits = [b for b, room in enumerate(rooms) if all(r >= x for r, x in zip(room, need))]

        def value(b):
            room = rooms[b]
            if limits.rule == "norm":
                return sum(w * ((r - x) / c) ** 2 for w, r, x, c in
                           zip(limits.weights, room, need, capacity))
            return -sum(w * r / c * x / c for w, r, x, c in
                        zip(limits.weights, room, need, capacity))
        if fits:
            best = min(value(b) for b in fits)
            b = next(b for b in fits if value(b) <= best + abs(best) * 1e-12 + 1e-15)
        else:
            b = len(rooms)
            rooms.append(list(capacity))
        where[i] = b
        rooms[b] = [r - x for r, x in zip(rooms[b], need)]
    return [where[i] for i in range(len(lengths))], rooms


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [{}, {"pieces": 3}, {"cost": 4000.0},
                                    {"pieces": 4, "cost": 3000.0, "weights": (1.0, 2.0, 0.5)}])
def test_best_fit_keeps_every_limit(rule, limits):
    r = np.random.default_rng(2)
    lengths = r.integers(1, 50, 400)
    own = Limits(**{"tokens": 100, "pieces": 100, "cost": 1e9, "rule": rule, **limits})
    sequence, offset = best_fit(lengths, own)
    for s in np.unique(sequence):
        n = lengths[sequence == s]
        assert n.sum() <= own.tokens and len(n) <= own.pieces and (n ** 2).sum() <= own.cost
        order = np.argsort(offset[sequence == s])
        assert (np.cumsum(n[order]) - n[order] == offset[sequence == s][order]).all()
    where, rooms = slow_best_fit(lengths.tolist(), own)
    assert len(rooms) == sequence.max() + 1
    same = np.array(where) == sequence
    assert same.mean() > 0.9


def test_a_piece_above_a_limit_is_an_error():
    with pytest.raises(ValueError):
        best_fit(np.array([5]), Limits(tokens=10, pieces=1, cost=20.0))
