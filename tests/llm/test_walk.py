"""The traversal of op6: how often it looks into the trie, and that its results hold against the library."""

from __future__ import annotations

import random

import numpy as np

from tessera.llm import pieces


class Counted(dict):
    looks = 0

    def get(self, *key):
        Counted.looks += 1
        return super().get(*key)


def test_a_character_is_looked_up_twice_at_most_however_many_pieces_are_open():
    model = pieces.PieceModel.__new__(pieces.PieceModel)
    model.bpe, model.bytes_fallback, model.unknown, model.pairs = False, False, 0, {}
    model.pieces = ["<unk>", *("a" * n for n in range(1, 41))]
    model.score = [-20.0, *(-10.0 + n / 10 for n in range(40))]
    model.floor, model.longest, model.trie = -30.0, 40, Counted()
    for i, piece in enumerate(model.pieces[1:], 1):
        node = model.trie
        for ch in piece:
            node = node.setdefault(ch, Counted())
        node[""] = i
    model.words(["a"])
    Counted.looks = 0
    ids = model.words(["a" * 400])["a" * 400]
    assert sum(ids) == 400 and Counted.looks <= 800


def test_random_texts_equal_the_library():
    import public_tokenizers as public
    import sentencepiece

    path, r = public.path("piece_bpe_32k.model"), random.Random(5)
    texts = ["".join(r.choice("aeinrst ▁\n\té北𐍈0.#x") for _ in range(r.randrange(60))) for _ in range(2_000)]
    expected = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)
    for words in (pieces.WORDS, 4):
        own = pieces.PieceCodec(path, words)
        got = [x for i in range(0, len(texts), 100) for x in own.encode(texts[i : i + 100])]
        assert [np.frombuffer(x, "<i4").tolist() for x in got] == expected
