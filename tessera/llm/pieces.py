"""SentencePiece encoding and decoding by a shared-prefix Viterbi over a trie of words.

A text falls apart at its spaces into marked words (a leading U+2581), and no piece of
the vocabularies this takes crosses such a border.  The distinct words of a block of texts
that are not in the cache are sorted; walking them in order is a depth-first traversal of
their trie, and the forward states of a prefix that two words share are computed
once.  A state keeps, for its prefix, the last piece of the best segmentation and the node of an automaton
over the vocabulary, which holds the pieces that end there.

* ``unigram`` models: the best segmentation has the largest sum of piece scores.
* ``bpe`` models: the best segmentation is the one that merging yields.  A sequence of pieces is
  that one if and only if each two neighbours are what merging makes of their joint text, and each
  prefix has exactly one such sequence, so the same forward pass finds it.  Summing the scores
  (which are merge ranks) would give other ids than the library does; this gives the same.

Runs of several spaces merge after all else (their pieces score lowest); they are encoded by
merging the run, once per length.  Characters outside the vocabulary become byte pieces.

Defined results
---------------
* a null or empty text has no pieces; ids are those of the library with default options;
* U+2581 in a text stands for a space, as in the library, so decoding returns a space for it;
* a null id passes through; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches, spread, table, tidy

MARK = "▁"
#: Distinct words that a worker remembers, and the longest it does; checked pairs of pieces; characters of texts taken at a time.
WORDS = 400_000
LONGEST = 64
PAIRS = 1_000_000
BLOCK_CHARS = 1 << 20
UNKNOWN = -1
#: Keys of a node of the trie beside its characters, and "" for its piece.
BACK, ENDS = "back", "ends"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message: number and value (varints, or raw bytes)."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + n]
            at += n


class PieceModel:
    """Vocabulary of a SentencePiece model file, as the traversal needs it."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        said = dict(_fields(lib.serialized_model_proto()))
        kind = dict(_fields(said[2])).get(3, 1)
        norm = dict(_fields(said.get(3, b"")))
        if kind not in (1, 2) or norm.get(2) or not norm.get(3, 1) or norm.get(4, 1) or not norm.get(5, 1):
            raise ValueError("only unigram and BPE models that keep texts as they are can be used")
        self.bpe = kind == 2
        size = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(size)]
        self.score = [lib.get_score(i) for i in range(size)]
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        normal = [i for i in range(size) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in normal}
        if any(MARK in p.lstrip(MARK) or p.startswith(MARK * 2) and p.strip(MARK) for p in self.ids):
            raise ValueError("a piece crosses the border of a word")
        self.bytes_fallback = lib.is_byte(self.byte_ids[0])
        self.unknown = lib.unk_id()
        self.floor = min(self.score) - 10
        self.trie: dict = {}
        for piece, i in self.ids.items():
            node = self.trie
            for ch in piece:
                node = node.setdefault(ch, {})
            node[""] = i
        self.spelt = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.byte_ids):
            if self.bytes_fallback:
                self.spelt[i] = bytes([b])
        self.spelt[self.unknown] = " ⁇ ".encode()
        self.pairs: dict[int, bool] = {}
        self.runs: dict[int, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """Pieces of text by merging best-scored neighbours, leftmost first among equals."""
        sym, left, right = list(text), [*range(-1, len(text) - 1)], [*range(1, len(text) + 1)]
        heap: list = []

        def propose(i: int, j: int) -> None:
            if i >= 0 and j < len(sym):
                both = sym[i] + sym[j]
                if both in self.ids:
                    heapq.heappush(heap, (-self.score[self.ids[both]], i, j, both))

        for i in range(len(sym) - 1):
            propose(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not sym[i] or not sym[j] or sym[i] + sym[j] != both or right[i] != j:
                continue
            sym[i], sym[j] = both, ""
            right[i] = right[j]
            if right[j] < len(sym):
                left[right[j]] = i
            propose(left[i], i)
            propose(i, right[i])
        return [s for s in sym if s]

    def fits(self, before: int, piece: int) -> bool:
        """Whether merging the joint text of two pieces yields these two (before -1: whether the piece stays whole)."""
        key = before * len(self.pieces) + piece
        found = self.pairs.get(key)
        if found is None:
            parts = [self.pieces[before], self.pieces[piece]] if before >= 0 else [self.pieces[piece]]
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.merge("".join(parts)) == parts
        return found

    def run(self, n: int) -> bytes:
        """Ids of n marks in a row."""
        if n not in self.runs:
            if len(self.runs) > 10_000:
                self.runs.clear()
            pieces = self.merge(MARK * n) if self.bpe else [p for w in self.words([MARK * n]).values() for p in w]
            ids = [self.ids[p] for p in pieces] if self.bpe else pieces
            self.runs[n] = np.array(ids, "<i4").tobytes()
        return self.runs[n]

    def _link(self) -> dict:
        """The trie, made an automaton (Aho and Corasick 1975): a node leads to that of its longest proper suffix, and holds
        the pieces that end where it does, longest first, with their lengths."""
        root = self.trie
        if ENDS not in root:
            root[ENDS] = ()
            walk = [(root, 0)]
            for node, depth in walk:
                for ch, child in [x for x in node.items() if len(x[0]) == 1]:
                    back = node.get(BACK)
                    while back is not None and ch not in back:
                        back = back.get(BACK)
                    child[BACK] = back = root if back is None else back[ch]
                    child[ENDS] = ((child[""], depth + 1), *back[ENDS]) if "" in child else back[ENDS]
                    walk.append((child, depth + 1))
        return root

    def words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each distinct word, by one traversal of their trie.

        The state of a prefix is its last piece, its node of the automaton and, for unigram models, its best score.
        """
        out: dict[str, list[int]] = {}
        root, bpe, score, fits, pairs = self._link(), self.bpe, self.score, self.fits, self.pairs
        pieces, n_pieces = self.pieces, len(self.pieces)
        last, nodes, best = [UNKNOWN], [root], [0.0]
        before = ""
        for word in sorted(set(words)):
            keep = 0
            for a, b in zip(before, word):  # noqa: B905
                if a != b:
                    break
                keep += 1
            del last[keep + 1 :], nodes[keep + 1 :], best[keep + 1 :]
            node, i = nodes[keep], keep
            for ch in word[keep:]:
                i += 1
                found = node.get(ch)
                while found is None and node is not root:
                    node = node[BACK]
                    found = node.get(ch)
                node = root if found is None else found
                piece = UNKNOWN
                if bpe:
                    for p, size in node[ENDS]:
                        b = last[i - size]
                        ok = pairs.get(b * n_pieces + p)
                        if fits(b, p) if ok is None else ok:
                            piece = p
                            break
                else:
                    top = -math.inf
                    for p, size in node[ENDS]:
                        if best[i - size] + score[p] > top:
                            piece, top = p, best[i - size] + score[p]
                    best.append(best[i - 1] + self.floor if piece < 0 else top)
                last.append(piece)
                nodes.append(node)
            ids = []
            while i:
                p = last[i]
                if p < 0:
                    ids += [self.byte_ids[x] for x in reversed(word[i - 1].encode("utf-8", "surrogatepass"))] if self.bytes_fallback else [self.unknown]
                    i -= 1
                else:
                    ids.append(p)
                    i -= len(pieces[p])
            ids.reverse()
            out[word] = ids
            before = word
        return out


class PieceCodec:
    """Encodes blocks of texts with a cache of words in two generations; decodes ids."""

    def __init__(self, path: str, words: int = WORDS):
        self.model, self.most = PieceModel(path), words
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, parts: set[str]) -> dict[str, bytes]:
        """Makes sure that the cache holds each part (what stands between two spaces, mark included by meaning), and
        returns those that are too long for it."""
        new, old, missing, rare = self.new, self.old, [], {}
        for p in parts.difference(new):
            if p in old:
                new[p] = old[p]
            else:
                missing.append(p)
        # A line feed is in no piece, so it splits a part; what stands behind it has no mark.
        breaks = "\n" not in self.model.trie and self.model.bytes_fallback
        lines = {p: p.split("\n") for p in missing if "\n" in p} if breaks else {}
        feed = np.array([self.model.byte_ids[10]], "<i4").tobytes() if breaks else b""
        atoms = {MARK + p for p in missing if p not in lines} if lines else {MARK + p for p in missing}
        for first, *rest in lines.values():
            atoms.add(MARK + first)
            atoms.update(rest)
        found = self.model.words(atoms)
        flat, ids, at = np.fromiter(chain.from_iterable(found.values()), "<i4").tobytes(), {}, 0
        for w, x in found.items():
            to = at + 4 * len(x)
            ids[w] = flat[at:to]
            at = to
        for p in missing:
            known = new if len(p) <= LONGEST else rare
            if p in lines:
                first, *rest = lines[p]
                known[p] = feed.join([ids[MARK + first], *(ids[y] for y in rest)])
            else:
                known[p] = ids[MARK + p]
        return rare

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, four bytes each."""
        if len(self.new) > self.most // 2:
            self.old, self.new = self.new, {}
        split = [(t.replace(MARK, " ") if MARK in t else t).split(" ") if t else [] for t in texts]
        parts = {p for x in split for p in x}
        parts.discard("")
        rare = self._learn(parts)
        lone = np.array([self.model.ids[MARK]], "<i4").tobytes() if MARK in self.model.ids else b""
        new, out = self.new, []
        get = (lambda p: new.get(p) or rare[p]) if rare else new.__getitem__
        for x in split:
            if "" not in x:
                out.append(b"".join(map(get, x)))
                continue
            ids, marks = [], 0
            for empty, group in groupby(x, lambda p: not p):
                if empty:
                    marks = sum(1 for _ in group)
                    continue
                for p in group:
                    word = get(p)
                    if marks and lone and word.startswith(lone):  # the word leaves its mark to the run
                        ids += [self.model.run(marks + 1), word[len(lone) :]]
                    else:
                        ids += [self.model.run(marks), word] if marks else [word]
                    marks = 0
            if marks:
                ids.append(self.model.run(marks))
            out.append(b"".join(ids))
        return out

    def rest(self) -> None:
        """Between tasks a worker keeps the newer generation of words only."""
        self.old = {}

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.model.spelt.__getitem__, ids))
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def _blocks(texts: list[str | None]) -> Iterator[slice]:
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held > BLOCK_CHARS or i - first >= 2048:
            yield slice(first, i + 1)
            first, held = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids, round_trip (whether decoding the ids returns the text) for every row of docs."""
    rows = spread(docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text")))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _blocks(texts):
                packed = own.encode(texts[part])
                sizes = np.array([len(x) // 4 for x in packed], np.int64)
                flat = np.frombuffer(b"".join(packed), "<i4")
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                same = [own.decode(np.frombuffer(x, "<i4").tolist()) == (t or "").replace(MARK, " ") for x, t in zip(packed, texts[part], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, len(same)), pa.array(sizes), ids, pa.array(same, pa.bool_())],
                    names=["doc_id", "n_pieces", "ids", "round_trip"],
                )
        own.rest()

    return small_batches(rows).mapInArrow(encode, f"doc_id {id_type}, n_pieces long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text from doc_id, ids."""
    rows = encoded.select("doc_id", "ids")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    @tidy
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                ids = batch.column(1).slice(i, 512).to_pylist()
                texts = pa.array([own.decode(x or []) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 512), texts], names=["doc_id", "text"])

    return small_batches(rows).mapInArrow(decode, f"doc_id {id_type}, text string")


def query(spark, sf_dir):
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
