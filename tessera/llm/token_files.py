"""Token-id files: fixed-width bit packing with block offsets.

File layout, all little-endian::

    0   8s   magic  b"TSRBITS2"
    8   u32  bits per id
    12  u32  ids per block
    16  ...  blocks: ids of `bits` bits each, lowest bit first, padded to whole bytes
        u64  doc_id (two's complement), d times
        u64  first id of each document inside the file, d + 1 times
        u64  byte offset of each block in the file, b + 1 times
        u64  number of ids (n), of documents (d), of blocks (b)
        8s   magic

Any block unpacks alone with numpy, so any document is read without its neighbours.  Blocks are written as
they fill; a task holds the ids of a block and the index of its file.

Documents are range-partitioned by id and the beginning of the text, so that rows of one id or of none can be
split; each partition is tokenised and written as one file in ascending order.  A task writes a name of its own
attempt and then renames, so tasks that run twice leave one whole file.  The manifest (one row per file) is kept
as Parquet; running sums over it give each file's first id.

Ids are those of the tokenizers library with its defaults but ``add_special_tokens=False``: an added token of the
vocabulary that a text spells out is that token.

Defined results
---------------
* a null text is empty: it has its end id alone; ids of rows may repeat, each row is a document, ordered
  by (id, text); a null id sorts first and reads back as null;
* an empty table gives no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Stage, table, tidy

MAGIC = b"TSRBITS2"
_HEAD = struct.Struct("<8sII")
_TAIL = struct.Struct("<QQQ8s")
BLOCK_IDS = 1 << 13
#: The id of a row without one, in the files.
NO_ID = -(1 << 63)
#: Distinct words of which a worker remembers the ids.
WORDS = 1_000_000
#: Code points of a text that tell ranges of one id apart.
RANGE_CHARS = 64
#: Documents read back at a time, in ids.
READ_IDS = 1 << 20

#: How the byte-level vocabulary splits a text and spells bytes.
WORD = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = ((ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(spread.reshape(-1), bitorder="little").tobytes()


def unpack(data, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return flat.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class TokenWriter:
    """Writes one file to a binary stream, block by block."""

    def __init__(self, stream, bits: int, block: int = BLOCK_IDS):
        self.stream, self.bits, self.block = stream, bits, block
        self.doc_ids, self.starts, self.offsets = array("q"), array("q", [0]), array("q", [_HEAD.size])
        self.rest: list[np.ndarray] = []
        self.waiting = 0
        stream.write(_HEAD.pack(MAGIC, bits, block))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            flat = np.concatenate(self.rest)
            whole = len(flat) // self.block * self.block
            for i in range(0, whole, self.block):
                self._write(flat[i : i + self.block])
            self.rest, self.waiting = [flat[whole:]], len(flat) - whole

    def _write(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.stream.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def close(self) -> None:
        if self.waiting:
            self._write(np.concatenate(self.rest))
        for index in (self.doc_ids, self.starts, self.offsets):
            self.stream.write(np.array(index, "<i8").tobytes())
        self.stream.write(_TAIL.pack(self.starts[-1], len(self.doc_ids), len(self.offsets) - 1, MAGIC))


class TokenFile:
    """Random access to one file through a seekable binary stream."""

    def __init__(self, stream):
        self.stream = stream
        magic, self.bits, self.block = _HEAD.unpack(stream.read(_HEAD.size))
        end = stream.seek(0, 2) - _TAIL.size
        stream.seek(end)
        self.n, self.docs, blocks, last = _TAIL.unpack(stream.read(_TAIL.size))
        if magic != MAGIC or last != MAGIC:
            raise ValueError("not a whole token file")
        stream.seek(end - 8 * (2 * self.docs + blocks + 2))
        self.doc_ids = np.frombuffer(stream.read(8 * self.docs), "<i8")
        self.starts = np.frombuffer(stream.read(8 * (self.docs + 1)), "<i8").astype(np.int64)
        self.offsets = np.frombuffer(stream.read(8 * (blocks + 1)), "<i8").astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of the file; reads the blocks that hold them and no others."""
        if start >= stop:
            return np.empty(0, np.uint32)
        a, b = start // self.block, (stop - 1) // self.block + 1
        self.stream.seek(int(self.offsets[a]))
        raw = self.stream.read(int(self.offsets[b] - self.offsets[a]))
        out = [
            unpack(
                raw[int(self.offsets[k] - self.offsets[a]) : int(self.offsets[k + 1] - self.offsets[a])],
                min(self.block, self.n - k * self.block),
                self.bits,
            )
            for k in range(a, b)
        ]
        return np.concatenate(out)[start - a * self.block : stop - a * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


class _Spelling(dict):
    """How the byte-level vocabulary spells a character: by a visible character for each of its bytes."""

    def __init__(self):
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.bytes = {b: chr(b) for b in plain}
        self.bytes.update({b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in self.bytes)})

    def __missing__(self, c: str) -> str:
        found = self[c] = "".join(self.bytes[b] for b in c.encode("utf-8", "surrogatepass"))
        return found


class WordEncoder:
    """Byte-level BPE of the tokenizers library, one distinct word at a time.

    The vocabulary splits texts into words and merges inside words only, so the ids of a
    text are those of its words in a row.  ``words`` most recent distinct words are kept
    (in two generations), each as its ids in four bytes.  Texts that spell an added token, and all texts where the
    file describes another way of splitting, go through the library as a whole.
    """

    def __init__(self, path: str, words: int = WORDS):
        import json

        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model, self.words = self.library.model, words
        said = json.loads(self.library.to_str())
        split = said["pre_tokenizer"] or {}
        self.by_word = (
            said["normalizer"] is None
            and said["model"]["type"] == "BPE"
            and not said["model"].get("dropout")
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
        )
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
        self.find = regex.compile(WORD).findall
        self.spelling = _Spelling()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        """Ids of one word of the vocabulary's split."""
        if word.isascii() and word.isprintable():  # visible characters spell themselves
            spelt = word.replace(" ", "\u0120")
        else:
            spelt = "".join(map(self.spelling.__getitem__, word))
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a space and the run of other characters behind it; remembers them.

        A chunk that begins with a space stands for one word of the split with nothing before it.
        """
        found = self.old.get(chunk)
        if found is None:
            if chunk.isalpha():
                found = self._word(" " + chunk)
            elif chunk[0] == " ":
                found = self._word(chunk[1:])
            else:
                first, *lines = chunk.split("\n")
                parts = [self._letters(first, ""), *(self._letters(x, " ") for x in lines)]
                found = self._whole(" " + chunk) if None in parts else self._known(" \n").join(parts)
        if len(self.new) >= self.words // 2:
            self.old, self.new = self.new, {}
        self.new[chunk] = found
        return found

    def _known(self, chunk: str) -> bytes:
        return self.new.get(chunk) or self._chunk(chunk)

    def _letters(self, run: str, lead: str) -> bytes | None:
        """Ids of letters and any ASCII marks behind them, up to a single line end or space; None for another run.

        Letters are one word and marks are one word; so is a line end between two such runs.
        """
        body = run.rstrip(punctuation)
        if not body.isalpha():
            return None
        found = self._known(lead + body)
        return found if len(body) == len(run) else found + self._known(" " + run[len(body) :])

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self._word, self.find(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a text, four bytes each.

        A single space always starts a word of the split, so a text falls apart at its
        spaces; texts with two spaces in a row or one at an end are split as a whole.
        """
        if not self.by_word or any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return self._whole(text)
        first, *rest = text.split(" ")
        out = [self._whole(first), *map(self.new.get, rest)]
        if None in out:
            new, chunk = self.new, self._chunk
            for i, x in enumerate(out):
                if x is None:
                    x = new.get(rest[i - 1])
                    if x is None:
                        x = chunk(rest[i - 1])
                        new = self.new
                    out[i] = x
        return b"".join(out)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_files(docs: DataFrame, out: str, tokenizer: str, vocabulary: int, end_id: int) -> DataFrame:
    """Writes the files under the folder ``out`` and returns the lazy manifest: file_no, path, n_docs, n_ids."""
    bits = bits_for(max(vocabulary, end_id + 1))
    end = np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    @tidy
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer).encode
        number, writer, name = TaskContext.get().partitionId(), None, ""
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if writer is None:
                    store, folder = _open(out)
                    store.create_dir(folder, recursive=True)
                    name, own = f"{folder}/ids-{number:06d}.bin", f"{folder}/.{uuid.uuid4().hex}"
                    stream = store.open_output_stream(own)
                    writer = TokenWriter(stream, bits)
                writer.add(doc_id.as_py(), np.frombuffer(encode(text.as_py()) + end, "<u4"))
        if writer is None:
            return
        writer.close()
        stream.close()
        store.move(own, name)
        cols = [[number], [f"{out}/ids-{number:06d}.bin"], [len(writer.doc_ids)], [writer.starts[-1]]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["file_no", "path", "n_docs", "n_ids"])

    ordered = rows.repartitionByRange(F.col("doc_id"), F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(write, "file_no long, path string, n_docs long, n_ids long")


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the manifest's files, read from the files."""
    before = F.sum("n_ids").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("base", F.coalesce(before, F.lit(0))).select("file_no", "path", "base")

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                store, name = _open(path)
                with store.open_input_file(name) as stream:
                    file = TokenFile(stream)
                    first = 0
                    while first < file.docs:
                        last = max(first + 1, int(np.searchsorted(file.starts, file.starts[first] + READ_IDS, "right")) - 1)
                        at = file.starts[first : last + 1]
                        raw = file.ids(int(at[0]), int(at[-1])).astype("<u4").tobytes()
                        cut = (at - at[0]) * 4
                        crc = [zlib.crc32(raw[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                        own = file.doc_ids[first:last]
                        cols = [pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(at[:-1] + base), pa.array(np.diff(at)), pa.array(crc, pa.int64())]
                        yield pa.RecordBatch.from_arrays(cols, schema=_READ)
                        first = last

    width = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(width, "file_no").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int) -> DataFrame:
    """Writes docs into the shared folder and reads them back."""
    stage = Stage(docs.sparkSession, "tokens")
    manifest = stage.keep(write_files(docs, f"{stage.root}/files", tokenizer, vocabulary, end_id), "manifest")
    return read_files(manifest)


def query(spark, sf_dir):
    import public_tokenizers

    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 50_257, 2)
