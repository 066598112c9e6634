"""Exact dedup by Patricia-trie owners.

Texts are equal when identical after deleting ASCII white space.  Each scan task
inserts its normalised byte strings into a compressed radix trie whose terminal
nodes hold the owner: most code points in the original, then smallest id.  One row
per distinct text of a task goes on, partitioned by (length, SHA-256); there the full
byte strings meet in tries again, and a last sum by key joins what tries had to spill.
So a group of copies of any size is one row per task before anything is shuffled.

A trie over its memory bound spills its largest subtree: the owners in it are emitted
as partial results, which the next step merges.

Defined results
---------------
* a null text counts as empty, and all empty texts are one group;
* a null id goes after all others; rows that repeat both id and text are one document given more than
  once: each counts in ``group_size`` and carries the same ``kept``;
* an empty table gives an empty result; other columns are ignored.
Two different texts of one length and SHA-256 would be reported as an error, never merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACE, Stage, small_batches, spread, table, tidy, without

_SPACE = ASCII_SPACE.encode()
#: Bytes that one trie holds before it spills: those of its edges, and what a node takes besides.
TRIE_BYTES = 96 << 20
NODE_BYTES = 320
BATCH_ROWS = 512

PARTIAL = "norm_len long, digest binary, body binary, code_points long, keep_id long, members long"
_PARTIAL = pa.schema(
    [("norm_len", pa.int64()), ("digest", pa.binary()), ("body", pa.binary()), ("code_points", pa.int64()), ("keep_id", pa.int64()), ("members", pa.int64())]
)
_NAMED = pa.schema([("doc_id", pa.int64()), ("norm_len", pa.int64()), ("digest", pa.binary())])

Owner = tuple[int, int | None, int]


def better(a: Owner, b: Owner) -> Owner:
    """Joins two owners (code points, id, members) of one text."""
    first = min(a, b, key=lambda o: (-o[0], o[1] is None, o[1] or 0))
    return first[0], first[1], a[2] + b[2]


class _Node:
    __slots__ = ("edge", "kids", "owner", "size")

    def __init__(self, edge: bytes, owner: Owner | None = None):
        self.edge, self.owner, self.kids, self.size = edge, owner, None, len(edge) + NODE_BYTES


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low if low < n and a[low] != b[low] else high


class PatriciaTrie:
    """Byte strings to owners; edges hold whole runs of bytes."""

    def __init__(self):
        self.root = _Node(b"")

    @property
    def size(self) -> int:
        return self.root.size

    def insert(self, text: bytes, owner: Owner) -> None:
        node, at, path = self.root, 0, [self.root]
        while True:
            if at == len(text):
                node.owner = owner if node.owner is None else better(node.owner, owner)
                return
            kid = node.kids.get(text[at]) if node.kids else None
            if kid is None:
                kid = _Node(text[at:], owner)
                if node.kids is None:
                    node.kids = {}
                node.kids[text[at]] = kid
                for p in path:
                    p.size += kid.size
                return
            edge = kid.edge
            if text.startswith(edge, at):
                node, at = kid, at + len(edge)
                path.append(node)
                continue
            n = _shared(edge, text[at : at + len(edge)])
            fork = _Node(edge[:n])
            fork.size = kid.size + NODE_BYTES
            kid.edge, kid.size = edge[n:], kid.size - n
            fork.kids = {edge[n]: kid}
            node.kids[text[at]] = fork
            for p in path:
                p.size += NODE_BYTES
            node, at = fork, at + n
            path.append(fork)

    def items(self, node: _Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, Owner]]:
        todo = [(node or self.root, prefix)]
        while todo:
            x, before = todo.pop()
            text = before + x.edge
            if x.owner is not None:
                yield text, x.owner
            todo.extend((k, text) for k in (x.kids or {}).values())

    def spill(self) -> Iterator[tuple[bytes, Owner]]:
        """Takes out the largest subtree that starts where the trie branches, and yields what it held."""
        node, path, prefix = self.root, [], b""
        while True:
            path.append(node)
            if not node.kids:
                break
            key, kid = max(node.kids.items(), key=lambda x: x[1].size)
            if len(node.kids) > 1 or not kid.kids or node.owner is not None:
                break
            prefix += node.edge
            node = kid
        if not node.kids:
            held = list(self.items())
            self.root = _Node(b"")
            yield from held
            return
        del node.kids[key]
        for p in path:
            p.size -= kid.size
        yield from self.items(kid, prefix + node.edge)


def _rows(found: list) -> pa.RecordBatch:
    cols = list(zip(*found, strict=True)) if found else [[] for _ in _PARTIAL]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _PARTIAL, strict=True)], schema=_PARTIAL)


def _emit(items: Iterator[tuple[bytes, Owner]]) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    for text, (points, keep, members) in items:
        out.append((len(text), hashlib.sha256(text).digest(), text, points, keep, members))
        held += len(text)
        if len(out) >= BATCH_ROWS or held > 4 << 20:
            yield _rows(out)
            out, held = [], 0
    if out:
        yield _rows(out)


def _normal(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _SPACE)


@tidy
def local_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> one partial owner per distinct text of the task."""
    trie = PatriciaTrie()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            trie.insert(_normal(text), (len(text or ""), doc_id, 1))
            while trie.size > TRIE_BYTES:
                yield from _emit(trie.spill())
    yield from _emit(trie.items())


@tidy
def merged_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial owners of whole (length, digest) keys -> owners; the same schema."""
    trie = PatriciaTrie()
    for batch in batches:
        _, _, bodies, points, keeps, members = (c.to_pylist() for c in batch.columns)
        for body, *owner in zip(bodies, points, keeps, members, strict=True):
            trie.insert(body, tuple(owner))
            while trie.size > TRIE_BYTES:
                yield from _emit(trie.spill())
    yield from _emit(trie.items())


@tidy
def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, norm_len, digest."""
    for batch in batches:
        bodies = [_normal(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(map(len, bodies), pa.int64()), pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary())],
            schema=_NAMED,
        )


def owners(docs: DataFrame) -> DataFrame:
    """norm_len, digest, keep_id, group_size, texts (1, or more if a key has several texts) of each group."""
    rows = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    partial = small_batches(rows).mapInArrow(local_owners, PARTIAL).repartition("norm_len", "digest")
    merged = small_batches(partial).mapInArrow(merged_owners, PARTIAL).withColumn("text_key", F.xxhash64("body")).drop("body")
    order = F.struct(-F.col("code_points"), F.col("keep_id").isNull(), "keep_id")
    return merged.groupBy("norm_len", "digest").agg(
        F.min(order).alias("first"),
        F.sum("members").alias("group_size"),
        (F.min("text_key") == F.max("text_key")).alias("one"),
    ).select(
        "norm_len",
        "digest",
        F.when(F.col("one"), F.col("first.keep_id"))
        .otherwise(F.raise_error(F.lit("two texts have one length and SHA-256")).cast("long"))
        .alias("keep_id"),
        "group_size",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs.

    The rows of a hot group are narrow here (an id and a digest), and the sort-merge join
    with their one owner row can be split by adaptive execution.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = small_batches(rows).mapInArrow(named, "doc_id long, norm_len long, digest binary")
    return keyed.join(owners(docs), ["norm_len", "digest"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with their columns; of rows repeating id and text, one.

    Only where ids repeat or are null are whole rows moved: else the few ids that go are enough.
    """
    stage = Stage(docs.sparkSession, "exact")
    decided = stage.keep(exact_dedup(docs), "decided")
    if decided.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return without(docs, "doc_id", decided.where("not kept").select(F.col("doc_id").alias("_gone")))
    kept = decided.where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_sha")).distinct()
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        docs["doc_id"].cast("long").alias("_id"),
        F.sha2(F.regexp_replace(F.coalesce(docs["text"], F.lit("")), r"[\x20\x09-\x0D]+", ""), 256).alias("_text"),
    )
    same = rows["_id"].eqNullSafe(kept["_kept_id"]) & (rows["_text"] == kept["_sha"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["_id", "_text"]).select("row.*")


def query(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
with n as (
  select doc_id, length(coalesce(text, '')) as points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256
  from documents)
select doc_id,
  first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as keep_id,
  count(*) over (partition by text_sha256)::BIGINT as group_size,
  first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) = doc_id as kept,
  text_sha256
from n
"""
