"""Approximate nearest neighbours: inverted file, product-quantised residuals, exact reranking.

Nearness is the inner product.  Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest
norm, which makes the largest inner product the smallest distance; on unit vectors it is zero.

* The index is fitted on at most ``SAMPLE`` vectors (by hash of the id): coarse centroids and
  one codebook per slice of the residuals.  Every vector is then indexed.
* A query probes every list that can hold one of its k nearest: the centroid's product and the list's radius bound the
  products of a list, and the k-th best of the sampled vectors is a score that the k nearest reach. So what is probed
  follows from each query itself, however unlike other vectors it is.
* Lists are packed into blocks of vectors, a list of any size into as many as it needs.  A task holds one block at a
  time, and the queries that probe it stream past; a vector is sent once, a query to the blocks that it probes.
* In a block, tables of query times codebook give approximate inner products; the best ``RERANK`` are
  computed from the original vectors in double precision, then all whose product, by the length of what their codes leave
  out, can still be among the k best. The best of all blocks are the result, and are the truly nearest.
* ``exact=True`` probes every list and ranks every vector by its exact product.

Defined results
---------------
* vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor do null ids;
* an id that several rows hold asks once with each different vector (``query_vector``, a hash, tells the lists apart);
* a query does not find rows of its own id; rows that repeat an id are candidates of their own;
* equal scores go to the smaller id; with fewer candidates than wanted, all are returned;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Stage, key_bits, small_batches, spread, table, tidy

#: Bounds of the sample, in rows and bytes; its rows for a list, at least; slices of a vector.
SAMPLE, SAMPLE_BYTES = 32_768, 64 << 20
ROWS_A_LIST = 16
SLICES = 16
RERANK = 256
#: Rounding of a product for each component, as a share of the two lengths multiplied; far more than it is.
ROUNDING = 1e-13
#: Vectors of a block (more where there are more than tasks can share), and queries that stream past one copy of it.
BLOCK_LEAST, BLOCK_MOST, GROUP = 4_096, 65_536, 1 << 20


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (centres**2).sum(axis=1) / 2
    for i in range(0, len(x), 4096):
        out[i : i + 4096] = (x[i : i + 4096] @ centres.T - half).argmax(axis=1)
    return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from distinct rows; an empty cluster restarts at a row far from its centre."""
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        far = np.argsort(-((x - centres[own]) ** 2).sum(axis=1), kind="stable")
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
        empty = np.flatnonzero(n == 0)
        centres[empty] = x[far[: len(empty)]]
    return centres


class Index:
    """Coarse centroids and residual codebooks."""

    def __init__(self, sample: np.ndarray, lists: int, top: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.top = top
        x = self.lift(sample)
        self.centres = _kmeans(x, lists, rng)
        rest = x - self.centres[_nearest(x, self.centres)]
        self.cuts = np.linspace(0, x.shape[1], min(SLICES, x.shape[1]) + 1).astype(int)
        self.books = [_kmeans(rest[:, a:b], 256, rng, 8) for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]

    def lift(self, x: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.top - (x**2).sum(axis=1), 0))
        return np.concatenate([x, more[:, None]], axis=1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and codes of each vector."""
        y = self.lift(x)
        own = _nearest(y, self.centres)
        rest = y - self.centres[own]
        codes = [_nearest(rest[:, a:b], book) for a, b, book in zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)]
        return own, np.stack(codes, axis=1).astype(np.uint8)

    def radii(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Distance of each vector from the centroid of its list, without the added component, as a query has zero there."""
        return np.sqrt(((x - self.centres[own, :-1]) ** 2).sum(axis=1))

    def left_out(self, x: np.ndarray, own: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Length of what the codes of each vector leave out, likewise."""
        rest = self.lift(x) - self.centres[own]
        for s, (a, b, book) in enumerate(zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)):
            rest[:, a:b] -= book[codes[:, s]]
        return np.sqrt((rest[:, :-1] ** 2).sum(axis=1))

    def slack(self, q: np.ndarray) -> np.ndarray:
        """What rounding may add to a product of each query: no vector or centroid is longer than the longest vector."""
        return ROUNDING * (self.centres.shape[1] + 16) * np.sqrt((q**2).sum(axis=-1) * self.top)

    def most(self, q: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The largest product that each query can have with a vector of each list."""
        return q @ self.centres[:, :-1].T + np.sqrt((q**2).sum(axis=1))[:, None] * radius + self.slack(q)[:, None]

    def reached(self, q: np.ndarray, q_ids: np.ndarray, sample: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
        """A score that the k nearest of each query reach, as k of the sample do; minus infinity if the sample has fewer."""
        if len(sample) <= k:
            return np.full(len(q), -np.inf)
        score = q @ sample.T
        score[q_ids[:, None] == ids] = -np.inf
        return np.partition(score, len(sample) - k, axis=1)[:, len(sample) - k] - self.slack(q)

    def approximate(self, q: np.ndarray, own: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Inner products of one query with coded vectors of the lists ``own``, from its tables."""
        y = np.append(q, 0.0)
        out = (self.centres @ y)[own]
        for s, (a, b, book) in enumerate(zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)):
            out += (book @ y[a:b])[codes[:, s]]
        return out


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (array<double>) of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(
        "id is not null and vec is not null and size(vec) > 0"
    )
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where(~bad).where(F.exists("vec", lambda v: v != 0))


def _exact(q: np.ndarray, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.concatenate([(x[some] * q).sum(axis=1) for some in np.split(rows, range(8192, len(rows), 8192))])


def _best(index: Index, q: np.ndarray, block: Block, rows: np.ndarray, k: int, least: float, rerank: int | None):
    """Ids and exact scores of the k best of ``rows`` of a block; those under ``least`` may be missing."""
    if rerank is None or len(rows) <= rerank:
        exact = _exact(q, block.x, rows)
    else:
        score = index.approximate(q, block.own[rows], block.codes[rows])
        tops = np.argpartition(score, len(score) - rerank)[len(score) - rerank :]
        exact = _exact(q, block.x, rows[tops])
        least = max(least, np.partition(exact, rerank - k)[rerank - k]) if k <= rerank else least
        # Not "at least": what is not a number, from products beyond the range of doubles, stays in.
        open_ = ~(score + math.sqrt(q @ q) * block.left_out[rows] + index.slack(q) < least)
        open_[tops] = False
        rest = np.flatnonzero(open_)
        rows, exact = rows[np.concatenate([tops, rest])], np.concatenate([exact, _exact(q, block.x, rows[rest])])
    if len(rows) > k:
        some = np.flatnonzero(~(exact < np.partition(exact, len(exact) - k)[len(exact) - k]))
        rows, exact = rows[some], exact[some]
    best = np.lexsort((block.ids[rows], -exact))[:k]
    return block.ids[rows][best], exact[best]


class Block:
    """The vectors that a task holds, by list."""

    def __init__(self, index: Index, batches: list[pa.RecordBatch]):
        all_ = pa.Table.from_batches(batches)
        own = all_.column("list").to_numpy()
        order = np.argsort(own, kind="stable")
        codes = np.frombuffer(b"".join(all_.column("codes").to_pylist()), np.uint8).reshape(len(own), -1)
        self.ids, self.x, self.own, self.codes = all_.column("id").to_numpy()[order], _matrix(all_.column("vec"))[order], own[order], codes[order]
        self.left_out = np.concatenate([index.left_out(*(a[i : i + 4096] for a in (self.x, self.own, self.codes))) for i in range(0, len(own), 4096)])
        self.lists, starts = np.unique(self.own, return_index=True)
        self.spans = np.stack([starts, np.append(starts[1:], len(own))], axis=1)


_FOUND = pa.schema([("query_id", pa.int64()), ("query_vector", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _compared(index: Index, radius: np.ndarray, k: int, rerank: int | None):
    """Rows sorted by (task, side): the vectors of a block (side 0), then its queries -> the best of the block for each query."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now, ready = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy().astype(np.int64) * 2 + batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                task, side = divmod(int(key[a]), 2)
                if task != now:
                    now, held, ready = task, [], None
                if not side:
                    held.append(batch.slice(a, b - a))
                    continue
                if not held and ready is None:
                    continue
                if ready is None:
                    ready, held = Block(index, held), []
                part = batch.slice(a, b - a)
                out: list = [[], [], [], []]
                vectors, leasts = _matrix(part.column("vec")), part.column("least").to_numpy()
                open_ = ~(index.most(vectors, radius)[:, ready.lists] < leasts[:, None])
                asked = zip(part.column("id").to_pylist(), part.column("qv").to_pylist(), vectors, leasts.tolist(), open_, strict=True)
                for q_id, qv, q, least, some in asked:
                    rows = np.concatenate([np.arange(i, j) for i, j in ready.spans[some]] or [np.zeros(0, np.int64)])
                    found, score = _best(index, q, ready, rows[ready.ids[rows] != q_id], k, least, rerank)
                    out[0] += [q_id] * len(found)
                    out[1] += [qv] * len(found)
                    out[2] += found.tolist()
                    out[3] += score.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _FOUND, strict=True)], schema=_FOUND)

    return run


def search(
    vectors: DataFrame, query_ids, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", exact: bool = False
) -> DataFrame:
    """query_id, rank, vec_id, score, query_vector: the k nearest of each vector whose id ``query_ids(column)`` selects."""
    spark = vectors.sparkSession
    stage = Stage(spark, "ann")
    rows = valid_vectors(vectors, id_col, vec_col)
    shape = rows.groupBy(F.size("vec").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)).alias("top")
    )
    shape = shape.orderBy(F.desc("n"), "d").first()
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_vector long")
    width, n = shape["d"], shape["n"]
    rows = rows.where(F.size("vec") == width)
    size = max(256, min(SAMPLE, SAMPLE_BYTES // (8 * width)))
    taken = rows.orderBy(key_bits(F.col("id")), "id").limit(size).toArrow()
    sample_ids, sample = taken.column("id").to_numpy(), _matrix(taken.column("vec"))
    lists = max(1, min(int(math.sqrt(n)), len(sample) // ROWS_A_LIST + 1))
    index = Index(sample, lists, shape["top"])

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                own, codes = index.encode(x)
                cols = [pa.array(own.astype(np.int32)), pa.array(index.radii(x, own)), batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column(1)]
                yield pa.RecordBatch.from_arrays(cols, names=["list", "radius", "id", "codes", "vec"])

    coded = stage.keep(small_batches(rows).mapInArrow(encode, "list int, radius double, id long, codes binary, vec array<double>"), "coded")
    sizes, radius = np.zeros(len(index.centres), np.int64), np.full(len(index.centres), -np.inf)
    for r in coded.groupBy("list").agg(F.count("*").alias("n"), F.max("radius").alias("radius")).collect():  # one row per list
        sizes[r["list"]], radius[r["list"]] = r["n"], r["radius"]
    # Blocks of each list: lists share a block until it is full, a larger list has blocks of its own.
    block_size = min(BLOCK_MOST, max(BLOCK_LEAST, n // (2 * spark.sparkContext.defaultParallelism)))
    first, several = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // block_size))
    block, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > block_size:
            block, held = block + 1, 0
        first[i], held = block, held + size
        if several[i] > 1:
            block, held = block + several[i], 0
    blocks = int(block) + 1

    @tidy
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                q = _matrix(part.column(1))
                least = np.full(len(q), -np.inf) if exact else index.reached(q, part.column(0).to_numpy(), sample, sample_ids, k)
                hit = np.zeros((len(q), blocks), bool)
                open_ = ~(index.most(q, radius) < least[:, None]) & (sizes > 0)
                for x in np.flatnonzero(open_.any(axis=0)):
                    hit[:, first[x] : first[x] + several[x]] |= open_[:, x, None]
                rows_, blocks_ = np.nonzero(hit)
                picked = part.take(pa.array(rows_))
                cols = [pa.array(blocks_.astype(np.int32)), picked.column(0), picked.column(1), pa.array(least[rows_])]
                yield pa.RecordBatch.from_arrays(cols, names=["block", "id", "vec", "least"])

    asked = stage.keep(rows.where(query_ids(F.col("id"))).dropDuplicates(["id", "vec"]), "asked")
    parts = max(1, -(-asked.count() // GROUP))
    probes = small_batches(spread(asked)).mapInArrow(probe, "block int, id long, vec array<double>, least double")
    task = lambda b, p: (b * parts + p).cast("int").alias("task")
    right = probes.select(
        task(F.col("block"), F.pmod(F.xxhash64("id"), F.lit(parts))), F.lit(1).alias("side"), "id", "vec", F.lit(None).cast("int").alias("list"),
        F.lit(None).cast("binary").alias("codes"), F.xxhash64("vec").alias("qv"), "least",
    )
    of = lambda a: F.element_at(F.lit([int(v) for v in a]), F.col("list") + 1)
    own = of(first) + F.pmod(F.xxhash64("id", "vec"), of(several))
    copies = coded.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))) if parts > 1 else coded.withColumn("part", F.lit(0))
    left = copies.select(
        task(own, F.col("part")), F.lit(0).alias("side"), "id", "vec", "list", "codes", F.lit(None).cast("long").alias("qv"),
        F.lit(None).cast("double").alias("least"),
    )
    dealt = left.unionByName(right).repartitionById(blocks * parts, F.col("task")).sortWithinPartitions("task", "side")
    compare = _compared(index, radius, k, None if exact else RERANK)
    found = small_batches(dealt).mapInArrow(compare, "query_id long, query_vector long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_vector").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "query_vector")


def query(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
