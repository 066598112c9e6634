"""Shared plumbing: table access, stage files in the shared folder, bitmap filters, ASCII white space."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Iterable
from contextlib import closing
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that the contracts name: U+0020 and U+0009 to U+000D.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as the session runs tasks at once: a small file is one partition
    and would keep a single core busy.  Tables of many files stay as they are."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= wanted else df.repartition(wanted)


#: Bytes of an Arrow batch, where the session names none: Spark's own bound is 64 MiB, and a batch is held several times
#: by the executor and by its worker.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, for an Arrow function: rows are whole texts, so batches are bounded by bytes.

    Sets ``spark.sql.execution.arrow.maxBytesPerBatch`` of the session if nobody has; a longer row is a batch of its own.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in conf.getAll:
        conf.set(key, str(BATCH_BYTES))
    return df


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share.

    ``spark.checkpoint.dir`` of the session decides.  Only a local session
    (one machine, such as a test) may go without: it gets a folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file:///tmp/checkpoints/tessera"
    return found.rstrip("/")


class Stage:
    """Cuts lineage through Parquet files in the shared folder.

    ``keep`` writes a frame and returns it reread; ``drop`` deletes files that
    no later plan reads.  Files that the returned frame still reads stay; they
    lie in one folder per call of the operator.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.names.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def lines(self, lines: Iterable[str], name: str, schema: str) -> DataFrame:
        """Lines of JSON that the driver makes, as a file and reread."""
        path = self._path(name)
        with closing(path.getFileSystem(self._conf()).create(path, True)) as out:
            for some in batched(lines, 10_000):
                out.write("".join(f"{x}\n" for x in some).encode())
        return self.spark.read.schema(schema).json(f"{self.root}/{name}")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _conf(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def drop(self, name: str) -> None:
        path = self._path(name)
        path.getFileSystem(self._conf()).delete(path, True)

    def only(self, *names: str) -> None:
        """Deletes what was kept under other names."""
        for name in self.names:
            if name not in names:
                self.drop(name)
        self.names = list(names)


def tidy(run):
    """run (an Arrow function over batches) that gives freed memory back to the system when its task ends:
    workers live on, and what they keep adds to what later stages need."""

    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            import pyarrow

            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidied


#: Most bits of a bitmap filter, as a power of two: its broadcast has at most 2^20 rows of 16 bytes.
FILTER_BITS = 26


def maybe_among(rows: DataFrame, key: list[str], ids: DataFrame) -> DataFrame:
    """rows with a column ``_maybe``: false only if the columns ``key`` of a row equal no row of ``ids``.

    ids (with the same columns) become a bitmap of bounded size, 16 bits an id up to 2^FILTER_BITS in all, so what is
    broadcast does not grow with the data; beyond that, more rows are let through, and results stay the same.
    """
    slots = 1 << min(FILTER_BITS, max(10, (16 * ids.count()).bit_length()))
    at = F.pmod(F.xxhash64(*key), F.lit(slots))
    words = ids.select(F.shiftright(at, 6).alias("_word"), F.pmod(at, F.lit(64)).cast("int").alias("_bit"))
    words = words.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    marked = rows.withColumns({"_word": F.shiftright(at, 6), "_bit": F.pmod(at, F.lit(64)).cast("int")}).join(F.broadcast(words), "_word", "left")
    hit = F.expr("coalesce(shiftrightunsigned(_bits, _bit) & 1L, 0L) = 1L")
    return marked.withColumn("_maybe", hit).drop("_word", "_bit", "_bits")


def without(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """rows whose ``key`` (a long; null stays) equals no row of ids (one column, ``_gone``), with their columns.

    Only rows that the bitmap lets through are shuffled, which are few where few rows go.
    """
    packed = rows.select(F.struct(*(rows[c] for c in rows.columns)).alias("row"), rows[key].cast("long").alias("_gone"))
    marked = maybe_among(packed, ["_gone"], ids)
    asked = marked.where("_maybe").drop("_maybe").join(ids, "_gone", "left_anti")
    return marked.where("not _maybe").select("row.*").unionByName(asked.select("row.*"))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def key_bits(column: Column) -> Column:
    """60 hash bits of an id as a non-negative long: the first 15 hex digits of md5 of its decimal text."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


#: The same in DuckDB, over a column named by ``{0}``.
KEY_BITS_SQL = "('0x' || substr(md5(coalesce(({0})::varchar, '')), 1, 15))::BIGINT"
