"""Sharding by extendible hashing, with DataFrame functions only.

Each row has 60 hash bits of its id.  A shard is a hash prefix; the directory
starts with the empty prefix, and only a bucket over the byte limit splits on
its next bit, until every shard fits.

Bytes only shrink from a prefix to a longer one, so the shard of a row is its
shortest prefix within the limit.  One pass sums bytes by a fine prefix, and the
sums roll up to all shorter ones; the few fine buckets still over the limit
are refined by the next bits, and by nothing else.

Defined results
---------------
* a null text has no bytes; a null id hashes as the empty text; rows with equal ids share a shard;
* a bucket of one id cannot be split: it stays a shard, ``oversize`` if over the limit;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import KEY_BITS_SQL, Stage, key_bits, table

BITS = 60
#: Production size of a shard, in bytes of UTF-8 text, and the size that the query asks for, which small tables exceed, too.
LIMIT = 64 << 20
QUERY_LIMIT = 1 << 18
#: Bits by which each further round refines what is still over the limit.
STEP = 8


def _levels(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Leaves among prefixes of low..high bits: fine, depth (null: not settled), shard_bytes, oversize."""
    fine = (
        rows.withColumn("fine", F.shiftright("h", BITS - high))
        .groupBy("fine")
        .agg(F.sum("bytes").alias("b"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    )
    up = fine.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn(
        "prefix", F.expr(f"shiftright(fine, {high} - depth)")
    )
    sums = up.groupBy("depth", "prefix").agg(F.sum("b").alias("sb"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    fits = sums.where((F.col("sb") <= limit) | (F.col("lo") == F.col("hi"))).select("depth", "prefix", "sb")
    return (
        up.select("fine", "depth", "prefix")
        .join(fits, ["depth", "prefix"], "left")
        .groupBy("fine")
        .agg(F.min(F.when(F.col("sb").isNotNull(), F.struct("depth", "sb"))).alias("leaf"))
        .select("fine", F.col("leaf.depth").alias("depth"), F.col("leaf.sb").alias("shard_bytes"))
    )


def assign_shards(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, shard (its prefix as bits), depth, bytes, shard_bytes, oversize for every row of docs."""
    if limit < 1:
        raise ValueError("limit must be positive")
    stage = Stage(docs.sparkSession, "shards")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        key_bits(F.col(id_col)).alias("h"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("bytes"),
    )
    rows = stage.keep(rows, "rows")
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    high = min(BITS, max(4, math.ceil(math.log2(max(1.0, total / limit))) + 4))
    done, rest, low, k = [], rows, 0, 0
    while True:
        leaves = stage.keep(_levels(rest, low, high, limit), f"leaves{k}")
        found = rest.withColumn("fine", F.shiftright("h", BITS - high)).join(leaves, "fine")
        done.append(found.where(F.col("depth").isNotNull()))
        if high == BITS or leaves.where(F.col("depth").isNull()).isEmpty():
            break
        rest = stage.keep(found.where(F.col("depth").isNull()).select("doc_id", "h", "bytes"), f"rest{k}")
        low, high, k = high + 1, min(BITS, high + STEP), k + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(
        "doc_id",
        F.expr(f"substr(lpad(bin(h), {BITS}, '0'), 1, depth)").alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        "bytes",
        "shard_bytes",
        (F.col("shard_bytes") > limit).alias("oversize"),
    )


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Writes docs as Parquet, one folder per shard."""
    where = assign_shards(docs, limit).select("doc_id", "shard").distinct()
    docs.join(where, docs["doc_id"].eqNullSafe(where["doc_id"])).drop(where["doc_id"]).write.partitionBy("shard").parquet(path)


def query(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"), QUERY_LIMIT)


SQL = f"""
with h as (
  select doc_id, {KEY_BITS_SQL.format("doc_id")} as h, strlen(coalesce(text, ''))::BIGINT as bytes from documents),
up as (select doc_id, bytes, h, d, h >> ({BITS} - d) as p from h, range(0, 61) r(d)),
sums as (select d, p, sum(bytes)::BIGINT as sb, min(h) = max(h) as one from up group by d, p),
leaf as (
  select u.doc_id, u.bytes, u.h, min(u.d) as depth, arg_min(s.sb, u.d) as sb
  from up u join sums s using (d, p) where s.sb <= {QUERY_LIMIT} or s.one group by all)
select doc_id, substr(lpad(bin(h), {BITS}, '0'), 1, depth::INT) as shard, depth::INT as depth, bytes,
  sb as shard_bytes, sb > {QUERY_LIMIT} as oversize
from leaf
"""
