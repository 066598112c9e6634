"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source's rows, in the order of a hash of their ids and texts, form blocks of equal
size.  Block k (from 1) of a source of weight w is released at floor((k-1)/w)
and due at ceil(k/w); among released blocks the earliest deadline gets the next
slot.  With weights that sum to 1 every block runs inside its window, so at each
slot no source is a whole block ahead of or behind its share, until it runs out.

Weights are exact: whole numbers over their sum, without rounding to a period.  The driver schedules the blocks
that the data has, and no others.  A block has ``block`` code points or, if that would make more than MOST_BLOCKS of
them, as many as keep to that; so the schedule is bounded.  It is written as a file, and rows meet
it in a join.  A source that has run out leaves its slots to others that are released, and the others keep their
windows.  No row is dropped or repeated: the mix is an order.

Offsets inside a source are summed in two levels (chunks of a source, rows of a chunk),
so no task gets a whole source.

Defined results
---------------
* a null source is the source '' ; an empty or null text has size 1 and hashes as ''; so does a null id;
* equal hashes go by id, then size; repeated rows are rows of their own;
* a source without a given weight is refused (KeyError); an empty table gives an empty result;
* the driver holds each source's total and the schedule, so a table of more than 100,000 sources (MOST_SOURCES) is refused.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import KEY_BITS_SQL, Stage, key_bits, table

#: Code points of a block, at least; most blocks, about; the exponent that tempers natural sizes to target weights.
BLOCK = 1 << 16
MOST_BLOCKS = 1 << 20
TEMPER = 0.5
#: Tempered weights are whole numbers of this fineness.
FINE = 1 << 20
#: Rows of a chunk, about; most sources that the driver takes.
CHUNK_ROWS = 5_000
MOST_SOURCES = 100_000
ADDED = ("mix_source", "mix_block", "mix_slot", "mix_release", "mix_deadline", "mix_offset")


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """The same weights, exactly, as whole numbers."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights must be positive")
    scale = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}


def schedule(weights: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block from 1, slot, release, deadline) of all blocks by earliest deadline first among released ones."""
    total = sum(weights[s] for s in blocks)
    waiting = [(0, s, 1) for s in sorted(blocks) if blocks[s]]
    ready: list[tuple[int, str, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-k * total // weights[s]), s, k))
        deadline, s, k = heapq.heappop(ready)
        yield s, k, slot, (k - 1) * total // weights[s], deadline
        if k < blocks[s]:
            heapq.heappush(waiting, (k * total // weights[s], s, k + 1))
        slot += 1


def tempered(sizes: dict[str, int], temper: float = TEMPER) -> dict[str, int]:
    """Target weights of natural sizes: their power ``temper``."""
    return {s: max(1, int((math.sqrt(n) if temper == 0.5 else n**temper) * FINE)) for s, n in sizes.items()}


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block: int = BLOCK,
    carry: list[str] | None = None,
) -> DataFrame:
    """row (a struct of the columns of docs, or of those in carry), mix_source, mix_block (from 1), mix_slot, mix_release, mix_deadline, mix_offset.

    Sorting by (mix_slot, mix_offset) gives the mixed order.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    sized = docs.select(
        F.struct(*(docs[c] for c in carry or docs.columns)).alias("row"),
        docs["doc_id"].alias("_id"),
        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("mix_source"),
        key_bits(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit("|"), F.md5(text))).alias("_h"),
        F.greatest(F.length(text), F.lit(1)).cast("long").alias("_size"),
    )
    totals = (
        sized.groupBy("mix_source").agg(F.sum("_size").alias("size"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    )
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sizes = {r["mix_source"]: r["size"] for r in totals}
    given = tempered(sizes) if weights is None else {s: weights[s] for s in sizes}
    block = max(block, -(-sum(sizes.values()) // MOST_BLOCKS))
    plan = schedule(whole_weights(given), {s: (n - 1) // block + 1 for s, n in sizes.items()})
    names = ("mix_source", "mix_block", "mix_slot", "mix_release", "mix_deadline")
    lines = (json.dumps(dict(zip(names, x, strict=True))) for x in plan)
    slots = Stage(docs.sparkSession, "mix").lines(lines, "schedule", "mix_source string, mix_block long, mix_slot long, mix_release long, mix_deadline long")
    chunks = max(1, sum(r["n"] for r in totals) // CHUNK_ROWS)
    sized = sized.withColumn("_chunk", F.expr(f"cast(floor(_h / {float(1 << 60)!r}D * {chunks}) as int)"))
    by_chunk = (
        sized.groupBy("mix_source", "_chunk")
        .agg(F.sum("_size").alias("_sum"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_sum").over(Window.partitionBy("mix_source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .drop("_sum")
    )
    inside = Window.partitionBy("mix_source", "_chunk").orderBy("_h", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(by_chunk, ["mix_source", "_chunk"])
    placed = placed.withColumn("mix_offset", F.col("_inside") + F.col("_before"))
    placed = placed.withColumn("mix_block", F.expr(f"mix_offset div {block} + 1"))
    return placed.join(slots, ["mix_source", "mix_block"]).select("row", *ADDED)


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows and columns of docs in mixed order."""
    return mix(docs, **how).orderBy("mix_slot", "mix_offset", "row.doc_id").select("row.*")


def query(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), carry=["doc_id"]).select("row.doc_id", *ADDED)


#: Offsets are window sums; the schedule is one recursion step a slot, over lists of sources.
SQL = f"""
with recursive d as (
  select doc_id, coalesce(source, '') as s, greatest(length(coalesce(text, '')), 1)::BIGINT as size,
    {KEY_BITS_SQL.format("coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))")} as h from documents),
o as (select doc_id, s, sum(size) over (partition by s order by h, doc_id, size rows unbounded preceding)::BIGINT - size as off from d),
size as (select greatest({BLOCK}, (sum(size) + {MOST_BLOCKS - 1}) // {MOST_BLOCKS})::BIGINT as block from d),
p as (select s, greatest(1, floor(sqrt(sum(size)::DOUBLE) * {FINE}))::HUGEINT as w, ((sum(size) - 1) // any_value(block) + 1)::BIGINT as b
  from d, size group by s),
a as materialized (select list(s order by s) as s, list(w order by s) as w, list(b order by s) as b, sum(w)::HUGEINT as total, sum(b)::BIGINT as blocks from p),
run as (
  select -1::BIGINT as slot, list_transform(b, lambda x: 0::BIGINT) as done, 0::BIGINT as pick from a
  union all
  select slot, list_transform(range(1, len(done) + 1), lambda i: done[i] + (i = pick)::BIGINT), pick
  from (select slot + 1 as slot, done, coalesce(list_sort(list_transform(
      list_filter(range(1, len(done) + 1), lambda i: done[i] < b[i] and (done[i] * total) // w[i] <= slot + 1),
      lambda i: {{'due': ((done[i] + 1) * total + w[i] - 1) // w[i], 'i': i}}))[1].i, 0) as pick
    from run, a where list_sum(done) < blocks)),
slots as (select a.s[pick] as s, done[pick] as k, slot, ((done[pick] - 1) * total // w[pick])::BIGINT as release,
    ((done[pick] * total + w[pick] - 1) // w[pick])::BIGINT as due from run, a where pick > 0)
select doc_id, s as mix_source, k as mix_block, slot as mix_slot, release as mix_release, due as mix_deadline, off as mix_offset
from o cross join size join slots using (s) where k = off // block + 1
"""
