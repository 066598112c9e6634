"""Measures of long texts of pairs, without a copy of both texts for every pair.

S1 records are dealt into blocks and the others into parts.  A cell is one block and one part: it holds the texts of
its block in a worker's memory and streams the records of its part past them, each followed by its pairs.  So a text
moves once for each cell of its block or part, however many pairs it is in, and of the pairs only ids and columns move.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of the texts that a worker holds at a time.
BLOCK_CHARS = 48_000_000
#: Cells for each task that the session runs at once.
CELLS = 2
HELD, ROW, PAIR = 0, 1, 2

#: Field, text, what is made of a text, and the measure of two of these.
Measure = tuple[str, str, Callable[[str], object], Callable[[object, object], float]]


def words(text: str) -> set[str]:
    out = set(text.split(" "))
    out.discard("")
    return out


def grams(text: str, n: int = 3) -> set[str]:
    """The set of n-grams, as ``text.char_ngrams`` has it."""
    return {text[i : i + n] for i in range(max(len(text) - n + 1, 1))} if text else set()


def share(both_empty: float) -> Callable[[set, set], float]:
    """The share of common words, as ``similarity.jaccard`` has it."""

    def of(a: set, b: set) -> float:
        shared = len(a & b)
        union = len(a) + len(b) - shared
        return shared / union if union else both_empty

    return of


def meet(a: set, b: set) -> float:
    return float(not a.isdisjoint(b))


def _run(measures: list[tuple[str, int, Callable, Callable]]):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        names = ["pair", *(m[0] for m in measures)]
        held: dict[str, list[tuple[str, ...]]] = {}
        at, rows = None, []
        seen: dict[tuple[str, ...], list[list[float]]] = {}  # by the texts of S1 records: copies are measured once
        for batch in batches:
            pair = batch.column(3)
            kinds, ids, others = (batch.column(i).to_pylist() for i in range(3))
            texts = [batch.column(i).to_pylist() for i in range(4, batch.num_columns)]
            taken: list[int] = []
            values: list[list[float]] = [[] for _ in measures]
            for i, (kind, name) in enumerate(zip(kinds, ids, strict=True)):
                if kind == HELD:
                    held.setdefault(name, []).append(tuple(t[i] for t in texts))
                    continue
                if name != at:
                    at, rows, seen = name, [], {}
                if kind == ROW:
                    rows.append([make(texts[t][i]) for _, t, make, _ in measures])
                    continue
                for left in held.get(others[i], ()):
                    if left not in seen:
                        seen[left] = [[of(make(left[t]), made) for (_, t, make, of), made in zip(measures, right, strict=True)] for right in rows]
                    for found in seen[left]:
                        taken.append(i)
                        for out, value in zip(values, found, strict=True):
                            out.append(value)
            columns = [pair.take(pa.array(taken, pa.int64())), *(pa.array(v, pa.float64()) for v in values)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def measured(pairs: DataFrame, records: DataFrame, texts: dict[str, Column], measures: list[Measure], block_chars: int | None = None) -> DataFrame:
    """pairs with a column for each measure; pairs with an unknown id are left out.

    ``records``: entity_id and what ``texts`` are made of; ids of S1 are those on the left of pairs.
    """
    spark, ids = pairs.sparkSession, pairs.columns[:2]
    if ids != ["source1_entity_id", "candidate_entity_id"]:
        raise ValueError("pairs start with the ids of the S1 record and the candidate")
    left = F.col("entity_id").startswith("S1-")
    # Sizes are of the texts as they came, where they are there, so that counting normalises nothing.
    made = [c for c in ("business_name", "business_address") if c in records.columns] or [c for c in records.columns if c != "entity_id"]
    chars = sum((F.length(F.coalesce(c, F.lit(""))) for c in made), F.lit(0))
    size = records.agg(F.sum(F.when(left, chars)).alias("own"), F.sum(F.when(~left, chars)).alias("others")).first()
    own_chars, others = size["own"] or 0, size["others"] or 0
    cells = CELLS * spark.sparkContext.defaultParallelism
    # Blocks times others plus parts times own is least there; a block also has to fit.
    blocks = max(1, -(-own_chars // (block_chars or BLOCK_CHARS)), min(cells, round((cells * own_chars / max(1, others)) ** 0.5)))
    parts = max(1, -(-cells // blocks))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    part = lambda c: F.pmod(F.xxhash64(c, F.lit(1)), F.lit(parts))
    own = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: block("entity_id") * parts + p)
    other = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b * parts + part("entity_id"))
    fields = [F.coalesce(c, F.lit("")).alias(f"_text_{t}") for t, c in texts.items()]
    known = records.where("entity_id is not null").select(
        F.explode(F.when(left, own).otherwise(other).cast("array<int>")).alias("cell"), F.when(left, HELD).otherwise(ROW).alias("kind"),
        F.col("entity_id").alias("id"), F.lit(None).cast("string").alias("other"), F.lit(None).cast(pairs.schema).alias("pair"), *fields,
    )
    asked = pairs.where(" and ".join(f"{c} is not null" for c in ids)).select(
        (block(ids[0]) * parts + part(ids[1])).cast("int").alias("cell"), F.lit(PAIR).alias("kind"), F.col(ids[1]).alias("id"), F.col(ids[0]).alias("other"),
        F.struct(*pairs.columns).cast(pairs.schema).alias("pair"), *(F.lit("").alias(f"_text_{t}") for t in texts),
    )
    # Held records first, then each other record before its pairs.
    dealt = known.unionByName(asked).repartitionById(blocks * parts, "cell").sortWithinPartitions(F.col("kind") != HELD, "id", "kind").drop("cell")
    names = list(texts)
    if (key := "spark.sql.execution.arrow.maxBytesPerBatch") not in spark.conf.getAll:
        spark.conf.set(key, str(4 << 20))
    found = dealt.mapInArrow(
        _run([(field, names.index(t), make, of) for field, t, make, of in measures]),
        f"pair {pairs.schema.simpleString()}, " + ", ".join(f"{field} double" for field, *_ in measures),
    )
    return found.select("pair.*", *(field for field, *_ in measures))
