"""MinHash-style near-dedup with SetSketch registers.

1. Whole texts become sets of shingle hashes (64 bits); documents with one and the same set form a class.
2. A sketch of 128 registers per class: register i is the truncated logarithm (base b) of the smallest of
   exponentially spaced values of the shingles, so sketches of parts merge by maximum and equal
   registers tell of similarity.
3. Bands of 4 registers are hashed; classes that share a band are candidates.  At similarity 0.8 a pair
   shares none of 32 bands with a chance of 5e-8.
4. Candidates first go through the joint likelihood of both sketches, given both set sizes; pairs whose
   estimate is more than 4.5 standard deviations under the limit go no further.
5. The others are verified on full sets, and verified links form components.

Buckets never emit all their pairs.  First each member meets the two heads of its bucket: the members that share
most with others, which in a group of near copies are those with fewest changes.  Pairs of a bucket
that are by then in different components come after.  Members with too many shingles of their own (in no
other member of such buckets) to be linked with anything go first, and pairs that have too many go, too.  The rest
meets in buckets of up to 64 members as pairs, in larger ones in blocks of 512 that compare sketches and
verify inside a task, the largest component's members only against those of others.  So each candidate pair is linked, joined by other links, or refuted.

Defined results
---------------
* a null or empty text, or one without words, has an empty set and is linked with nothing;
* a text of fewer words than a shingle has one shingle: its whole word sequence;
* rows that repeat an id are one document, also with different texts: what is linked with one of its texts is linked
  with all of them, and all its rows get one component; a null id stays a component of its own;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACE, Stage, maybe_among, small_batches, spread, table, tidy, without

REGISTERS, BAND = 128, 4
BASE, RATE, TOP = 1.02, 20.0, (1 << 16) - 2
#: Members of a bucket whose pairs are emitted; members and shingles of a block in larger ones.
SMALL, BLOCK, BLOCK_SHINGLES = 64, 512, 1 << 20
DEVIATIONS = 4.5
#: Members of a bucket that all others meet.
HEADS = 2

_rng = np.random.default_rng(0x5E75)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = _rng.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(1, 1 << 63, REGISTERS, dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(ASCII_SPACE.encode())] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


_POWERS = _powers(256)


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of data (lower-cased bytes, split at ASCII white space)."""
    raw = np.frombuffer(data, np.uint8)
    word = ~_IS_SPACE[raw]
    at = np.flatnonzero(word)
    if not len(at):
        return np.empty(0, np.uint64)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    sizes = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    longest = int(sizes.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    sums = np.add.reduceat(_BYTE[raw[at]] * powers[place], first)
    return _mix(sums + sizes.astype(np.uint64) * _STEP)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    h = word_hashes((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not len(h):
        return h
    if len(h) < words:
        return _mix((h * _PLACE[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - words + 1
    total = h[:n] * _PLACE[0]
    for i in range(1, words):
        total = total + h[i : i + n] * _PLACE[i]
    return np.unique(_mix(total))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a set, as big-endian 16-bit numbers; a larger register is a smaller minimum."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        low = np.minimum(low, ((hashes[i : i + 2048, None] ^ _XOR) * _MULT).min(axis=0))
    # The smallest of n uniform values is, by -ln(1-u), the smallest of n exponential ones.
    least = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(least) / math.log(BASE)), 0, TOP).astype(">u2")


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def likely_similarity(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity under which the counts of larger and smaller registers of a are likeliest."""
    u = (n_a / (n_a + n_b))[:, None]
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / (1 - u), (1 - u) / u)
    up, down = _p(u - (1 - u) * j), _p((1 - u) - u * j)
    same = np.maximum(1 - up - down, 1e-12)
    more, less = more[:, None], less[:, None]
    fit = more * np.log(np.maximum(up, 1e-12)) + less * np.log(np.maximum(down, 1e-12)) + (REGISTERS - more - less) * np.log(same)
    return j[np.arange(len(j)), fit.argmax(axis=1)]


def least_estimate(limit: float) -> float:
    return limit - DEVIATIONS * math.sqrt(limit * (1 - limit) / REGISTERS)


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u2").reshape(-1, REGISTERS)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (digest of the whole set), sketch of rows (doc_id, text, text_key)."""
    names = ["doc_id", "text_key", "n_shingles", "set_key", "sketch"]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, made = [], [], []
            for value in batch.column(1):
                h = shingle_set(value.as_py(), words)
                sizes.append(len(h))
                keys.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                made.append(sketch(h).tobytes() if len(h) else None)
            cols = [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return small_batches(docs).mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_key binary, sketch binary")


def _sets(ids: DataFrame, reps: DataFrame, texts: DataFrame, words: int, stage: Stage, name: str) -> DataFrame:
    """id, doc_id, shingles (sorted) of the classes in ids, each from the one text that stands for it.

    Texts that the bitmap of the wanted ones rules out are not shuffled.
    """
    wanted = stage.keep(reps.join(ids, "id", "left_semi").select("id", "doc_id", "text_key"), f"wanted-{name}")
    near = maybe_among(texts, ["doc_id", "text_key"], wanted.select("doc_id", "text_key")).where("_maybe").drop("_maybe")
    docs = near.join(wanted.hint("merge"), ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                sets = [shingle_set(t, words).view(np.int64) for t in part.column(2).to_pylist()]
                for s in sets:
                    s.sort()
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=["id", "doc_id", "shingles"])

    made = small_batches(docs.select("id", "doc_id", "text")).mapInArrow(run, "id long, doc_id long, shingles array<long>")
    return stage.keep(made, f"sets-{name}")


def _likely(pairs: DataFrame, reps: DataFrame, limit: float) -> DataFrame:
    """Pairs (a, b) of classes whose estimated similarity is not clearly under the limit."""
    least = least_estimate(limit)
    side = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    both = both.where(F.least("n_a", "n_b") >= limit * F.greatest("n_a", "n_b") - 1e-6).select("a", "b", "n_a", "n_b", "s_a", "s_b")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _registers(batch.column(4)), _registers(batch.column(5))
            n_a, n_b = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
            est = likely_similarity((x > y).sum(axis=1), (x < y).sum(axis=1), n_a, n_b)
            yield batch.select([0, 1, 2, 3]).filter(pa.array(est >= least))

    return small_batches(both).mapInArrow(run, "a long, b long, n_a long, n_b long")


def _verified(pairs: DataFrame, sets: DataFrame, limit: float, stage: Stage, name: str) -> DataFrame:
    """Links (a, b) of documents: those of the likely pairs of classes that the full sets confirm."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("doc_id").alias(f"doc_{x}"), F.col("shingles").alias(f"h_{x}"))
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    shared = F.size(F.array_intersect("h_a", "h_b")).cast("long")
    percent = round(limit * 100)
    links = both.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"), "n_a", "n_b", shared.alias("i")).where(
        100 * F.col("i") >= percent * (F.col("n_a") + F.col("n_b") - F.col("i"))
    )
    return stage.keep(links.select("a", "b"), f"links-{name}")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def components(links: DataFrame, stage: Stage, name: str) -> DataFrame:
    """id, root (the smallest id of its component) of each id with a link, by rounds of large and small stars."""

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        root = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(root, "a").where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b").distinct()

    def small(e: DataFrame) -> DataFrame:
        root = e.groupBy("b").agg(F.min("a").alias("m"))
        rest = e.join(root, "b").where(F.col("a") > F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b"))
        return rest.unionByName(root.select(F.col("m").alias("a"), "b")).distinct()

    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    k = 0
    while True:
        edges = stage.keep(small(large(edges)), f"star-{name}{k}")
        if k:
            stage.drop(f"star-{name}{k - 1}")
        k += 1
        # Done when all is stars: each larger end has one edge, and is the smaller end of none.
        ends = edges.select(F.inline(F.array(F.struct(F.col("b").alias("id"), F.lit(1).alias("over")), F.struct(F.col("a").alias("id"), F.lit(0).alias("over")))))
        if ends.groupBy("id").agg(F.sum("over").alias("over"), F.count("*").alias("n")).where("over > 0 and n > 1").isEmpty():
            break
    return edges.select(F.col("b").alias("id"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct()
    )


def _linkable(sets: DataFrame, limit: float) -> DataFrame:
    """id, n, own of the members that can be linked: own shingles are in no other member, and a link leaves
    at most a share of 1 - limit of a set unshared."""
    each = sets.select("id", F.explode("shingles").alias("h"))
    lone = each.groupBy("h").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n = 1").groupBy("id").agg(F.count("*").alias("own"))
    sizes = sets.select("id", F.size("shingles").alias("n"))
    own = sizes.join(lone, "id", "left").select("id", "n", F.coalesce("own", F.lit(0)).alias("own"))
    return own.where(F.col("n") - F.col("own") >= limit * F.col("n") - 1e-6)


def _block_links(members: DataFrame, reps: DataFrame, sets: DataFrame, limit: float) -> DataFrame:
    """Verified links of documents inside large buckets: members (band, id, root, own) -> (a, b).

    Buckets with one main component are one group, whatever their band, so a pair is compared once.  A block holds
    the sets of its members: pairs that the sketches leave open are verified there, and of the links found only those
    go on that join components not yet joined.
    """
    least = least_estimate(limit)
    sizes = members.groupBy("band", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("band").agg(F.max(F.struct("n", F.col("root").alias("main"))).alias("top")).select("band", "top.main")
    rows = members.join(main, "band").select("main", "id", "root", "own").distinct()
    # Blocks are bounded by members and by shingles, so that long documents make more of them.
    size = F.greatest(F.lit(1 / BLOCK), F.col("n") / BLOCK_SHINGLES)
    groups = rows.join(reps.select("id", "n"), "id").groupBy("main").agg(
        F.ceil(F.sum(F.when(F.col("root") != F.col("main"), size).otherwise(0.0))).cast("int").alias("lefts"),
        F.ceil(F.sum(size)).cast("int").alias("rights"),
    )
    rows = rows.join(groups.where("lefts > 0"), "main").join(reps, "id").join(sets, "id")
    spread = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    pick = lambda side, l, r: (F.lit(side).alias("side"), "main", l, r, "doc_id", "root", "n", "own", "sketch", "shingles")
    left = rows.where("root <> main").select(*pick(0, spread(F.col("lefts")).alias("l"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("r")))
    right = rows.select(*pick(1, F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("l"), spread(F.col("rights")).alias("r")))

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids, root, n, own = (table.column(c).to_numpy() for c in ("doc_id", "root", "n", "own"))
        regs = _registers(table.column("sketch").combine_chunks())
        lists = table.column("shingles").combine_chunks()
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        joined: dict[int, int] = {}

        def top(x: int) -> int:
            while joined.get(x, x) != x:
                x = joined[x]
            return x

        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        out = []
        for i in x:
            most = np.minimum(n[y] - own[y], n[i] - own[i])  # shingles that both can have
            other = y[(root[y] != root[i]) & (most >= limit * (n[y] + n[i] - most) - 1e-6)]
            if not len(other):
                continue
            more, less = (regs[i] > regs[other]).sum(axis=1), (regs[i] < regs[other]).sum(axis=1)
            est = likely_similarity(more, less, np.full(len(other), float(n[i])), n[other].astype(float))
            mine = flat[offsets[i] : offsets[i + 1]]
            for k in other[est >= least]:
                if top(root[i]) == top(root[k]):
                    continue
                theirs = flat[offsets[k] : offsets[k + 1]]
                at = np.searchsorted(mine, theirs)
                shared = int((mine[np.minimum(at, len(mine) - 1)] == theirs).sum())
                if 100 * shared >= round(limit * 100) * (len(mine) + len(theirs) - shared):
                    out.append((min(ids[i], ids[k]), max(ids[i], ids[k])))
                    joined[top(root[i])] = top(root[k])
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return small_batches(left.unionByName(right)).groupBy("main", "l", "r").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, limit: float = 0.8, stage: Stage | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    if not 0 < limit <= 1 or not 1 <= words <= len(_PLACE):
        raise ValueError("limit must be in (0, 1], words in 1..64")
    stage = stage or Stage(docs.sparkSession, "near")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    all_docs = stage.keep(sketches(spread(texts), words), "sketches")
    filled = all_docs.where("n_shingles > 0 and doc_id is not null")
    reps = filled.groupBy("set_key", "sketch", F.col("n_shingles").alias("n")).agg(
        F.min_by("text_key", "doc_id").alias("text_key"), F.min("doc_id").alias("doc_id")
    )
    # Pairs are of classes, by an id of their own; links are of documents, by the smallest doc_id of a class.
    reps = stage.keep(reps.withColumn("id", F.monotonically_increasing_id()), "classes")
    part = F.expr(f"substring(sketch, band_no * {2 * BAND} + 1, {2 * BAND})")
    # The number of a band is part of its hash, so a class is in a bucket once.
    bands = reps.select("id", "sketch", F.explode(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1))).alias("band_no")).select(
        "id", F.xxhash64("band_no", part).alias("band")
    )
    buckets = bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = stage.keep(bands.join(buckets.hint("merge"), "band"), "members")
    # Most classes share no band with another; what follows moves sketches of the others only.
    keyed = maybe_among(reps.select("id", "n", "sketch"), ["id"], members.select("id").distinct()).where("_maybe").drop("_maybe")
    keyed = stage.keep(keyed, "keyed")
    shared = members.groupBy("id").agg(F.sum(F.log2("size")).alias("shared"))
    first = Window.partitionBy("band").orderBy(F.desc("shared"), "id")
    heads = members.join(shared, "id").withColumn("place", F.row_number().over(first)).where(F.col("place") <= HEADS)
    met = members.join(heads.select("band", F.col("id").alias("head")), "band").where("id <> head")
    stars = stage.keep(met.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct(), "stars")
    likely = stage.keep(_likely(stars, keyed, limit), "likely-first")
    first_sets = _sets(_ends(likely), reps, texts, words, stage, "first")
    links = _verified(likely, first_sets, limit, stage, "first")

    # Ids with several sets link the classes of these.
    each = all_docs.where("doc_id is not null").groupBy("doc_id")
    each = each.agg(F.min("set_key").alias("x"), F.max("set_key").alias("y"), F.count_if(F.col("set_key").isNull()).alias("blanks"))
    mixed = stage.keep(each.where("x <> y or (x is not null and blanks > 0)").select("doc_id", "x", "blanks"), "mixed")
    repeats = not mixed.isEmpty()
    x = reps.select(F.col("set_key").alias("x"), F.col("doc_id").alias("a"))
    if repeats:
        tied = filled.join(mixed, "doc_id").where("set_key <> x").select("x", "set_key").distinct()
        tied = tied.join(x, "x").join(reps.select("set_key", F.col("doc_id").alias("b")), "set_key").select("a", "b")
        links = links.unionByName(stage.keep(tied, "tied"))
    roots = stage.keep(components(links, stage, "first"), "roots-first")

    # What buckets of three and more still hold in different components.
    root_of = reps.select("id", "doc_id").join(roots.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    open_ = members.where("size > 2").join(root_of.select("id", F.coalesce("root", "doc_id").alias("root")), "id")
    several = open_.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("band")
    open_ = stage.keep(open_.join(several, "band", "left_semi"), "open")
    open_ids = open_.select("id").distinct()
    more_sets = _sets(open_ids.join(first_sets, "id", "left_anti"), reps, texts, words, stage, "second")
    sets = stage.keep(first_sets.join(open_ids, "id", "left_semi").unionByName(more_sets), "open-sets")
    able = stage.keep(_linkable(sets, limit).join(open_, "id"), "able")
    few = able.where(f"size <= {SMALL}").select("band", "id", "root", "n", "own")
    other = few.select("band", *(F.col(c).alias(f"{c}_b") for c in ("id", "root", "n", "own")))
    most = F.least(F.col("n") - F.col("own"), F.col("n_b") - F.col("own_b"))  # shingles that both can have
    meet = (few["band"] == other["band"]) & (F.col("id") < F.col("id_b")) & (F.col("root") != F.col("root_b"))
    meet = meet & (most >= limit * (F.col("n") + F.col("n_b") - most) - 1e-6)
    pairs = few.join(other, meet).select(F.col("id").alias("a"), F.col("id_b").alias("b")).distinct()
    more = stage.keep(_likely(pairs.join(stars, ["a", "b"], "left_anti"), keyed, limit), "likely-second")
    found = _verified(more, sets, limit, stage, "second")
    many = able.where(f"size > {SMALL}").select("band", "id", "root", "own")
    if not many.isEmpty():
        found = found.unionByName(stage.keep(_block_links(many, keyed, sets, limit), "block-links"))
    if not found.isEmpty():
        roots = stage.keep(components(links.unionByName(found), stage, "second"), "roots-second")

    stage.only("sketches", "classes", "mixed", "roots-first", "roots-second")
    # Rows of empty texts and null ids belong to no class; a key of their own keeps them apart.
    own = F.coalesce("set_key", F.concat(F.lit("-"), F.coalesce("doc_id", F.lit(0)).cast("string")).cast("binary"))
    own = F.when(F.col("doc_id").isNull(), F.lit("-").cast("binary")).otherwise(own)
    roots = roots.withColumnRenamed("id", "a")
    named = reps.join(roots, reps["doc_id"] == roots["a"], "left").select("set_key", F.coalesce("root", "doc_id").alias("component"))
    if repeats:  # a blank row of an id goes with its other rows
        blank = mixed.where("blanks > 0").join(x, "x").join(roots, "a", "left")
        key = F.concat(F.lit("-"), F.col("doc_id").cast("string")).cast("binary")
        named = named.unionByName(blank.select(key.alias("set_key"), F.coalesce("root", "a").alias("component")))
    return (
        all_docs.select("doc_id", "n_shingles", own.alias("set_key"))
        .join(named, "set_key", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def dedup_documents(docs: DataFrame, words: int = 5, limit: float = 0.8) -> DataFrame:
    """The rows of docs that stay, one document of each group, with their columns."""
    stage = Stage(docs.sparkSession, "near")
    gone = near_duplicates(docs, words, limit, stage).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    gone = stage.keep(gone, "gone")
    stage.only("gone")
    return without(docs, "doc_id", gone)


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, limit=0.8)
