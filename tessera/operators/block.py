"""Candidate generation: an inverted index with tf-idf weights, and its relatives.

Everything is a join on tokens and one aggregation.  A pair of records meets only through
tokens that both hold, inside one country, and tokens in more than ``max_df`` of a pool are dropped first, which
bounds the longest posting list; adaptive execution splits what skew is left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import nearest as N
from tessera.operators.together import Measure
from tessera.sources.tables import of_source


@dataclass(frozen=True)
class Blocking:
    top_k: int = 20
    min_sim: float = 0.05
    rel_floor: float = 0.25
    max_df: float = 0.05
    min_df: int = 1
    channels: tuple[str, ...] = ("name", "address")
    no_rank: int = 999


DEFAULT = Blocking()


def normalized(ents: DataFrame) -> DataFrame:
    """entity_id, country, name, address (normalised), business_name, business_address."""
    return ents.select(
        "entity_id",
        "country",
        X.normalize_name(F.col("business_name"), F.col("country")).alias("name"),
        X.normalize_address(F.col("business_address"), F.col("country")).alias("address"),
        "business_name",
        "business_address",
    )


def held_tokens(norm: DataFrame, channels: tuple[str, ...], cut=X.words) -> DataFrame:
    """entity_id, country, source, channel, token: each token of a record once."""
    texts = F.array(
        *(F.struct(F.lit(c).alias("channel"), F.array_distinct(cut(X.channel_text(c, F.col("name"), F.col("address")))).alias("tokens")) for c in channels)
    )
    each = norm.select("entity_id", "country", X.source_tag(F.col("entity_id")).alias("source"), F.inline(texts))
    return each.select("entity_id", "country", "source", "channel", F.explode("tokens").alias("token"))


def tokens(norm: DataFrame, channels: tuple[str, ...], cut=X.words) -> DataFrame:
    """entity_id, country, source, channel, token, tf."""
    texts = F.array(
        *(F.struct(F.lit(c).alias("channel"), cut(X.channel_text(c, F.col("name"), F.col("address"))).alias("tokens")) for c in channels)
    )
    each = norm.select("entity_id", "country", X.source_tag(F.col("entity_id")).alias("source"), F.inline(texts))
    each = each.select("entity_id", "country", "source", "channel", F.explode("tokens").alias("token"))
    return each.groupBy("entity_id", "country", "source", "channel", "token").agg(F.count("*").alias("tf"))


def vocabulary(pool_tokens: DataFrame, pool: DataFrame, how: Blocking = DEFAULT) -> DataFrame:
    """country, pool, channel, token, df, idf of the tokens kept; the pool alone decides."""
    n = pool.groupBy("country", X.source_tag(F.col("entity_id")).alias("pool")).agg(F.count("*").alias("n"))
    df = pool_tokens.groupBy("country", F.col("source").alias("pool"), "channel", "token").agg(F.count("*").alias("df"))
    kept = df.join(n, ["country", "pool"]).where((F.col("df") >= how.min_df) & (F.col("df") <= how.max_df * F.col("n")))
    return kept.select("country", "pool", "channel", "token", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def _weighted(side: DataFrame, vocab: DataFrame, on: list[str]) -> DataFrame:
    raw = side.join(vocab.drop("df"), on).withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("entity_id", "pool", "channel")))
    return raw.select("entity_id", "country", "pool", "channel", "token", (F.col("raw") / norm).alias("w"))


def fit_pool(norm: DataFrame, how: Blocking = DEFAULT, cut=X.words) -> tuple[DataFrame, DataFrame]:
    """The index of the pools: vocabulary, and unit vectors as postings (entity_id, country, pool, channel, token, w)."""
    pool = norm.where(X.source_tag(F.col("entity_id")) != "S1")
    held = tokens(pool, how.channels, cut)
    vocab = vocabulary(held, pool, how)
    return vocab, _weighted(held.withColumnRenamed("source", "pool"), vocab, ["pool", "country", "channel", "token"])


def save_pool(index: tuple[DataFrame, DataFrame], path: str) -> None:
    for name, rows in zip(("vocabulary", "postings"), index, strict=True):
        rows.write.mode("overwrite").partitionBy("country").parquet(f"{path}/{name}")


def load_pool(spark, path: str) -> tuple[DataFrame, DataFrame]:
    country = "country string"
    vocab = spark.read.schema(f"pool string, channel string, token string, df long, idf double, {country}").parquet(f"{path}/vocabulary")
    postings = spark.read.schema(f"entity_id string, pool string, channel string, token string, w double, {country}").parquet(f"{path}/postings")
    return vocab, postings


def similarities(norm: DataFrame, how: Blocking = DEFAULT, cut=X.words, index: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """s1, pool, cand, sim_<channel> for every pair that shares a kept token in a channel; ``index`` may come from files."""
    vocab, right = index or fit_pool(norm, how, cut)
    s1 = tokens(norm.where(X.source_tag(F.col("entity_id")) == "S1"), how.channels, cut).drop("source")
    left = _weighted(s1, vocab, ["country", "channel", "token"])
    left = left.select(F.col("entity_id").alias("s1"), "country", "pool", "channel", "token", F.col("w").alias("w1"))
    right = right.select(F.col("entity_id").alias("cand"), "country", "pool", "channel", "token", F.col("w").alias("w2"))
    both = left.join(right, ["country", "pool", "channel", "token"])
    product = F.col("w1") * F.col("w2")
    return both.groupBy("s1", "pool", "cand").agg(
        *(F.sum(F.when(F.col("channel") == c, product).otherwise(0.0)).alias(f"sim_{c}") for c in how.channels)
    )


def ranked(sims: DataFrame, how: Blocking = DEFAULT, more: tuple[str, ...] = ()) -> DataFrame:
    """Pairs that some channel picks, with rank_<channel> (``no_rank`` where it did not) and the columns ``more``.

    A channel picks pairs over both floors, the best ``top_k`` of each S1 record and pool.  All windows share one
    partitioning, so this is one shuffle.
    """
    rows = sims.where(" or ".join(f"round(sim_{c}, 9) >= {how.min_sim}" for c in how.channels))
    group = Window.partitionBy("s1", "pool")
    for c in how.channels:
        rows = rows.withColumn(f"_v_{c}", F.round(F.col(f"sim_{c}"), 9))
        top = F.max(F.col(f"_v_{c}")).over(group)
        rows = rows.withColumn(f"_ok_{c}", (F.col(f"_v_{c}") >= how.min_sim) & (F.col(f"_v_{c}") >= how.rel_floor * top))
    for c in how.channels:
        place = F.row_number().over(group.orderBy(F.desc(f"_ok_{c}"), F.desc(f"_v_{c}"), "cand")) - 1
        rows = rows.withColumn(f"rank_{c}", F.when(F.col(f"_ok_{c}") & (place < how.top_k), place).otherwise(how.no_rank))
    picked = rows.where(" or ".join(f"rank_{c} < {how.no_rank}" for c in how.channels))
    return picked.select("s1", "pool", "cand", *(f"sim_{c}" for c in how.channels), *(f"rank_{c}" for c in how.channels), *more)


def picked(norm: DataFrame, how: Blocking = DEFAULT, shard_chars: int | None = None, measures: list[Measure] = ()) -> DataFrame:
    """What ``ranked`` gives for the similarities of ``norm``, without a row for every pair that shares a token.

    ``measures`` of name or address follow, taken where a pair is found, so that no text goes with a pair.
    """
    rows = norm.select(
        "entity_id", F.col("country").alias("grp"), X.source_tag(F.col("entity_id")).alias("source"),
        *(X.channel_text(c, F.col("name"), F.col("address")).alias(c) for c in how.channels),
        *(F.col(c).alias(f"own_{c}") for c in dict.fromkeys(m[1] for m in measures)),
    )
    measures = [(field, f"own_{t}", make, of) for field, t, make, of in measures]
    # Sizes are of the texts as they came, so that counting normalises nothing.
    raw = [c for c in ("business_name", "business_address") if c in norm.columns and how.channels != (("address",) if c == "business_name" else ("name",))]
    size = norm.select("entity_id", "country", sum((F.coalesce(F.length(c), F.lit(0)) for c in raw or ("name", "address")), F.lit(0)).alias("chars"))

    def terms() -> DataFrame:
        pool = norm.where(X.source_tag(F.col("entity_id")) != "S1")
        return vocabulary(held_tokens(pool, how.channels), pool, how).withColumnRenamed("country", "grp")

    near = N.Nearest(how.channels, how.top_k, how.min_sim, how.rel_floor, min_df=how.min_df, max_df=how.max_df, no_rank=how.no_rank)
    found, final = N.nearest(rows, near, terms, shard_chars, size.select(F.col("country").alias("grp"), X.source_tag(F.col("entity_id")).alias("source"), "chars"), measures)
    names, more = ["s1", "pool", "cand", *(f"sim_{c}" for c in how.channels)], tuple(m[0] for m in measures)
    return found.select(*names, *(f"rank_{c}" for c in how.channels), *more) if final else ranked(found.select(*names, *more), how, more)


def candidates(norm: DataFrame, how: Blocking = DEFAULT, index: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The candidate table: pairs of all pools with similarities, ranks and what the whole list of an S1 record says."""
    rows = ranked(similarities(norm, how, index=index), how) if index else picked(norm, how)
    best = F.greatest(*(F.col(f"sim_{c}") for c in how.channels)) if len(how.channels) > 1 else F.col(f"sim_{how.channels[0]}")
    whole = Window.partitionBy("source1_entity_id")
    rows = rows.withColumnRenamed("s1", "source1_entity_id").withColumnRenamed("cand", "candidate_entity_id").drop("pool")
    rows = rows.withColumn("sim_best", best)
    rows = rows.withColumn("cand_count", F.count("*").over(whole)).withColumn("sim_max_for_s1", F.max("sim_best").over(whole))
    return rows.withColumn("sim_margin", F.col("sim_max_for_s1") - F.col("sim_best"))


def _nearest_texts(rows: DataFrame, near: N.Nearest, terms, shard_chars: int | None) -> DataFrame:
    """grp, pool, s1, cand, sim: the ``top_k`` nearest of each S1 record and pool."""
    found, final = N.nearest(rows, near, terms, shard_chars)
    sims = found.select("grp", "pool", "s1", "cand", F.round("sim_name", 9).alias("sim"))
    if final:
        return sims
    place = F.row_number().over(Window.partitionBy("s1", "pool").orderBy(F.desc("sim"), "cand"))
    return sims.withColumn("place", place).where(F.col("place") <= near.top_k).drop("place")


def ngram_neighbours(norm: DataFrame, top_k: int = 20, low: int = 3, high: int = 5, shard_chars: int | None = None) -> DataFrame:
    """s1, cand, sim of the older generation: nearest names by n-gram tf-idf fitted on S1 and pool together,
    without regard to country.  Pairs without a common n-gram are left out."""
    rows = norm.select("entity_id", "name", X.source_tag(F.col("entity_id")).alias("source"), F.lit("").alias("grp"))

    def terms() -> DataFrame:
        n = rows.groupBy("source").agg(F.count("*").alias("n"))
        df = rows.select("source", F.explode(F.array_distinct(X.char_ngram_bag(F.col("name"), low, high))).alias("token"))
        df = df.groupBy("source", "token").agg(F.count("*").alias("df"))
        pools = n.where("source <> 'S1'").select(F.col("source").alias("pool"), "n")
        pools = pools.crossJoin(n.where("source = 'S1'").select(F.col("n").alias("own"))).select("pool", (F.col("n") + F.col("own")).alias("n"))
        # Counts of S1 go to every pool.
        both = df.join(F.broadcast(pools), (F.col("source") == "S1") | (F.col("source") == F.col("pool")))
        both = both.groupBy("pool", "token", "n").agg(F.sum("df").alias("df"))
        idf = F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1
        return both.select(F.lit("").alias("grp"), "pool", F.lit("name").alias("channel"), "token", idf.alias("idf"))

    return _nearest_texts(rows, N.Nearest(("name",), top_k, pool_fit=False, grams=(low, high)), terms, shard_chars).select("s1", "cand", "sim")


def capped_neighbours(
    ents: DataFrame, text: str = "business_name", top_k: int = 20, most_terms: int = 40_000, min_df: int = 2, low: int = 3, high: int = 5, shard_chars: int | None = None
) -> DataFrame:
    """country, pool, s1, cand, sim: nearest raw texts (lower-cased, white space squeezed) by character n-grams.

    Each pool of a country has a vocabulary of its own: terms of at least ``min_df`` records, the ``most_terms`` that occur
    oftenest in all (ties by term).  Pairs without a common term are left out.
    """
    rows = ents.select("entity_id", F.col("country").alias("grp"), X.source_tag(F.col("entity_id")).alias("source"), X.squeeze(F.lower(F.col(text))).alias("name"))

    def terms() -> DataFrame:
        pool = rows.where("source <> 'S1'").withColumnRenamed("source", "pool")
        n = pool.groupBy("grp", "pool").agg(F.count("*").alias("n"))
        bag = X.char_ngram_bag(F.col("name"), low, high)
        once = lambda df, all_: lambda t: F.struct(t.alias("token"), F.lit(df).alias("df"), F.lit(all_).alias("all"))
        each = pool.select("grp", "pool", bag.alias("bag")).select(
            "grp", "pool", F.inline(F.concat(F.transform(F.array_distinct("bag"), once(1, 0)), F.transform("bag", once(0, 1))))
        )
        found = each.groupBy("grp", "pool", "token").agg(F.sum("df").alias("df"), F.sum("all").alias("all")).where(F.col("df") >= min_df)
        place = F.row_number().over(Window.partitionBy("grp", "pool").orderBy(F.desc("all"), "token"))
        found = found.withColumn("place", place).where(F.col("place") <= most_terms).join(F.broadcast(n), ["grp", "pool"])
        return found.select("grp", "pool", F.lit("name").alias("channel"), "token", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))

    near = N.Nearest(("name",), top_k, pool_fit=False, grams=(low, high))
    return _nearest_texts(rows, near, terms, shard_chars).withColumnRenamed("grp", "country")


def sorted_neighbours(norm: DataFrame, window: int = 5) -> DataFrame:
    """s1, cand: pool records at sorted name positions [p - window, p + window), p being how many names sort before.

    Positions come from a global order in two levels: rows per range of names first, then rows inside a range.
    """
    rows = norm.select("entity_id", "name", X.source_tag(F.col("entity_id")).alias("source"))
    pools = rows.where("source <> 'S1'").withColumnRenamed("source", "pool")
    tags = pools.select("pool").distinct()
    both = rows.where("source = 'S1'").drop("source").crossJoin(F.broadcast(tags)).withColumn("member", F.lit(0))
    both = both.unionByName(pools.withColumn("member", F.lit(1)))
    # The range of a name is its first three characters: equal names share one, and ranges sort as names do.
    both = both.withColumn("range", F.substring("name", 1, 3))
    per = both.groupBy("pool", "range").agg(F.sum("member").alias("k"))
    before = F.coalesce(F.sum("k").over(Window.partitionBy("pool").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.select("pool", "range", before.alias("before"))
    inside = Window.partitionBy("pool", "range").orderBy("name", "member", "entity_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = both.withColumn("inside", F.coalesce(F.sum("member").over(inside), F.lit(0))).join(per, ["pool", "range"])
    placed = placed.withColumn("pos", F.col("inside") + F.col("before"))
    asked = placed.where("member = 0").select(
        F.col("entity_id").alias("s1"), "pool", F.explode(F.sequence(F.col("pos") - window, F.col("pos") + window - 1)).alias("pos")
    )
    held = placed.where("member = 1").select(F.col("entity_id").alias("cand"), "pool", "pos")
    return asked.join(held, ["pool", "pos"]).select("s1", "cand")


def older_candidates(norm: DataFrame, top_k: int = 20, window: int = 5) -> DataFrame:
    return ngram_neighbours(norm, top_k).select("s1", "cand").unionByName(sorted_neighbours(norm, window)).distinct()


def postal_candidates(ents: DataFrame, most: int = 100) -> DataFrame:
    """s1, cand pairs with one postal code (by the country's pattern), the first ``most`` of a code."""
    coded = ents.select("entity_id", "country", X.postal_code_profile(F.col("business_address"), F.col("country")).alias("postal")).where("postal <> ''")
    pool = of_source(coded, "S2", "S3").withColumn("pool", X.source_tag(F.col("entity_id")))
    place = F.row_number().over(Window.partitionBy("country", "pool", "postal").orderBy("entity_id"))
    pool = pool.withColumn("place", place).where(F.col("place") <= most).select("country", "postal", F.col("entity_id").alias("cand"))
    s1 = of_source(coded, "S1").select("country", "postal", F.col("entity_id").alias("s1"))
    return s1.join(pool, ["country", "postal"]).select("s1", "cand", "postal")


def recall_at(sims: DataFrame, pairs: DataFrame, ents: DataFrame, channels: tuple[str, ...], ks=(5, 10, 20, 50, 100)) -> DataFrame:
    """country, source, channel, k, recovered, total, recall_pct, avg_cand_size over S1 records with a true match.

    ``pairs`` are true pairs (source1_entity_id, matched_entity_id); the channel ``union`` takes the best place of any.
    """
    truth = pairs.where("matched_entity_id is not null").select(
        F.col("source1_entity_id").alias("s1"), F.col("matched_entity_id").alias("cand"), X.source_tag(F.col("matched_entity_id")).alias("pool")
    )
    asked = truth.select("s1", "pool").distinct()
    place = lambda c: F.when(
        F.round(F.col(f"sim_{c}"), 9) > 0,
        F.row_number().over(Window.partitionBy("s1", "pool").orderBy(F.desc(F.round(F.col(f"sim_{c}"), 9)), "cand")),
    )
    rows = sims.join(asked, ["s1", "pool"], "left_semi").select("s1", "pool", "cand", *(place(c).alias(c) for c in channels))
    rows = rows.withColumn("union", F.least(*(F.col(c) for c in channels)) if len(channels) > 1 else F.col(channels[0]))
    names = [*channels, "union"]
    stacked = rows.select("s1", "pool", "cand", F.inline(F.array(*(F.struct(F.lit(c).alias("channel"), F.col(f"`{c}`").alias("place")) for c in names))))
    stacked = stacked.where(F.col("place") <= max(ks)).join(truth.withColumn("true", F.lit(1)), ["s1", "pool", "cand"], "left")
    country = of_source(ents, "S1").select(F.col("entity_id").alias("s1"), "country")
    grid = F.explode(F.array(*map(F.lit, ks))).alias("k")
    got = (
        stacked.join(country, "s1")
        .select("country", "pool", "channel", "place", "true", grid)
        .where("place <= k")
        .groupBy("country", "pool", "channel", "k")
        .agg(F.count("true").alias("recovered"), F.count("*").alias("cands"))
    )
    base = truth.join(country, "s1").groupBy("country", "pool").agg(F.count("*").alias("total"), F.countDistinct("s1").alias("asked"))
    base = base.withColumn("channel", F.explode(F.array(*map(F.lit, names)))).select("*", grid)
    return base.join(got, ["country", "pool", "channel", "k"], "left").select(
        "country",
        F.col("pool").alias("source"),
        "channel",
        "k",
        F.coalesce("recovered", F.lit(0)).alias("recovered"),
        "total",
        (F.coalesce("recovered", F.lit(0)) / F.col("total") * 100).alias("recall_pct"),
        (F.coalesce("cands", F.lit(0)) / F.col("asked")).alias("avg_cand_size"),
    )
