"""Profiling queries over the source tables and the ground truth: each is a few aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import similarity as M
from tessera.functions import text as X
from tessera.operators.assign import hash_places
from tessera.sources.tables import of_source

FIELDS = ("entity_id", "business_name", "business_address", "country")


def with_source(ents: DataFrame) -> DataFrame:
    return ents.withColumn("source", X.source_tag(F.col("entity_id")))


def _fields(*parts: tuple[str, Column]) -> Column:
    """One row per field, with the given values of that field."""
    return F.inline(F.array(*(F.struct(F.lit(name).alias("field"), *values) for name, values in parts)))


def row_counts(ents: DataFrame) -> DataFrame:
    """Rows, rows by country and repeated ids of each table."""
    per = with_source(ents).groupBy("source", "country").agg(F.count("*").alias("n"))
    ids = with_source(ents).groupBy("source", "entity_id").agg(F.count("*").alias("k")).groupBy("source").agg((F.sum("k") - F.count("*")).alias("repeated"))
    return per.join(ids, "source").select("source", "country", "n", F.sum("n").over(Window.partitionBy("source")).alias("n_rows"), "repeated")


def countries(ents: DataFrame) -> DataFrame:
    """Countries, and whether S1 and the noisy tables have them."""
    rows = with_source(ents).groupBy("country").agg(F.max((F.col("source") == "S1").cast("int")).alias("in_s1"), F.max((F.col("source") != "S1").cast("int")).alias("in_noisy"))
    return rows.select("country", "in_s1", "in_noisy")


def anomalies(ents: DataFrame) -> DataFrame:
    """source, field, kind, n, rate of empty, blank and broken cells; only kinds that occur."""
    cell = lambda c: (F.col(c).alias("v"),)
    rows = with_source(ents).select("source", _fields(*((c, cell(c)) for c in FIELDS)))
    counted = rows.groupBy("source", "field").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("v") == "").alias("empty"),
        F.count_if((F.trim("v") == "") & (F.col("v") != "")).alias("blank"),
        F.count_if(F.contains("v", F.lit("�"))).alias("broken"),
    )
    long = counted.unpivot(["source", "field", "rows"], ["empty", "blank", "broken"], "kind", "n").where("n > 0")
    return long.select("source", "field", "kind", "n", (F.col("n") / F.col("rows")).alias("rate"))


def lengths(ents: DataFrame) -> DataFrame:
    """Nearest-rank percentiles of characters and words of names and addresses, over all rows."""
    n_words = lambda c: F.size(X.words(X.squeeze(F.col(c))))
    parts = [(f"{c}_{unit}", (v.alias("v"),)) for c in ("business_name", "business_address") for unit, v in (("chars", F.length(c)), ("words", n_words(c)))]
    rows = with_source(ents).select("source", "country", _fields(*parts))
    p = lambda q: F.expr(f"percentile_disc({q}) within group (order by v)")
    return rows.groupBy("source", "country", "field").agg(
        F.min("v").alias("least"), p(0.5).cast("int").alias("p50"), F.avg("v").alias("mean"), p(0.9).cast("int").alias("p90"),
        p(0.99).cast("int").alias("p99"), F.max("v").alias("most"),
    )


def scripts(ents: DataFrame) -> DataFrame:
    """Shares of non-ASCII, accented and non-Latin characters in names, by table and country."""
    n = F.col("business_name")
    rows = with_source(ents).groupBy("source", "country").agg(
        F.sum(F.length(n)).alias("chars"), F.sum(X.non_ascii(n)).alias("non_ascii"), F.sum(X.accented(n)).alias("accented"), F.sum(X.non_latin(n)).alias("non_latin")
    )
    share = lambda c: F.coalesce(F.try_divide(c, F.col("chars")), F.lit(0.0)).alias(f"{c}_share")
    return rows.select("source", "country", "chars", *(share(c) for c in ("non_ascii", "accented", "non_latin")))


def _per_record(ents: DataFrame, truth: DataFrame) -> DataFrame:
    tag = X.source_tag(F.col("matched_entity_id"))
    per = truth.groupBy("source1_entity_id").agg(
        F.count("matched_entity_id").alias("k"), F.count_if(tag == "S2").alias("k2"), F.count_if(tag == "S3").alias("k3")
    )
    return per.join(ents.select(F.col("entity_id").alias("source1_entity_id"), "country"), "source1_entity_id")


def singletons(ents: DataFrame, truth: DataFrame) -> DataFrame:
    """Records without a match, overall and by country."""
    rows = _per_record(ents, truth).rollup("country").agg(F.count("*").alias("n"), F.count_if(F.col("k") == 0).alias("singletons"))
    return rows.select(F.coalesce("country", F.lit("OVERALL")).alias("country"), "n", "singletons", (F.col("singletons") / F.col("n") * 100).alias("pct"))


def overlap(ents: DataFrame, truth: DataFrame) -> DataFrame:
    kind = F.when((F.col("k2") > 0) & (F.col("k3") > 0), "both").when(F.col("k2") > 0, "s2_only").when(F.col("k3") > 0, "s3_only").otherwise("singleton")
    rows = _per_record(ents, truth).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(1))
    matched = F.sum(F.when(F.col("kind") != "singleton", F.col("n"))).over(every)
    of_matched = F.when(F.col("kind") != "singleton", F.col("n") / matched * 100)
    return rows.select("kind", "n", (F.col("n") / F.sum("n").over(every) * 100).alias("pct_all"), F.coalesce(of_matched, F.lit(0.0)).alias("pct_matched"))


def match_distribution(ents: DataFrame, truth: DataFrame) -> DataFrame:
    """Records by number of matches: all, in S2, in S3."""
    long = _per_record(ents, truth).unpivot(["source1_entity_id"], ["k", "k2", "k3"], "which", "matches")
    rows = long.groupBy("matches").agg(*(F.count_if(F.col("which") == w).alias(name) for w, name in (("k", "n_all"), ("k2", "n_s2"), ("k3", "n_s3"))))
    return rows.where("matches <= 10 or n_all + n_s2 + n_s3 > 0")


def several_owners(truth: DataFrame) -> DataFrame:
    """One row: matched records and those with more than one owner."""
    per = truth.where("matched_entity_id is not null").groupBy("matched_entity_id").agg(F.countDistinct("source1_entity_id").alias("owners"))
    return per.agg(F.count("*").alias("matched"), F.count_if(F.col("owners") > 1).alias("several"))


def orphans(ents: DataFrame, truth: DataFrame) -> DataFrame:
    """Noisy records without an owner, by table and country."""
    owned = truth.where("matched_entity_id is not null").select(F.col("matched_entity_id").alias("entity_id"), F.lit(1).alias("owned")).distinct()
    rows = with_source(of_source(ents, "S2", "S3")).join(owned, "entity_id", "left")
    return rows.groupBy("source", "country").agg(F.count("*").alias("n"), F.count_if(F.col("owned").isNull()).alias("orphans")).withColumn("pct", F.col("orphans") / F.col("n") * 100)


def true_pairs(ents: DataFrame, truth: DataFrame) -> DataFrame:
    """Both records of each true pair: l_ and r_ columns."""
    side = lambda p, key: ents.select(F.col("entity_id").alias(key), *(F.col(c).alias(f"{p}_{c}") for c in FIELDS[1:]))
    pairs = truth.where("matched_entity_id is not null")
    return pairs.join(side("l", "source1_entity_id"), "source1_entity_id").join(side("r", "matched_entity_id"), "matched_entity_id")


def country_consistency(ents: DataFrame, truth: DataFrame) -> DataFrame:
    same = F.col("l_country") == F.col("r_country")
    return true_pairs(ents, truth).agg(F.count("*").alias("pairs"), F.count_if(~same).alias("mismatches"), (F.avg(same.cast("double")) * 100).alias("pct"))


def country_mismatches(ents: DataFrame, truth: DataFrame) -> DataFrame:
    """The true pairs whose records name different countries."""
    return true_pairs(ents, truth).where("l_country <> r_country").select("source1_entity_id", "matched_entity_id", "l_country", "r_country")


def records_by_source(ents: DataFrame) -> DataFrame:
    """Records of each country, a column per table."""
    return with_source(ents).groupBy("country").pivot("source", ["S1", "S2", "S3"]).agg(F.count("entity_id")).na.fill(0)


def matched_together(ents: DataFrame, truth: DataFrame, reach: int = 3) -> DataFrame:
    """Pairs of one record's matches from one table, at most ``reach`` places apart in order of id, with both names.

    Each match meets the next ones by ``lead``, so a long list gives at most ``reach`` pairs for each of its members.
    """
    rows = truth.where("matched_entity_id is not null").select("source1_entity_id", F.col("matched_entity_id").alias("entity_id"))
    rows = with_source(rows).join(ents.select("entity_id", "business_name"), "entity_id")
    order = Window.partitionBy("source1_entity_id", "source").orderBy("entity_id")
    after = F.array(*(F.struct(F.lead("entity_id", i).over(order).alias("id"), F.lead("business_name", i).over(order).alias("name")) for i in range(1, reach + 1)))
    each = rows.select("source", "entity_id", "business_name", after.alias("after")).select("source", "entity_id", "business_name", F.explode("after").alias("o"))
    return each.where("o.id is not null").select("source", "entity_id", F.col("o.id").alias("other_id"), "business_name", F.col("o.name").alias("other_name"))


def matched_together_similarity(ents: DataFrame, truth: DataFrame, limit: float = 0.8) -> DataFrame:
    pairs = matched_together(ents, truth)
    e = M.edit_similarity([("ratio", "ratio", F.lower("business_name"), F.lower("other_name"))])
    return pairs.withColumn("e", e).groupBy("source").agg(F.count("*").alias("pairs"), (F.avg((F.col("e.ratio") >= limit).cast("double")) * 100).alias("pct"))


NOISE = (
    "name_exact name_match_strip_suffix name_transposition name_typo name_subset name_diff_dba addr_missing_in_matched addr_has_postal_both "
    "addr_postal_same addr_postal_diff addr_postal_missing_either addr_landmark_text addr_reordered addr_abbr_difference"
).split()
#: Those of them that need no edit similarity.
NOISE_PLAIN = [n for n in NOISE if n not in ("name_transposition", "name_typo", "name_diff_dba", "addr_reordered", "addr_abbr_difference")]


def noise_flags(pairs: DataFrame) -> DataFrame:
    """true_pairs with fourteen kinds of difference as booleans, and source, country."""
    c = F.col
    low = lambda x: F.trim(F.lower(c(x)))
    a, b = low("l_business_name"), low("r_business_name")
    x, y = F.lower("l_business_address"), F.lower("r_business_address")
    both = (c("l_business_address") != "") & (c("r_business_address") != "")
    e = M.edit_similarity(
        [("sorted", "token_sort", a, b), ("raw", "ratio", a, b), ("as_set", "token_set", a, b), ("addr_sorted", "token_sort", x, y), ("addr_raw", "ratio", x, y)]
    )
    pct = lambda f: c(f"e.{f}") * 100
    addr = lambda f: F.when(both, pct(f)).otherwise(0.0)
    exact = a == b
    wa, wb = F.array_distinct(X.word_runs(a)), F.array_distinct(X.word_runs(b))
    na, nb = F.size(F.array_except(wa, wb)), F.size(F.array_except(wb, wa))
    pa, pb = (X.postal_code_profile(c(f"{s}_business_address"), c("l_country")) for s in "lr")
    transposed = (pct("sorted") >= 98) & (pct("raw") < 95)
    made = {
        "name_exact": exact,
        "name_match_strip_suffix": (X.strip_suffix_profile(c("l_business_name")) == X.strip_suffix_profile(c("r_business_name"))) & ~exact,
        "name_transposition": transposed,
        "name_typo": (pct("raw") >= 80) & (pct("raw") < 100) & ~transposed,
        "name_diff_dba": (pct("raw") < 50) & (pct("as_set") < 60),
        "name_subset": ((na == 0) | (nb == 0)) & (na + nb > 0),
        "addr_missing_in_matched": F.trim("r_business_address") == "",
        "addr_has_postal_both": (pa != "") & (pb != ""),
        "addr_postal_same": (pa != "") & (pa == pb),
        "addr_postal_diff": (pa != "") & (pb != "") & (pa != pb),
        "addr_postal_missing_either": (pa == "") | (pb == ""),
        "addr_landmark_text": y.rlike(X.whole("|".join(X.LANDMARKS_PROFILE))),
        "addr_reordered": (addr("addr_sorted") >= 80) & (addr("addr_raw") < 60),
        "addr_abbr_difference": (X.expand_streets(c("l_business_address")) == X.expand_streets(c("r_business_address"))) & (addr("addr_raw") < 95),
    }
    rows = pairs.withColumn("e", e).withColumns(made)
    return rows.withColumn("source", X.source_tag(c("matched_entity_id"))).withColumn("country", c("l_country"))


def noise_summary(pairs: DataFrame, flags: list[str] = NOISE) -> DataFrame:
    """Percentage of each kind of difference by country and table."""
    return noise_flags(pairs).groupBy("country", "source").agg(F.count("*").alias("pairs"), *((F.avg(F.col(f).cast("double")) * 100).alias(f) for f in flags))


def postal_profile(ents: DataFrame) -> DataFrame:
    """By country: S1 records, share with a postal code, share whose address starts with five (India: or six) digits."""
    a = F.trim("business_address")
    starts = F.when(F.col("country") == "India", a.rlike(rf"^\p{{Nd}}{{5,6}}(?!{X.WORD})")).otherwise(a.rlike(rf"^\p{{Nd}}{{5}}(?!{X.WORD})"))
    has = X.postal_code_profile(F.col("business_address"), F.col("country")) != ""
    pct = lambda x: F.avg(x.cast("double")) * 100
    return of_source(ents, "S1").groupBy("country").agg(F.count("*").alias("n"), pct(has).alias("postal_pct"), pct(starts).alias("starts_with_digits_pct"))


def suffix_inventory(ents: DataFrame) -> DataFrame:
    """By country and legal suffix: S1 names that end with it, and names that hold it before their end."""
    found = X.word_runs(F.lower("business_name"))
    names = of_source(ents, "S1").select("country", found.alias("t"))
    total = names.groupBy("country").agg(F.count("*").alias("names"))
    last = F.try_element_at("t", F.lit(-1))
    # Each name yields the suffixes that it holds, so nothing is multiplied by the whole list.
    held = F.array_intersect(F.array_distinct("t"), F.array(*map(F.lit, X.SUFFIX_INVENTORY)))
    rows = names.select("country", last.alias("last"), F.explode(held).alias("suffix"))
    per = rows.groupBy("country", "suffix").agg(
        F.count_if(F.col("last") == F.col("suffix")).alias("n_trailing"), F.count_if(F.col("last") != F.col("suffix")).alias("n_middle")
    )
    return per.join(total, "country").select(
        "country", "suffix", "n_trailing", (F.col("n_trailing") / F.col("names") * 100).alias("trailing_pct"), "n_middle",
        (F.col("n_middle") / F.col("names") * 100).alias("middle_pct"), F.coalesce(F.try_divide(F.col("n_middle"), F.col("n_trailing")), F.lit(0.0)).alias("middle_to_trailing"),
    )


def top_suffixes(ents: DataFrame, most: int = 5) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("country").orderBy(F.desc("n_trailing"), "suffix"))
    return suffix_inventory(ents).withColumn("place", place).where(F.col("place") <= most).select("country", "suffix", "n_trailing", "place")


def random_negatives(ents: DataFrame, truth: DataFrame, times: int = 5, seed: int = 42) -> DataFrame:
    """country, s1, cand: ``times`` as many random pairs of one country as it has true pairs, true ones left out.

    Slot i of a country takes the S1 record and the noisy record that a seeded hash of i picks; both sides are numbered
    by hash order, so this is two joins on a number.
    """
    def numbered(side: DataFrame, name: str) -> DataFrame:
        placed = hash_places(side.select("country", "entity_id"), ["country"], F.concat(F.lit(f"{seed}|"), F.col("entity_id")), "entity_id")
        return placed.select("country", F.col("entity_id").alias(name), (F.col("place") - 1).cast("long").alias(f"{name}_no"))

    s1, pool = numbered(of_source(ents, "S1"), "s1"), numbered(of_source(ents, "S2", "S3"), "cand")
    sizes = s1.groupBy("country").agg(F.count("*").alias("n1")).join(pool.groupBy("country").agg(F.count("*").alias("n2")), "country")
    wanted = true_pairs(ents, truth).groupBy(F.col("l_country").alias("country")).agg((F.count("*") * times).alias("k")).join(sizes, "country")
    pick = lambda salt, n: F.expr(f"cast(conv(substr(md5(concat('{salt}{seed}|', slot)), 1, 8), 16, 10) as long) % {n}")
    slots = wanted.select("country", "n1", "n2", F.explode(F.sequence(F.lit(1).cast("long"), "k")).alias("slot"))
    slots = slots.select("country", "slot", pick("a", "n1").alias("s1_no"), pick("b", "n2").alias("cand_no"))
    rows = slots.join(s1, ["country", "s1_no"]).join(pool, ["country", "cand_no"]).select("country", "s1", "cand").distinct()
    known = truth.select(F.col("source1_entity_id").alias("s1"), F.col("matched_entity_id").alias("cand"))
    return rows.join(known, ["s1", "cand"], "left_anti")


def pair_similarities(ents: DataFrame, truth: DataFrame) -> DataFrame:
    """country, true and the similarities of true and random pairs."""
    found = true_pairs(ents, truth).select("source1_entity_id", "matched_entity_id", F.lit(True).alias("true"))
    other = random_negatives(ents, truth).select(F.col("s1").alias("source1_entity_id"), F.col("cand").alias("matched_entity_id"), F.lit(False).alias("true"))
    keys = found.unionByName(other)
    side = lambda p, key: ents.select(F.col("entity_id").alias(key), *(F.lower(c).alias(f"{p}_{c[9:]}") for c in FIELDS[1:3]), F.col("country").alias(f"{p}_country"))
    rows = keys.join(side("l", "source1_entity_id"), "source1_entity_id").join(side("r", "matched_entity_id"), "matched_entity_id")
    name, address = (F.col("l_name"), F.col("r_name")), (F.col("l_address"), F.col("r_address"))
    e = M.edit_similarity([("name_ratio", "ratio", *name), ("name_sort", "token_sort", *name), ("name_set", "token_set", *name), ("addr_sort", "token_sort", *address)])
    return rows.withColumn("e", e).select("source1_entity_id", "matched_entity_id", F.col("l_country").alias("country"), "true", "e.*")


def separability(sims: DataFrame, limit: float = 0.6) -> DataFrame:
    """Means and shares under or over the limit for true and random pairs, overall and by country."""
    c = F.col
    of = lambda true, x: F.avg(F.when(c("true") == true, x))
    under = lambda f: (c(f) < limit).cast("double") * 100
    over = lambda f: (c(f) >= limit).cast("double") * 100
    return sims.rollup("country").agg(
        F.count_if(c("true")).alias("n_true"), F.count_if(~c("true")).alias("n_random"),
        *(of(t, c(f)).alias(f"mean_{name}_{f}") for f in ("name_ratio", "name_set", "addr_sort") for t, name in ((True, "true"), (False, "random"))),
        *(of(True, under(f)).alias(f"true_{f}_under_pct") for f in ("name_ratio", "name_sort", "name_set", "addr_sort")),
        of(True, ((c("name_set") < limit) & (c("addr_sort") < limit)).cast("double") * 100).alias("true_both_under_pct"),
        *(of(False, over(f)).alias(f"random_{f}_over_pct") for f in ("name_set", "addr_sort")),
    ).withColumn("country", F.coalesce("country", F.lit("ALL")))


def histogram(sims: DataFrame, field: str, bins: int = 50) -> DataFrame:
    """Density of a similarity in 0..1, in equal bins."""
    bin_ = F.least(F.floor(F.col(field) * bins), F.lit(bins - 1)).cast("int")
    rows = sims.groupBy("true", bin_.alias("bin")).agg(F.count("*").alias("n"))
    return rows.select("true", "bin", "n", (F.col("n") * bins / F.sum("n").over(Window.partitionBy("true"))).alias("density"))


def shift_ratios(ents: DataFrame) -> DataFrame:
    """Noisy records per S1 record, by country and in total."""
    rows = with_source(ents).rollup("country").agg(*(F.count_if(F.col("source") == s).alias(s.lower()) for s in ("S1", "S2", "S3"))).where("s1 > 0")
    return rows.select(
        F.coalesce("country", F.lit("total")).alias("country"), "s1", "s2", "s3", (F.col("s2") / F.col("s1")).alias("s2_per_s1"),
        (F.col("s3") / F.col("s1")).alias("s3_per_s1"), ((F.col("s2") + F.col("s3")) / F.col("s1")).alias("noisy_per_s1"),
    )


def street_terms(ents: DataFrame, country: str = "France", most: int = 12) -> DataFrame:
    """The street words found in most addresses of a country."""
    rows = ents.where(F.col("country") == country)
    held = F.array_intersect(F.array_distinct(X.word_runs(F.lower("business_address"))), F.array(*map(F.lit, X.STREETS_FRENCH)))
    per = rows.select(F.explode(held).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("records"))
    return per.crossJoin(F.broadcast(total)).select("term", "n", (F.col("n") / F.col("records") * 100).alias("pct")).orderBy(F.desc("n"), "term").limit(most)


def postal_position(ents: DataFrame, country: str = "France") -> DataFrame:
    """Where the last postal code of an address stands."""
    a = F.trim(F.lower("business_address"))
    head = F.regexp_extract(a, rf"(?s)^(.*){X._BEFORE}{X.POSTAL_FRANCE}{X._AFTER}", 1)
    has = a.rlike(X.whole(X.POSTAL_FRANCE))
    start = F.length(head)
    kind = F.when(~has, "none").when(start < 10, "near_start").when(start + 5 > F.length(a) - 15, "near_end").otherwise("middle")
    rows = ents.where(F.col("country") == country).groupBy(kind.alias("position")).agg(F.count("*").alias("n"))
    return rows.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))) * 100)


def legal_suffixes(ents: DataFrame, country: str = "France") -> DataFrame:
    last = F.try_element_at(X.word_runs(F.lower("business_name")), F.lit(-1))
    return ents.where(F.col("country") == country).groupBy(last.alias("suffix")).agg(F.count("*").alias("n")).where(F.col("suffix").isin(*X.SUFFIXES_FRENCH))


def rate_scenarios(known: DataFrame, truth: DataFrame, target: DataFrame) -> DataFrame:
    """Expected singleton and orphan rates of target tables: (A) matches per S1 record as known, (B) orphan rates as known."""
    per = truth.groupBy("source1_entity_id").agg(F.count("matched_entity_id").alias("k"))
    base = per.agg(F.count("*").alias("n1"), F.count_if(F.col("k") == 0).alias("alone"))
    sizes = lambda e, p: e.agg(*(F.count_if(X.source_tag(F.col("entity_id")) == s).alias(f"{p}{s[1]}") for s in ("S1", "S2", "S3")))
    hits = truth.agg(*(F.count_if(X.source_tag(F.col("matched_entity_id")) == s).alias(f"m{s[1]}") for s in ("S2", "S3")))
    one = base.crossJoin(sizes(known, "k")).crossJoin(sizes(target, "t")).crossJoin(hits)
    c = F.col
    grown = lambda i: (F.lit(1.0) - c(f"m{i}") / c("n1") * c("t1") / c(f"t{i}")) * 100
    same = lambda i: (F.lit(1.0) - c(f"m{i}") / c(f"k{i}")) * 100
    alone = c("alone") / c("n1") * 100
    # With more matches per record the chance of none falls as under a Poisson law with the larger mean.
    denser = F.when(c("alone") > 0, F.pow(c("alone") / c("n1"), (c("m2") / c("k2") * c("t2") + c("m3") / c("k3") * c("t3")) / c("t1") / ((c("m2") + c("m3")) / c("n1"))) * 100).otherwise(0.0)
    row = lambda name, s, a, b: F.struct(F.lit(name).alias("scenario"), s.alias("singletons_pct"), a.alias("s2_orphans_pct"), b.alias("s3_orphans_pct"))
    return one.select(F.inline(F.array(row("A", alone, grown(2), grown(3)), row("B", denser, same(2), same(3)))))


def first_rows(ents: DataFrame, country: str, sizes: dict[str, int]) -> DataFrame:
    """The first records of a country in each table, in order of id."""
    place = F.row_number().over(Window.partitionBy("source").orderBy("entity_id"))
    rows = with_source(ents.where(F.col("country") == country)).withColumn("place", place)
    wanted = F.create_map(*(F.lit(x) for kv in sizes.items() for x in kv))
    return rows.where(F.col("place") <= F.try_element_at(wanted, F.col("source"))).drop("place")


def tiny_sample(ents: DataFrame, s1: int = 200, noisy: int = 3000, seed: int = 42) -> DataFrame:
    """A small copy of the tables: first S1 records by id, noisy records by seeded hash."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col("entity_id")))
    first = of_source(ents, "S1").orderBy("entity_id").limit(s1)
    for tag in ("S2", "S3"):
        first = first.unionByName(of_source(ents, tag).orderBy(h, "entity_id").limit(noisy))
    return first
