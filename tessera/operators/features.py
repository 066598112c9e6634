"""Feature sets of candidate pairs.  Records are normalised once, before the joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import similarity as M
from tessera.functions import text as X
from tessera.operators import together
from tessera.operators.block import normalized

BLOCKING = "sim_name sim_address rank_name rank_address sim_best cand_count sim_max_for_s1 sim_margin".split()
BATCH = [*BLOCKING, *(
    "n_ratio n_token_sort n_token_set n_partial n_despace a_ratio a_token_sort a_token_set n_jaccard a_jaccard digit_jaccard "
    "digit_any n_exact a_both_present n_len_ratio nonlatin_name is_source3"
).split()]
PAIR = (
    "channel_name_cosine channel_address_cosine channel_combo_cosine name_exact_match name_levenshtein_ratio name_token_sort_ratio "
    "name_token_set_ratio name_partial_ratio name_token_jaccard name_char3gram_jaccard name_len_ratio addr_levenshtein_ratio "
    "addr_token_sort_ratio addr_token_set_ratio addr_token_jaccard addr_both_present postal_both_present postal_match "
    "name_substring_in_address country_match is_source3"
).split()
OLDER = (
    "name_exact_match name_levenshtein_ratio name_token_sort_ratio name_token_set_ratio name_partial_ratio name_token_jaccard "
    "name_char3gram_jaccard name_tfidf_cosine name_len_ratio addr_levenshtein_ratio addr_token_sort_ratio addr_token_set_ratio "
    "addr_token_jaccard addr_tfidf_cosine postal_both_present postal_match name_substring_in_address country_match "
    "country_either_missing is_source3"
).split()
IDS = ["source1_entity_id", "candidate_entity_id"]
_AS_CAME = ["business_name", "business_address"]


def looked_up(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """pairs with each column of records twice, as l_ and r_; pairs with an unknown id are left out."""
    left = records.select(F.col("entity_id").alias(IDS[0]), *(F.col(c).alias(f"l_{c}") for c in records.columns if c != "entity_id"))
    right = records.select(F.col("entity_id").alias(IDS[1]), *(F.col(c).alias(f"r_{c}") for c in records.columns if c != "entity_id"))
    return pairs.join(left, IDS[0]).join(right, IDS[1])


def unknown_ids(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Ids of pairs that records lack."""
    ids = pairs.select(F.explode(F.array(*IDS)).alias("entity_id")).distinct()
    return ids.join(records.select("entity_id"), "entity_id", "left_anti")


def require_known(pairs: DataFrame, records: DataFrame) -> None:
    """Raises KeyError if records lack an id of pairs."""
    some = [r["entity_id"] for r in unknown_ids(pairs, records).limit(5).collect()]
    if some:
        raise KeyError(f"pairs name records that are not there, such as {some}")


def name_features(pairs: DataFrame, ents: DataFrame, ready: bool = False) -> DataFrame:
    """The features of the batch set that need no UDF and no address; ``ready`` records are normalised already."""
    both = looked_up(pairs, (ents if ready else normalized(ents)).select("entity_id", "name", "business_name"))
    c = F.col
    # Words of names are cut after the joins: an array of them takes several times the room of the name, once for each pair.
    both = both.withColumns({f"{side}_nt": F.array_distinct(X.words(c(f"{side}_name"))) for side in "lr"})
    return both.withColumns(
        {
            "n_jaccard": M.jaccard(c("l_nt"), c("r_nt"), 0.0),
            "n_exact": M.exact(c("l_name"), c("r_name")),
            "n_len_ratio": M.length_ratio(c("l_name"), c("r_name")),
            "nonlatin_name": M.flag(X.has_non_latin(c("r_business_name"))),
            "is_source3": M.flag(c(IDS[1]).startswith("S3")),
        }
    )


def set_features(pairs: DataFrame, ents: DataFrame, ready: bool = False, more: list[together.Measure] = ()) -> DataFrame:
    """The features of the batch set but edit measures, and ``more`` of addresses; addresses do not travel with pairs."""
    rows = ents if ready else normalized(ents)
    pairs = pairs.select(*IDS, *(c for c in pairs.columns if c not in IDS))
    texts = {"address": F.col("address"), "digits": F.array_join(X.digit_runs(F.col("business_address")), " ")}
    of_address = together.measured(
        pairs, rows.select("entity_id", "address", "business_address"), texts,
        [("a_jaccard", "address", together.words, together.share(0.0)), ("digit_jaccard", "digits", together.words, together.share(0.0)),
         ("digit_any", "digits", together.words, together.meet), ("a_both_present", "address", bool, lambda a, b: float(a and b)), *more],
    )
    return name_features(of_address, rows, ready=True)


_EDITS: list[together.Measure] = [
    ("a_ratio", "address", M.Measured, M.ratio_to), ("a_token_sort", "address", M.sorted_measured, M.ratio_to), ("a_token_set", "address", M.word_set, M.token_set_of),
]


def batch_features(candidates: DataFrame, ents: DataFrame) -> DataFrame:
    """The 25 features of the current generation, in their fixed order, after the ids."""
    both = set_features(candidates, ents, more=_EDITS)
    n = (F.col("l_name"), F.col("r_name"))
    edit = M.edit_similarity(
        [("n_ratio", "ratio", *n), ("n_token_sort", "token_sort", *n), ("n_token_set", "token_set", *n), ("n_partial", "partial", *n),
         ("n_despace", "ratio", X.despace(n[0]), X.despace(n[1]))]
    )
    return both.withColumn("e", edit).select("*", "e.*").select(*IDS, *BATCH)


def _common(both: DataFrame) -> dict:
    c = F.col
    words = lambda side, f: F.array_distinct(X.words(c(f"{side}_{f}")))
    return {
        "name_exact_match": M.exact(c("l_name"), c("r_name")),
        "name_token_jaccard": M.jaccard(words("l", "name"), words("r", "name"), 1.0),
        "name_char3gram_jaccard": M.jaccard(X.char_ngrams(c("l_name")), X.char_ngrams(c("r_name")), 1.0),
        "name_len_ratio": M.length_ratio(c("l_name"), c("r_name")),
        "postal_both_present": M.flag((c("l_postal") != "") & (c("r_postal") != "")),
        "postal_match": M.flag((c("l_postal") != "") & (c("l_postal") == c("r_postal"))),
        "country_match": M.flag((c("l_country") != "") & (F.lower(F.trim("l_country")) == F.lower(F.trim("r_country")))),
        "country_either_missing": M.flag((c("l_country") == "") | (c("r_country") == "")),
        "is_source3": M.flag(c(IDS[1]).startswith("S3")),
    }


def _named(text: str) -> tuple[str, str]:
    """Name and address of a text made as length of the name, space, name, address."""
    size, _, rest = text.partition(" ")
    return rest[: int(size)], rest[int(size) :]


def _of_address(make):
    return lambda text: make(_named(text)[1])


_ADDRESS: list[together.Measure] = [
    ("addr_token_jaccard", "both", _of_address(together.words), together.share(1.0)), ("addr_both_present", "both", _of_address(bool), lambda a, b: float(a and b)),
    ("name_substring_in_address", "both", _named, lambda a, b: float(a[0] != "" and a[0] in b[1])),
    ("addr_levenshtein_ratio", "both", _of_address(M.Measured), M.ratio_to), ("addr_token_sort_ratio", "both", _of_address(M.sorted_measured), M.ratio_to),
    ("addr_token_set_ratio", "both", _of_address(M.word_set), M.token_set_of),
]


_OLDER_ADDRESS: list[together.Measure] = [("addr_tfidf_cosine", "both", _of_address(M.counted), M.cosine_of)]


def _both(pairs: DataFrame, records: DataFrame, more: list[together.Measure] = ()) -> DataFrame:
    """pairs with all measures that need no candidate table; addresses meet in cells, once with their names, and do not travel with pairs."""
    records = records.withColumns({c: F.coalesce(c, F.lit("")) for c in ("name", "address")})
    texts = {"both": F.concat(F.length("name").cast("string"), F.lit(" "), "name", "address")}
    pairs = pairs.select(*IDS, *(c for c in pairs.columns if c not in IDS))
    of_address = together.measured(pairs, records.select("entity_id", "name", "address", *_AS_CAME), texts, [*_ADDRESS, *more])
    both = looked_up(of_address, records.drop("address", *_AS_CAME))
    return both.withColumns(_common(both))


def _edit(cosines: bool = False):
    n = (F.col("l_name"), F.col("r_name"))
    measures = [
        ("name_levenshtein_ratio", "ratio", *n), ("name_token_sort_ratio", "token_sort", *n), ("name_token_set_ratio", "token_set", *n),
        ("name_partial_ratio", "partial", *n),
    ]
    return M.edit_similarity(measures + [("name_tfidf_cosine", "cosine", *n)] * cosines)


def pair_records(ents: DataFrame) -> DataFrame:
    postal = X.postal_code(F.col("business_address"), F.col("country"))
    return normalized(ents).withColumn("postal", postal)


def older_records(ents: DataFrame) -> DataFrame:
    return ents.select(
        "entity_id", "country", *_AS_CAME, X.normalize_name_old(F.col("business_name")).alias("name"),
        X.normalize_address_old(F.col("business_address")).alias("address"), X.postal_code_old(F.col("business_address")).alias("postal"),
    )


def pair_features(candidates: DataFrame, ents: DataFrame) -> DataFrame:
    """The 21 features of the per-pair set; channel cosines come from the candidate table, 0 where it has none."""
    both = _both(candidates, pair_records(ents))
    cosines = {
        f"channel_{c}_cosine": F.coalesce(F.col(f"sim_{c}"), F.lit(0.0)) if f"sim_{c}" in candidates.columns else F.lit(0.0)
        for c in ("name", "address", "combo")
    }
    return both.withColumns(cosines).withColumn("e", _edit()).select("*", "e.*").select(*IDS, *PAIR)


def older_features(candidates: DataFrame, ents: DataFrame) -> DataFrame:
    """The 20 features of the older generation."""
    both = _both(candidates.select(*IDS), older_records(ents), _OLDER_ADDRESS)
    return both.withColumn("e", _edit(cosines=True)).select("*", "e.*").select(*IDS, *OLDER)


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label 1 for true ones."""
    known = truth.where("matched_entity_id is not null").select(
        "source1_entity_id", F.col("matched_entity_id").alias("candidate_entity_id"), F.lit(1).alias("label")
    )
    return pairs.join(known.distinct(), IDS, "left").withColumn("label", F.coalesce("label", F.lit(0)))
