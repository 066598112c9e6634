"""Whole runs from files to files: blocking, training, inference, scoring, profiles.

Every function takes paths that the executors can reach.  A data folder holds ``{split}_source1.tsv`` to ``3`` and,
for training, ``{split}_ground_truth.tsv``.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import assign, block, features, model, profile
from tessera.sources import tables as S

DEFAULTS = {"threshold": 0.5, "scorer": "model"}


def read_records(spark: SparkSession, data_dir: str, split: str) -> DataFrame:
    """S1, S2 and S3 of a split as one table."""
    rows = [S.read_source(spark, f"{data_dir}/{split}_source{i}.tsv") for i in (1, 2, 3)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _first_by_hash(rows: DataFrame, n: int, seed: int) -> DataFrame:
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col("entity_id"))), "entity_id").limit(n)


def run_blocking(
    spark: SparkSession, data_dir: str, out_dir: str, split: str = "train", how: block.Blocking = block.DEFAULT,
    sample_s1: int = 0, seed: int = 42, cache_dir: str | None = None,
) -> DataFrame | None:
    """Writes ``candidates`` (Parquet), ``candidate_pairs.tsv`` and the settings; returns the recall row of a training split.

    ``sample_s1`` takes that many S1 records by seeded hash, never of the pools.  The index of the pools is read from
    ``cache_dir`` if it is there, and written to it if not.  Recall under 0.95 is warned of.
    """
    ents = read_records(spark, data_dir, split)
    if sample_s1:
        ents = _first_by_hash(S.of_source(ents, "S1"), sample_s1, seed).unionByName(S.of_source(ents, "S2", "S3"))
    norm = block.normalized(ents)
    index = None
    if cache_dir:
        named = f"{cache_dir}/{split}-" + "-".join(map(str, (*how.channels, how.max_df, how.min_df)))
        if not S._exists(spark, f"{named}/postings/_SUCCESS"):
            block.save_pool(block.fit_pool(norm, how), named)
        index = block.load_pool(spark, named)
    S.write_candidates(block.candidates(norm, how, index), f"{out_dir}/candidates")
    found = S.read_candidates(spark, f"{out_dir}/candidates")
    ids = S.of_source(ents, "S1").select(F.col("entity_id").alias("source1_entity_id"))
    lists = found.groupBy("source1_entity_id").agg(F.array_sort(F.collect_list("candidate_entity_id")).alias("candidate_entity_ids"))
    rows = ids.join(lists, "source1_entity_id", "left").withColumn("candidate_entity_ids", F.coalesce("candidate_entity_ids", F.array().cast("array<string>")))
    S.write_candidate_pairs(rows, f"{out_dir}/candidate_pairs.tsv")
    S.write_config(spark, f"{out_dir}/blocking.json", asdict(how) | {"split": split, "sample_s1": sample_s1, "seed": seed})
    if split != "train":
        return None
    truth = S.truth_pairs(S.read_ground_truth(spark, f"{data_dir}/{split}_ground_truth.tsv")).join(ids, "source1_entity_id", "left_semi")
    ceiling = assign.low_recall(assign.recall_ceiling(found, truth))
    row = ceiling.first()
    if row["low"]:
        warnings.warn(f"blocking finds {row['recall']:.3f} of the true pairs", stacklevel=2)
    return ceiling


def _learn(spark, pairs: DataFrame, truth: DataFrame, names: list[str], settings: dict, share: float, seed: int, ratio: float, grid, stop_early: bool, owned: bool):
    """Trees on the training fold, and the best threshold of the grid on the other: model, config, gains."""
    ids = truth.select(F.col("source1_entity_id").alias("entity_id")).distinct()
    folds = assign.fold(ids, share, seed).withColumnRenamed("entity_id", "source1_entity_id")
    rows = features.labelled(pairs, truth).join(folds, "source1_entity_id").persist()
    try:
        train, held = rows.where("not validation"), rows.where("validation")
        if ratio:
            train = assign.subsample_negatives(train, ratio, seed)
        used = train.unionByName(held) if stop_early else train
        fitted = model.train(used, names, validation="validation" if stop_early else None, **settings)
        scored = model.score(fitted, held)
        auc = model.auc(scored)
        scored = scored.select(*features.IDS, "score")
        own = truth.join(folds.where("validation"), "source1_entity_id", "left_semi")
        best = assign.best_threshold(assign.threshold_sweep(assign.owners(scored) if owned else scored, own, grid)).first()
    finally:
        rows.unpersist()
    config = {"threshold": best["threshold"], "val_f0.5": best["f_beta"], "val_auc": auc, "best_iteration": fitted.stages[-1].getNumTrees, "features": names}
    return fitted, config, model.importance(spark, fitted, names)


def train_matcher(
    spark: SparkSession, candidates: str, data_dir: str, model_out: str, threshold_out: str, share: float = 0.25, seed: int = 42,
    negatives: float = 0.0, settings: dict | None = None,
) -> tuple[dict, DataFrame]:
    """Learns from a candidate table; saves the model and its threshold; returns the config and the eight best features."""
    ents = read_records(spark, data_dir, "train")
    found = S.read_candidates(spark, candidates)
    features.require_known(found, ents)
    ids = found.select(features.IDS[0]).distinct()
    truth = S.truth_pairs(S.read_ground_truth(spark, f"{data_dir}/train_ground_truth.tsv")).join(ids, "source1_entity_id", "left_semi")
    pairs = features.batch_features(found, ents)
    fitted, config, gains = _learn(spark, pairs, truth, features.BATCH, settings or model.CURRENT, share, seed, negatives, assign.GRID, True, True)
    model.save(fitted, model_out)
    S.write_config(spark, threshold_out, config | {"scorer": "model"})
    return config, gains


def _write_matches(ents: DataFrame, matched: DataFrame, path: str) -> None:
    S.write_matching_results(assign.result_lists(S.of_source(ents, "S1"), matched), path)


def run_infer(
    spark: SparkSession, candidates: str, data_dir: str, model_dir: str | None, threshold_config: str, out_dir: str,
    threshold: float | None = None, split: str = "test",
) -> None:
    """Scores a candidate table and writes ``matching_results.tsv``, one row for every S1 record.

    Pairs that name unknown records raise KeyError.  Without a model the scorer is the linear one.
    """
    config = S.read_config(spark, threshold_config, DEFAULTS)
    ents = read_records(spark, data_dir, split)
    found = S.read_candidates(spark, candidates)
    features.require_known(found, ents)
    if model_dir is None:
        scored = features.name_features(found, ents).select(*features.IDS, assign.linear_score().alias("score"))
    else:
        scored = model.score(model.load(model_dir), features.batch_features(found, ents)).select(*features.IDS, "score")
    scored = scored.withColumn("score", F.round("score", 9))
    limit = config["threshold"] if threshold is None else threshold
    _write_matches(ents, assign.matches(assign.owners(scored), limit), f"{out_dir}/matching_results.tsv")


def _generation(version: int, ents: DataFrame, top_k: int) -> DataFrame:
    """Pairs with features of generation 1 (older blocking and features) or 2 (per-pair features)."""
    if version == 1:
        norm = features.older_records(ents)
        pairs = block.older_candidates(norm, top_k).select(F.col("s1").alias(features.IDS[0]), F.col("cand").alias(features.IDS[1]))
        return features.older_features(pairs, ents)
    how = block.Blocking(top_k=top_k)
    return features.pair_features(block.candidates(block.normalized(ents), how), ents)


def train(spark: SparkSession, data_dir: str, model_out: str, threshold_out: str, version: int = 2, top_k: int = 20, settings: dict | None = None) -> dict:
    """One-step training of an earlier generation: no early stop; generation 1 has no ownership and a coarser grid."""
    ents = read_records(spark, data_dir, "train")
    truth = S.truth_pairs(S.read_ground_truth(spark, f"{data_dir}/train_ground_truth.tsv"))
    names, grid = (features.OLDER, assign.GRID_OLDER) if version == 1 else (features.PAIR, assign.GRID_COARSE)
    fitted, config, _ = _learn(spark, _generation(version, ents, top_k), truth, names, settings or model.OLDER, 0.2, 42, 0.0, grid, False, version != 1)
    config |= {"scorer": "model", "version": version, "top_k": top_k}
    model.save(fitted, model_out)
    S.write_config(spark, threshold_out, config)
    return config


def infer(spark: SparkSession, data_dir: str, model_dir: str, threshold_config: str, out_dir: str, split: str = "test") -> None:
    """One-step inference of the generation that the config names."""
    config = S.read_config(spark, threshold_config, DEFAULTS | {"version": 2, "top_k": 20})
    ents = read_records(spark, data_dir, split)
    pairs = _generation(config["version"], ents, config["top_k"])
    scored = model.score(model.load(model_dir), pairs).select(*features.IDS, "score")
    scored = scored if config["version"] == 1 else assign.owners(scored)
    _write_matches(ents, assign.matches(scored, config["threshold"]), f"{out_dir}/matching_results.tsv")


def score_local(spark: SparkSession, predictions: str, ground_truth: str, beta: float = 0.5) -> DataFrame:
    """One row: macro F of a result file against a truth file."""
    found = S.truth_pairs(S.read_ground_truth(spark, predictions)).where("matched_entity_id is not null")
    pairs = found.withColumnRenamed("matched_entity_id", "candidate_entity_id")
    return assign.f_beta_macro(pairs, S.truth_pairs(S.read_ground_truth(spark, ground_truth)), beta)


#: The profiles of a full run, in order.
PROFILES: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "records_by_source": lambda ents, truth: profile.records_by_source(ents),
    "overlap": profile.overlap,
    "match_distribution": profile.match_distribution,
    "orphans": profile.orphans,
    "country_consistency": profile.country_consistency,
    "noise": lambda ents, truth: profile.noise_summary(profile.true_pairs(ents, truth)),
    "postal": lambda ents, truth: profile.postal_profile(ents),
    "suffixes": lambda ents, truth: profile.suffix_inventory(ents),
    "separability": lambda ents, truth: profile.separability(profile.pair_similarities(ents, truth)),
    "shift": lambda ents, truth: profile.shift_ratios(ents),
}


def run_all(spark: SparkSession, data_dir: str, out_dir: str, split: str = "train") -> list[str]:
    """Writes every profile as ``table_<name>.csv`` and as a Markdown table; the first that fails ends the run."""
    ents = read_records(spark, data_dir, split)
    truth = S.truth_pairs(S.read_ground_truth(spark, f"{data_dir}/{split}_ground_truth.tsv"))
    for name, make in PROFILES.items():
        rows = make(ents, truth)
        S.write_table(rows, f"{out_dir}/table_{name}.csv")
        S.markdown(rows).write.mode("overwrite").text(f"{out_dir}/table_{name}.md")
    return list(PROFILES)
