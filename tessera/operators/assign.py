"""Scores, thresholds, ownership, folds and the evaluation of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.features import IDS

#: A scorer without a model, for tests and first runs: weights of features that sum to 1.
LINEAR = {"sim_name": 0.35, "sim_address": 0.25, "n_jaccard": 0.2, "n_len_ratio": 0.1, "n_exact": 0.1}
#: Threshold grids, in thousandths: first, last, step.
GRID, GRID_COARSE, GRID_OLDER = (200, 950, 25), (300, 950, 50), (50, 950, 50)


def linear_score(weights: dict[str, float] = LINEAR) -> Column:
    total = F.lit(0.0)
    for name, w in weights.items():
        total = total + F.col(name) * F.lit(w)
    return total


def matches(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.where(F.col("score") >= threshold)


def owners(scored: DataFrame) -> DataFrame:
    """One owner for each candidate: its best-scored S1 record, the smaller id among equals.

    The owner does not depend on a threshold, so a threshold may follow.
    """
    best = Window.partitionBy("candidate_entity_id").orderBy(F.desc(F.round("score", 9)), "source1_entity_id")
    return scored.withColumn("_place", F.row_number().over(best)).where("_place = 1").drop("_place")


def result_lists(s1: DataFrame, matched: DataFrame) -> DataFrame:
    """One row per S1 record, with its matches best first and an empty list where it has none."""
    lists = matched.groupBy("source1_entity_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.round("score", 9)).alias("s"), F.col("candidate_entity_id").alias("c")))), lambda x: x["c"]).alias(
            "matched_entity_ids"
        )
    )
    ids = s1.select(F.col("entity_id").alias("source1_entity_id"))
    return ids.join(lists, "source1_entity_id", "left").select(
        "source1_entity_id", F.coalesce("matched_entity_ids", F.array().cast("array<string>")).alias("matched_entity_ids")
    )


def f_beta(tp: Column, predicted: Column, true: Column, beta: float = 0.5) -> Column:
    """F of one record: 1 if both lists are empty, 0 if one is."""
    p, r, b = tp / predicted, tp / true, beta * beta
    return (
        F.when((predicted == 0) & (true == 0), 1.0)
        .when((predicted == 0) | (true == 0) | (tp == 0), 0.0)
        .otherwise((1 + b) * p * r / (b * p + r))
    )


def _truth_sizes(truth: DataFrame) -> DataFrame:
    return truth.groupBy("source1_entity_id").agg(F.count("matched_entity_id").alias("n_true"))


def _marked(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    known = truth.where("matched_entity_id is not null").select(
        "source1_entity_id", F.col("matched_entity_id").alias("candidate_entity_id"), F.lit(1).alias("tp")
    )
    return pairs.join(known, IDS, "left").withColumn("tp", F.coalesce("tp", F.lit(0)))


def f_beta_by_record(matched: DataFrame, truth: DataFrame, beta: float = 0.5) -> DataFrame:
    sizes = _marked(matched, truth).groupBy("source1_entity_id").agg(F.sum("tp").alias("tp"), F.count("*").alias("n_pred"))
    rows = _truth_sizes(truth).join(sizes, "source1_entity_id", "left").na.fill(0, ["tp", "n_pred"])
    return rows.withColumn("f", f_beta(F.col("tp"), F.col("n_pred"), F.col("n_true"), beta))


def f_beta_macro(matched: DataFrame, truth: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row: f_beta, records, records the predictions lack."""
    rows = f_beta_by_record(matched, truth, beta)
    return rows.agg(F.avg("f").alias("f_beta"), F.count("*").alias("n_records"), F.count_if(F.col("n_pred") == 0).alias("n_without"))


def threshold_sweep(owned: DataFrame, truth: DataFrame, grid=GRID, beta: float = 0.5) -> DataFrame:
    """threshold, f_beta for each threshold of the grid.

    Counts change only where a threshold passes a score, so each pair is put once into the highest grid
    step it reaches, and a running sum gives all steps: no pair is copied per threshold.
    """
    first, last, step = grid
    steps = (last - first) // step
    owned = _marked(owned, truth)
    level = F.floor((F.round(F.col("score"), 9) * 1000 - first + 1e-6) / step).cast("int")
    reached = owned.withColumn("level", F.least(level, F.lit(steps))).where("level >= 0")
    per = reached.groupBy("source1_entity_id", "level").agg(F.sum("tp").alias("tp"), F.count("*").alias("n"))
    sizes = _truth_sizes(truth)
    grid_rows = sizes.select("source1_entity_id", "n_true", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("level"))
    down = Window.partitionBy("source1_entity_id").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    rows = grid_rows.join(per, ["source1_entity_id", "level"], "left").na.fill(0, ["tp", "n"])
    rows = rows.withColumn("tp", F.sum("tp").over(down)).withColumn("n", F.sum("n").over(down))
    return rows.groupBy("level").agg(F.avg(f_beta(F.col("tp"), F.col("n"), F.col("n_true"), beta)).alias("f_beta")).select(
        ((F.col("level") * step + first) / 1000.0).alias("threshold"), "f_beta"
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    return sweep.orderBy(F.desc(F.round("f_beta", 9)), "threshold").limit(1)


def recall_ceiling(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """recall, mean candidates, share of records without any, records, true pairs; recall is 1 without true pairs."""
    per = _marked(pairs.select(*IDS).distinct(), truth).groupBy("source1_entity_id").agg(F.count("*").alias("n"), F.sum("tp").alias("tp"))
    rows = _truth_sizes(truth).join(per, "source1_entity_id", "left").na.fill(0, ["n", "tp"])
    return rows.agg(
        F.coalesce(F.try_divide(F.sum("tp"), F.sum("n_true")), F.lit(1.0)).alias("recall"),
        F.avg("n").alias("mean_candidates"),
        F.avg((F.col("n") == 0).cast("double")).alias("empty_fraction"),
        F.count("*").alias("n_entities"),
        F.sum("n_true").alias("n_true"),
    )


def low_recall(ceiling: DataFrame, least: float = 0.95) -> DataFrame:
    """The recall ceiling with ``low``: whether blocking loses more than a matcher should be asked to bear."""
    return ceiling.withColumn("low", F.col("recall") < least)


def missed(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """True pairs that are not among the candidates."""
    known = truth.where("matched_entity_id is not null").withColumnRenamed("matched_entity_id", "candidate_entity_id")
    return known.join(pairs.select(*IDS), IDS, "left_anti")


def hash_places(rows: DataFrame, groups: list[str], key: Column, *ties: str) -> DataFrame:
    """rows with ``place`` (from 1) by (md5 of key, ties) inside each group, and ``of``, the size of the group.

    Places come in two levels, 4,096 hash ranges of a group and rows of a range, so no task gets a whole group.
    """
    rows = rows.withColumn("_h", F.md5(key)).withColumn("_b", F.substring("_h", 1, 3))
    group = [F.col(g) for g in groups] or [F.lit(1)]
    per = rows.groupBy(*groups, "_b").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({"_before": F.coalesce(F.sum("_n").over(upto), F.lit(0)), "of": F.sum("_n").over(Window.partitionBy(*group))})
    per = per.select(F.col("_b").alias("_pb"), *(F.col(g).alias(f"_p_{g}") for g in groups), "_before", "of")
    same = F.col("_b") == F.col("_pb")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_p_{g}"))
    inside = F.row_number().over(Window.partitionBy(*groups, "_b").orderBy("_h", *ties))
    rows = rows.withColumn("_in", inside).join(per, same)
    return rows.withColumn("place", F.col("_before") + F.col("_in")).drop("_h", "_b", "_pb", "_in", "_before", *(f"_p_{g}" for g in groups))


def fold(ids: DataFrame, share: float, seed: int = 42, id_col: str = "entity_id") -> DataFrame:
    """ids with validation true for the first max(1, n * share) by a seeded hash."""
    placed = hash_places(ids, [], F.concat(F.lit(f"{seed}|"), F.col(id_col)), id_col)
    first = F.col("place") <= F.greatest(F.lit(1), F.floor(F.col("of") * share))
    return placed.withColumn("validation", first).drop("place", "of")


def subsample_negatives(pairs: DataFrame, ratio: float, seed: int = 42) -> DataFrame:
    """All positive pairs and the first positives * ratio negative ones by a seeded hash."""
    wanted = pairs.agg(F.floor(F.count_if(F.col("label") == 1) * ratio).alias("_wanted"))
    placed = hash_places(pairs, ["label"], F.concat(F.lit(f"{seed}|"), F.col(IDS[0]), F.lit("|"), F.col(IDS[1])), *IDS)
    return placed.crossJoin(F.broadcast(wanted)).where("label = 1 or place <= _wanted").drop("place", "of", "_wanted")


def systematic_sample(rows: DataFrame, n: int, id_col: str = "entity_id", key: str = "source") -> DataFrame:
    """Every n-th row of each ``key`` in the order of ids, the n-th first.

    Positions come in two levels: ranges of ids (their first 12 characters), and rows of a range.
    """
    ranged = rows.withColumn("_r", F.substring(id_col, 1, 12))
    per = ranged.groupBy(key, "_r").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy(key, "_r").orderBy(id_col))
    placed = ranged.withColumn("_in", inside).join(per.select(key, "_r", before.alias("_before")), [key, "_r"])
    return placed.where((F.col("_in") + F.col("_before")) % n == 0).select(*rows.columns)


def without_owner(scored: DataFrame) -> DataFrame:
    """One row: pairs dropped because another S1 record owns the candidate."""
    kept = scored.select("candidate_entity_id").distinct()
    return scored.agg(F.count("*").alias("n")).crossJoin(kept.agg(F.count("*").alias("m"))).select((F.col("n") - F.col("m")).alias("dropped"))
