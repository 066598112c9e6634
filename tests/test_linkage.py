import math

from pyspark.sql import functions as F

from tessera.operators import assign, block, features, profile
from tessera.sources import tables as S

SF = "/root/testdata/sf0.001"


def test_f_beta(spark):
    truth = spark.createDataFrame([("a", "x"), ("b", None), ("c", "y"), ("d", None)], "source1_entity_id string, matched_entity_id string")
    found = spark.createDataFrame([("a", "x", 1.0), ("a", "z", 1.0), ("d", "q", 1.0)], "source1_entity_id string, candidate_entity_id string, score double")
    got = {r["source1_entity_id"]: r["f"] for r in assign.f_beta_by_record(found, truth).collect()}
    assert math.isclose(got.pop("a"), 0.625 / 1.125, rel_tol=1e-9)
    assert got == {"b": 1.0, "c": 0.0, "d": 0.0}


def test_owner_is_the_best_then_the_smaller_id(spark):
    rows = [("s1", "c", 0.9), ("s2", "c", 0.8), ("s2", "d", 0.7), ("s2", "e", 0.5), ("s1", "e", 0.5)]
    owned = assign.owners(spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, score double"))
    assert sorted((r[0], r[1]) for r in owned.collect()) == [("s1", "c"), ("s1", "e"), ("s2", "d")]


def test_sweep_is_threshold_by_threshold(spark):
    truth = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "source1_entity_id string, matched_entity_id string")
    rows = [("a", "x", 0.71), ("a", "w", 0.4), ("b", "z", 0.55), ("b", "y", 0.3), ("c", "q", 0.21)]
    owned = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, score double")
    for t, f in assign.threshold_sweep(owned, truth, assign.GRID_COARSE).collect():
        assert math.isclose(f, assign.f_beta_macro(assign.matches(owned, t), truth).first()["f_beta"])


def test_recall_without_truth_is_one(spark):
    truth = spark.createDataFrame([("a", None)], "source1_entity_id string, matched_entity_id string")
    none = spark.createDataFrame([], "source1_entity_id string, candidate_entity_id string")
    assert assign.recall_ceiling(none, truth).first()["recall"] == 1.0


def test_tiny_pools_and_ranges(spark):
    ents = S.entities(spark, SF)
    rows = block.candidates(block.normalized(ents)).join(ents.select(F.col("entity_id").alias("candidate_entity_id"), "country"), "candidate_entity_id").persist()
    sizes = {(r["country"], r["s"]): r["count"] for r in ents.groupBy("country", F.substring("entity_id", 1, 2).alias("s")).count().collect()}
    found = rows.select("country", F.substring("candidate_entity_id", 1, 2).alias("s")).distinct().collect()
    assert found and all(0.05 * sizes[r["country"], r["s"]] >= 1 for r in found)
    assert rows.where("sim_name < 0 or sim_name > 1.000001 or sim_margin < -0.000001").isEmpty()


def test_features_are_in_range(spark):
    ents = S.entities(spark, SF)
    pairs = block.candidates(block.normalized(ents))
    rows = features.batch_features(pairs, ents).persist()
    assert rows.columns == [*features.IDS, *features.BATCH] and rows.count() == pairs.count()
    share = [c for c in features.BATCH if c.startswith(("n_", "a_", "digit"))]
    assert rows.where(" or ".join(f"{c} < 0 or {c} > 1" for c in share)).isEmpty()
    assert len(features.PAIR) == 21 and len(features.OLDER) == 20 and len(features.BATCH) == 25


def test_files_come_back(spark, tmp_path):
    lists = spark.createDataFrame([("S1-1", ["S2-1", "S3-1", "S2-1"]), ("S1-2", [])], "source1_entity_id string, matched_entity_ids array<string>")
    S.write_matching_results(lists, str(tmp_path / "m"))
    back = S.truth_pairs(S.read_ground_truth(spark, str(tmp_path / "m"))).collect()
    assert sorted((r[0], r[1] or "") for r in back) == [("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "")]
    (tmp_path / "s.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\tmore\nS1-1\t\"a\tb\"\tx\nS1-2\tn\ta\tUS\tz\n")
    rows = sorted(map(tuple, S.read_source(spark, str(tmp_path / "s.tsv")).collect()))
    assert rows == [("S1-1", "a\tb", "x", ""), ("S1-2", "n", "a", "US")]
    S.write_config(spark, str(tmp_path / "c"), {"threshold": 0.4})
    assert S.read_config(spark, str(tmp_path / "c"), {"threshold": 0.5, "top_k": 20}) == {"threshold": 0.4, "top_k": 20}


def test_matched_together_reach(spark):
    ents = spark.createDataFrame([(f"S2-{i}", f"n{i}", "", "US") for i in range(6)], "entity_id string, business_name string, business_address string, country string")
    truth = spark.createDataFrame([("S1-0", f"S2-{i}") for i in range(6)], "source1_entity_id string, matched_entity_id string")
    assert profile.matched_together(ents, truth).count() == 3 + 3 + 3 + 2 + 1
