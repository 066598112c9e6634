"""Whole runs from files to files on the smallest tables."""

import pytest

from tessera.operators import assign, features, model
from tessera.plans import drivers, linkage
from tessera.sources import tables as S

SF = "/root/testdata/sf0.001"
FEW = {"rounds": 3, "depth": 3, "least": 5, "rows": 1.0, "columns": "all"}


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('runs')}"
    ents = S.entities(spark, SF)
    for split in ("train", "test"):
        for tag in ("S1", "S2", "S3"):
            S.write_source(S.of_source(ents, tag), f"{root}/data/{split}_source{tag[1]}.tsv")
    truth = S.truth(ents).groupBy("source1_entity_id").agg({"matched_entity_id": "collect_list"}).toDF("source1_entity_id", "matched_entity_ids")
    S.write_matching_results(truth, f"{root}/data/train_ground_truth.tsv")
    return root


def test_sources_come_back_whole(spark, data):
    back = drivers.read_records(spark, f"{data}/data", "test")
    assert sorted(back.collect()) == sorted(S.entities(spark, SF).select(*back.columns).collect())


def test_block_train_infer_score(spark, data):
    ceiling = drivers.run_blocking(spark, f"{data}/data", f"{data}/train", cache_dir=f"{data}/cache").first()
    again = drivers.run_blocking(spark, f"{data}/data", f"{data}/again", cache_dir=f"{data}/cache").first()
    assert ceiling == again and 0 < ceiling["recall"] <= 1 and ceiling["low"] == (ceiling["recall"] < 0.95)
    config, gains = drivers.train_matcher(spark, f"{data}/train/candidates", f"{data}/data", f"{data}/model", f"{data}/threshold.json", settings=FEW)
    assert 0.5 < config["val_auc"] <= 1 and gains.count() == 8
    assert S.read_config(spark, f"{data}/threshold.json", {})["threshold"] == config["threshold"]
    drivers.run_infer(spark, f"{data}/train/candidates", f"{data}/data", f"{data}/model", f"{data}/threshold.json", f"{data}/out")
    found = S.read_ground_truth(spark, f"{data}/out/matching_results.tsv")
    assert found.count() == S.of_source(S.entities(spark, SF), "S1").count()
    assert drivers.score_local(spark, f"{data}/out/matching_results.tsv", f"{data}/data/train_ground_truth.tsv").first()["f_beta"] > 0.5
    pairs = S.read_candidates(spark, f"{data}/train/candidates")
    with pytest.raises(KeyError):
        features.require_known(pairs, S.entities(spark, SF).where("entity_id not like 'S1-L%'"))


@pytest.mark.parametrize("version", [1, 2])
def test_earlier_generations(spark, data, version):
    where = f"{data}/v{version}"
    drivers.train(spark, f"{data}/data", f"{where}/model", f"{where}/threshold.json", version, settings=FEW)
    drivers.infer(spark, f"{data}/data", f"{where}/model", f"{where}/threshold.json", f"{where}/out")
    assert drivers.score_local(spark, f"{where}/out/matching_results.tsv", f"{data}/data/train_ground_truth.tsv").first()["f_beta"] > 0.3


def test_all_profiles(spark, data):
    for name in drivers.run_all(spark, f"{data}/data", f"{data}/tables"):
        assert spark.read.option("header", True).csv(f"{data}/tables/table_{name}.csv").count() > 0


def test_trees_are_deterministic_and_rank_well(spark):
    rows = linkage._training(spark, SF).persist()
    one, two = (model.score(model.train(rows, linkage.FREE, rounds=3, validation="validation"), rows) for _ in range(2))
    key = [*features.IDS, "score"]
    assert sorted(one.select(*key).collect()) == sorted(two.select(*key).collect())
    assert model.auc(one) > 0.8


def test_places_by_hash(spark):
    rows = spark.range(5000).selectExpr("cast(id as string) as entity_id", "case when id % 3 = 0 then null else id % 3 end as g")
    placed = assign.hash_places(rows, ["g"], rows["entity_id"], "entity_id").collect()
    for g in (None, 1, 2):
        own = [r for r in placed if r["g"] == g]
        assert sorted(r["place"] for r in own) == list(range(1, len(own) + 1)) and {r["of"] for r in own} == {len(own)}
