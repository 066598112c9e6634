import math
import random
from collections import Counter
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import functions as F

from tessera.functions import similarity as M
from tessera.operators import block, features, nearest
from tessera.plans import linkage
from tessera.plans.registry import QUERIES
from tessera.sources import tables


def _records(spark, n=240):
    rng, words = random.Random(5), [f"w{i}" for i in range(60)]
    text = lambda k: " ".join(rng.choices(words, k=k))
    rows = [(f"S{1 + i % 3}-{i:04}", rng.choice(["US", "France", None]), text(rng.randint(0, 6)), text(rng.randint(0, 12))) for i in range(n)]
    rows += [(f"S{1 + i % 3}-c{i:03}", "US", "w1 w2 w3 rare", "w4 w5 w5 odd") for i in range(90)]
    return spark.createDataFrame(rows, "entity_id string, country string, name string, address string")


def _rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_picked_pairs_are_the_ranked_ones(spark):
    """Against the join of all pairs with a common token; copies, null countries and pools of one and of several shards."""
    norm = _records(spark).persist()
    for how in (block.Blocking(max_df=0.6), block.Blocking(channels=("combo",), max_df=0.3, top_k=3)):
        expected = _rows(block.ranked(block.similarities(norm, how), how))
        assert expected
        for chars in (None, 700):
            assert _rows(block.picked(norm, how, shard_chars=chars)) == expected


def test_no_row_for_every_pair(spark):
    """A join of records on tokens makes a row for each pair that shares one."""
    plan = block.picked(_records(spark))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "MapInArrow" in plan


def _brute(rows, grp, vocabulary):
    """(grp, s1, cand, sim) by definition: the 20 nearest of each S1 record and pool over tf-idf of 3- to 5-grams."""
    bag = lambda t: Counter(t[i : i + n] for n in (3, 4, 5) for i in range(len(t) - n + 1))
    out = []
    for g in {grp(r) for r in rows}:
        for pool in ("S2", "S3"):
            own, held = ([(r[0], bag(r[2])) for r in rows if grp(r) == g and r[0].startswith(tag)] for tag in ("S1", pool))
            idf = vocabulary(own, held)
            unit = lambda b, idf=idf: {t: k * idf[t] / math.sqrt(sum((x * idf[u]) ** 2 for u, x in b.items() if u in idf)) for t, k in b.items() if t in idf}
            held = [(i, unit(b)) for i, b in held]
            for i, b in own:
                x = unit(b)
                sims = sorted((-round(sum(w * y[t] for t, w in x.items() if t in y), 9), j) for j, y in held if x.keys() & y.keys())
                out += [(g, i, j, round(-v, 6)) for v, j in sims[:20]]
    return sorted(out)


def test_ngram_neighbours_are_brute_force(spark):
    norm = _records(spark).where("country is not null")
    rows = [tuple(r) for r in norm.collect()]

    def together(own, held):
        df = Counter(t for _, b in [*own, *held] for t in b)
        return {t: math.log((1 + len(own) + len(held)) / (1 + k)) + 1 for t, k in df.items()}

    def capped(own, held):
        df, total = Counter(t for _, b in held for t in b), Counter()
        for _, b in held:
            total.update(b)
        kept = sorted((-total[t], t) for t, k in df.items() if k >= 2)[:40]
        return {t: math.log((1 + len(held)) / (1 + df[t])) + 1 for _, t in kept}

    ents = norm.select("entity_id", "country", F.col("name").alias("business_name"))
    for chars in (None, 400):
        got = block.ngram_neighbours(norm, shard_chars=chars)
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert _rows(got.select("s1", "cand", "sim")) == [r[1:] for r in _brute(rows, lambda r: "", together)]
        got = block.capped_neighbours(ents, most_terms=40, shard_chars=chars)
        assert _rows(got.select("country", "s1", "cand", "sim")) == _brute(rows, lambda r: r[1], capped)


def test_names_travel_as_texts(spark):
    """Arrays of a name's words in the joins took several times the room."""
    norm = _records(spark).withColumns({"business_name": F.col("name"), "business_address": F.col("address")})
    pairs = spark.createDataFrame([("S1-0000", "S2-0001")], "source1_entity_id string, candidate_entity_id string")
    rows = features.set_features(pairs, norm, ready=True).select(*features.IDS, "n_jaccard", "n_len_ratio", "n_exact")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    joins = plan[plan.index("Join") :]
    assert "split" not in joins and "split" in plan
    by = {r[0]: r[2].split() for r in norm.collect()}
    a, b = set(by["S1-0000"]), set(by["S2-0001"])
    assert math.isclose(rows.first()["n_jaccard"], len(a & b) / len(a | b) if a | b else 0.0)


def test_texts_travel_without_words_that_have_no_weight(spark, monkeypatch):
    """Words in more than max_df of a pool are in most of a text; with them, texts took more disk than the whole input."""
    monkeypatch.setattr(nearest, "FIRST", 10)
    norm = _records(spark).select("entity_id", "country", "name", F.concat_ws(" ", "address", F.lit("the of the and"), F.when(F.col("entity_id") < "S3", "two")).alias("address")).persist()
    how = block.Blocking(max_df=0.6)
    expected = _rows(block.ranked(block.similarities(norm, how), how))
    for chars in (None, 700):
        assert _rows(block.picked(norm, how, shard_chars=chars)) == expected
    sizes = [(r["country"], r["source"], r["n"]) for r in norm.groupBy("country", F.substring("entity_id", 1, 2).alias("source")).agg(F.count("*").alias("n")).where("source <> 'S1' and country is not null").collect()]
    rows = norm.where("country is not null").select(F.col("country").alias("grp"), F.substring("entity_id", 1, 2).alias("source"), F.col("name").alias("text_name"), F.col("address").alias("text_address"))
    found = nearest._weightless(rows, nearest.Nearest(("name", "address"), max_df=0.6), sizes)
    for (grp, pool, channel), words in found.items():
        texts = [set(r[0].split()) for r in rows.where(f"grp = '{grp}' and source = '{pool}'").select(f"text_{channel}").collect()]
        assert all(sum(w in t for t in texts) > 0.6 * len(texts) for w in words)
    assert {"the", "of", "and"} <= found["US", "S2", "address"] and "two" not in found.get(("US", "S3", "address"), ())
    batch = pa.RecordBatch.from_pydict({"grp": ["US", "US"], "pool": ["S2", "S3"], "text_name": ["w1", "w1"], "text_address": ["the two w3 w1 of w1"] * 2})
    (out,) = nearest._pack(nearest.Nearest(("name", "address")), SimpleNamespace(value=found))([batch])
    left = [nearest._text(x) for x in out.column(3).to_pylist()]
    assert left == [" ".join(w for w in ("two", "w1", "w1", "w3") if w not in found["US", pool, "address"]) for pool in ("S2", "S3")] and "two" in left[1]


def test_packed_texts_come_back():
    for text in ("", "a", "-", "z", "é " * 400, "w" * 99, "w" * 100):
        assert nearest._text(nearest._packed(text)) == text


def test_names_are_measured_where_a_pair_is_found(spark):
    """Names do not go with pairs: no join, and the same values, with one shard of a pool and with several."""
    norm = _records(spark).persist()
    measures = [("v", "name", str, M.token_set), ("w", "name", M.sorted_words, M.ratio), ("a", "address", str, M.cosine)]
    how = block.Blocking(max_df=0.6)
    by = {r["entity_id"]: r for r in norm.collect()}
    for chars in (None, 700):
        got = block.picked(norm, how, shard_chars=chars, measures=measures)
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in got.select("s1", "cand", "v", "w", "a").collect())
        pairs = sorted(tuple(r) for r in block.ranked(block.similarities(norm, how), how).select("s1", "cand").collect())
        assert got == [(s, c, M.token_set(by[s]["name"], by[c]["name"]), M.token_sort(by[s]["name"], by[c]["name"]), M.cosine(by[s]["address"], by[c]["address"])) for s, c in pairs]


def test_ids_and_measures_do_without_a_candidate_table(spark):
    """Before, each of these queries wrote the whole table, and names went through the joins of all pairs."""
    sf, kept = "/root/testdata/sf0.001", dict(tables._CACHED)
    tables._CACHED.clear()
    names = ("feat_indel", "feat_token_sort", "feat_token_set", "feat_tfidf_pair", "label_pairs", "candidate_lists")
    try:
        alone = {q: sorted(map(tuple, QUERIES[q](spark, sf).collect())) for q in names}
        assert not [k for k in tables._CACHED if k[1] == "candidates"]
        linkage._candidates(spark, sf)
        assert {q: sorted(map(tuple, QUERIES[q](spark, sf).collect())) for q in names} == alone
    finally:
        tables._CACHED.update(kept)
