"""Features of long texts: right, and without the texts in the rows of pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import similarity as M
from tessera.functions import text as X
from tessera.operators import features, together


@pytest.mark.parametrize("block_chars", [60, None])
def test_measures_equal_those_of_joined_pairs(spark, block_chars):
    r = random.Random(3)
    text = lambda: " ".join(r.choice("abcdefgh") for _ in range(r.randrange(6)))
    records = [(f"S{1 + i % 3}-{i}", text()) for i in range(60)]
    pairs = [(f"S1-{3 * r.randrange(20)}", f"S2-{3 * r.randrange(20) + 1}", i) for i in range(300)] + [("S1-x", "S2-1", -1), ("S1-0", "S2-x", -2), ("S1-0", None, -3)]
    rows = spark.createDataFrame(records, "entity_id string, address string")
    asked = spark.createDataFrame(pairs, "source1_entity_id string, candidate_entity_id string, place int")
    got = together.measured(asked, rows, {"address": F.col("address")}, [("v", "address", together.words, together.share(0.5))], block_chars)
    word = lambda c: F.array_distinct(X.words(F.col(c)))
    expected = features.looked_up(asked, rows).select(*asked.columns, M.jaccard(word("l_address"), word("r_address"), 0.5).alias("v"))
    assert got.columns == expected.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect())) and got.count() == 300


def test_addresses_do_not_travel_with_pairs(spark):
    ents = spark.createDataFrame([("S1-1", "a b", "1 x", "US"), ("S2-1", "b", "x 1 2", "US")], "entity_id string, business_name string, business_address string, country string")
    pairs = spark.createDataFrame([("S1-1", "S2-1")], "source1_entity_id string, candidate_entity_id string")
    rows = features.set_features(pairs, ents)
    got = rows.first()
    assert (got["a_jaccard"], got["digit_jaccard"], got["digit_any"], got["a_both_present"], got["n_jaccard"]) == (2 / 3, 0.5, 1.0, 1.0, 0.5)
    assert not [c for c in rows.columns if c.endswith(("address", "_at", "_dr"))]


def test_pair_features_without_addresses_in_pairs(spark):
    """Before, each pair carried both addresses through two joins, and masks of an address were made for each of its pairs."""
    ents = spark.createDataFrame(
        [("S1-1", "Foo Traders", "1 Foo Traders x", "US"), ("S1-2", "", "b c", "US"), ("S1-3", None, None, "US"), ("S2-1", "foo traders", "Foo traders 1 y", "US"), ("S3-1", "Bar", "", "France")],
        "entity_id string, business_name string, business_address string, country string",
    )
    pairs = spark.createDataFrame([(a, b) for a in ("S1-1", "S1-2", "S1-3") for b in ("S2-1", "S3-1")], "source1_entity_id string, candidate_entity_id string")
    for make, use in ((features.pair_records, features.pair_features), (features.older_records, features.older_features)):
        by = {r["entity_id"]: r for r in make(ents).collect()}
        rows = use(pairs, ents)
        assert not {"l_address", "r_address"} & set(features._both(pairs, make(ents)).columns)
        got = {tuple(r[c] for c in features.IDS): r for r in rows.collect()}
        assert len(got) == 6
        for (s, c), r in got.items():
            (n, a), (m, b) = ((by[i]["name"] or "", by[i]["address"] or "") for i in (s, c))
            assert r["name_substring_in_address"] == float(n != "" and n in b)
            assert r["addr_levenshtein_ratio"] == M.ratio(a, b) and r["addr_token_sort_ratio"] == M.token_sort(a, b) and r["addr_token_set_ratio"] == M.token_set(a, b)
            assert r["name_levenshtein_ratio"] == M.ratio(n, m) and r["addr_token_jaccard"] == together.share(1.0)(together.words(a), together.words(b))
        assert any(r["name_substring_in_address"] for r in got.values())


def test_long_texts_by_their_masks():
    r = random.Random(4)
    for size in (0, 1, 63, 64, 65, 199, 200, 201, 700):
        a, b = ("".join(r.choice("ab é日😀") for _ in range(max(0, size + r.randrange(-3, 4)))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        expected = 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0
        assert M.ratio(a, b) == expected == M.ratio_to(M.Measured(a), M.Measured(b))


def test_copies_of_an_s1_text_are_measured_once():
    import pyarrow as pa

    asked = []
    run = together._run([("v", 0, str, lambda a, b: asked.append((a, b)) or float(len(a) + 10 * len(b)))])
    rows = [(together.HELD, f"S1-{i}", None, -1, t) for i, t in enumerate(["x", "x", "xy"])]
    rows += [(together.ROW, "S2-1", None, -1, "z"), (together.ROW, "S2-1", None, -1, "zz")] + [(together.PAIR, "S2-1", f"S1-{i}", i, "") for i in range(3)]
    rows += [(together.ROW, "S2-2", None, -1, "z"), (together.PAIR, "S2-2", "S1-1", 3, "")]
    kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string())
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names=list("abcde")) for some in (rows[:5], rows[5:6], rows[6:])]
    got = [tuple(r.values()) for b in run(batches) for r in b.to_pylist()]
    assert got == [(0, 11.0), (0, 21.0), (1, 11.0), (1, 21.0), (2, 12.0), (2, 22.0), (3, 11.0)]
    assert asked == [("x", "z"), ("x", "zz"), ("xy", "z"), ("xy", "zz"), ("x", "z")]


def test_a_text_goes_to_a_cell_once(spark, monkeypatch):
    """Before, an address went there alone and again behind its name, and counting its characters normalised it."""
    ents = spark.createDataFrame([("S1-1", "Foo", "1 Street", "US"), ("S2-1", "Foo", "1 Street", "US")], "entity_id string, business_name string, business_address string, country string")
    pairs = spark.createDataFrame([("S1-1", "S2-1")], "source1_entity_id string, candidate_entity_id string")
    sent, measured = [], together.measured
    monkeypatch.setattr(together, "measured", lambda pairs, records, texts, *more: sent.append((records.columns, list(texts))) or measured(pairs, records, texts, *more))
    for use in (features.pair_features, features.older_features):
        assert use(pairs, ents).first()["addr_levenshtein_ratio"] == 1.0
    assert [t for _, t in sent] == [["both"]] * 2 and all({"business_name", "business_address"} <= set(c) for c, _ in sent)


def test_words_of_a_text_are_cut_once_for_its_pairs():
    r = random.Random(6)
    for _ in range(200):
        a, b = (" ".join(r.choice(["ab", "b", "c d", "abc", "é"]) for _ in range(r.randrange(6))) for _ in range(2))
        for name, _, make, of in features._EDITS:
            assert of(make(a), make(b)) == {"a_ratio": M.ratio, "a_token_sort": M.token_sort, "a_token_set": M.token_set}[name](a, b)
    assert all(not isinstance(make("a b"), str) for _, _, make, _ in features._EDITS)


def test_words_of_a_text_are_counted_once_for_its_pairs():
    r = random.Random(7)
    ((_, _, make, of),) = features._OLDER_ADDRESS
    for _ in range(200):
        a, b = (" ".join(r.choice(["ab", "B", "c d", "abc", "é"]) for _ in range(r.randrange(6))) for _ in range(2))
        assert of(make(f"2 xy{a}"), make(f"0 {b}")) == M.cosine(a, b)
    assert not isinstance(make("0 a b"), str)
