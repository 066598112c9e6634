import pytest
from pyspark.sql import functions as F

from tessera.functions import text as X

NAMES = [
    ("Pioneer Industries Private Limited", "India", "pioneer industries", "pioneer industries"),
    ("M/s. Foo Traders Pvt. Ltd.", "India", "foo traders", "m s foo traders"),
    ("energyvrtextile.com", "India", "energyvrtextile", "energyvrtextile com"),
    ("Ltd", "US", "ltd", ""),
    ("Foo Co Ltd Pvt Inc LLC", "US", "foo co", "foo"),
    ("AT&T Inc", "US", "at and t", "at and t"),
    ("Boulangerie St. Honoré SARL", "France", "boulangerie saint honore", "boulangerie st honore"),
    ("St. Jude Supplies", "US", "st jude supplies", "st jude supplies"),
    ("-- Mr. Smith & Sons LLC", "US", "smith and sons", "mr smith and sons"),
    ("Acme.co.in", "India", "acme", "acme in"),
    ("हिन्दी कंपनी लिमिटेड", "India", "ह नद क पन ल म ट ड", "ह नद क पन ल म ट ड"),
    ("Smith Associates Group", "US", "smith associates group", "smith associates group"),
    ("Co Op Market Inc.", "US", "co op market", "op market"),
    ("", "US", "", ""),
]
ADDRESSES = [
    ("Near SBI ATM, MG Rd, No. 5", "India", "sbi atm mg road number 5"),
    ("12 Rue St-Honoré", "France", "12 rue saint honore"),
    ("151 W 25th St, Ste 4", "US", "151 w 25th street suite 4"),
    ("opp. Bus Stand, nr Temple", "India", "bus stand temple"),
    ("Next to Park Ave", "US", "park avenue"),
    ("5 Av. de la République", "France", "5 av de la republique"),
]
POSTAL = [
    ("12345 Elm St, Springfield, IL 62704", "US", "62704"),
    ("12345 Elm St", "US", ""),
    ("75008 Paris", "France", "75008"),
    ("560001 Bangalore 560001", "India", ""),
]


def test_names(spark):
    df = spark.createDataFrame([n[:2] for n in NAMES], "name string, country string")
    rows = df.select(X.normalize_name(F.col("name"), F.col("country")), X.normalize_name_old(F.col("name"))).collect()
    assert [tuple(r) for r in rows] == [n[2:] for n in NAMES]


def test_addresses_and_postal_codes(spark):
    df = spark.createDataFrame([a[:2] for a in ADDRESSES], "a string, c string")
    assert [r[0] for r in df.select(X.normalize_address(F.col("a"), F.col("c"))).collect()] == [a[2] for a in ADDRESSES]
    df = spark.createDataFrame([p[:2] for p in POSTAL], "a string, c string")
    assert [r[0] for r in df.select(X.postal_code(F.col("a"), F.col("c"))).collect()] == [p[2] for p in POSTAL]
    old, profile = spark.createDataFrame([("12345 Elm St 62704", "US")], "a string, c string").select(
        X.postal_code_old(F.col("a")), X.postal_code_profile(F.col("a"), F.col("c"))
    ).first()
    assert (old, profile) == ("12345", "62704")


def test_sets(spark):
    row = spark.range(1).select(
        X.digit_runs(F.lit("Plot 42, Sec 18, 42")), X.char_ngrams(F.lit("ab")), X.char_ngrams(F.lit("")), X.char_ngrams(F.lit("abcd")),
        X.char_ngram_bag(F.lit("abcd")), X.char_ngram_bag(F.lit("ab")), X.words(F.lit("")),
    ).first()
    assert sorted(row[0]) == ["18", "42"]
    assert [sorted(x) for x in row[1:4]] == [["ab"], [], ["abc", "bcd"]]
    assert [sorted(x) for x in row[4:]] == [["abc", "abcd", "bcd"], [], []]


def test_exact_fold_takes_ligatures(spark):
    assert spark.range(1).select(X.fold_accents_exact(F.lit("ﬁn é½"))).first()[0] == "fin e1⁄2"


def test_unknown_channel():
    with pytest.raises(ValueError):
        X.channel_text("fax", None, None)
