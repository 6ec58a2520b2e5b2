import pytest

from txrisk.functions.time import add_time_features
from txrisk.operators.prep import encode_categories, impute, null_counts, split_profile, split_train_test
from txrisk.operators.profile import batch_manifest


def test_codes_declared_vs_plain(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "z")], "id int, c string")
    dec = {r["id"]: r["c"] for r in encode_categories(df, declared=["c"]).collect()}
    assert [dec[i] for i in (1, 2, 3, 4)] == [1, 3, 0, 2]
    pl = {r["id"]: r["c"] for r in encode_categories(df, plain=["c"]).collect()}
    assert [pl[i] for i in (1, 2, 3, 4)] == [1, 2, 0, 3]


def test_codes_existing_missing_literal_shared_by_nulls(spark):
    df = spark.createDataFrame([(1, "missing"), (2, None), (3, "a")], "id int, c string")
    dec = {r["id"]: r["c"] for r in encode_categories(df, declared=["c"]).collect()}
    assert dec[1] == dec[2] == 1 and dec[3] == 0


def test_numeric_looking_strings_sort_as_strings(spark):
    df = spark.createDataFrame([(1, "100.0"), (2, "52.0"), (3, "7")], "id int, c string")
    got = {r["id"]: r["c"] for r in encode_categories(df, declared=["c"]).collect()}
    assert [got[i] for i in (1, 2, 3)] == [0, 1, 2]


def test_impute_forced_fill_of_excluded(spark):
    df = spark.createDataFrame([(1, None, 5.0, "x"), (2, 1, float("nan"), None)],
                               "TransactionID long, isFraud int, v double, s string")
    rows = {r["TransactionID"]: r for r in impute(df).collect()}
    assert rows[1]["isFraud"] == 0
    assert rows[2]["v"] == 0.0 and rows[2]["s"] == "missing"
    nc = {r["column"]: r["nulls"] for r in null_counts(df).collect()}
    assert nc == {"TransactionID": 0, "isFraud": 1, "v": 1, "s": 1}


def test_time_features(spark):
    df = spark.createDataFrame([(1, 100, -1.5), (2, 86499, 2.25), (3, 86500, 3.0)],
                               "TransactionID long, TransactionDT long, TransactionAmt double")
    got = {r["TransactionID"]: r for r in add_time_features(df).collect()}
    assert [got[i]["TransactionDay"] for i in (1, 2, 3)] == [0, 0, 1]
    assert got[1]["Cents"] == pytest.approx(0.5)
    assert got[2]["TimeDay"] == 99


def test_batches_skip_empty(spark):
    df = spark.createDataFrame([(14, 0), (15, 1), (30, 0)], "TransactionDay int, isFraud int")
    rows = sorted(tuple(r) for r in batch_manifest(df, 7).collect())
    assert rows == [(0, 14, 20, 2, 0.5), (2, 28, 34, 1, 0.0)]


def test_split(spark):
    df = spark.createDataFrame([(d, d % 2) for d in range(0, 70)], "TransactionDay int, isFraud int")
    tr, te = split_train_test(df, 8)
    assert tr.count() == 56 and te.count() == 14
    prof = {r["side"]: r["rows"] for r in split_profile(df, 8).collect()}
    assert prof == {"train": 56, "test": 14}


def test_vocabulary_split_into_ranges_matches_sorted_rank(spark):
    from txrisk.operators.prep import category_lookup
    import random
    rnd = random.Random(4)
    words = sorted({"".join(rnd.choice("abcxyzé") for _ in range(rnd.randint(1, 6))) for _ in range(400)}
                   | {"abc"})
    rows = [(w,) for w in words for _ in range(rnd.randint(1, 3))] + [("abc",)] * 200   # a frequent value
    df = spark.createDataFrame(rows, "c string")
    lk = category_lookup(df, plain=["c"], n_buckets=8, single_bucket_max=20)
    got = {r["value"]: r["code"] for r in lk.collect() if r["value"] is not None}
    assert got == {w: i for i, w in enumerate(words)}
