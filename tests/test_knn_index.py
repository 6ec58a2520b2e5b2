import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.operators import knn_index
from txrisk.operators.sampling import smote


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(30, 24))
    x = centre[rng.integers(0, 30, 2500)] + 0.4 * rng.normal(size=(2500, 24))
    x = np.concatenate([x, np.repeat(x[:1], 700, axis=0)])       # one vector holds a fifth of all rows
    return spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "id long, vec array<double>, g int").repartition(5)


def test_recall_and_exact_distances(vectors):
    found = knn_index.lsh_knn(vectors, 5, bucket_rows=100, block_size=200)
    exact = knn_index.nearest_of_queries(vectors, 5, block_size=300)
    rows = {r["id"]: np.array(r["vec"]) for r in vectors.collect()}
    for r in exact.where("id = 100").collect():
        d = sorted((float(np.linalg.norm(rows[100] - v)), i) for i, v in rows.items() if i != 100)
        assert (pytest.approx(r["distance"]), r["nn_id"]) == d[r["nn_rank"] - 1]
    got = knn_index.recall(found, exact).first()
    assert got["queries"] == 32 and got["neighbours"] == 160 and got["recall"] >= 0.9
    some = found.where("id % 400 = 3").collect()
    assert some and all(r["distance"] == pytest.approx(np.linalg.norm(rows[r["id"]] - rows[r["nn_id"]])) for r in some)
    assert found.select("id").distinct().count() == 3200       # every row is indexed


def test_groups_do_not_mix_and_few_rows(spark, vectors):
    got = knn_index.lsh_knn(vectors.where("id < 40"), 3, group_col="g").collect()
    assert got and all(r["id"] % 2 == r["nn_id"] % 2 and r["id"] != r["nn_id"] for r in got)
    assert knn_index.lsh_knn(vectors.where("id < 0"), 3).count() == 0


def test_copies_per_vector_are_bounded():
    rng = np.random.default_rng(1)
    for n in (100, 10_000, 10 ** 9):
        bits = knn_index.signature_bits(n)
        assert n / 2 ** bits <= knn_index.BUCKET_ROWS or bits == knn_index.MAX_BITS
        planes = rng.standard_normal((knn_index.TABLES, bits, 8))
        sig = knn_index.signatures(rng.standard_normal((50, 8)), planes, knn_index.PROBES)
        assert sig.shape == (50, knn_index.TABLES, 1 + min(knn_index.PROBES, bits))
        assert (sig[:, :, 1:] != sig[:, :, :1]).all() and sig.max() < 2 ** bits


def test_smote_over_the_index(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 1 if i < 30 else 0, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, y int, vec array<double>")
    syn = smote(df, "y", "id", "vec", neighbours=knn_index.lsh_knn).where(F.col("base_id").isNotNull())
    assert syn.count() == 30


def test_vectors_are_copied_per_stretch_not_per_bucket(vectors, monkeypatch):
    copies = []
    kernel = knn_index.nearest_in_buckets

    def counted(k):
        inner = kernel(k)
        total = vectors.sparkSession.sparkContext.accumulator(0)
        copies.append(total)

        def topk(qpdf, mpdf):
            total.add(len(qpdf))
            return inner(qpdf, mpdf)
        return topk

    monkeypatch.setattr(knn_index, "nearest_in_buckets", counted)
    knn_index.lsh_knn(vectors.where("id < 600"), 3, tables=2, bucket_rows=20).count()
    assert copies[0].value == 2 * 600       # five bits: one stretch a table, six buckets asked
