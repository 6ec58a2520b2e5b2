"""The exact kNN join: copies of a vector per block, not per cell; the kernel's shortlist."""

import numpy as np

from txrisk.operators import knn as kn


def test_vectors_are_copied_per_block_not_per_cell(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(600, 16))          # no structure: nothing is pruned
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    seen = []
    merge = kn.merge_nearest
    monkeypatch.setattr(kn, "merge_nearest", lambda pairs, k: (seen.append(pairs.count()), merge(pairs, k))[1])
    got = {(r["id"], r["nn_rank"]): r["nn_id"] for r in kn.knn(df, 2, n_pivots=64, block_size=300).collect()}
    assert seen[0] <= 600 * 2 * 5                                # at most five blocks, 64 cells
    for i in range(0, 600, 37):
        d = np.linalg.norm(x - x[i], axis=1)
        d[i] = np.inf
        assert [got[i, 1], got[i, 2]] == np.argsort(d, kind="stable")[:2].tolist()


def test_kernel_equals_plain_distances():
    rng = np.random.default_rng(5)
    m = np.concatenate([rng.normal(size=(80, 6)), np.ones((20, 6)), np.full((1, 6), np.nan)]) + 1e6
    mid = np.concatenate([np.arange(100, 0, -1), [500]]).astype("int64")
    q, qid = np.concatenate([m[:30], m[80:101]]), np.concatenate([mid[:30], mid[80:101]])
    rid, rnn, rd = kn.nearest(q, qid, m, mid, 4)
    want = []
    for i, v in zip(qid, q):
        d = np.sqrt(((m - v) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((mid, d)) if mid[j] != i and np.isfinite(d[j])][:4]
        want += [(i, mid[j], round(d[j], 9)) for j in order]
    assert list(zip(rid, rnn, np.round(rd, 9))) == want


def test_units_gather_near_cells_and_cut_large_ones():
    pivots = np.array([[0.0], [10.0], [0.1], [10.1], [5.0]])
    units = kn._units([(0, 4, 1.0), (1, 4, 1.0), (2, 4, 1.0), (3, 4, 1.0), (4, 25, 1.0)], pivots, 8)
    assert units == [([0, 2], 0, 1), ([1, 3], 1, 1), ([4], 2, 4)]


def test_folded_shortlist_bounds_the_kth_and_misses_none():
    rng = np.random.default_rng(8)
    d2 = rng.normal(size=(50, 3000)) ** 2
    d2[:5, :2990] = np.inf
    d2[5:9] = 1.0                                              # ties everywhere
    for k in (1, 3, 5):
        near, kth = kn._kth_at_most(d2, k), np.sort(d2, axis=1)[:, k - 1]
        assert (near >= kth).all()
        assert np.median((d2 <= near[:, None]).sum(axis=1)[9:]) <= 3 * k
    m = np.concatenate([rng.normal(size=(2900, 4)), np.full((100, 4), 2.0)]) + 1e5
    mid, qid = rng.permutation(3000).astype("int64"), np.arange(3000, 3040, dtype="int64")
    q = np.concatenate([m[:30] + 0.01, m[-10:]])
    rid, rnn, rd = kn.nearest(q, qid, m, mid, 5)
    want = []
    for i, v in zip(qid, q):
        d = np.sqrt(((m - v) ** 2).sum(axis=1))
        want += [(i, mid[j], round(d[j], 9)) for j in np.lexsort((mid, d))[:5]]
    assert list(zip(rid, rnn, np.round(rd, 9))) == want
