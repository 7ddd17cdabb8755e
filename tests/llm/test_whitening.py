from collections import Counter

import numpy as np
import pytest

from postlens.llm import whitening

from .helpers import SF

SCHEMA = "vec_id long, embedding array<float>, label int, x int, idx int, _part int"


def check(found, vectors):
    """``found`` against a plain version over ``(vec_id, usable vector)``; ids may repeat."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array([[float(a - s / n) for a, s in zip(row, sums, strict=True)] for row in x])
    cov = centred.T @ centred / n
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1], vec[:, ::-1]
    used = int(sum(e[:32] > 1e-12 * e[0]))
    assert Counter((r.vec_id, r.component) for r in found) == Counter((i, c + 1) for i, _ in vectors for c in range(used))
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-8
    ids = [i for i, _ in vectors]
    if len(set(ids)) == len(ids):
        off = {i: int(((n * row - sums) ** 2).sum()) for i, row in zip(ids, x, strict=True)}
        assert all(r.deviation == off[r.vec_id] for r in found)
        want = centred @ vec[:, :used] / np.sqrt(e[:used])
        got = np.zeros_like(want)
        at = {i: k for k, i in enumerate(ids)}
        for r in found:
            got[at[r.vec_id], r.component - 1] = r.whitened
        assert np.abs(got.T @ got / n - np.eye(used)).max() < 1e-8
        # Same components but for the sign, where eigenvalues are apart.
        for c in range(used):
            gap = min([abs(e[c] - e[k]) for k in range(len(e)) if k != c], default=1)
            if gap > 1e-6 * e[0]:
                assert min(np.abs(got[:, c] - want[:, c]).max(), np.abs(got[:, c] + want[:, c]).max()) < 1e-6
    shares = {r.component: r.explained for r in found}
    assert np.allclose([shares[c + 1] for c in range(used)], e[:used] / np.trace(cov), rtol=1e-6)


def test_test_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in table.collect() if r.embedding is not None]
    check(whitening.whiten(table).collect(), vectors)


@pytest.mark.parametrize("height", [2, 1024])
def test_odd_rows(spark, monkeypatch, height):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", height)
    monkeypatch.setattr(whitening, "BLOCKS_PER_TASK", 1)
    rng = np.random.default_rng(1)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=5)]) for i in range(40)] + [(40, [0.0] * 5), (41, [100.0, -3.0, 0.0, 1e3, 2.0])]
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [float("nan")] * 5), (53, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (54, []),
           (55, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in good + bad], SCHEMA).repartition(4)
    check(whitening.whiten(table).collect(), good)
    check(whitening.whiten(table.unionByName(table)).collect(), good + good)


def test_more_than_a_long_holds_and_no_variance(spark):
    table = spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (None, [0.0, 2.0])], "vec_id long, embedding array<float>")
    found = whitening.whiten(table).collect()
    assert {(r.vec_id, r.deviation) for r in found} == {(1, None), (2, None), (None, 36864)}
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).count() == 0
    empty = whitening.whiten(same.limit(0))
    assert empty.count() == 0 and empty.columns == whitening.whiten(table).columns


def test_many_tasks_share_the_scatter_product(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 8)
    table = spark.range(256).selectExpr("id as vec_id", "array(id % 7, id % 5, id % 3) as embedding")
    rows = whitening.indexed(whitening.whole_numbers(table))
    assert sorted(r.idx for r in rows.collect()) == list(range(256))
    matrix = whitening.blocks(rows, 8, 3, rows["x"].cast("array<double>"))
    made = whitening.product(matrix.transpose(), matrix, 8)
    # The result block is added up in one task from the products of eight.
    assert "+-(8)" in made._java_matrix_wrapper._java_model.blocks().toDebugString()
    x = np.array([r.x for r in rows.orderBy("idx").collect()], dtype=float)
    assert np.array_equal(made.toLocalMatrix().toArray(), x.T @ x)
