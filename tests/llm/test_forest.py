import numpy as np
import pytest

from postlens.llm import forest

from .helpers import SF, components


def brute(rows, cosine=0.95):
    sound = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = list(sound)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if len(sound[a]) == len(sound[b]) and
             sound[a] @ sound[b] / np.linalg.norm(sound[a]) / np.linalg.norm(sound[b]) >= cosine]
    found = components([i for i, _ in rows if i is not None], links)
    return {i: (sum(i in p for p in links), found[i]) for i in found}


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, label int, id int, leaf int")


@pytest.fixture(scope="module")
def groups():
    random = np.random.default_rng(4)
    rows = []
    for g in range(60):
        centre = random.standard_normal(16)
        for _ in range([1, 3, 40][g % 3] if g else 200):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + random.standard_normal(16) * 0.12]))
    rows += [(len(rows) + k, rows[k][1]) for k in range(30)]
    return rows


def check(rows, result):
    want = brute(rows)
    assert len(result) == len(rows)
    for r in result:
        assert (r.n_links, r.component_id) == (want[r.vec_id] if r.vec_id is not None else (0, None)), r
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)


def test_links_of_groups_in_small_blocks(spark, groups):
    check(groups, forest.near_duplicates(table(spark, groups), leaf=100, block=64).collect())


def test_test_table(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    check([(r.vec_id, r.embedding) for r in vectors.collect()], forest.near_duplicates(vectors).collect())


def test_odd_vectors_and_empty_table(spark):
    unit = [1.0, 0.0, 0.0]
    rows = [(1, unit), (2, [2.0, 0.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [float("nan"), 1.0, 0.0]),
            (7, [float("inf"), 0.0, 0.0]), (8, [1.0, None, 0.0]), (9, [1.0, 0.0]), (10, unit), (None, unit), (11, [-1.0, 0.0, 0.0])]
    check(rows, forest.near_duplicates(table(spark, rows)).collect())
    assert forest.near_duplicates(table(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("size", [400, 2000])
def test_pairs_at_the_threshold_meet_beyond_the_sample(size):
    """10,000 pairs at a cosine of 0.952 among vectors of which the trees saw a small part: recall of the leaves."""
    random = np.random.default_rng(size)
    x = random.standard_normal((10_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = random.standard_normal(x.shape)
    other -= (other * x).sum(axis=1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    y = 0.952 * x + np.sqrt(1 - 0.952 ** 2) * other
    both = np.concatenate([x, y])
    trees = forest.fit(both[random.choice(len(both), size, replace=False)], len(both), 0.95)
    leaves = [set(f) for f in forest.leaves_of(trees, both.astype(np.float32))]
    met = sum(bool(leaves[i] & leaves[i + len(x)]) for i in range(len(x)))
    assert met / len(x) > 0.9999
