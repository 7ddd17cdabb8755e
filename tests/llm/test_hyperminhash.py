import random

import numpy as np
import pyarrow as pa

from postlens.llm import hyperminhash as h

from .helpers import docs_of, edge_rows, near_components, shingle_set


def family(random_, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(random_.randint(0, edits)):
            w[random_.randrange(len(w))] = f"z{random_.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def rows_of_families(seed, sizes=(1, 2, 5, 30), edits=6):
    r = random.Random(seed)
    texts = []
    for n in sizes * 3:
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([8, 20, 60, 150, 400]))]
        texts += family(r, base, n, max(1, edits * len(base) // 150))
    texts += r.sample(texts, 20)
    r.shuffle(texts)
    return [(i, t, "s") for i, t in enumerate(texts)]


def check(rows, result, percent):
    want = near_components(rows, percent)
    assert len(result) == len(rows)
    for x in result:
        if x.doc_id is None:
            assert x.component_id is None and x.kept
        else:
            assert (x.n_shingles, x.component_id) == want[x.doc_id], (x, want[x.doc_id])
            assert x.kept == (x.doc_id == x.component_id)


def test_components_equal_brute_force(spark):
    for percent in (80, 85):
        rows = rows_of_families(percent)
        check(rows, h.near_duplicates(docs_of(spark, rows), percent).collect(), percent)


def test_chains_in_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK", 8)
    monkeypatch.setattr(h, "SMALL", 4)
    monkeypatch.setattr(h, "COLUMNS", 50)
    rows = rows_of_families(9, sizes=(60,), edits=14)
    check(rows, h.near_duplicates(docs_of(spark, rows), 80).collect(), 80)


def test_odd_rows(spark):
    rows = edge_rows()
    docs = docs_of(spark, rows)
    check(rows, h.near_duplicates(docs, 80).collect(), 80)
    left = h.drop_near_duplicates(docs, 80)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [1, 3, 4, 5, 6, 8, 9, None, 10, 11, 12, 13]))
    assert h.near_duplicates(docs.limit(0), 80).count() == 0


def test_one_id_with_different_texts(spark):
    def text(mark, n=60):
        return " ".join(f"{mark}{i}" for i in range(n))
    a, b, c, d = (text(x) for x in "abcd")
    rows = [(1, a, "s"), (5, a, "s"), (5, b, "s"), (7, b + " tail", "s"), (7, b + " tail", "s"), (8, c, "s"), (8, d, "s"), (9, c + " tail", "s"),
            (10, d + " tail", "s"), (8, None, "s"), (10, "", "s"), (11, text("e"), "s"), (11, text("e").upper(), "s")]
    docs = docs_of(spark, rows)
    want = near_components(rows, 80)
    assert {want[i][1] for i in (1, 5, 7)} == {1} and {want[i][1] for i in (8, 9, 10)} == {8}
    for shards in (1, 5):
        result = h.near_duplicates(docs.repartition(shards), 80).collect()
        assert len(result) == len(rows) and {(r.doc_id, r.component_id) for r in result} == {(i, w[1]) for i, w in want.items()}
        left = sorted((r.doc_id, r.text or "") for r in h.drop_near_duplicates(docs.repartition(shards), 80).collect())
        assert left[:2] == [(1, a), (5, b)] and left[2:6] == [(8, ""), (8, c), (8, d), (10, "")]
        assert len(left) == 7 and left[6][0] == 11


def test_sets_equal_plain_shingles(monkeypatch):
    monkeypatch.setattr(h, "PIECE", 40)
    texts = [t for _, t, _ in edge_rows()] + ["A b\tC\nd\x0be\x0cf  G", "x" * 200 + " y", " lead", "trail "]
    with np.errstate(over="ignore"):
        sets = list(h.sets_of(pa.array(texts, pa.string())))
        again = list(h.sets_of(pa.array(["pad pad", *texts], pa.string())[1:]))
    known = {}
    for text, found, same in zip(texts, sets, again, strict=True):
        want = shingle_set(text)
        assert len(found) == len(want) and (found == same).all()
        for other, values in known.items():
            assert len(np.intersect1d(values, found)) == len(shingle_set(other) & want)
        if len(want) < 2000:
            known[text] = found


def test_estimates_are_close():
    r = np.random.default_rng(2)
    with np.errstate(over="ignore"):
        for n in (40, 200, 3000, 50_000):
            both = r.integers(0, 2**63, n).astype(np.uint64)
            cut = int(n * 0.95)
            a, b = np.unique(both[:cut]), np.unique(both[n - cut:])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            level = h.level_of(len(a))
            share, chance, m = h.estimate(h.registers(a, level), h.registers(b, level), len(a), len(b))
            assert abs((share - chance) / (1 - chance) - true) < 4.5 * (true * (1 - true) / m) ** 0.5
            assert h.likely(share, chance, m, 85)
