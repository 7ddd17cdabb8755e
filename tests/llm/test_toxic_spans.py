import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import queries, toxic_spans
from postlens.llm.common import bounded_sample

from .helpers import docs_of, edge_rows


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_marginals_against_all_sequences():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 10):
        emission, transition, start = rng.normal(size=n) * 2, rng.normal(size=(2, 2)), rng.normal(size=2)
        breaks = rng.random(n) < .3
        breaks[0] = True
        total, single, pairs = 0, np.zeros(n), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=n):
            weight = np.exp(sum(emission[i] * s + (start[s] if breaks[i] else transition[states[i - 1], s]) for i, s in enumerate(states)))
            total += weight
            single += weight * np.array(states)
            for i in range(1, n):
                if not breaks[i]:
                    pairs[states[i - 1], states[i]] += weight
        p, both = toxic_spans.marginals(emission, breaks, transition, start, True)
        assert np.allclose(p, single / total) and np.allclose(both, pairs / total)


def test_long_chains_stay_finite_and_equal_one_by_one():
    rng = np.random.default_rng(1)
    emission, breaks, transition, start = rng.normal(size=50_000) * 20, np.zeros(50_000, bool), rng.normal(size=(2, 2)) * 5, np.zeros(2)
    breaks[[0, 10, 11, 40_000]] = True
    p = toxic_spans.marginals(emission, breaks, transition, start)
    alone = toxic_spans.marginals(emission[10:11], breaks[10:11], transition, start)
    assert np.isfinite(p).all() and np.isclose(p[10], alone[0])
    assert np.allclose(p[40_000:], toxic_spans.marginals(emission[40_000:], breaks[40_000:], transition, start))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op12_toxic_crf(spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in rows)
    judged = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in judged if y], [s for s, y in judged if not y]
    auc = np.mean([(a > b) + (a == b) / 2 for a in toxic for b in clean])
    assert auc > 0.95
    assert np.mean([s < .5 for s in clean]) > 0.99 and np.mean([s >= .5 for s in toxic]) > 0.85


def made(spark):
    """Toxic documents say 'vileword' with many endings, clean ones do not."""
    rng = np.random.default_rng(3)
    common = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        words = list(rng.choice(common, 30))
        if i % 4 == 0:
            words[5] = "Vileword" + "abcdefgh"[i % 8] + ","
            words[20] = "vilewordz"
        rows.append((i, " ".join(words), "a"))
    docs = docs_of(spark, rows)
    return docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")


def test_spans_and_odd_rows(spark):
    docs, labels = made(spark)
    odd = docs_of(spark, [(i and -i, t, s) for i, t, s in edge_rows()] + [(-90, "", "a"), (-91, "w1  vilewordq vilewordx\tw2", "a"), (-91, "w1  vilewordq vilewordx\tw2", "a")])
    everything = docs.unionByName(odd).withColumn("toxicity", F.lit(1)).withColumn("score", F.lit(2))
    noise = spark.createDataFrame([(7, 0), (7, None), (0, 0), (10_000, 1)], "doc_id long, toxic int")
    model = toxic_spans.fit(everything, labels.unionByName(noise))
    found = toxic_spans.score(everything, model).select("doc_id", "text", "toxicity.*").collect()
    assert len(found) == everything.count()
    for r in found:
        if r.doc_id is not None and r.doc_id >= 0:
            assert (r.score >= .5) == (r.doc_id % 4 == 0)
            assert [r.text[s.start:s.end].lower().strip(",")[:8] for s in r.spans] == ["vileword"] * (2 if r.doc_id % 4 == 0 else 0)
    twice = [r for r in found if r.doc_id == -91]
    assert len(twice) == 2 and {tuple(map(tuple, r.spans)) for r in twice} == {((4, 23),)} and twice[0].n_toxic == 2
    low = min(r.score for r in found)
    assert all(r.score == low and not r.spans for r in found if not (r.text or "").split())


def test_without_labels_of_both_kinds(spark):
    docs, labels = made(spark)
    assert toxic_spans.score(docs, toxic_spans.fit(docs, labels.limit(0))).where("toxicity.score = 0").count() == 400
    assert toxic_spans.score(docs, toxic_spans.fit(docs, labels.where("toxic = 1"))).where("toxicity.score = 1").count() == 400
    assert toxic_spans.score(docs.limit(0), toxic_spans.fit(docs, labels)).count() == 0


@pytest.mark.parametrize("partitions", [2, 40])
def test_sample_that_reaches_the_driver_is_bounded(spark, partitions):
    rows = spark.range(20_000).repartition(partitions)
    taken = bounded_sample(rows, ["id"], 1000, 20_000)
    assert len(taken) == 1000 and taken == bounded_sample(spark.range(20_000), ["id"], 1000, 20_000)
    assert len(bounded_sample(rows.limit(30), ["id"], 1000, 30)) == 30
