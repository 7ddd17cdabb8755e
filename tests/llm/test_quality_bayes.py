from collections import defaultdict

import numpy as np
import pytest

from postlens.llm import quality_bayes

from .helpers import docs_of, edge_rows


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, test = labels.where("doc_id % 2 = 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    scored = {r.doc_id: r for r in quality_bayes.score(docs, train).collect()}
    assert len(scored) == docs.count()
    right = [scored[i].kept == bool(q) for i, q in test.items()]
    good = [scored[i].kept for i, q in test.items() if q]
    print(sum(right) / len(right), sum(good) / len(good))
    assert sum(right) / len(right) >= 0.95 and sum(good) / len(good) >= 0.97


def test_sparse_sites_stay_near_the_prior(spark):
    good, bad = "the cat and the dog went to the river on a cold day", "### $$$ %%% &&& ### $$$ %%% &&& ### $$$ %%%"
    rows = [(i, bad if i % 2 else good, "bad" if i % 10 else "good") for i in range(400)] + [(1000, bad, "rare")]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(400)], "doc_id long, quality int")
    scores = {r.doc_id: r for r in quality_bayes.score(docs_of(spark, rows), labels).collect()}
    assert scores[1].site_score < scores[1000].site_score < scores[0].site_score
    assert abs(scores[1000].site_score - 0.1) < 0.1


def test_odd_rows(spark):
    rows = edge_rows()
    docs = docs_of(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept and r.doc_score == 0.5 for r in quality_bayes.score(docs, none).collect())
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 0), (None, 0, 0), (5, None, None), (6, 1, 0)], none.schema)
    assert quality_bayes.score(docs, some).count() == len(rows)
    assert quality_bayes.score(docs.limit(0), some).count() == 0


def strength(groups):
    """Pseudo-documents of groups (n, rate, prior)."""
    n = sum(g[0] for g in groups)
    spread = sum(k * (r - p) ** 2 for k, r, p in groups) / n
    noise = sum(p * (1 - p) for _, _, p in groups) / n
    return min(max(sum(k * p * (1 - p) for k, _, p in groups) / n / max(spread - noise, 1e-9) - 1, 1.0), 1e6)


def test_posteriors_against_a_plain_version(spark):
    """Shrinkage from the classifier's probabilities on, document by document."""
    rng = np.random.default_rng(2)
    texts = ["the cat and the dog went to the river on a cold day", "### $$$ %%% &&& ### $$$ %%% &&& ### $$$ %%%", "of it and to be with"]
    rows = [(i, texts[rng.integers(3)], [None, "a", "b", "c"][min(3, rng.geometric(.4) - 1)]) for i in range(150)]
    labels = {i: int(rng.random() < .7) for i in range(0, 150, 3)}
    table = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    found = {r.doc_id: r for r in quality_bayes.score(docs_of(spark, rows), table).collect()}
    own = {i: labels.get(i, found[i].doc_score) for i, *_ in rows}
    sites, paths = defaultdict(list), defaultdict(list)
    for i, _, source in rows:
        sites[source].append(own[i])
        paths[source, "en" if source else None].append(own[i])
    prior = np.mean(list(own.values()))
    ws = strength([(len(v), np.mean(v), prior) for v in sites.values()])
    rate = {s: (sum(v) + ws * prior) / (len(v) + ws) for s, v in sites.items()}
    wp = strength([(len(v), np.mean(v), rate[k[0]]) for k, v in paths.items()])

    def logit(p):
        p = min(max(p, 1e-6), 1 - 1e-6)
        return np.log(p / (1 - p))

    for i, _, source in rows:
        base = (sum(own.values()) - own[i]) / (len(own) - 1)
        site = (sum(sites[source]) - own[i] + ws * base) / (len(sites[source]) - 1 + ws)
        path = paths[source, "en" if source else None]
        path = (sum(path) - own[i] + wp * site) / (len(path) - 1 + wp)
        score = 1 / (1 + np.exp(-(logit(found[i].doc_score) + logit(path) - logit(base))))
        assert [found[i].site_score, found[i].path_score, found[i].score] == pytest.approx([site, path, score], rel=1e-9)
