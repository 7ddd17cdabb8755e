import random

import pytest
from pyspark.sql import functions as F

from postlens.llm import mixing

from .helpers import docs_of, edge_rows, words


def water_level(sizes, weights, budget, cap):
    """Targets by handing the excess round until none is above."""
    most = {s: cap * n for s, n in sizes.items()}
    target, free, rest = dict.fromkeys(sizes, 0.0), set(sizes), budget
    while free:
        total = sum(weights[s] for s in free)
        over = {s for s in free if rest * weights[s] / total >= most[s]}
        if not over:
            return target | {s: rest * weights[s] / total for s in free}
        for s in over:
            target[s], rest = most[s], rest - most[s]
        free -= over
    return target


def check(rows, result):
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = water_level(sizes, weights, 1.5 * sum(sizes.values()), 2)
    assert len(result) == len(rows)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in result:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    return {s: abs(taken[s] - target[s]) / max(largest[s], 1) for s in sizes}


def test_targets_are_met_to_half_a_document(spark):
    random.seed(1)
    rows = [(i, " ".join(["w"] * random.randint(0, 60)), random.choice(["big"] * 6 + list("abcdefgh") + [None])) for i in range(900)]
    docs = docs_of(spark, rows)
    first = sorted(mixing.mix(docs).drop("below").collect(), key=lambda r: r.doc_id)
    assert max(check(rows, first).values()) <= 0.51
    again = sorted(mixing.mix(docs.repartition(5)).drop("below").collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.taken) for r in first] == [(r.doc_id, r.taken) for r in again]
    drawn = mixing.draw(docs)
    assert drawn.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in drawn.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in first if r.copies}


def test_odd_rows(spark):
    rows = edge_rows()
    check(rows, mixing.mix(docs_of(spark, rows)).collect())


def test_empty_table_and_table_without_words(spark):
    docs = docs_of(spark, [(1, None, "a"), (2, "", None)])
    assert [r.taken for r in mixing.mix(docs).collect()] == [0, 0]
    assert mixing.draw(docs).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.draw(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = mixing.draw(docs_of(spark, edge_rows()).select("doc_id", "text", "source").where(F.col("doc_id") < 0))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text
