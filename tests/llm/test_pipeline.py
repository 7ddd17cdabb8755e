import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from postlens.llm import mixing
from postlens.scratch import settle

from . import test_mixing
from .helpers import SF, docs_of, edge_rows, near_components
from .test_line_dedup import expected as without_lines
from .test_line_dedup import words
from .test_quality_rules import expected as measured


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = settle(stages["quality_rules"](spark, docs, SF), "good")
    assert good.columns == docs.columns and good.count() > 0.7 * docs.count()
    for r in docs.join(good, "doc_id", "left_anti").collect():
        assert measured(r.text)[0] < 10 or r.text
    lines = settle(stages["line_dedup"](spark, good, SF), "lines")
    want = [(i, t) for i, t, _, g in without_lines([(r.doc_id, r.text, r.source) for r in good.collect()], 10) if words(t) or not g]
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == sorted(want)
    near = settle(stages["near_duplicates"](spark, lines, SF), "near")
    found = near_components([(r.doc_id, r.text) for r in lines.collect()], corpus_pipeline.SIMILARITY)
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, (_, c) in found.items() if i == c)
    mixed = settle(stages["mixture"](spark, near, SF), "mixed")
    rows = [(r.doc_id, r.text, r.source) for r in near.collect()]
    taken = mixing.mix(near).collect()
    assert max(test_mixing.check(rows, taken).values()) <= 0.51
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in taken)
    last = stages["tokens"](spark, mixed, SF).collect()
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {i: t for i, t, _ in rows}
    for r in last:
        assert r.round_trip and r.n_tokens == len(r.ids) and r.ids == known.encode(texts[r.doc_id], add_special_tokens=False).ids
    assert len(last) == mixed.count()


def test_odd_rows_pass_all_stages(spark):
    docs = docs_of(spark, edge_rows())
    for table in (docs, docs.limit(0)):
        step = table
        for name, stage in corpus_pipeline.STAGES:
            step = settle(stage(spark, step, SF), name)
            if name != "tokens":
                assert step.columns == docs.columns
        assert step.count() == 0 or step.where("round_trip").count() == step.count()


@pytest.mark.parametrize("n", range(1, 11))
def test_a_query_for_each_operator(n):
    assert len([q for q in queries() if q.startswith(f"op{n}_")]) == 1 and "pipeline" in queries()


def test_sql_is_for_duckdb():
    assert set(oracle_sql()) <= set(queries()) and duckdb.connect()
