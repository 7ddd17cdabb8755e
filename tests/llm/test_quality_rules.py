import random
import re
from collections import Counter

from postlens.llm import quality_rules as q

from .helpers import docs_of, edge_rows, words


def expected(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def got(docs):
    return q.judge(docs).select("doc_id", "text", "quality.*").collect()


def test_measures_equal_brute_force(spark):
    random.seed(3)
    texts = [" ".join(random.choices("a b c # dd |x", k=n)) + random.choice(["", "\n", "\nb a\nb a"]) for n in range(60)]
    rows = edge_rows() + [(100 + i, t, "s") for i, t in enumerate(texts)]
    for r in got(docs_of(spark, rows)):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected(r.text), r.text[:50]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.broken) and not (r.base_failed and r.kept)


def test_keeps_columns_rows_and_empty_table(spark):
    docs = docs_of(spark, edge_rows())
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 4
    assert {r.doc_id for r in kept.collect()} == {1, 2, None}     # the long texts have no stop words
    assert q.keep_good(docs.limit(0)).count() == 0


def test_rules_are_a_parameter(spark):
    docs = docs_of(spark, [(1, "a b c", "x"), (2, "a b", "x")])
    assert [r.doc_id for r in q.keep_good(docs, [q.Rule("few", "n_words", None, 3, None, True)]).collect()] == [1]


def test_one_projection_without_functions_or_shuffles(spark):
    plan = q.keep_good(docs_of(spark, edge_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Sort", plan)
