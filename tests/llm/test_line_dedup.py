from postlens.llm import line_dedup

from .helpers import docs_of, edge_rows, words


def expected(rows, sites):
    spread, owner = {}, {}
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            if words(line):
                spread.setdefault(line, set()).add(s)
                if i is not None:
                    owner[line] = min(owner.get(line, i), i)
    out = []
    for i, t, _ in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        gone = [len(spread.get(x, ())) >= sites and owner.get(x) != i for x in t.split("\n")]
        out.append((i, "\n".join(x for x, g in zip(t.split("\n"), gone, strict=True) if not g), len(gone), sum(gone)))
    return sorted(out, key=str)


def got(done):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in done.collect()), key=str)


def rows_of_sites():
    rows = []
    for i in range(120):
        lines = [f"own line of {i}", "menu home about" if i % 3 else "", f"shared by few {i % 60}", "seen on ten" if i < 10 else "   "]
        rows.append((i, "\n".join(lines), f"s{i % 24}"))
    return rows + [(200, "menu home about", "s1"), (201, "menu home about\nseen on ten", None), (None, "only without id", "a")]


def test_lines_of_many_sites_go_but_once(spark):
    rows = rows_of_sites()
    for sites in (2, 10, 11, 12, 30):
        assert got(line_dedup.removed_lines(docs_of(spark, rows), sites)) == expected(rows, sites)


def test_estimates_off_by_much_are_settled_exactly(spark):
    rows = rows_of_sites()
    assert got(line_dedup.removed_lines(docs_of(spark, rows), 10, lg_k=4, margin=0.9)) == expected(rows, 10)


def test_odd_rows(spark):
    rows = edge_rows()
    docs = docs_of(spark, rows)
    assert got(line_dedup.removed_lines(docs, 1)) == expected(rows, 1)
    cleaned = line_dedup.clean(docs, 1)
    assert cleaned.columns == docs.columns and cleaned.count() == sum(not (g and not words(t)) for _, t, _, g in expected(rows, 1))
    assert line_dedup.clean(docs.limit(0)).count() == 0


def test_length_follows_the_text(spark):
    for r in line_dedup.clean(docs_of(spark, rows_of_sites())).collect():
        assert r.n_chars == len(r.text)


def test_no_python_on_the_way(spark):
    plan = line_dedup.removed_lines(docs_of(spark, edge_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
