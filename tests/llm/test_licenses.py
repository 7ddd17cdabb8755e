import re

from postlens.llm import licenses

from .helpers import SF, docs_of, edge_rows

PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def low_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def base(text):
    w = low_words(text)
    places = sorted((i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i:i + len(p)]) == p)
    starts = [i for i, _ in places]
    return (len(w), len(places), starts[0] if starts else None, starts[-1] if starts else None,
            ",".join(sorted({x for _, x in places})))


def check(rows, result):
    assert len(result) == len(rows)
    want = sorted((str(i), base(t)) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in result) == want
    for r in result:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


TEXTS = ["MIT License", "the mit\nlicense mit license, Apache--License general  public license mit license",
         "mit licenses", "limit license", "İmit license", "general public. License general public license",
         "x " * 3000 + "mit license " * 50 + "y " * 3000, "Kit license", "license mit"]


def test_base_places(spark):
    rows = edge_rows() + [(100 + i, t, "s") for i, t in enumerate(TEXTS)]
    docs = docs_of(spark, rows)
    check(rows, licenses.scan(docs).collect())
    assert licenses.scan(docs.limit(0)).count() == 0


def test_base_places_of_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], licenses.scan(docs).collect())


def test_longer_and_stronger_detections_win(spark):
    cases = {
        "Licensed under the Apache License, Version 2.0.": ("apache,apache-2.0", ["apache-2.0"]),
        "Licensed under CC BY-NC 4.0.": ("cc-by-nc-4.0", ["cc-by-nc-4.0"]),
        "SPDX-License-Identifier: MIT": ("mit", ["mit"]),
        "GNU General Public License v3": ("gpl,gpl-3", ["gpl-3"]),
        "Permission is hereby granted, free of charge, to any person": ("mit", ["mit"]),
        "Copyright 2020 X. All rights reserved. Commercial license": ("all-rights-reserved,proprietary", None),
    }
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(cases)])
    labels = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    hits = licenses.detect(docs).where("kept").collect()
    for i, (want, kept) in enumerate(cases.values()):
        assert labels[i] == want
        if kept:
            assert sorted({h.label for h in hits if h.doc_id == i}) == kept


def test_suppressed_hits_lie_in_kept_ones(spark):
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])
    hits = [h for h in licenses.detect(docs).collect() if h.rule]
    for h in hits:
        holders = [k for k in hits if k.row == h.row and k != h and k.start <= h.start and k.end >= h.end and k.priority >= h.priority]
        same = [k for k in holders if (k.start, k.end, k.priority) == (h.start, h.end, h.priority)]
        assert h.kept == (not [k for k in holders if k not in same or k.rule < h.rule])


NOTICE_TEXTS = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "no-warranty": "but WITHOUT ANY WARRANTY; without even the implied",
    "all-rights-reserved": "Copyright (c) 2001 to 2020 The Regents of Somewhere. All rights reserved.",
    "copyright": "Copyright (c) 2020 X", "copyleft": "It is copyleft software", "no-license": "There is no license at all",
    "proprietary": "an end user license agreement", "free-license": "Some open source licenses do",
}


def long_forms():
    """The longest texts of every family's forms: (label, rule, text)."""
    for line in licenses.FAMILIES.strip().splitlines():
        label, names, versions = (x.strip() for x in line.split(";"))
        for name in names.split("|"):
            yield from [(label, "spdx", f"spdx license identifier {name}"), (label, "named", f"{name} license"),
                        (label, "licensed", f"licensed under the terms of the {name} license"), (label, "after", f"license type {name}")]
            for v in [v for v in versions.split(",") if v != "0"]:
                full, tail = f"{label}-{v.replace(' ', '.')}", f"version v{v}"
                yield from [(full, "spdx", f"spdx license identifier {name} {tail}"), (full, "named", f"{name} license {tail}"),
                            (full, "licensed", f"licensed under the terms of the {name} license {tail}"), (full, "before", f"{name} {tail} license")]


def test_longest_forms_and_standard_notices_fire(spark):
    assert set(NOTICE_TEXTS) == {n[0] for n in licenses.NOTICES}
    pad = "word " * 60
    want = list(long_forms()) + [(label, "notice", text) for label, text in NOTICE_TEXTS.items()]
    docs = docs_of(spark, [(i, f"{pad}{text} {pad}", "s") for i, (_, _, text) in enumerate(want)])
    fired = {(h.doc_id, h.label, h.rule[5:]) for h in licenses.detect(docs).where("rule IS NOT NULL").collect()}
    assert [x for i, x in enumerate(want) if (i, x[0], x[1]) not in fired] == []


def test_british_spelling_fires_in_every_form(spark):
    forms = [(label, rule, re.sub(r"\blicens(?=e)", "licenc", text)) for label, rule, text in long_forms()] + [
        (label, "notice", NOTICE_TEXTS[label].replace("licens", "licenc")) for label in ("no-license", "proprietary", "free-license")]
    docs = docs_of(spark, [(i, text, "s") for i, (_, _, text) in enumerate(forms)])
    fired = {(h.doc_id, h.label, h.rule[5:]) for h in licenses.detect(docs).where("rule IS NOT NULL").collect()}
    assert [x for i, x in enumerate(forms) if (i, x[0], x[1]) not in fired] == []
    cases = {"MIT Licence": "mit", "Apache Licence 2.0": "apache,apache-2.0", "GNU General Public Licence": "gpl",
             "Licensed under the European Union Public Licence 1.2": "eupl,eupl-1.2"}
    found = {r.doc_id: r for r in licenses.scan(docs_of(spark, [(i, t, "s") for i, t in enumerate(cases)])).collect()}
    for i, want in enumerate(cases.values()):
        assert found[i].n_base == 0 and set(found[i].labels.split(",")) <= set(want.split(",")) and found[i].labels and found[i].score > 0


def test_windows_reach_as_far_as_the_rules():
    assert licenses.most_words(" a (?:b c |d )?(?:[^ ]+ ){0,8}") == 12
    sides = licenses.reach()
    assert sides["granted"][0] >= 20 and sides["licensed"][1] >= 16
    assert set(sides) == set(licenses.KEYWORDS)


def test_rules_are_many_and_valid():
    rules = licenses.rules()
    assert len(rules) > 300 and len({r["rule"] for r in rules}) == len(rules)
    for r in rules:
        re.compile(r["pattern"])
        assert r["keyword"] in licenses.KEYWORDS and re.search(licenses.GATE, r["keyword"])


def test_no_python_in_the_plan(spark):
    plan = licenses.scan(docs_of(spark, edge_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
