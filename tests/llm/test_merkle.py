import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from postlens.llm import merkle

from .helpers import docs_of, edge_rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return digest(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def tree(nodes):
    """Root, and for each node the levels of (left, right) above it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            start = i - i % 16
            paths[k].append(("".join(nodes[start:i]), "".join(nodes[i + 1:start + 16])))
        nodes = [digest(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], paths


def brute(rows):
    """All result rows of (doc_id, text, source, lang, n_chars)."""
    sources = defaultdict(list)
    for i, text, source, lang, n in rows:
        shown = text.translate(LOW) if text is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else text
        sources[source].append((i is not None, i or 0, leaf(i, source, lang, n, text), leaf(i, source, lang, n, shown), i))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([r[2] for r in sorted(sources[s])]) for s in names}
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        for (_, _, true, shown, i), path in zip(sorted(sources[s]), trees[s][1], strict=True):
            folded = shown
            for a, b in path + top:
                folded = digest(a, folded, b)
            proof = digest(*[a + b for a, b in path + top])
            out.append((i, s, true, trees[s][0], root, proof, folded, folded == root))
    return out


def tampered():
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return {"text": F.when(struck, merkle.lowered("text")).otherwise(F.col("text"))}


@pytest.mark.parametrize("partitions", [1, 5])
def test_odd_rows(spark, partitions):
    docs = docs_of(spark, edge_rows()).repartition(partitions)
    rows = [(r.doc_id, r.text, r.source, r.lang, r.n_chars) for r in docs.collect()]
    assert Counter(map(tuple, merkle.manifest(docs, tampered()).collect())) == Counter(brute(rows))


def test_names_of_other_columns_do_not_matter(spark):
    docs = docs_of(spark, edge_rows())
    for name in ("tree", "pos", "n", "node", "path", "_range", "block", "leaf", "shown", "id"):
        docs = docs.withColumn(name, F.lit(1))
    assert merkle.manifest(docs).where("verified").count() == len(edge_rows())


def test_trees_of_several_superblocks(spark, monkeypatch):
    """Superblocks of 4 x 4 nodes: one source of 1,100 rows has three rounds, 70 sources a top of two."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [(i, f"Text {i}", "hot" if i < 1100 else f"s{i % 70}", "en", i % 7) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    assert Counter(map(tuple, merkle.manifest(docs, tampered()).collect())) == Counter(brute(rows))


def test_single_row_and_empty_table(spark):
    docs = docs_of(spark, [(7, "Some TEXT", "a")])
    row = merkle.manifest(docs).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == digest("")
    assert merkle.manifest(docs.limit(0)).count() == 0
