"""A Merkle manifest of a table of documents: one tree per source, one tree over the sources.

``H`` is the lowercase hex SHA-256 of its inputs, concatenated (digests as hex text). A row's leaf is ``H`` of its fields,
each ``-`` if null, else its UTF-8 byte count, ``:`` and value. Inside a source leaves ascend by doc_id; as long as there
are several nodes, every 16 consecutive ones (the last run may have fewer, even one) become their ``H``. The subroots,
ordered by source (null first), are joined in the same way to the root of the table.

A superblock is 4,096 consecutive nodes of a tree. Going up, each superblock is reduced to one node, so a tree of n leaves
needs log4096(n) rounds. Coming down, the nodes of a superblock are cogrouped with the nodes outside it that its proofs
need (at most 15 a level, the same for all of its rows); one task then has all it takes to reduce the superblock again, join
each row's proof and fold it. No group is larger than a superblock, whatever the size of a source.

Null ids come first and are never tampered with; rows that repeat an id are ordered by leaf, repeated rows have equal leaves
and each its own place. Empty tables give no rows, a single row is its own root. Null and empty texts have different leaves.
Columns other than the five fields do not count and do not appear.
"""
import hashlib

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.llm.common import shipped
from postlens.scratch import settle

shipped(__name__)

RUN, LEVELS = 16, 3
BLOCK = RUN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<string>"


def joined_hash(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields):
    """Digest of the columns, given as names or expressions."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def lowered(text):
    """A-Z in lower case."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return F.translate(text, letters.upper(), letters)


def placed(rows, tree, order, carry):
    """``rows`` with the number of their tree, its size n and their place pos in it.

    Rows are dealt into ranges of (tree, order). Only counts per range and tree are put in order to number trees and
    places, so a tree that holds a third of all rows is as many pieces as it has ranges.
    """
    # Ranges are cut by keys short enough to be sampled cheaply; they agree with the whole order.
    cuts = [F.col(order[0]).asc_nulls_first(), F.substring(order[1], 1, 8).asc_nulls_first()]
    order = [F.col(c).asc_nulls_first() for c in order]
    spread = settle(rows.repartitionByRange(F.col(tree).asc_nulls_first(), *cuts).withColumn("_range", F.spark_partition_id()), "ranges")
    pieces = settle(spread.groupBy("_range", tree).agg(F.count("*").alias("_rows")), "pieces")
    sizes = settle(pieces.groupBy(tree).agg(F.sum("_rows").alias("n"), F.min("_range").alias("_range")), "sizes")
    # Trees are numbered like the ranges they begin in, then inside such a range.
    begun = sizes.groupBy("_range").agg(F.count("*").alias("_begun")).withColumn("_first", F.coalesce(F.sum("_begun").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_begun")
    numbered = sizes.join(begun, "_range").select(F.col(tree).alias("_tree"), "n", (F.col("_first") + F.row_number().over(
        Window.partitionBy("_range").orderBy(F.col(tree).asc_nulls_first())) - 1).cast("long").alias("tree"))
    before = Window.partitionBy(tree).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    pieces = settle(pieces.join(numbered, F.col(tree).eqNullSafe(F.col("_tree"))).select(
        F.col("_range").alias("_r"), "_tree", "tree", "n", "_before"), "pieces")
    inside = F.row_number().over(Window.partitionBy("_range", tree).orderBy(*order)) - 1
    numbered = spread.withColumn("_inside", inside)
    return settle(numbered.join(pieces, (F.col("_range") == F.col("_r")) & F.col(tree).eqNullSafe(F.col("_tree"))).select(
        "tree", "n", (F.col("_before") + F.col("_inside")).alias("pos"), *carry), "places")


def height(n):
    """Levels of a superblock of a tree with n nodes: three, or as many as it takes to one node."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // RUN), levels + 1
    return levels


def reduced(nodes, levels):
    """The nodes of a superblock, level by level; the last level is a single node."""
    found = [list(nodes)]
    for _ in range(levels):
        last = found[-1]
        found.append([joined_hash(last[i:i + RUN]) for i in range(0, len(last), RUN)])
    return found


def siblings(levels, place):
    """Texts left and right of a node's path in its superblock: [left, right, left, right, ...] from below."""
    out = []
    for nodes in levels[:-1]:
        start = place - place % RUN
        out += ["".join(nodes[start:place]), "".join(nodes[place + 1:start + RUN])]
        place //= RUN
    return out


def fold(node, path):
    for left, right in zip(path[::2], path[1::2], strict=True):
        node = joined_hash([left, node, right])
    return node


def _block(pdf):
    """Places in a superblock in order, and its levels."""
    pdf = pdf.sort_values("pos", kind="stable")
    return pdf, reduced(pdf["node"], height(int(pdf["n"].iloc[0])))


def climb(nodes):
    """Rounds of a forest ``(tree, n, pos, node)``: each has a node per superblock of the one before, the last one per tree."""
    def up(key, pdf):
        pdf, levels = _block(pdf)
        return pd.DataFrame({"tree": [key[0]], "n": [-(-int(pdf["n"].iloc[0]) // BLOCK)], "pos": [key[1]], "node": [levels[-1][0]]})

    rounds, largest = [nodes], nodes.agg(F.max("n")).first()[0] or 1
    while largest > 1:
        last, schema = rounds[-1], "tree long, n long, pos long, node string"
        made = last.where("n > 1").withColumn("block", F.floor(F.col("pos") / F.lit(BLOCK))).groupBy("tree", "block").applyInPandas(up, schema)
        rounds.append(settle(made.unionByName(last.where("n = 1").select("tree", "n", "pos", "node")), "nodes"))
        largest = -(-largest // BLOCK)
    return rounds


def descend(rounds, outer):
    """From the paths above each tree ``(tree, pos, path)`` to those above each node of the first of these rounds."""
    def down(inner, above):
        pdf, levels = _block(inner)
        rest, first = list(above["path"].iloc[0]), int(pdf["pos"].iloc[0])
        return pd.DataFrame({"tree": pdf["tree"], "pos": pdf["pos"],
                             "path": [siblings(levels, int(p) - first) + rest for p in pdf["pos"]]})

    for nodes in reversed(rounds):
        inner = nodes.where("n > 1").withColumn("block", F.floor(F.col("pos") / F.lit(BLOCK)))
        grown = outer.join(inner.select("tree").distinct(), "tree", "left_semi")
        made = inner.groupBy("tree", "block").cogroup(grown.groupBy("tree", "pos")).applyInPandas(
            down, f"tree long, pos long, path {PATH}")
        outer = settle(made.unionByName(outer.join(nodes.where("n = 1").select("tree"), "tree", "left_semi")), "paths")
    return outer


def manifest(docs, tampered=None, fields=FIELDS):
    """One row per document: doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` maps names of fields to what an intruder made of them: proofs are made of the true table and folded
    from the tampered leaf.
    """
    changed = [(tampered or {}).get(f, f) for f in fields]
    slim = docs.select(F.col("doc_id").cast("string").alias("id"), "doc_id", "source", leaf(fields).alias("node"),
                       leaf(changed).alias("shown"))
    leaves = placed(slim, "source", ["doc_id", "node", "shown"], ["id", "source", "node", "shown"])
    rounds = climb(leaves)
    subroots = rounds[-1].select(F.col("tree").alias("pos"), "node")
    top = climb(settle(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(subroots.count()).cast("long").alias("n"),
                                       "pos", "node"), "subroots"))
    whole = top[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.array().cast(PATH).alias("path"))
    paths = descend(top[:-1], whole).select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path")
    paths = descend(rounds[1:-1], paths)

    def prove(inner, above):
        pdf, levels = _block(inner)
        rest, first = list(above["path"].iloc[0]), int(pdf["pos"].iloc[0])
        n, outside = int(pdf["n"].iloc[0]), 0
        n = -(-n // BLOCK)
        while n > 1:
            n, outside = -(-n // RUN), outside + 1
        proofs = [siblings(levels, int(p) - first) + rest for p in pdf["pos"]]
        return pd.DataFrame({
            "id": pdf["id"], "source": pdf["source"], "leaf": pdf["node"],
            "subroot": fold(levels[-1][0], rest[:2 * outside]), "proof_sha256": [joined_hash(p) for p in proofs],
            "folded_root": [fold(node, p) for node, p in zip(pdf["shown"], proofs, strict=True)]})

    blocks = leaves.withColumn("block", F.floor(F.col("pos") / F.lit(BLOCK))).groupBy("tree", "block")
    proved = blocks.cogroup(paths.groupBy("tree", "pos")).applyInPandas(
        prove, "id string, source string, leaf string, subroot string, proof_sha256 string, folded_root string")
    root = top[-1].select("node").first()
    root = F.lit(root["node"] if root else None).cast("string")
    return proved.select(F.col("id").cast("long").alias("doc_id"), "source", "leaf", "subroot", root.alias("root"),
                         "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
