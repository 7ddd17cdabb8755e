"""Embedding near-duplicates with a forest of random-projection trees.

A node of a tree splits its vectors at the median along a random direction (the widest of a few); vectors
close to the cut go to both sides (spill), so a near pair is seldom parted, and many trees see different cuts. Vectors are compared
inside leaves only, in double precision. A pair that meets in several leaves counts in the first of them, which both
vectors' leaf lists tell, so no pairs are shuffled: a leaf gives link counts per vector and a spanning forest of its
links. Equal vectors are one class throughout. Leaves of more than ``BLOCK`` vectors are compared block against block.

The trees are fitted on at most ``SAMPLE`` classes chosen by hash (a documented bound); every vector goes through them. A pair at
cosine 0.95 is parted by one split with a probability of about 2 %, so by all trees with about 1e-8 at eight levels.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows without id; rows of
the same id are one node. Vectors of different lengths never meet. An empty table gives no rows; labels and other columns are ignored.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import bounded_sample, components, shipped
from postlens.scratch import settle

shipped(__name__)

TREES, LEAF, BLOCK, SAMPLE, CHOICES, FEWEST, SPILL = 10, 256, 2048, 8192, 8, 16, 0.5
SAMPLE_NUMBERS = 1 << 22


def fit(sample, total, cosine, trees=TREES, leaf=LEAF, seed=17):
    """Trees as lists of nodes ``(direction, cut, left, right)`` or leaf numbers; children are places in the list."""
    random = np.random.default_rng(seed + sample.shape[1])
    # Pairs at the threshold are this far apart along a direction, as a standard deviation.
    spread = (2 - 2 * cosine) ** 0.5 / sample.shape[1] ** 0.5
    share, made, leaves = total / max(len(sample), 1), [], 0
    for _ in range(trees):
        nodes, todo = [None], [(0, sample)]
        while todo:
            place, rows = todo.pop()
            if len(rows) * share <= leaf or len(rows) < FEWEST:
                nodes[place], leaves = leaves, leaves + 1
                continue
            ways = random.standard_normal((CHOICES, sample.shape[1]))
            ways /= np.linalg.norm(ways, axis=1, keepdims=True)
            along = rows @ ways.T
            best = int(along.std(axis=0).argmax())
            cut, margin = float(np.median(along[:, best])), SPILL * spread
            left, right = rows[along[:, best] <= cut + margin], rows[along[:, best] >= cut - margin]
            if len(left) == len(rows) or len(right) == len(rows):
                nodes[place], leaves = leaves, leaves + 1
                continue
            nodes[place] = (ways[best].astype(np.float32), cut, margin, len(nodes), len(nodes) + 1)
            nodes += [None, None]
            # The children are refitted without the spill, whose share would grow with every level.
            todo += [(nodes[place][3], rows[along[:, best] <= cut]), (nodes[place][4], rows[along[:, best] > cut])]
        made.append(nodes)
    return made


def leaves_of(forest, x):
    """The ascending leaf numbers of each unit vector."""
    found = [[] for _ in range(len(x))]
    for nodes in forest:
        todo = [(0, np.arange(len(x)))]
        while todo:
            place, rows = todo.pop()
            node = nodes[place]
            if not len(rows):
                continue
            if isinstance(node, int):
                for r in rows:
                    found[r].append(node)
                continue
            way, cut, margin, left, right = node
            along = x[rows] @ way
            todo += [(left, rows[along <= cut + margin]), (right, rows[along >= cut - margin])]
    return [sorted(f) for f in found]


def matrix(column):
    return np.array([np.asarray(v, dtype=np.float64) for v in column], dtype=np.float64)


def enter(forests):
    """Arrow batches of (id, copies, dim, v) with one more column of leaf numbers."""
    def run(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            vectors = batch.column(3).to_pylist()
            found = [[0]] * len(vectors)
            for dim in set(dims.tolist()) & set(forests.value):
                rows = np.flatnonzero(dims == dim)
                x = matrix([vectors[r] for r in rows])
                for r, f in zip(rows, leaves_of(forests.value[dim], (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)),
                                strict=True):
                    found[r] = f
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], [*batch.schema.names, "leaves"])
    return run


def spanning(linked):
    """A spanning forest, as pairs of rows, of a boolean matrix of links between left and right rows."""
    seen_left, pairs = np.zeros(linked.shape[0], bool), []
    seen_right = np.zeros(linked.shape[1], bool)
    for root in np.flatnonzero(linked.any(axis=1)):
        if seen_left[root]:
            continue
        seen_left[root], wave = True, np.array([root])
        while len(wave):
            fresh_right = []
            for r in wave:
                new = np.flatnonzero(linked[r] & ~seen_right)
                seen_right[new] = True
                pairs += [(r, c) for c in new]
                fresh_right.append(new)
            wave = []
            for c in np.concatenate(fresh_right):
                new = np.flatnonzero(linked[:, c] & ~seen_left)
                seen_left[new] = True
                pairs += [(r, c) for r in new]
                wave.append(new)
            wave = np.concatenate(wave) if wave else np.empty(0, np.int64)
    return pairs


def met_before(left, right, leaf):
    """Whether a left and a right row share a leaf before ``leaf``, from their leaf lists."""
    numbers = sorted({int(v) for row in left for v in row if v < leaf} & {int(v) for row in right for v in row if v < leaf})
    place = {v: i for i, v in enumerate(numbers)}

    def entries(rows):
        e = np.zeros((len(rows), max(len(numbers), 1)), np.float32)
        for i, row in enumerate(rows):
            e[i, [place[int(v)] for v in row if int(v) in place]] = 1
        return e
    return entries(left) @ entries(right).T > 0


def compare(cosine):
    """The links of one block of a leaf against another: (a, null, links) per vector, and (a, b, 0) of a spanning forest."""
    def run(rows):
        import pandas as pd

        leaf, own = int(rows["leaf"].iloc[0]), bool(rows["i"].iloc[0] == rows["j"].iloc[0])
        left = rows[rows["side"] == 0].reset_index(drop=True)
        right = left if own else rows[rows["side"] == 1].reset_index(drop=True)
        empty = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="Int64"), "w": pd.Series(dtype="int64")})
        if not len(left) or not len(right):
            return empty
        x, y = matrix(left["v"]), matrix(right["v"])
        linked = (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :]) >= cosine
        if own:
            np.fill_diagonal(linked, False)
        i, j = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        if not len(i):
            return empty
        linked = linked[np.ix_(i, j)]
        ids, others = left["id"].to_numpy()[i], right["id"].to_numpy()[j]
        edges = [(ids[r], others[c], 0) for r, c in spanning(linked)]
        new = linked & ~met_before(left["leaves"].iloc[i], right["leaves"].iloc[j], leaf)
        counts = [(ids, new @ right["copies"].to_numpy()[j])]
        if not own:
            counts.append((others, new.T @ left["copies"].to_numpy()[i]))
        rows = [(a, None, int(w)) for part, weights in counts for a, w in zip(part, weights, strict=True) if w] + edges
        return pd.DataFrame(rows, columns=["a", "b", "w"]).astype({"a": "int64", "b": "Int64", "w": "int64"})
    return run


def near_duplicates(vectors, cosine=0.95, trees=TREES, leaf=LEAF, block=BLOCK):
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    v = F.col("embedding")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) | ~F.exists(v, lambda e: e != 0)
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.coalesce(
        ~bad, F.lit(False)).alias("sound"), F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(7), v).alias("h2"))
    classes = settle(every.where(F.col("sound") & F.col("vec_id").isNotNull()).groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.size(F.first("v")).alias("dim"), F.first("v").alias("v")), "classes")
    forests = {}
    for row in classes.groupBy("dim").count().orderBy(F.desc("count")).limit(64).collect():
        rows = bounded_sample(classes.where(F.col("dim") == row["dim"]).select("v", "h1"), ["h1"],
                              max(256, min(SAMPLE, SAMPLE_NUMBERS // row["dim"])), row["count"])
        sample = matrix([r["v"] for r in rows])
        forests[row["dim"]] = fit(sample / np.linalg.norm(sample, axis=1, keepdims=True), row["count"], cosine, trees, leaf)
    shared = spark.sparkContext.broadcast(forests)
    kind = classes.schema["v"].dataType
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("copies", T.LongType()), T.StructField("dim", T.IntegerType()),
                           T.StructField("v", kind), T.StructField("leaves", T.ArrayType(T.IntegerType()))])
    entered = settle(classes.select("id", "copies", "dim", "v").mapInArrow(enter(shared), schema), "entered")
    sizes = settle(entered.select("dim", F.explode("leaves").alias("leaf")).groupBy("dim", "leaf").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks")), "leaves")
    each = entered.withColumn("leaf", F.explode("leaves")).join(sizes, ["dim", "leaf"])
    own = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    spread = each.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "copies", "v", "leaves", "dim", "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"))
    found = settle(spread.groupBy("dim", "leaf", "i", "j").applyInPandas(compare(cosine), "a long, b long, w long"), "found")
    links = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("links"))
    nodes = classes.select("id").distinct()
    named = components(nodes, found.where(F.col("b").isNotNull()).select("a", "b"))
    known = classes.select("h1", "h2", "id", "copies").join(links, "id", "left").join(named, "id").select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component")
    usable = F.col("sound") & F.col("vec_id").isNotNull()
    return every.drop("v").join(known, ["h1", "h2"], "left").select(
        "vec_id", F.when(usable, F.col("links")).otherwise(0).cast("long").alias("n_links"),
        F.when(usable, F.col("component")).otherwise(F.col("vec_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
