"""MinHash near-duplicates with HyperMinHash registers.

A text is lower-cased (A-Z) and cut into words (runs of other characters than ASCII white space); its set is that of its
five-word shingles as 64-bit hashes (fewer words: the whole sequence as one). Texts with equal sets form one class at
once. Every class gets ``BANDS * ROWS`` registers: hashes are dealt to buckets and a register keeps of its smallest hash the
number of leading zeros and ``MANTISSA`` bits after them (Yu & Weber, 2017). Small sets use more hash functions with
fewer buckets each, so registers are seldom empty; the size class decides, and sets near a class border are entered in both.

Classes that share a band of registers are candidates. Stars come first: in every band bucket each member is paired with
the member that shares most buckets. Pairs whose collision-corrected Jaccard estimate is within five standard errors of the threshold are
confirmed on their full sets. Buckets that still hold more than one component then have all pairs between components
estimated and confirmed. In large buckets that happens block against block inside tasks, which give a spanning forest of
the links they find, so no pairs are listed and no link that decides a component is skipped. A pair at the threshold shares no band with probability (1 - t**ROWS)**BANDS,
7e-9 at 0.85.

Classes are numbered in the order of their smallest id, so an id whose rows hold different texts is in several classes.
Null or blank texts have empty sets and link with nothing; rows without id are not linked either. Rows with the same id
are one node of the components; rows are dropped by their text's own class, so an id's other texts stay. Whole texts are used, read in pieces. Repeated rows share a class; an empty table gives no rows. Other columns are ignored.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from postlens.llm.common import components, fresh, running, shipped
from postlens.llm.forest import spanning
from postlens.scratch import settle

shipped(__name__)

WORDS, BANDS, ROWS, MANTISSA = 5, 32, 5, 10
LOAD, PIECE, SMALL, BLOCK, COLUMNS, EMPTY = 24, 1 << 20, 64, 512, 1 << 16, 65535
U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
TABLES: dict = {}

SKETCH = ("doc_id long, text_key long, n long, s1 long, s2 long, levels array<int>, regs array<binary>, keys array<long>")


def mix(x):
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def salts(n, start):
    return mix(np.arange(1, n + 1, dtype=U) * U(BASE) + U(start))


def powers(n):
    """Powers of the base and of its inverse modulo 2**64."""
    if len(TABLES.get("up", ())) < n:
        size = max(n, PIECE + 4096)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            table = np.full(size, base, dtype=U)
            table[0] = 1
            TABLES[name] = np.multiply.accumulate(table)
    return TABLES["up"], TABLES["down"]


def word_hashes(raw, starts):
    """Hash and place of each word in bytes that hold texts beginning at ``starts``."""
    if not len(raw):
        return np.empty(0, U), np.empty(0, np.int64)
    up, down = powers(len(raw))
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = starts[starts < len(raw)]
    first[begins] = word[begins]
    last = word.copy()
    last[:-1] &= ~word[1:] | first[1:]
    i, j = np.flatnonzero(first), np.flatnonzero(last)
    low = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    terms = (low.astype(U) + U(1)) * up[:len(raw)]
    sums = np.cumsum(terms, dtype=U)
    found = (sums[j] - sums[i] + terms[i]) * down[i]
    return mix(found + (j - i + 1).astype(U) * U(0xD6E8FEB86659FD93)), i


def shingles(words):
    """The distinct shingle hashes of a text's word hashes, in order."""
    n = len(words)
    if n == 0:
        return words
    factors = salts(WORDS, 11) | U(1)
    if n < WORDS:
        return mix(np.array([(words * factors[:n]).sum(dtype=U)], dtype=U) + U(n) * salts(1, 12))
    total = words[:n - WORDS + 1] * factors[0]
    for k in range(1, WORDS):
        total = total + words[k:n - WORDS + 1 + k] * factors[k]
    return np.unique(mix(total))


def pieces(raw):
    """Cuts of a long text at white space, about every ``PIECE`` bytes."""
    at = 0
    while at < len(raw):
        end = at + PIECE
        while end < len(raw) and not (raw[end] == 32 or 9 <= raw[end] <= 13):
            end += 1
        yield raw[at:end]
        at = end


def sets_of(column):
    """The shingle set of each text of an Arrow column."""
    column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    n = len(column)
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int32)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < n:
        to = at + 1
        while to < n and ends[to + 1] - ends[at] <= PIECE:
            to += 1
        part = raw[ends[at]:ends[to]]
        if to == at + 1:
            hashes = [word_hashes(p, np.zeros(1, np.int64))[0] for p in pieces(part)]
            yield shingles(np.concatenate(hashes) if hashes else np.empty(0, U))
        else:
            starts = (ends[at:to] - ends[at]).astype(np.int64)
            hashes, places = word_hashes(part, starts)
            cut = np.searchsorted(places, np.append(starts, len(part)))
            for k in range(to - at):
                yield shingles(hashes[cut[k]:cut[k + 1]])
        at = to


def level_of(n):
    """Binary logarithm of the bands one hash function fills."""
    return min(max(int(np.log2(max(n, 1) / LOAD)) if n >= LOAD else 0, 0), int(np.log2(BANDS)))


def registers(values, level):
    """All registers of a set at a level: leading zeros and mantissa of the smallest hash of each bucket."""
    per_seed = ROWS << level
    seeds = BANDS >> level
    borders = np.array([-(-(i << 64) // per_seed) for i in range(per_seed)], dtype=U)
    found = np.full((seeds, per_seed), EMPTY, np.uint16)
    for s, salt in enumerate(salts(seeds, 1000 + level)):
        x = np.sort(mix(values ^ salt))
        at = np.searchsorted(x, borders)
        full = np.append(at[1:], len(x)) > at
        rest = (x[at[full]] - borders[full]).astype(np.float64) * per_seed + 1.0
        mantissa, exponent = np.frexp(rest)
        zeros = np.clip(64 - exponent, 0, 62)
        found[s, full] = (zeros << MANTISSA) + ((mantissa * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return found.ravel()


def band_keys(regs, level):
    """One key for each band with at least one register filled."""
    bands = regs.reshape(BANDS, ROWS).astype(U)
    keys = salts(BANDS, 5000 + level)
    for k in range(ROWS):
        keys = mix(keys * U(BASE) + bands[:, k])
    return keys[(bands != EMPTY).any(axis=1)]


def sketch_batches(percent):
    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = []
                for doc_id, key, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sets_of(batch.column(2)),
                                               strict=True):
                    n = len(values)
                    levels = sorted({level_of(n), level_of(n * 100 // percent)}) if n else []
                    regs = [registers(values, v) for v in levels]
                    keys = np.concatenate([band_keys(r, v) for r, v in zip(regs, levels, strict=True)]) if n else np.empty(0, U)
                    digest = [int(mix(values ^ s).sum(dtype=U).astype(np.int64)) for s in salts(2, 77)]
                    rows.append((doc_id, key, n, *digest, levels, [r.tobytes() for r in regs], keys.view(np.int64)))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 8
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 ["doc_id", "text_key", "n", "s1", "s2", "levels", "regs", "keys"])
    return run


def estimate(a, b, size_a, size_b):
    """Jaccard estimate from two register arrays, corrected for registers that agree by chance, and its standard error."""
    filled = (a != EMPTY) | (b != EMPTY)
    n = max(int(filled.sum()), 1)
    ratio = max(size_a, size_b) / max(min(size_a, size_b), 1)
    chance = 0.1699 / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return ((a == b) & filled).sum() / n, chance, n


def likely(share, chance, n, percent):
    t = percent / 100
    return (share - chance) / (1 - chance) >= t - 5 * (t * (1 - t) / n) ** 0.5


def estimate_batches(percent):
    """Pairs with both sketches to the pairs whose estimate is near the threshold or above."""
    def one(na, nb, la, lb, ra, rb):
        if 100 * min(na, nb) < percent * max(na, nb):
            return False
        for v in set(la) & set(lb):
            a, b = (np.frombuffer(r[levels.index(v)], np.uint16) for r, levels in ((ra, la), (rb, lb)))
            if likely(*estimate(a, b, na, nb), percent):
                return True
        return False

    def run(batches):
        for batch in batches:
            c = batch.to_pydict()
            keep = [one(*x) for x in zip(c["na"], c["nb"], c["la"], c["lb"], c["ra"], c["rb"], strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def confirm_batches(percent):
    """Pairs with both texts to the pairs whose sets reach the threshold."""
    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                keep = []
                for x, y in zip(sets_of(batch.column(2)), sets_of(batch.column(3)), strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def overlaps(left, right):
    """Sizes of the intersections of two lists of sets: products of 0/1 matrices over the hashes that occur more than once."""
    values, counts = np.unique(np.concatenate([*left, *right]), return_counts=True)
    shared, total = values[counts > 1], np.zeros((len(left), len(right)), np.float64)
    for start in range(0, len(shared), COLUMNS):
        part = shared[start:start + COLUMNS]

        def entries(sets, part=part):
            table = np.zeros((len(sets), len(part)), np.float32)
            for row, values in enumerate(sets):
                at = np.minimum(np.searchsorted(part, values), len(part) - 1)
                table[row, at[part[at] == values]] = 1
            return table
        total += entries(left) @ entries(right).T
    return total


def block_links(percent):
    """One block of a large bucket against another: a spanning forest of the links between different components.

    Estimates say which rows are worth a comparison; those are compared on their full sets.
    """
    def run(rows):
        import pandas as pd

        own = bool((rows["i"] == rows["j"]).all())
        left = rows[rows["side"] == 0].reset_index(drop=True)
        right = left if own else rows[rows["side"] == 1].reset_index(drop=True)
        worth = np.zeros((len(left), len(right)), bool)
        for v in sorted({v for levels in rows["levels"] for v in levels}):
            def matrix(part, v=v):
                chosen = np.array([k for k, x in enumerate(part["levels"]) if v in set(x)], dtype=int)
                regs = [np.frombuffer(part["regs"][k][list(part["levels"][k]).index(v)], np.uint16) for k in chosen]
                return chosen, np.array(regs, np.uint16).reshape(len(chosen), BANDS * ROWS)
            (at, x), (other, y) = matrix(left), matrix(right)
            t = percent / 100
            for k in range(len(at)):
                filled = (x[k] != EMPTY) | (y != EMPTY)
                n = np.maximum(filled.sum(axis=1), 1)
                share = ((x[k] == y) & filled).sum(axis=1) / n
                worth[at[k], other] |= share >= t - 5 * np.sqrt(t * (1 - t) / n)
        worth &= left["comp"].to_numpy()[:, None] != right["comp"].to_numpy()[None, :]
        i, j = np.flatnonzero(worth.any(axis=1)), np.flatnonzero(worth.any(axis=0))
        edges = []
        if len(i):
            with np.errstate(over="ignore"):
                a, b = (list(sets_of(pa.array(list(part["text"].iloc[at]), pa.string()))) for part, at in ((left, i), (right, j)))
            both = overlaps(a, b)
            sizes = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :]
            linked = worth[np.ix_(i, j)] & (100 * both >= percent * (sizes - both))
            ids, others = left["id"].to_numpy()[i], right["id"].to_numpy()[j]
            edges = [(ids[r], others[c]) for r, c in spanning(linked)]
        return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")
    return run


def sketches(docs, percent):
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text"))
    return slim.mapInArrow(sketch_batches(percent), SKETCH)


def texts_of(ids, classes, docs):
    """``(id, text)`` of the classes in ``ids``."""
    wanted = ids.distinct().join(classes.select("id", "first", "text_key"), "id")
    return docs.select(F.col("doc_id").cast("long").alias("first"), F.xxhash64("text").alias("text_key"), "text").join(
        wanted, ["first", "text_key"]).groupBy("id").agg(F.first("text").alias("text"))


def confirmed(pairs, classes, docs, percent):
    """The pairs (a, b) of classes that reach the threshold: first by estimate, then on whole texts."""
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("levels").alias(f"l{side}"),
                                          F.col("regs").alias(f"r{side}")), side)
    likely_pairs = settle(pairs.select("a", "b", "na", "nb", "la", "lb", "ra", "rb").mapInArrow(
        estimate_batches(percent), "a long, b long"), "likely")
    texts = settle(texts_of(likely_pairs.select(F.explode(F.array("a", "b")).alias("id")), classes, docs), "texts")
    both = likely_pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    return settle(both.mapInArrow(confirm_batches(percent), "a long, b long"), "edges")


def ordered_pairs(x, y):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def class_components(docs, percent):
    """One row per document: doc_id, text_key, n, the number of its class, the smallest one linked to it, and that one's smallest id."""
    every = settle(sketches(docs, percent), "sketches")
    sets = settle(every.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("s1", "s2").agg(
        F.min("doc_id").alias("first"), F.min_by("text_key", "doc_id").alias("text_key"),
        *[F.first(c).alias(c) for c in ("n", "levels", "regs", "keys")]), "sets")
    numbers = settle(running(sets.select("first", "s1", "s2"), ["first", "s1", "s2"]).withColumnRenamed("row_before", "id"), "numbers")
    classes = settle(sets.join(numbers.select("s1", "s2", "id"), ["s1", "s2"]), "classes")
    # Smaller sets reach the threshold only if they are equal, and then they are one class.
    bands = classes.where(F.col("n") * (100 - percent) >= percent).select("id", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > 1)
    members = settle(bands.join(shared, "key"), "members")
    weight = members.groupBy("id").agg(F.sum("m").alias("weight"))
    hubs = members.join(weight, "id").groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("id"))).alias("top")).select(
        "key", (-F.col("top.id")).alias("hub"))
    stars = settle(members.join(hubs, "key").where(F.col("id") != F.col("hub")).select(
        *ordered_pairs(F.col("id"), F.col("hub"))).distinct(), "stars")
    edges = confirmed(stars, classes, docs, percent)
    nodes = classes.select("id").distinct()
    found = settle(components(nodes, edges), "components")

    # Buckets that still hold several components: every pair between components that is not tried yet.
    placed = members.join(found, "id")
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    rest = settle(placed.join(mixed, "key").select("key", "id", "m", F.col("component").alias("comp")), "mixed")
    small, large = rest.where(F.col("m") <= SMALL), rest.where(F.col("m") > SMALL)
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id"))
                   & (F.col("x.comp") != F.col("y.comp"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    more = settle(pairs.distinct().join(stars, ["a", "b"], "left_anti"), "more")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    spread = large.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "key", "id", "comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"))
    wide = spread.join(classes.select("id", "levels", "regs"), "id").join(
        settle(texts_of(large.select("id"), classes, docs), "texts"), "id")
    links = settle(wide.groupBy("key", "i", "j").applyInPandas(block_links(percent), "a long, b long"), "links")
    found = settle(components(nodes, edges.unionByName(confirmed(more, classes, docs, percent)).unionByName(links)), "components")
    leads = numbers.join(found, "id").join(numbers.select(F.col("id").alias("component"), F.col("first").alias("lead")), "component")
    return every.select("doc_id", "text_key", "n", "s1", "s2").join(
        leads.select("s1", "s2", "id", "component", "lead"), ["s1", "s2"], "left").select(
        "doc_id", "text_key", "n", *[F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col(c)).alias(c)
                                     for c in ("id", "component", "lead")])


def near_duplicates(docs, percent=80):
    """One row per document: doc_id, n_shingles, component_id and kept; ``percent`` is the threshold on the Jaccard index."""
    named = settle(class_components(docs, percent).select("doc_id", "n", F.coalesce("lead", "doc_id").alias("lead")), "named")
    # An id with texts of several components makes them one.
    several = named.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("lead").alias("lo"), F.max("lead").alias("hi")).where("lo < hi")
    ties = settle(named.join(several.select("doc_id"), "doc_id", "left_semi").select("doc_id", "lead").distinct(), "ties")
    joined = components(ties.select("lead").distinct(), ties.select(F.col("doc_id").alias("a"), F.col("lead").alias("b")), "lead")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "lead"))
    return named.join(joined, "lead", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs, percent=80):
    """One document of each group of linked texts, with its own columns: of the smallest id's. Of rows that repeat id and text one stays."""
    judged = settle(class_components(docs, percent).where("id IS NOT NULL").groupBy("doc_id", "text_key").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("id", "component", "lead")]), "judged")
    stay = settle(judged.where("id = component AND doc_id = lead").groupBy("doc_id", "id").agg(
        F.min("text_key").alias("text_key")), "stay").select("doc_id", "text_key")
    key, text_key = fresh(docs, "gone"), fresh(docs, "gone_text")

    def listed(rows):
        return settle(rows.select(F.col("doc_id").alias(key), F.col("text_key").alias(text_key)), "listed")
    same = (F.col("doc_id") == F.col(key)) & (F.xxhash64("text") == F.col(text_key))
    left = docs.join(listed(judged.join(stay, ["doc_id", "text_key"], "left_anti")), same, "left_anti")
    again = listed(judged.where("n > 1").join(stay, ["doc_id", "text_key"], "left_semi"))
    if not again.limit(1).count():
        return left
    return left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
