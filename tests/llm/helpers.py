"""Small tables with every odd case, and brute-force versions of the measures."""
import itertools
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, mark long, row long, d1 long, quality int, part0 int"
SF = "/root/testdata/sf0.001"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    return re.findall(f"[^{SPACES}]+", text or "")


def docs_of(spark, rows):
    """Rows of (doc_id, text, source) with language, a length and columns whose names clash with the operators' own."""
    full = [(i, t, "en" if s else None, s, None if t is None else len(t), 1, 2, 3, 4, 5, 6) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def edge_rows():
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
    plain = "the cat and the dog went to the river on a cold day in may and it was good for them"
    return [(1, plain, "a"), (2, plain, "a"), (2, plain, "a"), (3, None, "b"), (4, "", "b"), (5, " \t\n ", None), (6, long, "c"),
            (7, long + " tail", "c"), (8, "one", None), (9, "ONE two Three four", "a"), (None, plain, "a"), (10, None, None),
            (11, "é ü 漢字 😀 the İ K ß   x", "b"), (12, "a b c d e f " * 40, "d"), (13, "x" * 5000, "d")]


def shingle_set(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near_components(rows, percent):
    """{doc_id: (n_shingles, component)} by comparing all pairs of sets."""
    sets = {}
    for i, text, *_ in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingle_set(text))
    links = []
    for (i, xs), (j, ys) in itertools.combinations(sets.items(), 2):
        if any(100 * len(x & y) >= percent * len(x | y) and x for x in xs for y in ys):
            links.append((i, j))
    found = components(sets, links)
    return {i: (len(xs[0]), found[i]) for i, xs in sets.items()}
