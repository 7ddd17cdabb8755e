"""Toxic spans by a linear-chain conditional random field.

A text is a chain of words with a hidden state each, clean or toxic. States are scored by hashed features of the word (itself, its
first and last letters, its look) and of its neighbours, and by the state before. The labels are of whole documents,
so the words of the fit are labelled from them: a word is toxic if it stands in a toxic document and it, or a beginning of
it, is significantly more frequent in toxic documents than in clean ones. The field is fitted on the likelihood of those states
(forward-backward, Adam over portions of the texts). A document's score comes from its marginals, the largest one and their sum, by a logistic curve
fitted on labelled documents the field has not seen, weighted back to the true share of toxic documents.

The fit sees at most ``SAMPLE`` labelled documents of each kind, chosen by hash (a documented bound), whole texts; no other
input but the text is used. Scoring is one pass over all documents in Arrow batches without a shuffle. Forward and backward
messages are products of 2 x 2 matrices, and a batch of texts is one long chain with breaks, so both are prefix products that
numpy takes over all words at once. Memory is bounded by ``WORDS_AT_ONCE`` words and the longest single text.

Null and empty texts have no words, hence no spans and the lowest score. Repeated rows score alike; labels of repeated ids
count once (toxic if any says so); labels of unknown ids and null labels are ignored. Without labels of both kinds every
score is the rate of the labels (0 without any). Spans are ``(start, end)`` code points, whole words, in order.
"""
import re
from array import array
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import WORD, bounded_sample, shipped
from postlens.scratch import settle

shipped(__name__)

SAMPLE, FIT_SHARE = 1_500, 4
BUCKETS, EPOCHS, LEAST_STEPS, RATE, RIDGE = 1 << 18, 5, 60, 0.15, 2e-3
LEAST_DOCS, LEAST_GAIN, LEAST_ODDS = 4, 20.0, 4.0
WORDS_KEPT, WORDS_AT_ONCE, WORDS_A_STEP = 200_000, 200_000, 50_000
EDGES = ".,;:!?\"'()[]{}*#$%&|<>"
KINDS = ("own", "before", "after")


def pieces(word):
    """What of a word may mark it as toxic: the word without edge signs, and its beginnings."""
    bare = word.lower().strip(EDGES) or word
    return [bare, *[f"{bare[:k]}-" for k in (3, 4, 5, 6) if len(bare) > k]]


def features(word):
    """Hashed features of a word."""
    bare = word.lower().strip(EDGES)
    look = (word.isupper(), word[0].isupper(), word[-1] in EDGES, len(bare) > 8, not word.isalpha())
    names = [*pieces(word), f"-{bare[-3:]}", f"={look}", "*"]
    return [crc32(n.encode("utf-8", "replace")) % BUCKETS for n in names]


class Lexicon(dict):
    """Numbers of words, and the features of each in growing flat arrays."""

    def __init__(self):
        self.flat, self.ends = array("l"), array("l", [0])

    def __missing__(self, word):
        self[word] = n = len(self)
        self.flat.extend(features(word))
        self.ends.append(len(self.flat))
        return n

    def numbers(self, words):
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def matrix_product(x, y):
    """Products of 2 x 2 matrices given as four arrays of entries each, scaled to a largest entry of 1."""
    a, b, c, d = x[0] * y[0] + x[1] * y[2], x[0] * y[1] + x[1] * y[3], x[2] * y[0] + x[3] * y[2], x[2] * y[1] + x[3] * y[3]
    return np.stack([a, b, c, d]) / np.maximum(np.maximum(a, b), np.maximum(c, d))


def prefix_products(m):
    """Running products ``m[:, 0] @ ... @ m[:, i]`` of 2 x 2 matrices (four rows of entries), each scaled.

    Cut into pieces of about the square root of the length: products inside all pieces at once, then over the pieces.
    """
    n = m.shape[1]
    if n == 1:
        return m / m.max()
    wide = int(np.sqrt(n)) + 1
    high = -(-n // wide)
    full = np.zeros((4, high * wide))
    full[0], full[3] = 1, 1
    full[:, :n] = m
    steps = np.ascontiguousarray(full.reshape(4, high, wide).transpose(2, 0, 1))
    for j in range(1, wide):
        steps[j] = matrix_product(steps[j - 1], steps[j])
    if high > 1:
        starts = prefix_products(np.ascontiguousarray(steps[-1]))[:, :-1]
        steps[:, :, 1:] = matrix_product(starts[:, None, :], steps[:, :, 1:].transpose(1, 0, 2)).transpose(1, 0, 2)
    return steps.transpose(1, 2, 0).reshape(4, -1)[:, :n]


def marginals(emission, breaks, transition, start, edges=False):
    """Probability of the toxic state for each word; ``breaks`` says which words begin a text.

    ``emission`` is how much the score of the toxic state exceeds that of the clean one. With ``edges``, also the summed
    marginals of the pairs of neighbours inside texts.
    """
    n = len(emission)
    if not n:
        return np.zeros(0)
    toxic = np.exp(np.clip(emission, -30, 30))
    step, first = (np.exp(np.maximum(x - x.max(), -30)) for x in (transition, start))
    move = np.where(breaks, np.tile(first, 2)[:, None], step.reshape(4, 1))
    m = move * np.stack([np.ones(n), toxic] * 2)
    forward = prefix_products(m)[:2]
    forward = forward / forward.sum(axis=0)
    # What follows word i: the product of all later matrices on a vector of ones; a break makes both states alike.
    back = np.ones((2, n))
    if n > 1:
        later = prefix_products(np.ascontiguousarray(m[[0, 2, 1, 3], :0:-1]))[:, ::-1]
        back[:, :-1] = later[:2] + later[2:]
    both = forward * back
    p = both[1] / both.sum(axis=0)
    if not edges:
        return p
    inner = np.flatnonzero(~breaks[1:])
    pair = forward[[0, 0, 1, 1]][:, inner] * m[:, inner + 1] * back[[0, 1, 0, 1]][:, inner + 1]
    return p, (pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2)


def emissions(numbers, breaks, tables):
    """Scores of the toxic state of every word from its own and its neighbours' features."""
    own, before, after = tables
    out = own[numbers]
    inner = ~breaks[1:]
    out[1:] += before[numbers[:-1]] * inner
    out[:-1] += after[numbers[1:]] * inner
    return out


def word_tables(weights, flat, ends):
    """Sums of the weights of each word's features: one row for each place the word can have."""
    return np.add.reduceat(weights[:, flat], ends[:-1], axis=1) if len(flat) else np.zeros((len(KINDS), 0))


def chain(texts):
    """Words of all texts and where each text begins."""
    found = [re.findall(WORD, t or "") for t in texts]
    words = [w for ws in found for w in ws]
    breaks = np.zeros(len(words), bool)
    lengths = np.array([len(ws) for ws in found], np.int64)
    starts = np.cumsum(lengths) - lengths
    breaks[starts[lengths > 0]] = True
    return words, breaks, lengths


def toxic_words(texts, labels):
    """Words and beginnings of words that toxic texts have significantly more often (log-likelihood ratio and odds)."""
    def count(kind, among=None):
        found = Counter()
        for text, label in zip(texts, labels, strict=True):
            if bool(label) == kind:
                found.update({p for w in set(re.findall(WORD, text)) for p in pieces(w) if among is None or p in among})
        return found

    def gain(a, b):
        whole = (a + b) / sum(sizes)
        return 2 * sum(k * np.log(k / (n * whole)) for k, n in ((a, sizes[1]), (b, sizes[0])) if k)

    sizes = [max(1, sum(1 for y in labels if bool(y) == k)) for k in (False, True)]
    toxic = {p: n for p, n in count(True).items() if n >= LEAST_DOCS}
    clean = count(False, toxic)
    return {p for p, a in toxic.items() if (a + .5) / sizes[1] >= LEAST_ODDS * (clean[p] + .5) / sizes[0] and gain(a, clean[p]) >= LEAST_GAIN}


def portions(texts, labels, lexicon):
    """The words of the texts as numbers, in portions of about ``WORDS_A_STEP``: (numbers, breaks, whether in a toxic text)."""
    held, ys, size = [], [], 0
    for k, i in enumerate(sorted(range(len(texts)), key=lambda i: (crc32(texts[i].encode("utf-8", "replace")), i))):
        held.append(texts[i])
        ys.append(labels[i])
        size += len(texts[i])
        if size >= 6 * WORDS_A_STEP or k == len(texts) - 1:
            words, breaks, lengths = chain(held)
            if words:
                yield lexicon.numbers(words), breaks, np.repeat(np.array(ys, bool), lengths)
            held, ys, size = [], [], 0


def slopes(weights, transition, start, portion, bad, flat, ends):
    """Gradient of the log-likelihood of a portion's word states, per toxic word."""
    numbers, breaks, toxic = portion
    state = bad[numbers] & toxic
    used, place = np.unique(numbers, return_inverse=True)
    sizes = ends[used + 1] - ends[used]
    firsts = np.cumsum(sizes) - sizes
    near = flat[np.repeat(ends[used] - firsts, sizes) + np.arange(sizes.sum())]
    p, pairs = marginals(emissions(place, breaks, word_tables(weights, near, np.append(firsts, len(near)))), breaks, transition, start, True)
    rest, inner, owner = state - p, ~breaks[1:], np.repeat(np.arange(len(used)), sizes)
    by_word = [np.bincount(place, r, len(used)) for r in (rest, np.append(rest[1:] * inner, 0.0), np.insert(rest[:-1] * inner, 0, 0.0))]
    seen = np.bincount(2 * state[:-1][inner] + state[1:][inner], minlength=4).reshape(2, 2)
    begun, expected, scale = np.bincount(state[breaks].astype(int), minlength=2), p[breaks].sum(), max(1, state.sum())
    return [np.stack([np.bincount(near, g[owner], BUCKETS) for g in by_word]) / scale, (seen - pairs) / scale,
            (begun - np.array([breaks.sum() - expected, expected])) / scale]


def fit_field(texts, labels):
    """``(weights, transition, start)`` of the field on word states drawn from the labels of the texts."""
    marked, lexicon = toxic_words(texts, labels), Lexicon()
    parts = list(portions(texts, labels, lexicon))
    bad = np.array([any(p in marked for p in pieces(w)) for w in lexicon], bool)
    flat, ends = np.array(lexicon.flat), np.array(lexicon.ends)
    params = [np.zeros((len(KINDS), BUCKETS)), np.zeros((2, 2)), np.zeros(2)]
    if not bad.any():
        return params[0], params[1], np.array([0.0, -10.0])
    first, second = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    steps = max(EPOCHS * len(parts), LEAST_STEPS)
    for t in range(1, steps + 1):
        found = slopes(*params, parts[t % len(parts)], bad, flat, ends)
        found[0] -= RIDGE * params[0]
        rate = RATE * (1 - 0.9 * t / steps)
        for x, g, a, b in zip(params, found, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            x += rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
    return tuple(params)


class Field:
    """The fitted field with its words kept between batches."""

    def __init__(self, weights, transition, start):
        self.weights, self.transition, self.start = weights, transition, start
        self.lexicon, self.tables = Lexicon(), np.zeros((len(KINDS), 0))

    def marginals(self, texts):
        """Per text, the probability of the toxic state for each of its words."""
        words, breaks, lengths = chain(texts)
        if len(self.lexicon) > WORDS_KEPT:
            self.lexicon, self.tables = Lexicon(), np.zeros((len(KINDS), 0))
        lexicon, known = self.lexicon, len(self.lexicon)
        numbers = lexicon.numbers(words)
        start = lexicon.ends[known]
        fresh = word_tables(self.weights, np.array(lexicon.flat[start:], np.int64), np.array(lexicon.ends[known:]) - start)
        self.tables = np.concatenate([self.tables, fresh], axis=1)
        p = marginals(emissions(numbers, breaks, self.tables), breaks, self.transition, self.start) if words else np.zeros(0)
        return np.split(p, np.cumsum(lengths)[:-1])


def evidence(p):
    """What a document's score is made of: its most toxic word and the number of toxic words expected."""
    top = min(max(float(p.max()), 1e-6), 1 - 1e-6) if len(p) else 1e-6
    return [np.log(top / (1 - top)), np.log1p(float(p[p >= 0.05].sum())) if len(p) else 0.0, 1.0]


def fit_curve(rows, labels, weights):
    """Logistic weights of the evidence, by Newton's method with a small ridge."""
    x, y, w = np.array(rows), np.array(labels, float), np.array(weights, float)
    found, penalty = np.zeros(x.shape[1]), np.array([0.1, 0.1, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (w * (y - p)) - penalty * found)
        found = found + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return np.append(np.maximum(found[:2], 0), found[2])


def fit(docs, labels, sample=SAMPLE):
    """``(field, curve)`` from labelled documents; the curve is None, and the field a rate, without both kinds."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("y"))
    known = settle(docs.select("doc_id").distinct().join(known, "doc_id"), "labelled")
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return float(next(iter(sizes), False)), None
    drawn = [(r["doc_id"], y) for y in (False, True) for r in bounded_sample(known.where(F.col("y") == y), ["doc_id"], sample, sizes[y])]
    chosen = docs.select("doc_id", "text").join(F.broadcast(docs.sparkSession.createDataFrame(drawn, "doc_id long, y boolean")), "doc_id")
    rows = chosen.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("y").alias("y")).orderBy("doc_id").collect()
    texts, ys = [r["text"] or "" for r in rows], [r["y"] for r in rows]
    keep = [crc32(t.encode("utf-8", "replace")) % FIT_SHARE != 0 for t in texts]
    seen, unseen = [i for i, k in enumerate(keep) if k], [i for i, k in enumerate(keep) if not k]
    if len({ys[i] for i in seen}) < 2 or len({ys[i] for i in unseen}) < 2:
        seen = unseen = range(len(texts))
    field = fit_field([texts[i] for i in seen], [ys[i] for i in seen])
    rows = [evidence(p) for p in Field(*field).marginals([texts[i] for i in unseen])]
    drawn = Counter(ys)
    return field, fit_curve(rows, [ys[i] for i in unseen], [sizes[ys[i]] / drawn[ys[i]] for i in unseen])


def score(docs, model, text="text"):
    """``docs`` with a struct column ``toxicity`` (in place of one of that name): score, n_toxic (words of a marginal of 0.5
    or more) and their spans."""
    docs = docs.drop("toxicity")
    field, curve = model
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    kind = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("n_toxic", T.LongType()), T.StructField("spans", span)])
    if curve is None:
        return docs.withColumn("toxicity", F.struct(F.lit(field).alias("score"), F.lit(0).cast("long").alias("n_toxic"), F.array().cast(span).alias("spans")))
    shared = docs.sparkSession.sparkContext.broadcast((field, curve))

    def spans(content, p):
        """Runs of toxic words as offsets in the text."""
        out = []
        if len(p) and p.max() >= 0.5:
            last = False
            for word, toxic in zip(re.finditer(WORD, content), p >= 0.5, strict=True):
                if toxic and last:
                    out[-1]["end"] = word.end()
                elif toxic:
                    out.append({"start": word.start(), "end": word.end()})
                last = toxic
        return out

    def batches(source):
        (weights, transition, start), curve = shared.value
        chains = Field(weights, transition, start)
        for batch in source:
            column, found, at = batch.column(batch.schema.get_field_index(text)), [], 0
            while at < batch.num_rows:
                texts, size = [], 0
                while at < batch.num_rows and size < WORDS_AT_ONCE * 6:
                    texts.append(column[at].as_py() or "")
                    size += len(texts[-1])
                    at += 1
                for content, p in zip(texts, chains.marginals(texts), strict=True):
                    z = float(np.dot(evidence(p), curve))
                    found.append({"score": float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), "n_toxic": int((p >= 0.5).sum()), "spans": spans(content, p)})
            kinds = pa.struct([("score", pa.float64()), ("n_toxic", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kinds)], [*batch.schema.names, "toxicity"])
    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, T.StructField("toxicity", kind)]))
