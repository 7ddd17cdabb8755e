"""Quality by hierarchical empirical Bayes.

A logistic classifier over the native text measures gives each document its own evidence. The table has no URLs, so its source
is the site and the language stands in for the path inside the site. A site's rate of good documents (labels where there are,
else the classifier's probability) is shrunk toward the global rate, a path's rate toward its site's posterior; how strongly is
estimated from the spread of the rates (method of moments), so a site with few documents stays near the prior. A document's own
share is left out of the three rates it is judged by. Its posterior is its own odds with the global prior odds replaced
by those of its path.

Fitted on at most ``SAMPLE`` labelled documents, chosen by hash (a documented bound); rates cover all documents. Null sites and
languages are groups of their own; null texts are empty; labels of a repeated id are averaged. Without labels of both kinds
every document gets the rate of the labels (0.5 without any). Other columns are ignored; repeated rows score alike.
"""
import numpy as np
from pyspark.sql import functions as F

from postlens.llm.common import bounded_sample
from postlens.llm.quality_rules import judge
from postlens.scratch import settle

SAMPLE, RIDGE, KEEP_FROM = 20_000, 1.0, 0.5
TINY = 1e-6


def features(m):
    """Bounded features of the struct of measures."""
    words, lines = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["n_lines"], F.lit(1))
    return [F.least(F.log(m["n_words"] + 1.0) / 10, F.lit(2.0)), F.least(m["word_chars"] / words / 10, F.lit(5.0)),
            F.least(m["n_symbols"] / words, F.lit(2.0)), F.least(m["n_letterless"] / words, F.lit(1.0)),
            m["n_stop_words"] / words, m["n_repeat_words"] / words, m["n_dup_lines"] / lines, m["n_bullet_lines"] / lines,
            F.least(F.log(words / lines) / 5, F.lit(2.0)), (m["n_words"] < 10).cast("double"),
            (m["n_symbols"] > words * 0.1).cast("double"), (m["n_repeat_words"] > words * 0.2).cast("double")]


def fit(rows, ridge=RIDGE):
    """Weights (the last is the intercept) of a ridge logistic regression by Newton's method; None with a single class."""
    y = np.array([r[1] for r in rows], dtype=float)
    if len(y) == 0 or y.min() == y.max():
        return None
    x = np.array([[*r[0], 1.0] for r in rows], dtype=float)
    weights, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return [float(w) for w in weights]


def logit(p):
    safe = F.greatest(F.least(p, F.lit(1 - TINY)), F.lit(TINY))
    return F.log(safe / (1 - safe))


def strength(groups, rate, prior):
    """Pseudo-documents a prior counts for: what its variance leaves of the binomial spread of the groups' rates."""
    spread = F.sum(F.col("n") * (rate - prior) ** 2) / F.sum("n")
    noise = F.sum(prior * (1 - prior)) / F.sum("n")
    row = groups.agg(spread.alias("spread"), noise.alias("noise"), (F.sum(F.col("n") * prior * (1 - prior)) / F.sum("n")).alias("v")).first()
    if row["spread"] is None or not row["v"]:
        return 1.0
    return float(min(max(row["v"] / max(row["spread"] - row["noise"], 1e-9) - 1, 1.0), 1e6))


def score(docs, labels, sample=SAMPLE, keep_from=KEEP_FROM):
    """One row per document: doc_id, source, lang, doc_score, site_score, path_score, score, kept."""
    measured = judge(docs, name="m", columns=["doc_id", "source", "lang"])
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("label"))
    slim = settle(measured.select("doc_id", "source", "lang", F.array(*features(F.col("m"))).alias("x")), "features")
    slim = settle(slim.join(known, "doc_id", "left"), "features")
    labelled = slim.where(F.col("label").isNotNull()).select("doc_id", "x", "label")
    rows = bounded_sample(labelled, ["doc_id"], sample, labelled.count())
    weights = fit([(r["x"], float(r["label"] >= 0.5)) for r in rows])
    rate = sum(r["label"] for r in rows) / len(rows) if rows else 0.5
    z = F.lit(float(np.log(max(rate, TINY) / max(1 - rate, TINY)))) if weights is None else sum(
        (F.get("x", F.lit(i)) * w for i, w in enumerate(weights[:-1])), F.lit(weights[-1]))
    judged = settle(slim.select("doc_id", "source", "lang", "label", (1 / (1 + F.exp(-z))).alias("doc_score")), "judged")

    paths = settle(judged.groupBy("source", "lang").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("label", "doc_score")).alias("good")), "paths")
    sites = paths.groupBy("source").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    whole = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    prior = F.lit(float(whole["good"] / whole["n"]) if whole["n"] else 0.5)
    weight = strength(sites, F.col("good") / F.col("n"), prior)
    sites = sites.select(F.col("source").alias("s"), F.col("n").alias("site_n"), F.col("good").alias("site_good"))
    nested = settle(paths.join(sites, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "paths")
    site_rate = (F.col("site_good") + weight * prior) / (F.col("site_n") + weight)
    path_weight = strength(nested, F.col("good") / F.col("n"), site_rate)
    nested = nested.select(F.col("source").alias("s"), F.col("lang").alias("g"), "n", "good", "site_n", "site_good")
    own, total = F.coalesce("label", "doc_score"), F.lit(whole["n"] or 0)
    others = F.when(total > 1, (F.lit(whole["good"] or 0.0) - own) / F.greatest(total - 1, F.lit(1))).otherwise(0.5)
    joined = judged.join(nested, F.col("source").eqNullSafe(F.col("s")) & F.col("lang").eqNullSafe(F.col("g")))
    joined = joined.withColumn("base", F.greatest(F.least(others, F.lit(1.0)), F.lit(0.0))).withColumn("site_score", (
        F.col("site_good") - own + weight * F.col("base")) / (F.col("site_n") - 1 + weight)).withColumn("path_score", (
            F.col("good") - own + path_weight * F.col("site_score")) / (F.col("n") - 1 + path_weight))
    odds = logit(F.col("doc_score")) + logit(F.col("path_score")) - logit(F.col("base"))
    return joined.select("doc_id", "source", "lang", "doc_score", "site_score", "path_score", (1 / (1 + F.exp(-odds))).alias(
        "score")).withColumn("kept", F.col("score") >= keep_from)
