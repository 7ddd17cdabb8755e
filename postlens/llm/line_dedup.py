"""Removal of boilerplate lines that spread over many sites.

Lines are split at ``\\n`` and known by 128 bits of hash; only lines with a word count. One aggregation merges, for
every line, a HyperLogLog sketch of the sites that have it. Lines whose estimate is near the threshold get an
exact distinct count; estimates further off are many standard errors away. A line on ``sites`` or more sites is boilerplate:
it stays in the document with the smallest id that has it and goes from all others, so one copy of each text survives.

A null site is a site of its own. Null texts stay null. Among rows without id, which have no smallest id, a line that only they
have stays everywhere. Repeated rows are treated alike. The empty table gives none. Lines without a word stay.
Positions, not texts, are collected per document; the documents are joined once with the positions to drop.
"""
from pyspark.sql import functions as F

from postlens.llm.common import fresh
from postlens.scratch import settle

SITES, LG_K, MARGIN = 10, 12, 0.25
HAS_WORD = r"[^\x20\x09-\x0D]"


def _two(*values):
    return F.xxhash64(*values), F.xxhash64(F.lit(7), *values)


def lines_of(docs, site="source"):
    """Slim rows of all lines with a word: document key (d1, d2), doc_id, site, position and line key (a, b)."""
    d1, d2 = _two(F.col("doc_id"), F.col("text"))
    each = docs.select(d1.alias("d1"), d2.alias("d2"), "doc_id", F.coalesce(F.col(site).cast("string"), F.lit("\x00")).alias("site"),
                       F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.col("line").rlike(HAS_WORD))
    a, b = _two(F.col("line"))
    return each.select("d1", "d2", "doc_id", "site", "pos", a.alias("a"), b.alias("b"))


def boilerplate(docs, sites=SITES, site="source", lg_k=LG_K, margin=MARGIN):
    """``(a, b, owner)`` of the lines on ``sites`` or more sites."""
    lines = lines_of(docs, site)
    spread = lines.groupBy("a", "b").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("owner"), F.hll_sketch_agg("site", lg_k).alias("sketch"))
    some = settle(spread.where(F.col("n") >= sites).select("a", "b", "owner", F.hll_sketch_estimate("sketch").alias("estimate"))
                  .where(F.col("estimate") >= sites * (1 - margin)), "spread")
    far = some.where(F.col("estimate") > sites * (1 + margin))
    near = some.where(F.col("estimate") <= sites * (1 + margin))
    exact = lines.join(near.select("a", "b"), ["a", "b"], "left_semi").select("a", "b", "site").distinct().groupBy("a", "b").agg(
        F.count("*").alias("n")).where(F.col("n") >= sites)
    return settle(far.select("a", "b", "owner").unionByName(near.join(exact, ["a", "b"]).select("a", "b", "owner")), "boilerplate")


def removed_lines(docs, sites=SITES, site="source", **options):
    """``docs`` with ``text`` without boilerplate and two more columns, the numbers of lines before and of lines removed."""
    found = boilerplate(docs, sites, site, **options)
    lines = lines_of(docs, site).select("d1", "d2", "doc_id", "pos", "a", "b")
    drop = lines.join(found, ["a", "b"]).where(~F.col("doc_id").eqNullSafe(F.col("owner"))).groupBy("d1", "d2").agg(
        F.collect_set("pos").alias("drop"))
    names = [fresh(docs, n) for n in ("d1", "d2", "drop")]
    d1, d2 = _two(F.col("doc_id"), F.col("text"))
    marked = docs.withColumns({names[0]: d1, names[1]: d2}).join(
        settle(drop.select(*[F.col(c).alias(n) for c, n in zip(("d1", "d2", "drop"), names, strict=True)]), "drop"), names[:2], "left")
    parts, gone = F.split("text", "\n"), F.col(names[2])
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    text = F.when(gone.isNull(), F.col("text")).otherwise(
        F.element_at(F.transform(F.array(parts), lambda p: F.array_join(F.transform(left, lambda i: F.get(p, i)), "\n")), 1))
    counts = {fresh(docs, "n_lines"): F.coalesce(F.size(parts), F.lit(0)).cast("long"),
              fresh(docs, "n_removed"): F.coalesce(F.size(gone), F.lit(0)).cast("long")}
    # The new text has a name of its own first: inside a lambda Spark would take "text" for the new column of the same select.
    new = fresh(docs, "new_text")
    done = marked.withColumns({**counts, new: text})
    changed = {"text": F.col(new)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(gone.isNull(), F.col("n_chars")).otherwise(F.length(new)).cast(docs.schema["n_chars"].dataType)
    return done.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns], *counts)


def clean(docs, sites=SITES, site="source"):
    """The documents without boilerplate lines; those that held nothing else go."""
    done = removed_lines(docs, sites, site)
    emptied = (F.col(done.columns[-1]) > 0) & ~F.col("text").rlike(HAS_WORD)
    return done.where(~emptied | F.col("text").isNull()).select(*docs.columns)
