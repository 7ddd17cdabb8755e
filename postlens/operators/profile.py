"""Profiles of raw feeds and checks over stored and aggregated data."""
from pyspark.sql import functions as F

from postlens.constants import COMMUNITY_COLUMNS, LABEL_COLUMNS, SCORE_COLUMNS
from postlens.functions.sizes import row_bytes
from postlens.operators.sampling import rows_at
from postlens.schema import find_column
from postlens.scratch import settle


def resolved_columns(df):
    """Which raw column plays each optional role, None where there is none (metadata only)."""
    return {role: find_column(df.columns, names) for role, names in
            (("label", LABEL_COLUMNS), ("score", SCORE_COLUMNS), ("community", COMMUNITY_COLUMNS))}


def null_share(df, columns):
    """Share of missing values per column, one row each."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("null_share")) for c in columns]
    return shares.select(F.inline(F.array(*rows)))


def value_counts(df, column, n=10):
    """The most frequent values, null included."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("value")).limit(n)


def top_values(df, column, n=10, tracked=8192):
    """``value_counts`` for columns with very many values, which are not all shuffled.

    A mergeable sketch tracks the frequent values of each task, candidates are then counted exactly. A value that is no candidate
    occurs at most ``5.25 / tracked`` of the rows times (twice the sketch's error, 3.5 rows in its map size). Only if the n-th
    candidate is not above that bound could one be missing, and all values are counted.
    """
    values = df.select(F.col(column).cast("string").alias("value"))
    seen = values.agg(F.count("*").alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"), F.expr(
        f"approx_top_k(value, {tracked}, {tracked})").alias("top")).first()
    candidates = [r["item"] for r in seen["top"] or [] if r["item"] is not None]      # at most ``tracked``
    if not candidates:
        return value_counts(df, column, n)
    known = settle(df.sparkSession.createDataFrame([(c,) for c in candidates], "value string"), "candidates")
    counted = values.join(known, "value").groupBy("value").agg(F.count("*").alias("count"))
    if seen["nulls"]:
        counted = counted.unionByName(known.limit(1).select(F.lit(None).cast("string").alias("value"), F.lit(seen["nulls"]).cast("long").alias("count")))
    best = settle(counted.orderBy(F.desc("count"), F.asc_nulls_last("value")).limit(n), "top")
    last = best.agg(F.count("*").alias("n"), F.min("count").alias("least")).first()
    if last["n"] < n or last["least"] <= 5.25 * seen["rows"] / tracked:
        return value_counts(df, column, n)
    return best.orderBy(F.desc("count"), F.asc_nulls_last("value"))


def describe_number(df, column):
    """count, mean, std, min, exact quartiles and max of a numeric column.

    Quartiles interpolate between neighbouring order statistics. Equal values are counted before anything
    is ordered, so a frequent value is one row; the ranks are found by running totals over value ranges.
    """
    values = df.select(F.col(column).cast("double").alias("value")).where(F.col(column).isNotNull())
    counts = values.groupBy("value").agg(F.count("*").alias("n"))
    counts = settle(counts, "values")
    basics = counts.agg(F.sum("n").alias("count"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
                        F.min("value").alias("min"), F.max("value").alias("max")).first()
    size, mean = basics["count"] or 0, basics["mean"]
    if size == 0:
        return df.sparkSession.createDataFrame([("count", 0.0)], "statistic string, value double")
    squares = counts.agg(F.sum(F.pow(F.col("value") - F.lit(mean), 2) * F.col("n"))).first()[0]
    rows = [("count", float(size)), ("mean", mean),
            ("std", (squares / (size - 1)) ** 0.5 if size > 1 else None), ("min", basics["min"])]
    places = {name: q * (size - 1) for name, q in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75))}
    wanted = {int(p) + 1 for p in places.values()} | {min(int(p) + 2, size) for p in places.values()}
    at = rows_at(counts, ["value"], "n", sorted(wanted))
    for name, p in places.items():
        low, high = at[int(p) + 1]["value"], at[min(int(p) + 2, size)]["value"]
        rows.append((name, low + (high - low) * (p - int(p))))
    rows.append(("max", basics["max"]))
    return df.sparkSession.createDataFrame(rows, "statistic string, value double")


def input_inventory(spark, path):
    """Files and bytes under a path, from the listing alone: no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"),
                     (F.sum("length") / F.lit(1e9)).alias("gigabytes"))


def feed_summary(df, group):
    """Rows and estimated bytes per group, and combined (``combined`` true)."""
    sized = df.select(F.col(group).alias("feed"), row_bytes(df.columns).alias("bytes"))
    return (sized.rollup("feed").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"),
                                     (F.grouping("feed") == 1).alias("combined"))
            .withColumn("gigabytes", F.col("bytes") / F.lit(1e9)))


def fraction_counts(posts, fractions):
    """Posts below each sample fraction, counted in one pass."""
    counts = posts.agg(*[F.count_if(F.col("sample_key") < f).alias(str(i)) for i, f in enumerate(fractions)])
    rows = [F.struct(F.lit(float(f)).alias("fraction"), F.col(f"`{i}`").alias("posts")) for i, f in enumerate(fractions)]
    return counts.select(F.inline(F.array(*rows)))


def reconcile(tables, clean):
    """Posts per source in every result table that counts posts, next to the cleaned posts; ``holds`` if they agree."""
    counted = {"sentiment_by_source": "count", "daily_sentiment": "n", "monthly_totals": "n", "compound_hist": "count"}
    rows = [tables[name].groupBy("source").agg(F.sum(n).alias("total")).select(F.lit(name).alias("table"), "source", "total")
            for name, n in counted.items()]
    every = rows[0]
    for other in rows[1:]:
        every = every.unionByName(other)
    per_source = clean.groupBy("source").agg(F.count("*").alias("rows_clean"))
    pairs = per_source.select("source", "rows_clean", F.explode(F.array(*[F.lit(n) for n in counted])).alias("table"))
    return pairs.join(every, ["table", "source"], "full").select(
        "table", "source", "rows_clean", "total", F.coalesce(F.col("rows_clean") == F.col("total"), F.lit(False)).alias("holds"))


def totals_check(posts, expected):
    """Stored posts per source next to the expected ones (source, posts), and all of them together (source null)."""
    def totals(df, name, value):
        return df.rollup("source").agg(value.alias(name), F.grouping("source").alias("all"))
    stored = totals(posts.where(F.col("source").isNotNull()), "stored", F.count("*"))
    wanted = totals(expected, "expected", F.sum("posts"))
    same = F.col("s.source").eqNullSafe(F.col("w.source")) & (F.col("s.all") == F.col("w.all"))
    return stored.alias("s").join(wanted.alias("w"), same, "full").select(
        F.coalesce("s.source", "w.source").alias("source"), F.col("w.expected").alias("expected"), F.col("s.stored").alias("stored"),
        F.coalesce(F.col("w.expected") == F.col("s.stored"), F.lit(False)).alias("holds"))
