"""Result tables that grow slice by slice: only posts with a new text are scored, older ones are never read again.

Every slice leaves its own folder in two places under ``root``: ``survivors`` (the posts it brought into the analysis, scored) and
``partials`` (what it adds to each result table: counts and exact sums). A table is the sum of its partials. If a slice brings an
earlier copy of a text that an older slice has, that copy takes over, as in one full run: the partials of the slice then also
hold the older post's share with a minus sign. The last slice may be repeated; it replaces its own folders.
"""
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from postlens.constants import MIN_HASHTAG_COUNT, MIN_KEYWORD_COUNT
from postlens.operators.aggregates import SCORED_COLUMNS, daily_classes, hashtag_monthly, keyword_monthly, labelled, rolled_up, validation_confusion
from postlens.operators.cleaning import ANALYSED, KEY, clean, deduplicate
from postlens.operators.sentiment import RuleWords, score
from postlens.scratch import forget, settle

ORDER = ["created_ts", "post_id"]
STORED = [KEY, *ORDER, *[c for c in SCORED_COLUMNS if c not in ORDER]]
# Result tables by the columns that identify a row; all their other columns are sums.
IDENTITY = {"classes": ["source", "day", "month", "sentiment", "number"], "communities": ["community"], "keywords": ["month", "source", "token"],
            "hashtags": ["month", "source", "hashtag"], "confusion": ["orig", "sentiment"], "moments": []}


def contributions(scored):
    """What scored posts add to each table."""
    points = F.round(F.col("compound") * 10000).cast("long")
    pairs = labelled(scored).where(F.col("orig_score").isNotNull()).select(F.col("compound").alias("x"), F.col("orig_score").alias("y"))
    sums = {"n": F.count("*"), "x": F.sum("x"), "y": F.sum("y"), "xx": F.sum(F.col("x") * F.col("x")), "yy": F.sum(F.col("y") * F.col("y")),
            "xy": F.sum(F.col("x") * F.col("y"))}
    return {
        "classes": daily_classes(scored),
        "communities": scored.where(F.col("community").isNotNull()).groupBy("community").agg(F.count("*").alias("n"), F.sum(points).alias("points")),
        "keywords": keyword_monthly(scored, 1), "hashtags": hashtag_monthly(scored, 1), "confusion": validation_confusion(scored),
        "moments": pairs.agg(*[F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in sums.items()])}


def earlier(a, b):
    """Whether the post with columns prefixed ``a`` comes before that of ``b`` in the order duplicates are resolved in."""
    def place(p):
        return F.struct(F.col(f"{p}.created_ts"), F.col(f"{p}.post_id").isNull(), F.col(f"{p}.post_id"))
    return place(a) < place(b)


def stored_survivors(spark, root, schema, before):
    """Survivors of all slices but ``before``, with their slice; empty at the start."""
    try:
        table = spark.read.option("basePath", f"{root}/survivors").option("mergeSchema", "false").parquet(f"{root}/survivors")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], f"{schema}, slice string")
    return table.withColumn("slice", F.col("slice").cast("string")).where(F.col("slice") != before)


def add_slice(posts, lexicon, root, name, rules=True, rule_words=RuleWords(), text_limit=None):
    """Take a slice of posts into the tables under ``root``. Returns the numbers of posts that were new, taken over and given up."""
    spark = posts.sparkSession
    rows = settle(deduplicate(clean(posts, text_limit), ANALYSED), "slice")
    schema = f"{KEY} binary, created_ts timestamp, post_id string"
    history = stored_survivors(spark, root, schema, name)
    # Keys and order only; the texts of older posts are read for the few that are given up.
    held = history.select(KEY, "slice", *ORDER).join(rows.select(KEY), KEY, "left_semi")
    held = held.groupBy(KEY).agg(F.min(F.struct("created_ts", F.col("post_id").isNull().alias("nameless"), "post_id", "slice")).alias("old"))
    met = settle(rows.select(KEY, F.struct(*ORDER).alias("new")).join(held, KEY, "left").select(
        KEY, F.col("old.slice").alias("slice"), F.col("old.created_ts").alias("created_ts"), F.col("old.post_id").alias("post_id"),
        F.col("old").isNull().alias("unknown"), F.coalesce(earlier("new", "old"), F.lit(False)).alias("first")), "met")
    fresh = rows.join(met.where(F.col("unknown") | F.col("first")).select(KEY), KEY, "left_semi")
    scored = settle(score(fresh, lexicon, rules=rules, rule_words=rule_words).select(STORED), "scored")
    scored.write.mode("overwrite").parquet(f"{root}/survivors/slice={name}")
    given_up = met.where("first").select(KEY, "slice", *ORDER)
    slices = [r["slice"] for r in given_up.select("slice").distinct().collect()]
    parts = contributions(scored)
    if slices:
        same = [F.col(f"h.{c}").eqNullSafe(F.col(f"g.{c}")) for c in (KEY, "slice", *ORDER)]
        old = settle(history.where(F.col("slice").isin(slices)).alias("h").join(given_up.alias("g"), same, "left_semi").select(STORED), "given-up")
        for table, minus in contributions(old).items():
            sums = [c for c in minus.columns if c not in IDENTITY[table]]
            parts[table] = parts[table].unionByName(minus.select(*IDENTITY[table], *[(-F.col(c)).alias(c) for c in sums]))
    for table, part in parts.items():
        merged(part, table).write.mode("overwrite").parquet(f"{root}/partials/{table}/slice={name}")
    counts = met.agg(F.count_if("unknown").alias("new"), F.count_if("first").alias("taken_over")).first()
    forget(rows)
    return {"new": counts["new"], "taken_over": counts["taken_over"]}


def merged(partials, table):
    """Partials of a table added up; rows that cancel out are gone.

    A row goes only if all its sums are zero: a post may take the place of another in the same row, and leave its score behind.
    """
    sums = [c for c in partials.columns if c not in (*IDENTITY[table], "slice")]
    added = partials.groupBy(*IDENTITY[table]).agg(*[F.sum(c).alias(c) for c in sums])
    return added.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in sums])) if IDENTITY[table] else added


def merged_tables(spark, root, min_keyword_count=MIN_KEYWORD_COUNT, min_hashtag_count=MIN_HASHTAG_COUNT):
    """The result tables of all slices so far, by the names a full run gives them."""
    parts = {t: merged(spark.read.option("basePath", f"{root}/partials/{t}").parquet(f"{root}/partials/{t}"), t) for t in IDENTITY}
    n = F.col("n")
    spread = lambda a: F.col(a + a) / n - F.col(a) / n * F.col(a) / n
    # What is left of the squares after rounding counts as no spread.
    flat = (spread("x") <= 1e-12 * F.col("xx") / n) | (spread("y") <= 1e-12 * F.col("yy") / n)
    value = F.when(~flat, (F.col("xy") / n - F.col("x") / n * F.col("y") / n) / F.sqrt(spread("x") * spread("y")))
    return {
        **rolled_up(parts["classes"]),
        "community_sentiment": parts["communities"].select("community", "n", (F.round(F.col("points") / n) / 10000).alias("avg_compound")),
        "keyword_monthly": parts["keywords"].where(n >= min_keyword_count), "hashtag_monthly": parts["hashtags"].where(n >= min_hashtag_count),
        "validation_confusion": parts["confusion"],
        "validation_corr": parts["moments"].select(F.lit("pearson_compound_vs_orig_score").alias("metric"), F.coalesce(
            F.when(n > 0, value), F.lit(float("nan"))).alias("value"))}
