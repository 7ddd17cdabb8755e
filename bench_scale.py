"""The whole analysis on many short posts: python bench_scale.py [copies] [cpus]

Documents are cut into pieces of 160 characters, about the size of a post; each piece is posted ``copies``
times, three of four with a word of its own, so about a fifth of the posts are duplicates. Prints the run
metrics at 25, 50 and 100 percent, one JSON line each.
"""
import json
import os
import sys

from pyspark.sql import functions as F

from postlens.operators.normalize import with_sample_key
from postlens.operators.sentiment import default_lexicon
from postlens.plans.experiments import growth_verdict, scalability
from postlens.plans.ingest import bulk_load
from postlens.schema import POSTS_SCHEMA
from postlens.scratch import new_folder, settle
from postlens.session import get_session
from postlens.sources.store import read_posts
from workload import views


def short_posts(spark, sf_dir, copies):
    documents = views.table(spark, sf_dir, "documents").repartition(spark.sparkContext.defaultParallelism, "doc_id")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)).cast("int"), F.lit(160))).alias("at")
    pieces = documents.select("doc_id", "lang", "source", "text", starts).select(
        "doc_id", "lang", "source", "at", F.substring(F.col("text"), F.col("at"), F.lit(160)).alias("piece"))
    posted = pieces.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    own = F.when(F.col("copy") % 4 == 0, F.lit("")).otherwise(
        F.concat(F.lit(" "), F.translate(F.md5(F.col("copy").cast("string")), "0123456789", "ghijklmnop")))
    day = F.pmod(F.xxhash64("doc_id", "at", "copy"), F.lit(2000)).cast("int")
    posts = posted.select(
        F.concat_ws("-", F.lit("p"), "doc_id", "at", "copy").alias("post_id"),
        F.when(F.col("lang") == "en", F.lit("alpha")).otherwise(F.lit("beta")).alias("source"),
        F.concat("piece", own).alias("text"),
        F.date_add(F.lit("2018-01-01").cast("date"), day).cast("timestamp").alias("created_ts"),
        F.col("source").alias("community"),
        F.element_at(F.array(F.lit("bullish"), F.lit("bearish"), F.lit("neutral")), F.pmod(day, F.lit(3)) + 1).alias("orig_sentiment"),
        day.cast("double").alias("orig_score"))
    return with_sample_key(posts).select(POSTS_SCHEMA.names)


def main(copies=10, cpus=8):
    spark = get_session("bench-scale", spark__master=f"local[{cpus}]", spark__ui__enabled="false",
                        spark__driver__memory="7g", spark__sql__shuffle__partitions="64")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    raw, store = settle(short_posts(spark, sf_dir, int(copies)), "raw"), new_folder(spark, "store")
    for row in bulk_load(raw, store):
        print(json.dumps({"load": row}), flush=True)
    rows = scalability(read_posts(spark, 1.0, store), default_lexicon(spark))
    for row in rows:
        print(json.dumps({"analytics": row}), flush=True)
    print(json.dumps({"growth": growth_verdict(spark.createDataFrame(rows)).first().asDict()}))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
