"""Benchmark of the headline queries. Prints one JSON line.

BENCH_SF_DIR   folder of test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_RUNS     measured runs per query after one warm-up (default 3, the median counts)
"""
import json
import os
import statistics
import time

from postlens.operators.aggregates import result_tables
from postlens.operators.cleaning import ANALYSED, clean, deduplicate
from postlens.operators.sentiment import score
from postlens.plans.experiments import growth_verdict, scalability
from postlens.plans.ingest import bulk_load
from postlens.scratch import new_folder, settle
from postlens.session import get_session
from postlens.sources.store import read_posts, write_posts
from workload import views
from workload.queries import QUERIES

NAMES = ["normalize_union", "clean_dedupe", "sentiment_score", "sentiment_rules", "daily_sentiment", "keyword_monthly",
         "hashtag_monthly", "compound_hist", "validation_metrics", "trend_terms", "post_trends", "byte_budget_documents",
         "score_describe", "store_round_trip", "message_posts", "stream_ingest", "stream_dedupe", "stream_daily"]


def timed(work, runs):
    work()
    seconds = []
    for _ in range(runs):
        started = time.time()
        work()
        seconds.append(time.time() - started)
    return statistics.median(seconds)


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session("bench", spark__master=f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="8g",
                        spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: round(timed(lambda: drain(QUERIES[name](spark, sf_dir)), runs), 3) for name in NAMES}

    # The stages of the whole analysis, as in the published measurements: stored posts in, tables out.
    store = new_folder(spark, "store")
    write_posts(views.posts(spark, sf_dir), store, mode="overwrite")
    posts, lexicon = read_posts(spark, 1.0, store), views.lexicon(spark, sf_dir)
    load = bulk_load(views.posts(spark, sf_dir), new_folder(spark, "store"))
    rows = scalability(posts, lexicon)
    scored = settle(score(deduplicate(clean(posts), ANALYSED), lexicon), "scored")
    stages = {
        "load_clean_score": round(timed(lambda: drain(score(deduplicate(clean(posts), ANALYSED), lexicon)), runs), 3),
        "aggregate": round(timed(lambda: [drain(df) for df in result_tables(scored).values()], runs), 3),
    }
    verdict = growth_verdict(spark.createDataFrame(rows)).first()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "stages": stages,
        "posts": rows[-1]["rows_in"],
        "score_rows_per_sec": round(rows[-1]["rows_in"] / stages["load_clean_score"], 1),
        "load_rows_per_sec": load[-1]["cumulative_rows_per_sec"],
        "stream_records_per_sec": round(spark.read.parquet(f"{sf_dir}/events.parquet").count() / times["stream_ingest"], 1),
        "analytics": rows, "growth": verdict["verdict"]}))
    spark.stop()


if __name__ == "__main__":
    main()
