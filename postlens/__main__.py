"""Command line: python -m postlens <job> ... ; start it with spark-submit on a cluster."""
import argparse
import json

from postlens.operators import profile
from postlens.operators.sentiment import default_lexicon, load_lexicon
from postlens.plans.analytics import refresh_derived, run_analytics
from postlens.plans.experiments import scalability
from postlens.plans.ingest import bulk_load, replay
from postlens.session import get_session
from postlens.sources.feeds import load_feeds, scan_feed, standard_feeds
from postlens.sources.messages import message_stream
from postlens.sources.store import append_metrics, read_posts
from postlens.streaming.flows import ingest_messages


def pairs(values):
    return dict(v.split("=", 1) for v in values or [])


def arguments():
    parser = argparse.ArgumentParser(prog="postlens")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, *names, **optional):
        sub = jobs.add_parser(name)
        for n in names:
            sub.add_argument(f"--{n}", required=True)
        for n, default in optional.items():
            sub.add_argument(f"--{n}", default=default, type=str if default is None else type(default))
        return sub

    job("load", "raw", "store", metrics=None)
    job("analytics", "store", "results", lexicon=None, fraction=1.0)
    job("scalability", "store", "results", lexicon=None)
    job("refresh", "results")
    job("inspect", "raw")
    for name, extra in (("produce", {"n": 200000, "metrics": None}), ("consume", {})):
        sub = job(name, *(["raw"] if name == "produce" else ["target", "checkpoint"]), format="kafka", path=None, **extra)
        sub.add_argument("--option", action="append", help="reader or writer option as name=value")
    return parser.parse_args()


def main():
    args = arguments()
    spark = get_session(f"postlens-{args.job}")
    spark.sparkContext.setLogLevel("ERROR")
    lexicon = (load_lexicon(spark, args.lexicon) if getattr(args, "lexicon", None) else
               default_lexicon(spark) if hasattr(args, "lexicon") else None)
    if args.job == "load":
        rows = bulk_load(load_feeds(spark, standard_feeds(args.raw)), args.store, metrics=args.metrics)
    elif args.job == "analytics":
        rows = [run_analytics(read_posts(spark, float("inf"), args.store), lexicon, args.fraction, args.results)[0]]
    elif args.job == "scalability":
        rows = scalability(read_posts(spark, float("inf"), args.store), lexicon, args.results)
        append_metrics(spark, rows, f"{args.results}/scalability_metrics")
    elif args.job == "refresh":
        refresh_derived(spark, args.results)
        rows = []
    elif args.job == "produce":
        rows = [replay(load_feeds(spark, standard_feeds(args.raw)), args.n, args.format, args.path, **pairs(args.option))]
        if args.metrics:
            append_metrics(spark, rows, args.metrics)
    elif args.job == "consume":
        ingest_messages(message_stream(spark, args.format, args.path, **pairs(args.option)), args.target, args.checkpoint)
        rows = []
    else:
        rows = []
        for feed in standard_feeds(args.raw):
            raw = scan_feed(spark, feed)
            roles = profile.resolved_columns(raw)
            print(feed.name, raw.columns, roles)
            profile.input_inventory(raw).show(truncate=False)
            if roles["label"]:
                profile.value_counts(raw, roles["label"]).show(truncate=False)
            if roles["score"]:
                profile.describe_number(raw, roles["score"]).show(truncate=False)
    for row in rows:
        print(json.dumps(row))
    spark.stop()


if __name__ == "__main__":
    main()
