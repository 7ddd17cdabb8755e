"""The whole analysis: read, clean, de-duplicate, score, aggregate, trends, validation."""
import time

from pyspark.sql import Observation, functions as F

from postlens.operators.aggregates import analysis_columns, in_order, result_tables
from postlens.operators.cleaning import ANALYSED, clean, deduplicate
from postlens.operators.sentiment import RuleWords, score
from postlens.operators.trends import detect_trends
from postlens.operators.validation import validation_metrics
from postlens.scratch import forget, settle
from postlens.sources.store import count_stored, replace_tables


def scored_posts(posts, lexicon, rules=True, rule_words=RuleWords(), text_limit=None):
    """Posts to the analysis columns. The sample comes first: a smaller fraction has fewer duplicates."""
    unique = deduplicate(clean(posts, text_limit), ANALYSED)
    return analysis_columns(score(unique, lexicon, rules=rules, rule_words=rule_words))


def derived_tables(tables, **trend_options):
    """Trends and metrics from the (stored) result tables; also used to refresh them alone."""
    return {"trend_terms": detect_trends(tables["keyword_monthly"], tables["monthly_totals"], **trend_options),
            "validation_metrics": validation_metrics(tables["validation_confusion"])}


def run_analytics(posts, lexicon, fraction=1.0, results=None, rules=True, min_keyword_count=10, min_hashtag_count=5,
                  rule_words=RuleWords(), text_limit=None, **trend_options):
    """Run everything on a sample fraction. Returns the run metrics and the result tables.

    Scored posts, their roll-up and the result tables are settled in the shared folder: every table is computed once, reads
    only its columns, and a lost executor costs no recomputation of the scores. With ``results`` the
    tables also replace those stored there, in their published order; empty ones leave the old content.
    """
    started = time.time()
    sample = posts.where(posts["sample_key"] < fraction)
    rows_in = count_stored(posts, fraction)
    counted, cleaned = time.time(), Observation("cleaned")
    known = lexicon if hasattr(lexicon, "settled_in") else settle(lexicon, "lexicon")
    scored = settle(scored_posts(sample, known, rules, rule_words, text_limit).observe(
        cleaned, F.count(F.lit(1)).alias("n")), "scored")
    rows_clean = cleaned.get["n"]
    prepared = time.time()
    tables = {name: settle(df, name) for name, df in result_tables(scored, min_keyword_count, min_hashtag_count).items()}
    aggregated = time.time()
    tables.update({name: settle(df, name) for name, df in derived_tables(tables, **trend_options).items()})
    forget(scored)
    metrics = dict(dataset_fraction=float(fraction), rows_in=rows_in, rows_after_cleaning=rows_clean,
                   count_query_seconds=round(counted - started, 3),
                   load_clean_score_seconds=round(prepared - counted, 2),
                   aggregate_seconds=round(aggregated - prepared, 2),
                   total_seconds=round(aggregated - started, 2),
                   rows_per_second=round(rows_in / (aggregated - started), 1))
    if results:
        replace_tables(tables, results, order=in_order)
    return metrics, tables


def refresh_derived(spark, results, **trend_options):
    """Recompute trends and metrics from stored result tables and store them again."""
    tables = {name: spark.read.parquet(f"{results}/{name}")
              for name in ("keyword_monthly", "monthly_totals", "validation_confusion")}
    derived = derived_tables(tables, **trend_options)
    replace_tables(derived, results)
    return derived
