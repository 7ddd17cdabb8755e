"""The post feeds, lexicon and term tables the queries work on, derived from the test tables.

Documents become posts of two differently shaped feeds: English ones feed ``alpha`` (epoch milliseconds,
labels, scores), all others feed ``beta`` (weekday-first time text, communities). Orders give the time,
labels the data-set label. A hashtag, a URL and a mention are put in front of each text, and rows with missing,
empty or deleted texts are added, so that every cleaning rule has work to do.
"""
from pyspark.sql import functions as F

from postlens.operators.aggregates import analysis_columns
from postlens.operators.cleaning import ANALYSED, clean, deduplicate
from postlens.operators.normalize import normalize, unite
from postlens.operators.sentiment import RuleWords, score
from postlens.scratch import new_folder, settle
from postlens.session import configure, wide_shuffles

# Frequent words of the invented prose take the parts the rules look for.
RULE_WORDS = RuleWords(intensifiers=("the", "la", "die"), dampeners=("and", "le", "und"), negators=("is", "de", "that"),
                       contrast="to", no="with", joiners=("it", "or"), least="by", not_least=("at", "or"), never="in",
                       so=("of", "en"), without=("on", "a"), pairs=(("for", "of"), ("it", "is")))


def table(spark, sf_dir, name):
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_documents(spark, sf_dir, documents=None):
    """Documents with order time, label and noisy text; ``documents`` may be a stream."""
    documents = table(spark, sf_dir, "documents") if documents is None else documents
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    joined = (documents.join(orders, F.col("doc_id") == F.col("o_orderkey"))
              .join(labels, "doc_id", "left"))
    price = F.col("o_totalprice")
    front = F.concat(F.lit("#Size"), F.floor(F.col("n_chars") / 1000).cast("string"),
                     F.lit(" https://x.example/a#frag @user"), F.col("doc_id").cast("string"), F.lit(" "))
    # Noise rows stand beside the documents, under ids of their own.
    noise = F.when(price < 10000, F.lit(None)).when(price < 20000, F.lit("")).otherwise(F.lit("[deleted]"))
    rows = F.filter(F.array(
        F.struct(F.col("doc_id").alias("row_id"), F.concat(front, "text").alias("row_text"), F.lit(True).alias("there")),
        F.struct((-F.col("doc_id") - 1).alias("row_id"), noise.alias("row_text"), (price < 40000).alias("there"))), lambda r: r["there"])
    label = (F.when(F.col("toxic") == 1, F.lit("Bearish")).when(F.col("quality") == 1, F.lit("Bullish"))
             .when(F.col("quality").isNotNull(), F.lit("neutral")).alias("label"))
    return joined.select("lang", F.col("source").alias("place"), "o_orderdate", "o_totalprice", label, F.inline(rows)).select(
        F.col("row_id").alias("doc_id"), "lang", "place", "o_orderdate", "o_totalprice", F.col("row_text").alias("text"), "label")


def feed_alpha(raw):
    return raw.where(F.col("lang") == "en").select(
        F.col("doc_id").alias("ID"), F.col("text").alias("Text"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("Created_At"),
        F.col("label").alias("sentiment_label"), F.col("o_totalprice").alias("sentiment_score"))


def feed_beta(raw):
    return raw.where(F.col("lang") != "en").select(
        F.col("doc_id").cast("string").alias("comment_id"), F.col("text").alias("body"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "EEE MMM dd HH:mm:ss +0000 yyyy").alias("created_utc"),
        F.concat(F.lit("r/"), "place").alias("subreddit"))


def posts(spark, sf_dir, documents=None):
    """Unified posts of both feeds."""
    raw = raw_documents(spark, sf_dir, documents)
    return unite([normalize(feed_alpha(raw), "alpha", labels=True), normalize(feed_beta(raw), "beta", community=True)])


# A file of many row groups can be read by many tasks, also where it is a micro-batch by itself.
ROW_GROUPS = {"parquet.block.size": 256 << 10, "parquet.page.size": 64 << 10, "parquet.page.size.row.check.min": 100}


def _streamed(rows, n, pieces, batches):
    """About ``n`` rows as a stream of several micro-batches, written where they are: dealing them out anew would shuffle, and
    sort, all of them once more."""
    spark, pieces = rows.sparkSession, max(pieces, rows.sparkSession.sparkContext.defaultParallelism, batches)
    parts = new_folder(spark, "files")
    with wide_shuffles(spark, pieces):    # for a join in front
        rows.write.options(**ROW_GROUPS, maxRecordsPerFile=max(-(-n // pieces), 1)).parquet(parts)
    each = max(-(-len(spark.read.schema(rows.schema).parquet(parts).inputFiles()) // batches), 1)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", each).parquet(parts)


def table_stream(spark, sf_dir, name, batches=4):
    """A test table as a stream of several micro-batches, whose files grow in number with the table and not in size."""
    rows = table(spark, sf_dir, name)
    return _streamed(rows, rows.count(), rows.rdd.getNumPartitions(), batches)


def parted_stream(spark, sf_dir, name, key, files=4):
    """A test table as a stream whose micro-batch k holds the rows whose key is k modulo the number of files."""
    rows = table(spark, sf_dir, name)
    path = new_folder(spark, f"{name}-parts")
    for k in range(files):
        rows.where(F.pmod(F.col(key), F.lit(files)) == k).repartition(1).write.options(**ROW_GROUPS).parquet(f"{path}/part{k}")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/part*")


def post_stream(spark, sf_dir, batches=4):
    """The posts as a stream; joined before, as a join inside would shuffle all orders again for every micro-batch."""
    documents = table(spark, sf_dir, "documents")
    return _streamed(posts(spark, sf_dir), documents.count(), documents.rdd.getNumPartitions(), batches)


def lexicon(spark, sf_dir):
    """Words of the benchmark texts with a valence from -4 to 4 by hash."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    tokens = table(spark, sf_dir, "benchmark").select(words.alias("token")).where(F.length("token") >= 4).distinct()
    valence = F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("long") % 9 - 4
    return settle(tokens.select("token", valence.cast("double").alias("valence")), "lexicon")


def phrase_lexicon(spark, sf_dir):
    """The lexicon and phrases of two to four words from the benchmark texts, many of them overlapping."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    pieces = table(spark, sf_dir, "benchmark").select(words.alias("w")).where(F.size("w") > 0)
    pieces = pieces.select("w", F.explode(F.sequence(F.lit(1), F.size("w"), F.lit(2))).alias("i")).withColumn("n", 2 + F.col("i") % 3)
    phrases = pieces.where(F.col("i") + F.col("n") - 1 <= F.size("w")).select(
        F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("token")).distinct()
    valence = F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("long") % 9 - 4
    return settle(lexicon(spark, sf_dir).unionByName(phrases.select("token", valence.cast("double").alias("valence"))), "lexicon")


def cleaned(spark, sf_dir):
    return deduplicate(clean(posts(spark, sf_dir)), ANALYSED)


def scored(spark, sf_dir, rules=True):
    return score(cleaned(spark, sf_dir), lexicon(spark, sf_dir), rules=rules, rule_words=RULE_WORDS)


def scored_columns(spark, sf_dir):
    return analysis_columns(scored(spark, sf_dir))


def line_terms(spark, sf_dir):
    """Monthly term table from order lines: return flag as source, supplier as term."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(
        F.trunc(F.to_date("l_shipdate"), "month").alias("month"), F.col("l_returnflag").alias("source"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("token")).agg(F.count("*").alias("n"))


def line_totals(terms):
    return terms.groupBy("month", "source").agg(F.sum("n").alias("n"))


def event_messages(events):
    """Events as post messages, some of which break the schema.

    Errors lose a required key, sign-ups with a small value are cut off, purchases carry a null text.
    """
    ts = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS+00:00")
    base = [F.concat(F.lit("e-"), F.col("event_id").cast("string")).alias("post_id"),
            F.col("event_type").alias("source")]
    text = F.when(F.col("event_type") != "purchase", F.concat_ws(" ", "event_type", "props")).alias("text")
    keep = {"ignoreNullFields": "false"}
    whole = F.to_json(F.struct(*base, text, ts.alias("created_ts"), F.col("value").alias("orig_score")), keep)
    partial = F.to_json(F.struct(*base, ts.alias("created_ts")), keep)
    return events.select(
        F.when(F.col("event_type") == "error", partial)
        .when((F.col("event_type") == "signup") & (F.col("value") < 10), F.substring(whole, 1, 30))
        .otherwise(whole).alias("value"))
