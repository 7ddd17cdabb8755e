"""DuckDB SQL with the same rows as each query, written independently of the Spark plans."""
from postlens.constants import PUBLISHED_TEXT_LIMIT, STOPWORDS

RAW = """joined AS (
  SELECT d.doc_id, d.lang, d.source AS place, d.text, d.n_chars, o.o_orderdate, o.o_totalprice,
         CASE WHEN l.toxic = 1 THEN 'Bearish' WHEN l.quality = 1 THEN 'Bullish'
              WHEN l.quality IS NOT NULL THEN 'neutral' END AS label
  FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id),
raw AS (
  SELECT doc_id, lang, place, o_orderdate, o_totalprice, label,
         '#Size' || (n_chars // 1000) || ' https://x.example/a#frag @user' || doc_id || ' ' || text AS text FROM joined
  UNION ALL
  SELECT -doc_id - 1, lang, place, o_orderdate, o_totalprice, label,
         CASE WHEN o_totalprice < 10000 THEN NULL WHEN o_totalprice < 20000 THEN '' ELSE '[deleted]' END
  FROM joined WHERE o_totalprice < 40000)"""

POSTS = RAW + """,
keyed AS (
  SELECT CASE WHEN lang = 'en' THEN 'alpha' ELSE 'beta' END AS source, *
  FROM raw WHERE text IS NOT NULL AND text <> ''),
posts AS (
  SELECT source || '-' || doc_id AS post_id, source, text, o_orderdate AS created_ts,
         CASE WHEN source = 'beta' THEN place END AS community,
         CASE WHEN source = 'alpha' THEN lower(label) END AS orig_sentiment,
         CASE WHEN source = 'alpha' THEN o_totalprice END AS orig_score,
         ('0x' || substr(md5(source || '-' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS sample_key
  FROM keyed)"""


def cleaned(rows="posts", limit=None):
    text = "regexp_replace(text, 'https?://\\S+|www\\.\\S+', '', 'g')"
    text = f"substring({text}, 1, {limit})" if limit else text
    return f""",
seen AS (
  SELECT *, {text} AS text_v FROM {rows}),
shown AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(regexp_replace(text_v, '@\\w+', ' ', 'g')),
                                               '[^a-z\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS text_clean
  FROM seen WHERE lower(trim(text_v)) NOT IN ('[deleted]', '[removed]', '')),
clean AS (SELECT * FROM shown WHERE length(text_clean) >= 3),
uniq AS MATERIALIZED (
  SELECT *, created_ts::DATE AS day, date_trunc('month', created_ts)::DATE AS month FROM clean
  QUALIFY row_number() OVER (PARTITION BY source, text_clean ORDER BY created_ts, post_id) = 1)"""


CLEAN = POSTS + cleaned()

LEXICON = """,
lex AS MATERIALIZED (
  SELECT token, ((('0x' || substr(md5(token), 1, 8))::BIGINT % 9) - 4)::DOUBLE AS valence
  FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM benchmark)
  WHERE length(token) >= 4)"""

CLASSES = """CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END"""

PLAIN_SCORE = CLEAN + LEXICON + f""",
totals AS (
  SELECT post_id, sum(valence) AS total
  FROM (SELECT post_id, unnest(regexp_extract_all(lower(text_v), '[a-z]+')) AS token FROM uniq) JOIN lex USING (token)
  GROUP BY post_id),
compounds AS (
  SELECT uniq.*, round(coalesce(total, 0.0) / sqrt(coalesce(total, 0.0) * coalesce(total, 0.0) + 15.0), 4) AS compound
  FROM uniq LEFT JOIN totals USING (post_id)),
scored AS MATERIALIZED (SELECT *, {CLASSES} AS sentiment FROM compounds)"""


def _step(k, damping):
    never, so, without, doubt, neg = "'in'", "('of', 'en')", "'on'", "'a'", "('is', 'de', 'that')"
    negated = f"(replace(w{k}, '''', '') IN {neg} OR contains(w{k}, 'n''t'))"
    flip = {1: "",
            2: f"WHEN w2 = {never} AND w1 IN {so} THEN 1.25 WHEN w2 = {without} AND w1 = {doubt} THEN 1.0",
            3: f"WHEN (w3 = {never} AND w2 IN {so}) OR w1 IN {so} THEN 1.25 WHEN w3 = {without} AND {doubt} IN (w2, w1) THEN 1.0"}[k]
    pairs = " + ".join(f"(w{a} = '{x}' AND w{b} = '{y}')::INT" for a, b in ((3, 2), (2, 1)) for x, y in (("for", "of"), ("it", "is")))
    return f"""
step{k} AS (
  SELECT * REPLACE (CASE WHEN known{k} OR pos <= {k} THEN valence ELSE
    (valence + boost{k} * {damping}::DOUBLE * CASE WHEN valence < 0 THEN -1.0 ELSE 1.0 END::DOUBLE
      + CASE WHEN loud{k} AND boost{k} <> 0 THEN 0.733 ELSE 0.0 END::DOUBLE * {damping}::DOUBLE * CASE WHEN valence > 0 THEN 1.0 ELSE -1.0 END::DOUBLE)
    * (CASE {flip} WHEN {negated} THEN -0.74 ELSE 1.0 END)::DOUBLE {f"- 0.293::DOUBLE * ({pairs})" if k == 3 else ""} END AS valence)
  FROM step{k - 1}),"""


BAGS = """
bags AS (
  SELECT post_id, list_transform(
           list_filter(string_split_regex(text_v, '\\s+'), lambda w: w <> ''),
           lambda w: CASE WHEN length(regexp_replace(w, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')) <= 2 THEN w
                          ELSE regexp_replace(w, '^[[:punct:]]+|[[:punct:]]+$', '', 'g') END) AS words
  FROM uniq)"""

SCORED = CLEAN + LEXICON + f""",""" + BAGS + f""",
facts AS (
  SELECT *, len(list_filter(words, lambda w: w = upper(w) AND w <> lower(w))) AS shouted,
         coalesce(list_position(list_transform(words, lambda w: lower(w)), 'to'), 0) AS contrast_at
  FROM bags),
spread AS (
  SELECT post_id, shouted, len(words) AS size, contrast_at, unnest(words) AS word,
         generate_subscripts(words, 1) AS pos
  FROM facts),
valued AS (
  SELECT s.*, lower(word) AS token, lex.valence AS listed,
         shouted >= 1 AND shouted < size AND word = upper(word) AND word <> lower(word) AS loud,
         CASE WHEN lower(word) IN ('the', 'la', 'die') THEN 0.293 WHEN lower(word) IN ('and', 'le', 'und') THEN -0.293
              ELSE 0.0 END::DOUBLE AS boost
  FROM spread s LEFT JOIN lex ON lex.token = lower(s.word)),
around AS (
  SELECT *, lead(token) OVER w AS after, lead(listed) OVER w IS NOT NULL AS next_listed,
    {", ".join(f"coalesce(lag(token, {k}) OVER w, '') AS w{k}, lag(listed, {k}) OVER w IS NOT NULL AS known{k}, "
               f"coalesce(lag(boost, {k}) OVER w, 0.0) AS boost{k}, coalesce(lag(loud, {k}) OVER w, false) AS loud{k}" for k in (1, 2, 3))}
  FROM valued WINDOW w AS (PARTITION BY post_id ORDER BY pos)),
listed AS (
  SELECT *, CASE WHEN w1 = 'with' OR w2 = 'with' OR (w3 = 'with' AND w1 IN ('it', 'or')) THEN listed * -0.74::DOUBLE
                 WHEN token = 'with' AND next_listed THEN 0.0 ELSE listed END AS valence
  FROM around WHERE listed IS NOT NULL AND boost = 0 AND NOT (token = 'for' AND coalesce(after, '') = 'of')),
step0 AS (
  SELECT * REPLACE (valence + CASE WHEN NOT loud THEN 0.0 WHEN valence > 0 THEN 0.733 ELSE -0.733 END::DOUBLE AS valence)
  FROM listed),""" + _step(1, 1.0) + _step(2, 0.95) + _step(3, 0.9) + f"""
step4 AS (
  SELECT * REPLACE (CASE WHEN w1 = 'by' AND NOT known1 AND w2 NOT IN ('at', 'or') THEN valence * -0.74::DOUBLE ELSE valence END AS valence)
  FROM step3),
totals AS (
  SELECT post_id, sum(valence * CASE WHEN contrast_at = 0 OR pos = contrast_at THEN 1.0 WHEN pos < contrast_at THEN 0.5
                                     ELSE 1.5 END::DOUBLE) AS total
  FROM step4 GROUP BY post_id),
emphasised AS (
  SELECT uniq.*, coalesce(total, 0.0)::DOUBLE AS plain_total,
         (least(length(text_v) - length(replace(text_v, '!', '')), 4) * 0.292
          + CASE WHEN length(text_v) - length(replace(text_v, '?', '')) <= 1 THEN 0.0
                 WHEN length(text_v) - length(replace(text_v, '?', '')) <= 3
                 THEN (length(text_v) - length(replace(text_v, '?', ''))) * 0.18 ELSE 0.96 END)::DOUBLE AS emphasis
  FROM uniq LEFT JOIN totals USING (post_id)),
summed AS (SELECT *, plain_total + sign(plain_total) * emphasis AS t FROM emphasised),
compounds AS (SELECT *, round(t / sqrt(t * t + 15.0::DOUBLE), 4) AS compound FROM summed),
scored AS MATERIALIZED (SELECT *, {CLASSES} AS sentiment FROM compounds)"""

DAILY = SCORED + """,
daily AS (
  SELECT day, source, count(*) AS n, round(sum(round(compound * 10000)::BIGINT) / count(*)) / 10000 AS avg_compound,
         count(*) FILTER (sentiment = 'positive') AS n_pos, count(*) FILTER (sentiment = 'negative') AS n_neg
  FROM scored GROUP BY day, source)"""

LABELLED = SCORED + """,
labelled AS (
  SELECT *, CASE WHEN orig_sentiment LIKE 'pos%' OR orig_sentiment LIKE 'bull%' THEN 'positive'
                 WHEN orig_sentiment LIKE 'neg%' OR orig_sentiment LIKE 'bear%' THEN 'negative'
                 WHEN orig_sentiment LIKE 'neu%' THEN 'neutral' END AS orig
  FROM scored WHERE orig_sentiment IS NOT NULL),
conf AS (SELECT orig, sentiment, count(*) AS count FROM labelled WHERE orig IS NOT NULL GROUP BY ALL)"""

GRID = LABELLED + """,
grid AS (
  SELECT o.c AS orig, p.c AS sentiment, coalesce(conf.count, 0)::DOUBLE AS n
  FROM (VALUES ('positive'), ('neutral'), ('negative')) o(c)
  CROSS JOIN (VALUES ('positive'), ('neutral'), ('negative')) p(c)
  LEFT JOIN conf ON conf.orig = o.c AND conf.sentiment = p.c),
per_class AS (
  SELECT c, sum(n) FILTER (orig = c AND sentiment = c) AS tp, sum(n) FILTER (sentiment = c) AS predicted,
         sum(n) FILTER (orig = c) AS actual
  FROM grid CROSS JOIN (VALUES ('positive'), ('neutral'), ('negative')) k(c) GROUP BY c),
rates AS (
  SELECT c, tp, actual, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
         CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS r FROM per_class),
scores AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM rates)"""

KEYWORDS = CLEAN + f""",
stop AS (SELECT unnest(string_split('{' '.join(STOPWORDS)}', ' ')) AS token),
tokens AS (SELECT month, source, unnest(list_distinct(string_split(text_clean, ' '))) AS token FROM uniq),
counted AS (
  SELECT month, source, token, count(*) AS n FROM tokens
  WHERE regexp_matches(token, '^[a-z]{{4,}}$') AND token NOT IN (SELECT token FROM stop) GROUP BY ALL)"""

HASHTAGS = CLEAN + """,
tags AS (
  SELECT month, source, unnest(list_distinct(regexp_extract_all(lower(text_v), '#(\\w+)', 1))) AS hashtag FROM uniq),
tagged AS (
  SELECT month, source, hashtag, count(*) AS n FROM tags WHERE length(hashtag) >= 3 GROUP BY ALL HAVING count(*) >= 2)"""

LINES = """k AS MATERIALIZED (
  SELECT date_trunc('month', l_shipdate)::DATE AS month, l_returnflag AS source, 's' || l_suppkey AS token,
         count(*) AS n FROM lineitem GROUP BY ALL),
tot AS (SELECT month, source, sum(n)::BIGINT AS n FROM k GROUP BY ALL)"""

POST_TERMS = KEYWORDS + """,
k AS MATERIALIZED (SELECT * FROM counted WHERE n >= 2),
tot AS (SELECT month, source, count(*) AS n FROM uniq GROUP BY ALL)"""


POST_ANALYSIS = LABELLED + KEYWORDS[len(CLEAN):]


def trends(tables, min_total, min_months, min_peak_count, template_min_terms, top_n, floor_lift=1.5):
    """The dense form: every term has a row for every kept month."""
    return tables + f""",
kept AS MATERIALIZED (
  SELECT * FROM (SELECT *, median(n) OVER (PARTITION BY source) AS med FROM tot) WHERE n >= 0.3::DOUBLE * med),
dense AS MATERIALIZED (
  SELECT t.source, t.token, m.month, m.n AS total, coalesce(k.n, 0) AS n,
         coalesce(k.n, 0)::DOUBLE / m.n * 10000 AS share
  FROM (SELECT DISTINCT source, token FROM k) t JOIN kept m USING (source)
  LEFT JOIN k ON k.source = t.source AND k.token = t.token AND k.month = m.month),
profile AS (
  SELECT source, token, sum(n)::BIGINT AS total_mentions, count(*) FILTER (n > 0) AS months_present,
         max(n)::BIGINT AS peak_count, max(share) AS top, avg(share) AS mean, stddev_samp(share) AS sd
  FROM dense GROUP BY source, token),
peaks AS (
  SELECT source, token, month AS peak_month, n AS month_count, total AS month_total FROM dense
  QUALIFY row_number() OVER (PARTITION BY source, token ORDER BY share DESC, month) = 1),
prof AS MATERIALIZED (
  SELECT token, source, total_mentions, months_present, peak_month, peak_count, month_count, month_total,
         round(top, 2) AS peak_per_10k, round(mean, 2) AS avg_per_10k, round(top / mean, 2) AS lift,
         round(CASE WHEN sd > 0 THEN (top - mean) / sd ELSE 0 END, 2) AS burst_z
  FROM profile JOIN peaks USING (source, token)
  WHERE total_mentions >= {min_total} AND months_present >= {min_months}),
burst AS MATERIALIZED (SELECT * FROM prof WHERE lift >= {floor_lift} AND peak_count >= {min_peak_count}),
near AS (
  SELECT a.source, a.token, count(*) - 1 AS neighbours
  FROM burst a JOIN burst b ON a.source = b.source AND a.peak_month = b.peak_month
    AND abs(b.peak_count - a.peak_count) <= 0.15::DOUBLE * a.peak_count
  GROUP BY a.source, a.token),
judged AS (
  SELECT burst.*, neighbours,
         neighbours >= {template_min_terms} AND peak_count >= 0.01::DOUBLE * month_total AS template
  FROM burst JOIN near USING (source, token)),
trend AS (
  SELECT token, source, total_mentions, months_present, peak_month, peak_count, peak_per_10k, avg_per_10k, lift, burst_z
  FROM judged WHERE NOT template
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY burst_z DESC, token)
          <= greatest({top_n} // (SELECT count(DISTINCT source) FROM k), 1))"""


LINE_TRENDS = trends(LINES, 150, 4, 6, 2, 30)

EVENT_POSTS = """msgs AS (
  SELECT *, NOT (event_type = 'error' OR (event_type = 'signup' AND value < 10)) AS accepted FROM events),
event_posts AS (
  SELECT 'e-' || event_id AS post_id, event_type AS source, event_type || ' ' || props AS text,
         epoch_us(ts) AS micros, value AS orig_score,
         ('0x' || substr(md5('e-' || event_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS sample_key
  FROM msgs WHERE accepted AND event_type <> 'purchase')"""

DOC_BYTES = """sized AS (
  SELECT *, coalesce(octet_length(encode(doc_id::VARCHAR)), 4) + coalesce(octet_length(encode(text)), 4)
            + coalesce(octet_length(encode(lang)), 4) + coalesce(octet_length(encode(source)), 4)
            + coalesce(octet_length(encode(n_chars::VARCHAR)), 4) AS bytes
  FROM documents)"""

ALPHA = RAW + """,
alpha AS (SELECT * FROM raw WHERE lang = 'en')"""


def cleaned_fraction(fraction):
    """Rows of a sample before and after cleaning and duplicate removal."""
    sampled = POSTS + f""",
sampled AS (SELECT * FROM posts WHERE sample_key < {fraction})""" + cleaned("sampled")
    return f"WITH {sampled} SELECT {fraction}::DOUBLE AS fraction, (SELECT count(*) FROM sampled) AS rows_in, (SELECT count(*) FROM uniq) AS rows_clean"


def q(with_clause, select):
    return f"WITH {with_clause}\n{select}"


POST_FIELDS = """SELECT post_id, source, md5(text) AS text_md5, created_ts::DATE AS created_ts, community, orig_sentiment,
       orig_score"""

ORACLES = {
    "normalize_union": q(POSTS, f"{POST_FIELDS} FROM posts"),
    "epoch_units": """SELECT event_id, 7::BIGINT AS parsed, epoch(date_trunc('second', ts))::BIGINT AS first,
       epoch(date_trunc('second', ts))::BIGINT AS last FROM events""",
    "content_ids": """SELECT copies, count(*) AS ids FROM (
  SELECT count(*) AS copies FROM conversations WHERE text IS NOT NULL AND text <> '' GROUP BY conv_id, text)
GROUP BY copies""",
    "community_default": q(POSTS, """SELECT source, community, count(*) AS n FROM (
  SELECT 'kept' AS source, community FROM posts WHERE source = 'beta'
  UNION ALL SELECT 'bare', 'all' FROM posts WHERE source = 'beta') GROUP BY ALL"""),
    "language_filter": "SELECT source, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY source",
    "storable_types": q(DAILY, """SELECT source, epoch(day)::BIGINT AS day_seconds, n,
       CASE WHEN n_pos > 0 THEN round(n_pos / n, 6) END AS ratio FROM daily"""),
    "sample_fraction": q(POSTS, "SELECT post_id, sample_key FROM posts WHERE sample_key < 0.25"),
    "slice_counts": q(POSTS, """SELECT low::DOUBLE AS low, high::DOUBLE AS high, count(post_id) AS n
FROM (VALUES (0.0, 0.25), (0.25, 0.5), (0.5, 1.0)) s(low, high)
LEFT JOIN posts ON sample_key >= low AND sample_key < high GROUP BY ALL"""),
    "fraction_counts": q(POSTS, """SELECT fraction::DOUBLE AS fraction, count(post_id) AS posts
FROM (VALUES (0.05), (0.25), (0.5), (1.0)) s(fraction) LEFT JOIN posts ON sample_key < fraction GROUP BY ALL"""),
    "first_documents": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT (SELECT count(*) // 3 FROM documents)",
    "byte_budget_documents": q(DOC_BYTES, """SELECT doc_id, n_chars FROM (
  SELECT *, sum(bytes) OVER (ORDER BY doc_id) - bytes AS before FROM sized)
WHERE before < (SELECT sum(bytes)::BIGINT * 2 // 5 FROM sized)"""),
    "priority_budget_documents": q(DOC_BYTES, """SELECT doc_id, lang FROM (
  SELECT *, sum(bytes) OVER (ORDER BY CASE lang WHEN 'fr' THEN 0 WHEN 'en' THEN 2 ELSE 3 END, doc_id) - bytes AS before
  FROM sized WHERE lang IN ('fr', 'en', 'de'))
WHERE before < (SELECT sum(bytes)::BIGINT * 7 // 10 FROM sized)"""),
    "clean_dedupe": q(CLEAN, """SELECT post_id, length(text_v) AS visible_chars, length(text_clean) AS clean_chars,
       md5(text_clean) AS clean_md5 FROM uniq"""),
    "removed_posts": q(CLEAN, """SELECT (SELECT count(*) FROM posts) AS rows_in, (SELECT count(*) FROM clean) AS rows_clean,
       (SELECT count(*) FROM uniq) AS rows_distinct,
       round(1 - (SELECT count(*) FROM uniq) / (SELECT count(*) FROM posts), 6) AS removed_share"""),
    "sentiment_score": q(PLAIN_SCORE, "SELECT post_id, compound, sentiment, day, month FROM scored"),
    "sentiment_phrases": q(CLEAN + LEXICON + """,
pieces AS (SELECT w, unnest(range(1, len(w) + 1, 2)) AS i FROM (SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark)),
phrases AS (SELECT DISTINCT array_to_string(w[i:i + 1 + i % 3], ' ') AS token, 2 + i % 3 AS size FROM pieces WHERE i + 1 + i % 3 <= len(w)),
listed AS (
  SELECT token, 1 AS size, valence FROM lex
  UNION ALL SELECT token, size, ((('0x' || substr(md5(token), 1, 8))::BIGINT % 9) - 4)::DOUBLE FROM phrases),""" + BAGS + """,
grams AS (
  SELECT post_id, pos, size, array_to_string(list_transform(words[pos:pos + size - 1], lambda w: lower(w)), ' ') AS token
  FROM (SELECT *, generate_subscripts(words, 1) AS pos FROM bags), range(1, 5) r(size) WHERE pos + size - 1 <= len(words)),
found AS (
  SELECT post_id, list({'at': pos, 'upto': pos + size - 1, 'hits': 1, 'phrases': (size > 1)::INT, 'words': size, 'valence': valence}
                       ORDER BY pos, size DESC) AS hits
  FROM grams JOIN listed USING (token, size) GROUP BY post_id),
chosen AS (
  SELECT post_id, list_reduce(list_prepend({'at': 0, 'upto': 0, 'hits': 0, 'phrases': 0, 'words': 0, 'valence': 0.0::DOUBLE}, hits),
    lambda a, h: CASE WHEN h.at > a.upto THEN {'at': h.at, 'upto': h.upto, 'hits': a.hits + 1, 'phrases': a.phrases + h.phrases,
      'words': a.words + h.words, 'valence': a.valence + h.valence} ELSE a END) AS t
  FROM found)""", """SELECT post_id, t.hits::BIGINT AS n_hits, t.phrases::BIGINT AS n_phrases, t.words::BIGINT AS n_words, t.valence AS valence
FROM chosen"""),
    "sentiment_rules": q(SCORED, "SELECT post_id, compound, sentiment, day, month FROM scored"),
    "sentiment_by_source": q(SCORED, "SELECT source, sentiment, count(*) AS count FROM scored GROUP BY ALL"),
    "daily_sentiment": q(DAILY, "SELECT * FROM daily"),
    "monthly_totals": q(SCORED, "SELECT month, source, count(*) AS n FROM scored GROUP BY ALL"),
    "compound_hist": q(SCORED, """SELECT source, round(floor(round((compound + 1) * 10, 9)) / 10 - 1, 1) AS bin,
       count(*) AS count FROM scored GROUP BY ALL"""),
    "community_sentiment": q(SCORED, """SELECT community, count(*) AS n, round(sum(round(compound * 10000)::BIGINT) / count(*)) / 10000 AS avg_compound
FROM scored WHERE community IS NOT NULL GROUP BY community"""),
    "keyword_monthly": q(KEYWORDS, "SELECT * FROM counted WHERE n >= 3"),
    "hashtag_monthly": q(HASHTAGS, "SELECT * FROM tagged"),
    "confusion": q(LABELLED, "SELECT * FROM conf"),
    "confusion_matrix": q(GRID, "SELECT orig, sentiment, n::BIGINT AS count FROM grid"),
    "validation_metrics": q(GRID, """SELECT metric, round(value, 6) AS value FROM (
  SELECT 'accuracy' AS metric, coalesce(sum(tp) / nullif(sum(actual), 0), 0) AS value FROM scores
  UNION ALL SELECT 'precision_' || c, p FROM scores UNION ALL SELECT 'recall_' || c, r FROM scores
  UNION ALL SELECT 'f1_' || c, f FROM scores UNION ALL SELECT 'macro_f1', sum(f) / 3 FROM scores
  UNION ALL SELECT 'n_labelled_posts', sum(actual) FROM scores
  UNION ALL SELECT 'classes_present_in_reference_labels', count(*) FILTER (actual > 0)::DOUBLE FROM scores)"""),
    "validation_corr": q(LABELLED, """SELECT 'pearson_compound_vs_orig_score' AS metric,
       round(corr(compound, orig_score), 6) AS value
FROM labelled WHERE orig IS NOT NULL AND orig_score IS NOT NULL"""),
    "label_counts": q(POSTS, "SELECT orig_sentiment, count(*) AS count FROM posts GROUP BY ALL"),
    "class_share": q(SCORED, """SELECT source, count(*) AS posts,
       round(count(*) FILTER (sentiment = 'positive') / count(*), 6) AS positive,
       round(count(*) FILTER (sentiment = 'neutral') / count(*), 6) AS neutral,
       round(count(*) FILTER (sentiment = 'negative') / count(*), 6) AS negative
FROM scored GROUP BY source"""),
    "source_contrast": q(SCORED + """,
sh AS (SELECT source, count(*) FILTER (sentiment = 'positive') / count(*) AS pos,
              count(*) FILTER (sentiment = 'negative') / count(*) AS neg FROM scored GROUP BY source),
hi AS (SELECT * FROM sh ORDER BY pos DESC, source LIMIT 1), lo AS (SELECT * FROM sh ORDER BY pos, source LIMIT 1)""",
                         """SELECT hi.source AS highest, lo.source AS lowest,
       CASE WHEN (hi.pos - lo.pos) * 100 < 1.0 THEN 'similar' ELSE 'different' END AS verdict,
       round(hi.pos, 6) AS highest_positive, round(lo.pos, 6) AS lowest_positive,
       round(hi.neg, 6) AS highest_negative, round(lo.neg, 6) AS lowest_negative,
       round((hi.pos - lo.pos) * 100, 6) AS gap_points FROM hi, lo"""),
    "covered_span": q(DAILY, "SELECT min(day) AS first_day, max(day) AS last_day FROM daily"),
    "kpis": q(DAILY, """SELECT coalesce(sum(n), 0)::BIGINT AS posts,
       round(coalesce(sum(avg_compound * n), 0) / greatest(sum(n), 1), 6) AS avg_compound,
       round(sum(n_pos) / greatest(sum(n), 1), 6) AS share_positive,
       round(sum(n_neg) / greatest(sum(n), 1), 6) AS share_negative
FROM daily WHERE day BETWEEN '1996-01-01' AND '1999-12-31' AND source IN ('alpha', 'beta')"""),
    "label_check": q(LABELLED, """SELECT count(DISTINCT orig) AS label_classes, sum(count)::BIGINT AS n_labelled,
       count(DISTINCT orig) >= 2 AS comparable,
       round(100 * coalesce(sum(count) FILTER (sentiment = 'positive'), 0) / sum(count), 6) AS predicted_positive_pct,
       round(100 * coalesce(sum(count) FILTER (sentiment = 'neutral'), 0) / sum(count), 6) AS predicted_neutral_pct,
       round(100 * coalesce(sum(count) FILTER (sentiment = 'negative'), 0) / sum(count), 6) AS predicted_negative_pct
FROM conf"""),
    "trend_months": q(LINES, """SELECT source, month, n AS month_total, count(*) OVER (PARTITION BY source) AS months
FROM (SELECT *, median(n) OVER (PARTITION BY source) AS med FROM tot) WHERE n >= 0.3::DOUBLE * med"""),
    "trend_profiles": q(trends(LINES, 50, 2, 0, 2, 30), """SELECT token, source, total_mentions, months_present, peak_month,
       month_count AS peak_count, peak_per_10k, avg_per_10k, lift, burst_z FROM prof"""),
    "trend_template_filter": q(LINE_TRENDS, """SELECT DISTINCT source, peak_month, peak_count, neighbours
FROM judged WHERE template"""),
    "trend_terms": q(LINE_TRENDS, "SELECT * FROM trend"),
    "trend_counts": q(LINE_TRENDS, "SELECT source, count(*) AS terms FROM trend GROUP BY source"),
    "trend_overview": q(LINE_TRENDS, """SELECT token, source, total_mentions, strftime(peak_month, '%Y-%m') AS peak_month,
       lift, burst_z FROM trend ORDER BY trend.burst_z DESC, trend.source, trend.token LIMIT 10"""),
    "trend_default_terms": q(LINE_TRENDS, "SELECT token FROM trend ORDER BY burst_z DESC, source, token LIMIT 3"),
    "post_trends": q(trends(POST_TERMS, 12, 3, 3, 8, 40), "SELECT * FROM trend"),
    "rolling_daily": q(DAILY, """SELECT day, source, avg_compound, round(avg(avg_compound) OVER (
  PARTITION BY source ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 10) AS smoothed FROM daily"""),
    "rolling_days": q(DAILY, """SELECT day, source, avg_compound, round(avg(avg_compound) OVER (
  PARTITION BY source ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW), 10) AS smoothed
FROM daily"""),
    "keyword_series": q(LINES, """SELECT month, token, sum(n)::BIGINT AS n FROM k
WHERE token IN ('s1', 's2', 's3') AND source IN ('A', 'N') GROUP BY month, token"""),
    "keyword_per10k": q(LINES, """SELECT month, token, round(sum(k.n) / any_value(posts) * 10000, 6) AS per_10k
FROM k LEFT JOIN (SELECT month, sum(n) AS posts FROM tot WHERE source IN ('A', 'R')
                  GROUP BY month) USING (month)
WHERE token IN ('s1', 's2', 's3') AND source IN ('A', 'R') GROUP BY month, token"""),
    "top_keywords": q(KEYWORDS, """SELECT token, sum(n)::BIGINT AS n FROM counted WHERE n >= 3 GROUP BY token
ORDER BY sum(counted.n) DESC, token LIMIT 15"""),
    "top_hashtags": q(HASHTAGS, """SELECT hashtag, sum(n)::BIGINT AS n FROM tagged WHERE source = 'alpha' GROUP BY hashtag
ORDER BY sum(tagged.n) DESC, hashtag LIMIT 5"""),
    "top_communities": q(SCORED, """SELECT community, count(*) AS n, round(sum(round(compound * 10000)::BIGINT) / count(*)) / 10000 AS avg_compound
FROM scored WHERE community IS NOT NULL GROUP BY community ORDER BY count(*) DESC, community LIMIT 5"""),
    "term_list": "SELECT DISTINCT 's' || l_suppkey AS token FROM lineitem",
    "source_list": q(POSTS, "SELECT DISTINCT source FROM posts"),
    "confusion_pivot": q(LABELLED, """SELECT orig,
       coalesce(sum(count) FILTER (sentiment = 'positive'), 0)::BIGINT AS positive,
       coalesce(sum(count) FILTER (sentiment = 'neutral'), 0)::BIGINT AS neutral,
       coalesce(sum(count) FILTER (sentiment = 'negative'), 0)::BIGINT AS negative FROM conf GROUP BY orig"""),
    "store_round_trip": q(POSTS, f"{POST_FIELDS}, sample_key FROM posts WHERE sample_key < 0.5"),
    "store_both_paths": q(POSTS, """SELECT r.read, post_id, md5(text) AS text_md5, epoch_us(created_ts) AS micros
FROM posts, (VALUES ('fraction'), ('span'), ('all')) r(read)
WHERE CASE r.read WHEN 'fraction' THEN sample_key < 0.25
                  WHEN 'span' THEN source = 'alpha' AND created_ts >= TIMESTAMP '1995-01-01' AND created_ts < TIMESTAMP '1996-07-01' ELSE true END"""),
    "mixed_feed": q(RAW, """SELECT 'mixed-' || doc_id AS post_id, md5(text) AS text_md5, epoch_us(o_orderdate) AS micros,
       round(o_totalprice, 2) AS score FROM raw WHERE text IS NOT NULL AND text <> '' AND o_orderdate IS NOT NULL"""),
    "bulk_load_slices": q(POSTS, """SELECT high::DOUBLE AS dataset_fraction,
       count(*) FILTER (sample_key >= low) AS slice_rows, count(*) AS cumulative_rows
FROM (VALUES (0.0, 0.25), (0.25, 0.5), (0.5, 1.0)) s(low, high) JOIN posts ON sample_key < high GROUP BY ALL"""),
    "resumed_load": q(POSTS, """SELECT source, count(*) AS posts, count(DISTINCT post_id) AS ids,
  (SELECT count(*) FROM posts WHERE sample_key < 0.5) AS before FROM posts GROUP BY source"""),
    "live_counts": q(POSTS, "SELECT source, count(*) AS posts FROM posts WHERE sample_key < 0.25 GROUP BY source"),
    "inferred_scan": q(POSTS, "SELECT orig_sentiment, count(*) AS count FROM posts GROUP BY ALL"),
    "chunked_write": "SELECT count(*) AS rows, true AS within_limit FROM documents",
    "replaced_results": q(LINES, """SELECT 'terms' AS "table", count(*) AS rows FROM k WHERE n > 1
UNION ALL SELECT 'totals', count(*) FROM tot"""),
    "csv_results": """SELECT token, count(*) AS n, round(sum(value), 2) AS total FROM (
  SELECT CASE event_type WHEN 'click' THEN 'null' WHEN 'view' THEN 'nan' WHEN 'error' THEN NULL ELSE event_type END AS token,
         value FROM events) GROUP BY token""",
    "fallback_read": "SELECT 'file' AS origin, count(*) AS rows FROM orders UNION ALL SELECT 'missing', 0",
    "label_profile": q(ALPHA, "SELECT label AS value, count(*) AS count FROM alpha GROUP BY label"),
    "null_shares": q(ALPHA, """SELECT 'sentiment_label' AS "column", round(avg((label IS NULL)::INT), 6) AS null_share FROM alpha
UNION ALL SELECT 'sentiment_score', round(avg((o_totalprice IS NULL)::INT), 6) FROM alpha
UNION ALL SELECT 'Text', round(avg((text IS NULL)::INT), 6) FROM alpha"""),
    "score_describe": q(ALPHA, """SELECT statistic, round(value, 4) AS value FROM (
  SELECT 'count' AS statistic, count(o_totalprice)::DOUBLE AS value FROM alpha
  UNION ALL SELECT 'mean', avg(o_totalprice) FROM alpha UNION ALL SELECT 'std', stddev_samp(o_totalprice) FROM alpha
  UNION ALL SELECT 'min', min(o_totalprice) FROM alpha UNION ALL SELECT 'max', max(o_totalprice) FROM alpha
  UNION ALL SELECT '25%', quantile_cont(o_totalprice, 0.25) FROM alpha
  UNION ALL SELECT '50%', quantile_cont(o_totalprice, 0.5) FROM alpha
  UNION ALL SELECT '75%', quantile_cont(o_totalprice, 0.75) FROM alpha)"""),
    "feed_summary": q(DOC_BYTES, """SELECT lang AS feed, count(*) AS rows, sum(bytes)::BIGINT AS bytes,
       grouping(lang) = 1 AS combined, round(sum(bytes) / 1e9, 9) AS gigabytes FROM sized GROUP BY ROLLUP (lang)"""),
    "reconcile": q(SCORED, """SELECT name AS "table", source, count(*) AS rows_clean, count(*) AS total, true AS holds
FROM scored, (SELECT unnest(['sentiment_by_source', 'daily_sentiment', 'monthly_totals', 'compound_hist']) AS name) GROUP BY ALL"""),
    "totals_check": """SELECT source, count(*) AS expected, count(*) AS stored, true AS holds FROM (
  SELECT CASE WHEN lang = 'en' THEN 'alpha' ELSE 'beta' END AS source FROM documents d JOIN orders ON o_orderkey = doc_id
  UNION ALL SELECT CASE WHEN lang = 'en' THEN 'alpha' ELSE 'beta' END FROM documents d JOIN orders ON o_orderkey = doc_id
  WHERE o_totalprice >= 20000 AND o_totalprice < 40000) GROUP BY ROLLUP (source)""",
    "input_inventory": """SELECT 'documents' AS "table", true AS listed, count(*) AS rows FROM documents
UNION ALL SELECT 'orders', true, count(*) FROM orders""",
    "visible_prefix": q(POSTS + cleaned(limit=PUBLISHED_TEXT_LIMIT), """SELECT post_id, length(text_v) AS visible_chars,
       md5(text_clean) AS clean_md5 FROM uniq"""),
    "feed_scan": "SELECT 'alpha' AS feed, count(*) AS rows FROM documents WHERE lang = 'en' UNION ALL SELECT 'beta', count(*) FROM documents WHERE lang <> 'en'",
    "refreshed_trends": q(trends(POST_ANALYSIS + POST_TERMS[len(KEYWORDS):], 12, 3, 3, 8, 40),
                          "SELECT *, (SELECT coalesce(sum(count), 0)::BIGINT FROM conf) AS labelled FROM trend"),
    "missing_feed": q(POSTS, "SELECT 'missing beta' AS outcome, count(*) AS rows FROM posts WHERE source = 'alpha'"),
    "reacquired_chunks": "SELECT count(*) AS rows, true AS within_limit FROM documents WHERE doc_id % 2 = 0",
    "measured_runs": q(", ".join(f"f{i} AS (SELECT * FROM ({cleaned_fraction(f)}))" for i, f in enumerate((0.25, 0.5, 1.0))),
                       "SELECT *, (SELECT rows_clean FROM f2) AS saved FROM (FROM f0 UNION ALL FROM f1 UNION ALL FROM f2)"),
    "community_roles": q(RAW, """SELECT 'alpha' AS feed, '-' AS "column", 0::BIGINT AS filled
UNION ALL SELECT 'beta', 'subreddit', count(place) FROM raw WHERE lang <> 'en'"""),
    "growth": """WITH k AS (SELECT event_type, round(value * 100)::BIGINT AS cents, ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS key
  FROM events),
s AS (SELECT event_type, sum(cents) FILTER (key < 0.25) AS small, sum(cents) FILTER (key < 1) AS whole FROM k GROUP BY event_type)
SELECT event_type, small::BIGINT AS small, whole::BIGINT AS whole, CASE WHEN whole / nullif(small, 0)::DOUBLE < 3.6 THEN 'sub-linear'
  WHEN whole / nullif(small, 0)::DOUBLE < 4.4 THEN 'linear' WHEN whole / nullif(small, 0)::DOUBLE IS NOT NULL THEN 'super-linear' END AS verdict FROM s""",
    "incremental_tables": q(POST_ANALYSIS, """SELECT 'daily' AS "table", source, day::VARCHAR AS item, count(*) AS n,
  round(sum(round(compound * 10000)::BIGINT) / count(*)) / 10000 AS value FROM scored GROUP BY source, day
UNION ALL SELECT 'keywords', source, month || ' ' || token, n, NULL FROM counted WHERE n >= 3"""),
    "analytics_run": q(POST_ANALYSIS, """SELECT 'posts' AS "table", (SELECT count(*) FROM posts) AS rows, (SELECT count(*) FROM uniq)::BIGINT AS total
UNION ALL SELECT 'sentiment_by_source', (SELECT count(*) FROM (SELECT DISTINCT source, sentiment FROM scored)), (SELECT count(*) FROM scored)
UNION ALL SELECT 'daily_sentiment', (SELECT count(*) FROM (SELECT DISTINCT source, day FROM scored)), (SELECT count(*) FROM scored)
UNION ALL SELECT 'monthly_totals', (SELECT count(*) FROM (SELECT DISTINCT source, month FROM scored)), (SELECT count(*) FROM scored)
UNION ALL SELECT 'community_sentiment', count(DISTINCT community), count(community) FROM scored
UNION ALL SELECT 'keyword_monthly', count(*), coalesce(sum(n), 0)::BIGINT FROM counted WHERE n >= 3
UNION ALL SELECT 'validation_confusion', count(*), coalesce(sum(count), 0)::BIGINT FROM conf"""),
    "required_keys_gate": q(EVENT_POSTS, "SELECT accepted, count(*) AS messages FROM msgs GROUP BY accepted"),
    "message_posts": q(EVENT_POSTS, "SELECT * FROM event_posts"),
    "message_round_trip": q(POSTS, """SELECT post_id, source, md5(text) AS text_md5,
       epoch_us(created_ts) + CASE WHEN length(post_id) % 2 = 0 THEN 0 ELSE 123456 END AS micros, community, orig_sentiment, orig_score,
       sample_key FROM posts"""),
    "raw_messages": """SELECT event_id::VARCHAR AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, value,
       len(string_split(props, ':'))::INT AS tags FROM events""",
    "stream_ingest": q(EVENT_POSTS, "SELECT * FROM event_posts"),
    "stream_quarantine": q(EVENT_POSTS, """SELECT CASE WHEN NOT accepted THEN 'keys' WHEN event_type = 'purchase' THEN 'text' ELSE 'stored' END
       AS outcome, count(*) AS messages, (SELECT count(*) FROM events) AS received FROM msgs GROUP BY ALL"""),
    "foreign_fields": """SELECT key, type, (SELECT count(*) FROM events WHERE event_id % 5 = 0) AS messages, known
FROM (VALUES ('post_id', 'STRING', true), ('source', 'STRING', true), ('body', 'STRING', false), ('when', 'BIGINT', false)) f(key, type, known)""",
    "renamed_replay": """SELECT 'e-' || event_id AS post_id, event_type AS source, md5(concat_ws(' ', event_type, props)) AS text_md5,
  epoch(date_trunc('second', ts))::BIGINT AS seconds, ('0x' || substr(md5('e-' || event_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS sample_key,
  (SELECT count(*) FROM events WHERE event_id % 5 <> 0) AS first FROM events""",
    "top_words": """SELECT value, count(*) AS count FROM (SELECT unnest(string_split(lower(text), ' ')) AS value FROM documents) GROUP BY value
ORDER BY count(*) DESC, value LIMIT 10""",
    "stream_metrics": q(EVENT_POSTS, """SELECT event_id % 4 AS batch, count(*) AS received, count(*) FILTER (accepted AND event_type <> 'purchase') AS records,
       count(*) FILTER (NOT accepted OR event_type = 'purchase') AS skipped, count(*) AS input_rows, true AS timed
FROM msgs GROUP BY ALL"""),
    "stream_late": """WITH e AS (SELECT *, event_id % 4 AS batch FROM events),
marks AS (SELECT b.batch, (SELECT max(ts) FROM e WHERE e.batch < b.batch) - INTERVAL 20 DAYS AS mark FROM (SELECT DISTINCT batch FROM e) b),
rows AS (SELECT CASE WHEN date_trunc('day', ts) + INTERVAL 1 DAY <= mark THEN 'late' ELSE 'counted' END AS outcome, ts::DATE AS day, event_type
  FROM e JOIN marks USING (batch))
SELECT outcome, day, event_type, count(*) AS n, (SELECT count(*) FROM events) AS received FROM rows GROUP BY ALL""",
    "stream_replay": q(POSTS, """SELECT post_id, md5(text) AS text_md5, created_ts::DATE AS created_ts, sample_key FROM posts
ORDER BY posts.sample_key, post_id LIMIT (SELECT count(*) // 2 FROM posts)"""),
    "stream_daily": "SELECT ts::DATE AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_hourly": """SELECT epoch(date_trunc('hour', ts))::BIGINT AS hour, event_type, count(*) AS n
FROM events GROUP BY ALL""",
    "stream_monthly": """SELECT date_trunc('month', ts)::DATE AS month, event_type, count(*) AS n
FROM events GROUP BY ALL""",
    "stream_dedupe": q(CLEAN, "SELECT source, md5(text_clean) AS clean_md5, (SELECT count(*) FROM uniq) AS keys FROM uniq"),
    "stream_drop_repeats": q(CLEAN, "SELECT source, md5(text_clean) AS clean_md5 FROM uniq"),
    "stream_score": q(PLAIN_SCORE, "SELECT source, md5(text_clean) AS clean_md5, compound, sentiment FROM scored"),
}
