"""Text expressions: what a reader sees, what is compared, what is counted."""
from pyspark.sql import functions as F

from postlens.constants import (BLANK_TEXTS, HASHTAG_PATTERN, MENTION_PATTERN, MIN_CLEAN_LENGTH, MIN_KEYWORD_LENGTH,
                                STOPWORDS, URL_PATTERN)


def visible(text, limit=None):
    """URLs removed from the whole text; case and punctuation stay. ``limit`` keeps only so many characters after that."""
    may_hold_url = text.contains("://") | text.contains("www.")     # a plain search, much cheaper than the pattern
    whole = F.when(may_hold_url, F.regexp_replace(text, URL_PATTERN, "")).otherwise(text)
    return whole if limit is None else F.substring(whole, 1, limit)


def is_blank(text_v):
    """Removal markers and texts of blanks only."""
    return F.lower(F.trim(text_v)).isin(BLANK_TEXTS)


def plain(text_v):
    """Lower-case letters and single blanks; the form that duplicates and keywords are found on."""
    without_mentions = F.when(text_v.contains("@"), F.regexp_replace(text_v, MENTION_PATTERN, " ")).otherwise(text_v)
    return F.trim(F.regexp_replace(F.lower(without_mentions), "[^a-z]+", " "))


def is_long_enough(text_clean):
    return F.length(text_clean) >= MIN_CLEAN_LENGTH


def distinct_tokens(text_clean):
    return F.array_distinct(F.split(text_clean, " "))


def is_keyword(token, stopwords=STOPWORDS):
    """Four or more letters and not a stop word. Tokens of a plain text are letters only, so their length decides."""
    return (F.length(token) >= MIN_KEYWORD_LENGTH) & ~token.isin(list(stopwords))


def distinct_hashtags(text_v):
    return F.array_distinct(F.regexp_extract_all(F.lower(text_v), F.lit(HASHTAG_PATTERN), F.lit(1)))
