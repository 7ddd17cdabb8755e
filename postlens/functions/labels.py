"""Sentiment classes."""
from pyspark.sql import functions as F

from postlens.constants import NEGATIVE_TO, POSITIVE_FROM

# --- fixed values: label prefixes of each class ---
LABEL_PREFIXES = {"positive": ["pos", "bull"], "negative": ["neg", "bear"], "neutral": ["neu"]}


def polarity(compound):
    """Class of a compound score."""
    return (F.when(compound >= POSITIVE_FROM, F.lit("positive"))
            .when(compound <= NEGATIVE_TO, F.lit("negative"))
            .otherwise(F.lit("neutral")))


def label_class(label):
    """Class of a data-set label; null when the label belongs to none."""
    return F.coalesce(*[F.when(label.startswith(prefix), F.lit(name))
                        for name, prefixes in LABEL_PREFIXES.items() for prefix in prefixes])
