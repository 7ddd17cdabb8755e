"""Keys computed from a row alone, so they do not depend on partitioning, batch or run."""
from pyspark.sql import functions as F

SEPARATOR = "\u0001"


def content_id(source, text, created_ts):
    """Id for posts without one: the same post gets the same id wherever it is read."""
    return F.sha2(F.concat_ws(SEPARATOR, source, text, F.unix_micros(created_ts).cast("string")), 256)


def sample_key(identity):
    """Uniform number in [0, 1) from the first 32 bits of the md5 of ``identity``."""
    return F.conv(F.substring(F.md5(identity), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def duplicate_key(source, text_clean):
    """32-byte digest of what makes two posts duplicates: short to shuffle and compare.

    Never null, and declared so: joins on it then add no null filter, which would make the two plans of a
    self-join differ and keep Spark from reusing one shuffle for both.
    """
    return F.coalesce(F.unhex(F.sha2(F.concat_ws(SEPARATOR, source, text_clean), 256)), F.lit(b""))
