"""Row size estimates."""
from functools import reduce

from pyspark.sql import functions as F

NULL_BYTES = 4  # a missing value prints as four characters


def row_bytes(columns):
    """UTF-8 bytes of all values of a row written as text."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(NULL_BYTES)) for c in columns]
    return reduce(lambda a, b: a + b, sizes).cast("long")
