"""Sampling that depends on the key alone.

``DataFrame.sample`` and ``randomSplit`` draw by partition and row position, so a lost executor or another
file layout changes the draw; a digest of the key does not, and counts, fit and test see the same rows.
MD5 is used because every engine has it, so the split can be repeated outside Spark.
"""

from pyspark.sql import Column, functions as F

BUCKETS = 16**8


def key_fraction(key: Column, seed: int, draw: int = 0) -> Column:
    """A number in [0, 1) fixed by key and seed; draws 0..3 of one key are independent."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    part = F.substring(digest, 1 + 8 * draw, 8)
    return F.conv(part, 16, 10).cast("bigint") / F.lit(float(BUCKETS))
