"""Numbered batches of a fixed size within each shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicstream.functions.codec import quoted
from topicstream.schema import SHARD_ID

# Fixed value: records per shard in one send.
DEFAULT_BATCH_SIZE = 128


def assign_batches(
    df: DataFrame, size: int = DEFAULT_BATCH_SIZE, *, order_by: str = "seq", ranges: int | None = None
) -> DataFrame:
    """Add ``batch_no``: the first ``size`` rows of a shard in arrival order are batch 0, the next batch 1, ...

    ``order_by`` is a numeric column that orders the rows of a shard, an arrival sequence; it may start over in each
    shard. Two rows of a shard with the same value, or a null, fail the query. A single window per shard would sort a
    whole shard in one task, so the order is cut into ``ranges`` of about equal size (default: four for each shuffle
    partition, which evens out where they land). A task sorts one range of one shard, and the exact row counts of the
    ranges before it give its first number. Where the cuts are is approximate; the numbering is exact and does not
    depend on them. For a hot shard the work is split like for any other.

    Batch queries only. The input is read three times: once when called, to place the cuts, and twice by the plan, to
    count the ranges and to number the rows. Write it to a table first if it is costly to compute.
    """
    if df.isStreaming:
        raise ValueError("assign_batches needs a bounded DataFrame; a streaming sink caps its files instead")
    if size < 1:
        raise ValueError(f"batch size must be positive, got {size}")
    if "batch_no" in df.columns:
        raise ValueError("there is a column batch_no already")
    ranges = ranges or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_range, count, before, place = (_unused(name, df.columns) for name in ("range", "count", "before", "place"))
    located = df.withColumn(in_range, _range(df, order_by, _cuts(df, order_by, ranges)))

    part, order = [SHARD_ID, in_range], F.col(quoted(order_by))
    # One row per shard and range, whatever the size of the data.
    starts = (
        located.groupBy(*part)
        .agg(F.count(F.lit(1)).alias(count))
        .withColumn(before, F.sum(count).over(Window.partitionBy(SHARD_ID).orderBy(in_range)) - F.col(count))
        .drop(count)
    )
    # Equal values are in the same range, so neighbours there show every tie.
    ordered = Window.partitionBy(*part).orderBy(order)
    tie = F.raise_error(F.concat(F.lit(f"{order_by} repeats in a shard: "), order.cast("string"))).cast("int")
    number = F.when(order == F.lag(order).over(ordered), tie).otherwise(F.row_number().over(ordered))
    numbered = located.withColumn(place, number).join(starts, part)
    batch_no = F.expr(f"(`{before}` + `{place}` - 1) div {size}")
    return numbered.select(*(F.col(quoted(c)) for c in df.columns), batch_no.alias("batch_no"))


def _unused(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def _cuts(df: DataFrame, order_by: str, ranges: int) -> list[float]:
    """Where to cut the order, from one pass over it."""
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    at = F.col(quoted(order_by)).cast("double")
    return sorted(set(df.agg(F.percentile_approx(at, shares, 4 * ranges)).first()[0] or []))


def _range(df: DataFrame, order_by: str, cuts: list[float]) -> Column:
    """The number of the range a row is in. The cast to double may join neighbours but never swaps them."""
    order = F.col(quoted(order_by))
    missing = F.raise_error(F.lit(f"{order_by} is null")).cast("int")
    if not cuts:
        return F.when(order.isNull(), missing).otherwise(F.lit(0))
    bounds, at = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>"), order.cast("double")
    steps = [1 << p for p in range(len(cuts).bit_length() - 1, -1, -1)]
    found = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda n, step: F.when(F.coalesce(F.get(bounds, n + step - 1) <= at, F.lit(False)), n + step).otherwise(n),
    )
    return F.when(order.isNull(), missing).otherwise(found)
