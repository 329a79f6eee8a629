"""Mixing sources to target weights by entropy balancing.

The mix closest to the corpus (in Kullback-Leibler divergence over its words, every document between no and two copies)
that gives each source its target is an exponential tilt of the documents' base rates: with base rate b and a source's
multiplier m, a document's rate is 2 b e^m / (b e^m + 2 - b). The multipliers maximise the convex dual, which Newton
steps solve; its slopes are sums over (source, base rate) cells, which Spark aggregates. Rates become copies by order
sampling: the whole part for every document, and one more for the documents first in a fixed random order, until the
source has its target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topicstream.llm.common import written

#: Fixed values of the contract: weights by rank of the source, total share of all words, most copies.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BUCKETS = 4096
RESULT = ("size", "source_size", "target", "taken", "copies", "rate")


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
    base_col: str | None = None,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
) -> DataFrame:
    """``docs`` with the columns size, source_size, target, rate, copies and taken (columns of these names are replaced).

    Sources, in code point order with null last, have the weights in turn and share ``share`` times all words; a target
    stops at twice its source's size and the excess goes to the others by weight. ``taken`` is the number of words the
    mix takes: whole copies, except for one document per source that is cut so that the source meets its target to the
    word. ``copies`` is the same in whole copies. ``base_col`` may give base rates between 0 and 2 (null: 1).

    A null size counts as 0; null sources are one source; a null id sorts before others in the random order, and rows that
    repeat an id are taken in order of their sizes. An empty table gives an empty result.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in RESULT]
    base = F.coalesce(F.col(f"`{base_col}`").cast("double"), F.lit(1.0)) if base_col else F.lit(1.0)
    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").alias("source"),
        F.coalesce(F.col(f"`{size_col}`").cast("long"), F.lit(0)).cast("long").alias("size"),
        F.least(F.greatest(base, F.lit(0.0)), F.lit(float(MOST))).alias("base"),
    )
    cells = written(rows.groupBy("source", "base").agg(F.sum("size").cast("long").alias("words")), "mix-cells")
    state = _multipliers(cells, _targets(cells, weights, share))

    # A row per source; whether it is broadcast is decided by its size, and a hot source is split if it is not.
    tilted = F.col("base") * F.exp("multiplier")
    rate = F.when(F.col("multiplier") == float("inf"), F.lit(float(MOST))).otherwise(
        MOST * tilted / (tilted + MOST - F.col("base"))
    )
    near = F.abs(rate - F.round(rate)) < 1e-9
    dealt = (
        rows.join(state.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select("row", "id", "source", "size", "source_size", "target", rate.alias("rate"), near.alias("near"))
        .withColumn("whole", F.when(F.col("near"), F.round("rate")).otherwise(F.floor("rate")).cast("long"))
        .withColumn("part", F.when(F.col("near"), F.lit(0.0)).otherwise(F.col("rate") - F.col("whole")))
        .withColumn("place", F.when(F.col("part") > 0, _uniform("id") / F.col("part")))
        .withColumn("bucket", F.floor(BUCKETS * F.col("place") / (1 + F.col("place"))).cast("int"))
        .drop("near")
    )
    # Words by bucket of the order, so that a hot source is summed before it is sorted.
    by_bucket = dealt.groupBy("source", "target", "bucket").agg(
        F.sum(F.col("whole") * F.col("size")).alias("sure"), F.sum("size").alias("words")
    )
    every = W.partitionBy("source")
    running = F.sum(F.when(F.col("bucket").isNotNull(), F.col("words")).otherwise(0)).over(
        every.orderBy(F.asc_nulls_first("bucket")).rowsBetween(W.unboundedPreceding, 0)
    )
    ends = written(
        by_bucket.select("*", (F.round("target").cast("long") - F.sum("sure").over(every)).alias("open"), running.alias("upto"))
        .where("bucket is not null and upto >= open")
        .groupBy("source")
        .agg(F.min("bucket").alias("last"), F.min_by(F.col("open") - F.col("upto") + F.col("words"), "bucket").alias("left")),
        "mix-ends",
    )
    dealt = dealt.join(
        ends.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left"
    ).drop("of")
    # Only the bucket in which a source meets its target is sorted.
    last = F.coalesce(F.col("bucket") == F.col("last"), F.lit(False))
    order = W.partitionBy("source").orderBy("place", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    room = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - before))
    sorted_rows = dealt.where(last).withColumn("extra", room.cast("long"))
    # A source whose extra words never reach its target (rounding) has no last bucket: all its parts are taken.
    first = F.col("bucket").isNotNull() & (F.col("last").isNull() | (F.col("bucket") < F.col("last")))
    other_rows = dealt.where(~last).withColumn("extra", F.when(first, F.col("size")).otherwise(0).cast("long"))
    copies = F.col("whole") + F.when((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size")), 1).otherwise(0)
    return (
        sorted_rows.unionByName(other_rows)
        .withColumn("taken", F.col("whole") * F.col("size") + F.col("extra"))
        .withColumn("copies", copies.cast("int"))
        .select("row.*", *RESULT)
    )


def _uniform(column: str):
    """A number in [0, 1) that depends on the id alone."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)


def _targets(cells: DataFrame, weights: tuple, share: float) -> DataFrame:
    """Per source its words and its target. The running sums are over sources, not documents."""
    total = W.partitionBy()
    ranked = cells.groupBy("source").agg(F.sum("words").cast("long").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    cap = MOST * F.col("source_size")
    ranked = ranked.withColumn("weight", weight).withColumn("level", cap / F.col("weight"))
    order = W.orderBy("level", F.asc_nulls_last("source"))
    up, down = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    all_words = F.sum("source_size").over(total)
    # The level at which all sources from here on are filled if those before have stopped at their caps.
    fill = (F.lit(share) * all_words - F.coalesce(F.sum(cap).over(up), F.lit(0))) / F.sum("weight").over(down)
    filled = ranked.select("*", fill.alias("fill"), F.row_number().over(order).alias("nth"))
    first = F.min(F.when(F.col("fill") <= F.col("level"), F.struct("nth", "fill"))).over(total)
    filled = filled.withColumn("fill", first["fill"])
    target = F.least(F.col("weight") * F.coalesce(F.col("fill"), F.lit(float("inf"))), cap.cast("double"))
    return filled.select("source", "source_size", target.alias("target"))


def _multipliers(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """Newton steps on the dual, all sources at once, from multipliers of 0: every document at its base rate."""
    part = F.col("target") / F.nullif(MOST * F.col("source_size"), F.lit(0))
    start = (
        F.when(F.col("source_size") == 0, F.lit(0.0))
        .when(part >= 1 - 1e-12, F.lit(float("inf")))
        .when(part <= 0, F.lit(-700.0))
        .otherwise(F.lit(0.0))
    )
    state = written(targets.withColumn("multiplier", start), "mix-dual")
    for _ in range(60):
        tilted = F.col("base") * F.exp("multiplier")
        rate = MOST * tilted / (tilted + MOST - F.col("base"))
        slopes = (
            cells.join(state.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .where("source_size > 0 and multiplier < double('inf') and multiplier > -700")
            .groupBy("of")
            .agg(
                F.sum(F.col("words") * rate).alias("reached"),
                F.sum(F.col("words") * rate * (1 - rate / MOST)).alias("slope"),
            )
        )
        step = (F.col("reached") - F.col("target")) / F.nullif(F.col("slope"), F.lit(0.0))
        stepped = state.join(slopes, F.col("source").eqNullSafe(F.col("of")), "left").select(
            "source",
            "source_size",
            "target",
            (F.col("multiplier") - F.coalesce(F.greatest(F.lit(-2.0), F.least(F.lit(2.0), step)), F.lit(0.0))).alias(
                "multiplier"
            ),
            F.coalesce(F.abs(F.col("reached") - F.col("target")) / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0)).alias("off"),
        )
        state = written(stepped, "mix-dual")
        if (state.agg(F.max("off")).first()[0] or 0.0) < 1e-10:
            break
    return state.drop("off")
