"""Mixing sources to target weights by repetition rates and hash-seeded copies (operator 10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import with_position
from .common import WORD, store, unit

BROADCAST_ROWS = 10_000  # sources of up to so many rows are broadcast, more are joined by shuffle
SEED = 10


def words(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source (source, source_size, target) from a table (source, size).

    Sources in code point order, null last, take the weights in turn.  `share` times all sizes is dealt out by weight;
    a target stops at `most` times its source's size and the excess is dealt to the others, until none is above.
    """
    known = store(sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("last", F.col("source").isNull()))
    ranked = with_position(known, [], ["last", "source"], "pos")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    dealt = store(ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * float(most)).alias("cap")))
    level, stopped = 0.0, -1
    while True:
        full = F.col("cap") <= F.col("w") * level if stopped >= 0 else F.lit(False)
        total, held, open_weight, n = dealt.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("w"))), F.count(F.when(full, 1))
        ).first()
        # every round stops at least one more source at its cap
        if n == stopped or not open_weight:
            break
        stopped, level = n, (total * share - (held or 0.0)) / open_weight
    return dealt.select("source", "source_size", F.when(F.col("cap") <= F.col("w") * level, F.col("cap")).otherwise(F.col("w") * level).alias("target"))


def plan_mix(docs: DataFrame, size: Column, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = SEED) -> DataFrame:
    """Add `size`, `source_size`, `target`, `copies` to `docs` (doc_id, source, ...).

    A source's rate is its target by its size.  Every document is taken floor(rate) times, and once more if the hash of
    seed and doc_id falls below the rate's fraction; so reruns agree, and rows with equal ids share one draw.  Documents
    without words are taken as their source's rate says, with size 0; in a source without any words the rate is 0.
    A null doc_id draws like an id of its own, a null source is a source of its own.
    """
    sized = docs.withColumn("size", size)
    by_source = targets(sized.select("source", "size"), weights, share, most)
    if by_source.count() <= BROADCAST_ROWS:
        by_source = F.broadcast(by_source)
    by_source = by_source.withColumnRenamed("source", "__source")
    joined = sized.join(by_source, sized["source"].eqNullSafe(by_source["__source"])).drop("__source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return joined.withColumn("copies", (whole + (unit(seed, F.col("doc_id")) < rate - whole).cast("long")).cast("long"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """`docs` with every document as often as the mix takes it; the columns stay."""
    columns = docs.columns
    planned = plan_mix(docs.select(F.struct("*").alias("row"), "doc_id", "source"), words("row.text"), **options)
    return planned.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*[F.col("row").getField(c).alias(c) for c in columns])
