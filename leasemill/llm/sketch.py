"""Problem 5: percentiles of very large numeric columns, mergeable, with a guaranteed relative error.

A sketch is a table of counts in signed logarithmic buckets: bucket i of a sign holds the values with
gamma^(i-1) < |x| <= gamma^i, gamma = (1 + alpha) / (1 - alpha). Sketches of parts merge by adding matching counts, and the
result equals the sketch of the whole exactly. A percentile q is the value at 0-based rank floor(q * (n - 1)) of the
ordered values; the returned value v of the true x satisfies |v - x| <= alpha * |x|. Zeros are exact; values nearer to zero than the smallest normal double count as zeros.

Defined results: null, NaN and infinite values are counted as ``n_skipped`` and take no part; null group values form
groups of their own; a group without any value gives one row for each percentile with a null value; an empty table gives
no rows. All states are bounded: :func:`bucket_limit` buckets for a group, whatever its rows.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasemill.functions.buckets import SMALLEST, bucket_text, gamma, sign_text

ALPHA = 0.01
BUCKET = ["skipped", "sign", "bucket"]


def bucket_limit(alpha: float) -> int:
    """The most buckets that finite doubles can fill: both signs and the zero."""
    return 2 * math.ceil((math.log(sys.float_info.max) - math.log(SMALLEST)) / math.log(gamma(alpha))) + 3


def bucket_value(sign: Column, bucket: Column, alpha: float) -> Column:
    """The value whose relative distance to either bound of the bucket is at most ``alpha``; the largest double at most."""
    g = gamma(alpha)
    size = F.pow(F.lit(g), bucket.cast("double") - 1.0) * F.lit(2.0 * g / (g + 1.0))
    return F.when(sign == 0, F.lit(0.0)).otherwise(sign * F.least(size, F.lit(sys.float_info.max)))


def build(df: DataFrame, keys: list[str], value: str, alpha: float = ALPHA) -> DataFrame:
    """The sketch of each group: keys, skipped, sign, bucket, n. One scan of the keys and the value, one shuffle of counts."""
    if clash := {*BUCKET, "n", "_v"} & {*keys}:
        raise ValueError(f"a key may not be named {sorted(clash)}")
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).selectExpr(
        *[f"`{k}`" for k in keys], "NOT coalesce(NOT isnan(_v) AND abs(_v) < CAST('Infinity' AS DOUBLE), false) AS skipped", "_v"
    )
    rows = rows.selectExpr(*[f"`{k}`" for k in keys], "skipped", f"CASE WHEN NOT skipped THEN {sign_text('_v')} END AS sign", f"CASE WHEN NOT skipped THEN {bucket_text('_v', alpha)} END AS bucket")
    return rows.groupBy(*keys, *BUCKET).agg(F.count("*").alias("n"))


def merge(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """The sketch of all parts together, by ``keys``; parts may have finer keys, which are added up."""
    rows = None
    for p in parts:
        p = p.select(*keys, *BUCKET, "n")
        rows = p if rows is None else rows.unionByName(p)
    return rows.groupBy(*keys, *BUCKET).agg(F.sum("n").alias("n"))


def percentiles(sketch: DataFrame, keys: list[str], qs: list[float], alpha: float = ALPHA) -> DataFrame:
    """keys, n_values, n_skipped, q, value, low, high: the estimate and the bounds between which the true value lies.

    The running sum goes over the buckets of a group, whose number is bounded, not over its rows.
    """
    order = F.struct("sign", (F.col("bucket") * F.col("sign")).alias("place"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    running = group.orderBy(F.col("skipped"), order).rowsBetween(Window.unboundedPreceding, 0)
    values, skipped = F.when(~F.col("skipped"), F.col("n")), F.when(F.col("skipped"), F.col("n"))
    marked = sketch.withColumns(
        {
            "_upto": F.sum(values).over(running),
            "n_values": F.coalesce(F.sum(values).over(group), F.lit(0)),
            "n_skipped": F.coalesce(F.sum(skipped).over(group), F.lit(0)),
        }
    )
    marked = marked.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    rank = F.floor(F.col("q") * (F.col("n_values") - 1))
    holds = ~F.col("skipped") & (F.col("_upto") > rank) & (F.col("_upto") - F.col("n") <= rank)
    only_skipped = F.col("skipped") & (F.col("n_values") == 0)
    estimate = F.when(~F.col("skipped"), bucket_value(F.col("sign"), F.col("bucket"), alpha))
    near, far = estimate / (1 + alpha), estimate / (1 - alpha)
    return marked.filter(holds | only_skipped).select(
        *keys, "n_values", "n_skipped", "q", estimate.alias("value"), F.least(near, far).alias("low"), F.greatest(near, far).alias("high")
    )
