"""Exact medians from stored quantile sketches (A3).

Every stored partition (a run, a day) keeps a mergeable KLL sketch per column. The merged sketches
give a narrow bracket around the median's rank, and one scan counts what lies below it and the values
inside it: the exact lower median, from one pass over the values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import _long_values

K = 4096  # size of a sketch, about 50 kB
RANK_ERROR = 0.003  # twice and more what a sketch of this size is off by in rank


def value_sketches(df: DataFrame, cols: Sequence[str], part: Column) -> DataFrame:
    """``part, name, values, sketch``: one sketch per partition and column; nulls and NaN are no values."""
    entries = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in cols])
    rows = df.select(part.alias("part"), F.inline(entries)).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return rows.groupBy("part", "name").agg(F.count("*").alias("values"), F.kll_sketch_agg_double("v", F.lit(K)).alias("sketch"))


def brackets(sketches: DataFrame, margin: float) -> dict[str, tuple[int, float, float]]:
    """name -> (values, low, high): a bracket of ``margin`` ranks on either side of the median."""
    merged = sketches.groupBy("name").agg(F.sum("values").alias("values"), F.kll_merge_agg_double("sketch").alias("sketch"))
    ends = [F.kll_sketch_get_quantile_double("sketch", F.lit(at)) for at in (max(0.0, 0.5 - margin), min(1.0, 0.5 + margin))]
    rows = merged.select("name", "values", ends[0].alias("low"), ends[1].alias("high")).collect()  # one row per column
    return {r.name: (r["values"], r.low, r.high) for r in rows}


def medians_from_sketches(df: DataFrame, cols: Sequence[str], sketches: DataFrame, margin: float = RANK_ERROR) -> DataFrame:
    """``name, median``: exact lower medians of ``cols`` in one scan; a column without values is absent.

    All that a scan sends on is one row per value inside the bracket and task, and one for what lies below. Should a
    bracket miss the rank (sketches err by chance), it is doubled and the scan is repeated for all columns.
    """
    spark = df.sparkSession
    while True:
        found = brackets(sketches, margin)
        if not found:
            return spark.createDataFrame([], "name string, median double")
        pick = lambda i: F.create_map(*[x for c, b in found.items() for x in (F.lit(c), F.lit(b[i]))])[F.col("name")]
        near = _long_values(df, [c for c in cols if c in found]).filter(F.col("v") <= pick(2))
        below = F.col("v") < pick(1)
        counted = near.groupBy("name", below.alias("below"), F.when(~below, F.col("v")).alias("v")).agg(F.count("*").alias("n"))
        order = Window.partitionBy("name").orderBy(F.desc("below"), "v").rowsBetween(Window.unboundedPreceding, 0)
        upto = counted.withColumn("upto", F.sum("n").over(order)).withColumn("rank", F.ceil(pick(0) / 2))
        at = upto.filter(F.col("upto") >= F.col("rank")).groupBy("name").agg(F.min(F.struct("upto", "below", "v")).alias("hit"))
        rows = at.select("name", "hit.below", "hit.v").collect()
        if len(rows) == len(found) and not any(r.below for r in rows):
            return spark.createDataFrame([(r.name, r.v) for r in rows], "name string, median double")
        if margin >= 0.5:
            raise ValueError("the sketches are not of these values")
        margin = min(0.5, 2 * margin)
