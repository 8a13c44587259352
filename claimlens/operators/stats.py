"""Global statistics kept inside the plan.

Global scalars are attached to rows as scalar subqueries
(``DataFrame.scalar()``): Spark runs the one-row aggregate as its own job and
inlines the value, so there is no ``collect`` on the driver and no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scalar(df: DataFrame, expr: Column) -> Column:
    """One aggregate over ``df`` as a scalar-subquery column."""
    return df.select(expr).scalar()


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, v) rows for every non-null, non-NaN value of ``cols``."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in cols]
    )
    long = df.select(F.inline(entries))
    return long.filter(F.col("v").isNotNull() & ~F.isnan("v"))


def lower_medians(df: DataFrame, cols: Sequence[str], accuracy: int = 10_000, rounds: int = 2) -> DataFrame:
    """A3: exact lower median (``percentile_disc(0.5)``) of each column.

    Returns rows (name, median); a column with no values is absent (callers fall back to
    0.0). The rank is bracketed instead of shuffling the values:
      1. each round is one scan with partial aggregates: per column, how many values lie
         below and inside its bracket, and two approximate percentiles around the rank,
         which narrow the bracket to about 4 / ``accuracy`` of its rows;
      2. only the values in the last bracket (after two rounds some 1e-7 of all) are counted by
         value and ordered. A hot value is one row there.
    What returns to the driver is five numbers per column and round.
    """
    ok = {c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols}
    value = {c: F.when(ok[c], F.col(c).cast("double")) for c in cols}
    whole = df.agg(*[F.count(value[c]).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    rank = {c: -(-whole[f"n{i}"] // 2) for i, c in enumerate(cols) if whole[f"n{i}"]}  # 1-based
    inside = {c: ok[c] for c in rank}
    below = dict.fromkeys(rank, 0)
    size = {c: whole[f"n{i}"] for i, c in enumerate(cols) if c in rank}
    for _ in range(rounds):
        if not rank:
            break
        exprs = []
        for i, c in enumerate(rank):
            at, margin = (rank[c] - below[c]) / size[c], 2.0 / accuracy
            ends = [max(0.0, at - margin), min(1.0, at + margin)]
            exprs.append(F.percentile_approx(F.when(inside[c], value[c]), ends, accuracy).alias(f"p{i}"))
        ends = df.agg(*exprs).first()
        bracket = {c: (ends[f"p{i}"][0], ends[f"p{i}"][1]) for i, c in enumerate(rank)}
        counts = df.agg(
            *[F.count_if(ok[c] & (value[c] < lo)).alias(f"b{i}") for i, (c, (lo, _)) in enumerate(bracket.items())],
            *[F.count_if(ok[c] & value[c].between(lo, hi)).alias(f"s{i}") for i, (c, (lo, hi)) in enumerate(bracket.items())],
        ).first()
        for i, (c, (lo, hi)) in enumerate(bracket.items()):
            if counts[f"b{i}"] < rank[c] <= counts[f"b{i}"] + counts[f"s{i}"]:  # else the wider bracket stays
                inside[c], below[c], size[c] = ok[c] & value[c].between(lo, hi), counts[f"b{i}"], counts[f"s{i}"]
    entries = [F.struct(F.lit(c).alias("name"), F.when(inside[c], value[c]).alias("v"), F.lit(rank[c] - below[c]).alias("target")) for c in rank]
    if not entries:
        return df.sparkSession.createDataFrame([], "name string, median double")
    counted = (
        df.select(F.inline(F.array(*entries))).filter(F.col("v").isNotNull()).groupBy("name", "v", "target").agg(F.count(F.lit(1)).alias("cnt"))
    )
    running = Window.partitionBy("name").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counted.withColumn("upto", F.sum("cnt").over(running))
        .filter(F.col("upto") >= F.col("target"))
        .groupBy("name")
        .agg(F.min("v").alias("median"))
    )


def approx_medians(df: DataFrame, cols: Sequence[str], relative_error: float = 0.001) -> DataFrame:
    """A3 (sketch option): approximate median with bounded memory per column."""
    accuracy = max(1, int(1.0 / relative_error))
    return _long_values(df, cols).groupBy("name").agg(
        F.percentile_approx("v", 0.5, accuracy).alias("median")
    )


def median_table(
    df: DataFrame, cols: Sequence[str], exact: bool = True, relative_error: float = 0.001
) -> DataFrame:
    """One row with one column per input column holding its median (null if empty)."""
    table = lower_medians(df, cols) if exact else approx_medians(df, cols, relative_error)
    return table.agg(*[F.max(F.when(F.col("name") == c, F.col("median"))).alias(c) for c in cols])


def mean_std_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: one pass computing mean and sample stddev of every column."""
    exprs = []
    for c in cols:
        exprs.append(F.mean(c).alias(f"{c}__mean"))
        exprs.append(F.stddev_samp(c).alias(f"{c}__std"))
    return df.agg(*exprs)


def packed_scalar(one_row: DataFrame) -> Column:
    """All columns of a one-row DataFrame as one struct scalar subquery."""
    return one_row.select(F.struct(*one_row.columns)).scalar()


def with_scalars(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row as struct column ``name``.

    The scalar subquery appears once in the plan (later expressions read the
    column), so the optimiser does not copy the aggregate's plan per use.
    """
    return df.withColumn(name, packed_scalar(one_row))
