"""Exact positions within groups, without a task that holds a whole group."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stored, stored


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str = "numbered", drop: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``tree`` (a number of the group that ascends with it), ``idx`` (position from 0) and ``size`` (of the group).

    Rows are dealt by ranges of (group, order), so a group with a third of all rows is spread
    over the partitions that its range covers; rows that tie in all of these are told apart by their
    place in the input, so copies spread as well. A row's position is its place in its partition and
    the group's rows in earlier partitions: one small row per partition and group. Nulls come first,
    strings in order of their bytes. Columns of ``drop`` only order. The numbered rows are a stored table.
    """
    keys = [*group, *order]
    ranged, path = stored(
        rows.withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(*[F.col(c).asc_nulls_first() for c in keys], F.col("_place"))
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in keys], "_place")
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
        .drop("_place", *drop),
        f"{name}-ranged",
    )
    by = Window.partitionBy(*group)
    runs = (
        ranged.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
        .withColumns({
            "tree": F.min("_first").over(by),
            "size": F.sum("_rows").over(by),
            "_before": F.coalesce(F.sum("_rows").over(by.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        })
    )
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group]
    match: Column = reduce(operator.and_, same, F.col("a._part") == F.col("b._part"))
    out, _ = stored(
        ranged.alias("a").join(runs.alias("b"), match)
        .select(*[f"a.{c}" for c in rows.columns if c not in drop], "tree", (F.col("a._at") - F.col("_first") + F.col("_before")).alias("idx"), "size"),
        name,
    )
    drop_stored(rows.sparkSession, [path])
    return out
