"""Ingestion operators: incremental watermark (F1), latest version (W6),
corrupt-row split and NaN cleanup (D19)."""

from __future__ import annotations

import datetime as _dt
import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import utc_bound
from ..schemas import CORRUPT_COLUMN


def apply_watermark(df: DataFrame, since: str | _dt.datetime | None, column: str = "updated_at") -> DataFrame:
    """rows with ``column >= since`` (inclusive); no ``since`` = full load.

    The bound is a typed timestamp literal, so the comparison is never a string
    comparison and the predicate reaches the Parquet scan.
    """
    bound = utc_bound(since)
    if bound is None:
        return df
    return df.filter(F.col(column) >= F.lit(bound).cast("timestamp"))


#: Repeated keys up to which rows are split by them: hashes of 8 bytes, 8 MB that Spark sends to the tasks.
FEW_REPEATED = 1_000_000


def repeated_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``key_hash`` of the keys that several rows have (and of any that share their hash). Only hashes are exchanged."""
    keys = [key] if isinstance(key, str) else list(key)
    has_key = reduce(operator.and_, [F.col(c).isNotNull() for c in keys])
    hashes = df.filter(has_key).select(F.xxhash64(*keys).alias("key_hash")).repartition("key_hash")
    return hashes.groupBy("key_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key_hash")


def latest_of_repeated(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str], repeated: DataFrame) -> DataFrame:
    """:func:`latest_version`, by a stored table of :func:`repeated_keys`: a row whose key comes once is the
    latest as it is, so only rows of repeated keys are exchanged and ranked.

    Where over ``FEW_REPEATED`` keys repeat, all rows are exchanged once, as splitting them would do it twice.
    """
    many = repeated.limit(FEW_REPEATED + 1).count()
    if not many:
        return df
    if many > FEW_REPEATED:
        return latest_version(df, key, order_by)
    keys = [key] if isinstance(key, str) else list(key)
    met = F.xxhash64(*[df[c] for c in keys]) == repeated["key_hash"]
    return df.join(repeated, met, "left_anti").unionByName(latest_version(df.join(repeated, met, "left_semi"), key, order_by))


def latest_version(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per ``key``: the greatest by ``order_by``, then by the
    remaining columns (a total order, so the result is deterministic).

    One exchange, made before the ranking: rows are sorted once, in shuffle partitions that the
    session sizes, and not also in every scan task (which would sort its whole file split and spill,
    though few keys repeat within one). Rows with a null key have no identity and are all kept.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ordered = [*order_by, *(c for c in df.columns if c not in keys and c not in order_by)]
    no_key = reduce(operator.or_, [F.col(c).isNull() for c in keys])
    if not ordered:
        return df.filter(~no_key).select(*keys).distinct().unionByName(df.filter(no_key))
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ordered])
    one = df.filter(~no_key).repartition(*keys).withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")
    return one.unionByName(df.filter(no_key))


def split_null_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a key, and rows without one (for quarantine: nothing can match them)."""
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows parsed cleanly, and rows Spark kept in ``_corrupt_record``."""
    if CORRUPT_COLUMN not in df.columns:
        return df, df.limit(0)
    good = df.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    bad = df.filter(F.col(CORRUPT_COLUMN).isNotNull())
    return good, bad


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null, so imputation sees it."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if c in floats else F.col(c)
            for c in df.columns
        ]
    )


def stage_status(rows_written: int, errors: int = 0, failed: bool = False) -> str:
    """Success / partial_failure / failure of a stage from its counters."""
    if failed:
        return "failure"
    return "partial_failure" if errors else "success"


def run_partition(df: DataFrame, dt: str, run_id: str) -> DataFrame:
    """Attach the ``dt`` and ``run_id`` partition values (stale ones are replaced, D5)."""
    return df.drop("dt", "run_id").withColumns({"dt": F.lit(dt), "run_id": F.lit(run_id)})
