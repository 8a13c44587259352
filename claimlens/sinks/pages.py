"""Sorted results with a page directory (O1, O2): any page opens only the files that hold it.

Results are written once in their serving order, range-partitioned, and a directory keeps each file's
row count and first position. A row's position is its file's first position plus its place in the file,
so page 1 and the last page cost the same, and the total needs no scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.query import DEFAULT_PAGE_SIZE, _check_page, sort_value, total_pages
from ..operators.query import KEYS as RESULT_KEYS


def _file_order(name: Column) -> list[Column]:
    """Files in the order of the rows: the number of the writing task, then of its file."""
    return [F.regexp_extract(name, r"part-(\d+)-", 1).cast("long"), F.regexp_extract(name, r"-c(\d+)[.]", 1).cast("long")]


def write_pages(df: DataFrame, path: str, kind: str = "fraud", sort_by: str | None = None, descending: bool = True, rows_per_file: int = 1_000_000) -> int:
    """Write ``df`` in the order of ``sort_results`` and its directory; returns the rows.

    The key breaks ties also between ranges, so a score that a third of the rows share is spread over
    files. ``rows_per_file`` bounds what a page opens.
    """
    spark, value, key = df.sparkSession, sort_value(df, kind, sort_by), F.col(RESULT_KEYS[kind][0])
    order = [value.desc_nulls_last() if descending else value.asc_nulls_last(), key.asc()]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", rows_per_file).mode("errorifexists").parquet(f"{path}/rows")
    files = spark.read.schema(df.schema).parquet(f"{path}/rows").groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    before = Window.orderBy(*_file_order(F.col("file"))).rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).coalesce(1).write.mode("errorifexists").parquet(f"{path}/directory")
    return total_rows(spark, path)


def _directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string, rows long, before long").parquet(f"{path}/directory")


def total_rows(spark: SparkSession, path: str) -> int:
    """All rows of the stored results, from the directory."""
    return _directory(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def read_page(spark: SparkSession, path: str, page: int = 1, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """One page in order; a page beyond the last is empty. Only the files that overlap it are opened."""
    page, page_size = _check_page(page, page_size)
    low, high = (page - 1) * page_size, page * page_size
    held = _directory(spark, path).filter((F.col("before") < high) & (F.col("before") + F.col("rows") > low)).collect()
    rows = spark.read.parquet(f"{path}/rows")
    if not held:
        return rows.limit(0)
    first = F.create_map(*[x for r in held for x in (F.lit(r.file), F.lit(r.before))])
    opened = spark.read.schema(rows.schema).parquet(*[r.file for r in held])
    at = first[F.col("_metadata.file_path")] + F.col("_metadata.row_index")
    placed = opened.select("*", at.alias("_position")).filter((F.col("_position") >= low) & (F.col("_position") < high))
    return placed.orderBy("_position").drop("_position")


def last_page(spark: SparkSession, path: str, page_size: int = DEFAULT_PAGE_SIZE) -> int:
    return total_pages(total_rows(spark, path), page_size)
