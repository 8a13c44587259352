"""Score files without keys (S5, J5): line n of a score file belongs to row n of the feature file of its name.

Files are read in splits by many tasks. A line's number is its place in its split plus the lines of
the file's earlier splits, so it is exact however a file is cut. Alignment is an equi-join on (file, line): a
missing or extra line is an error of its own file and shifts nothing elsewhere.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.stages import stage_root
from .score_lines import parse_score_lines


def base_name(name: Column) -> Column:
    """Name of the scored file: without folders and the ``.out`` that a scoring job appends."""
    return F.regexp_replace(F.regexp_extract(name, r"([^/]+)$", 1), r"\.out$", "")


def numbered_lines(spark: SparkSession, path: str, name: Column | None = None) -> DataFrame:
    """``file, line`` (from 0), ``value`` of every line of the text files below ``path``, blank ones included.

    ``name`` gives the file's key (by default :func:`base_name` of its path; a partition column may serve). What is
    added up is one row per split; a file of any size is read by as many tasks as it has splits.
    """
    read = spark.read.text(path)
    named = read.select(
        (name if name is not None else base_name(F.col("_metadata.file_path"))).alias("file"),
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value",
    ).withColumn("at", F.monotonically_increasing_id())
    folder = f"{stage_root(spark)}/score-lines-{uuid.uuid4().hex[:12]}"
    named.write.parquet(folder)  # the numbers of a task's lines are fixed from here on
    lines = spark.read.schema(named.schema).parquet(folder)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("path", "block").agg(F.min("at").alias("first"), F.count("*").alias("lines")).withColumn(
        "before", F.coalesce(F.sum("lines").over(before), F.lit(0))
    )
    return lines.join(blocks, ["path", "block"]).select("file", (F.col("at") - F.col("first") + F.col("before")).alias("line"), "value")


def feature_rows(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, claim_id`` of the stored features: Parquet knows each row's place in its file."""
    return spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("line"), "claim_id"
    )


def align_by_line(features: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``claim_id, file, line, raw_score, parse_error`` of the matched rows, ``file, line, error`` of the others).

    Errors: ``missing_score`` (a feature row without a line), ``extra_score`` (a line beyond its feature
    file), ``unknown_file`` (a score file without a feature file). Blank lines are scores that are no number.
    A file whose counts differ may have lost any of its lines, so all its matched rows are
    withheld as ``count_mismatch`` errors: no score goes to the wrong claim.
    """
    # an even deal over all partitions: rows without their texts pack so small that AQE would join millions in one task
    dealt = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "line"
    f = features.select("file", "line", "claim_id", F.lit(True).alias("has_row")).repartition(*dealt)
    s = lines.select("file", "line", "value", F.lit(True).alias("has_line")).repartition(*dealt)
    both = f.join(s, ["file", "line"], "full_outer")
    odd = both.filter(F.col("has_row").isNull() | F.col("has_line").isNull())
    known = features.select("file").distinct().withColumn("known", F.lit(True))
    errors = odd.join(known, "file", "left").select(
        "file", "line",
        F.when(F.col("has_line").isNull(), "missing_score").when(F.col("known"), "extra_score").otherwise("unknown_file").alias("error"),
    )
    uneven = odd.select("file").distinct().withColumn("uneven", F.lit(True))
    matched = both.filter("has_row and has_line").join(uneven, "file", "left")
    withheld = matched.filter("uneven").select("file", "line", F.lit("count_mismatch").alias("error"))
    shown = F.when(F.trim("value") == "", F.lit("(blank)")).otherwise(F.col("value"))
    good = parse_score_lines(matched.filter(F.col("uneven").isNull()).withColumn("value", shown))
    return good.select("claim_id", "file", "line", "raw_score", "parse_error"), errors.unionByName(withheld)
