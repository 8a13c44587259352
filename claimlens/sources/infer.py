"""Types of text columns from all their values, and drift from the stored schema.

One pass counts, per column, how many values each type of a small lattice can hold (boolean; int, bigint, double;
date, timestamp; string holds all). Counts of files or days add up, so a type is the narrowest
that held every value ever seen, and new data costs only its own scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Narrowest first; a column has the first type that holds all its values.
LATTICE = ("boolean", "int", "bigint", "double", "date", "timestamp")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text; empty values are null."""
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path)


def _shapes(v: Column) -> dict[str, Column]:
    """Whether a value looks like a moment or a number. A pattern is only tried on values of its first byte."""
    number = (v >= "+") & (v < ":")  # begins with + , - . / or a digit
    moment = number & (F.substring(v, 5, 1) == "-") & v.rlike(r"^\d{4}-\d{2}-\d{2}([T ].+)?$")
    return {"moment": moment, "decimal": number & v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")}


def _holds(v: Column) -> dict[str, Column]:
    """Whether each type can hold a value, by its shapes."""
    moment, decimal = F.col("moment"), F.col("decimal")
    whole = decimal & v.rlike(r"^[+-]?\d+$")
    return {
        "boolean": F.length(v).between(4, 5) & F.lower(v).isin("true", "false"),
        "int": whole & v.try_cast("int").isNotNull(), "bigint": whole & v.try_cast("bigint").isNotNull(),
        "double": decimal & v.try_cast("double").isNotNull(),
        "date": moment & (F.length(v) == 10) & v.try_cast("date").isNotNull(), "timestamp": moment & v.try_cast("timestamp").isNotNull(),
    }


def type_counts(texts: DataFrame) -> DataFrame:
    """``column, rows, nulls`` and a count per type: a partial aggregate, one row per column.

    Values are laid out as rows, so that one small compiled expression serves all columns, however many.
    """
    none = texts.sparkSession.range(1).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[F.lit(0).cast("long").alias(n) for n in ("rows", "nulls", *LATTICE)]) for c in texts.columns])))
    value = lambda c: F.trim(F.col(f"`{c}`"))
    laid = texts.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), value(c).alias("v")) for i, c in enumerate(texts.columns)])))
    counts = [F.count_if(F.coalesce(ok, F.lit(False))).alias(t) for t, ok in _holds(F.col("v")).items()]
    values = laid.select("i", F.when(F.col("v") != "", F.col("v")).alias("v"))
    counted = values.withColumns(_shapes(F.col("v"))).groupBy("i").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("v").isNull()).alias("nulls"), *counts)
    named = counted.select(F.array(*map(F.lit, texts.columns))[F.col("i")].alias("column"), "rows", "nulls", *LATTICE)
    return merge_counts(named, none)  # also a column of a file without rows


def merge_counts(*parts: DataFrame) -> DataFrame:
    """Counts of several files or days as one."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("column").agg(*[F.sum(c).alias(c) for c in ("rows", "nulls", *LATTICE)])


def inferred_types(counts: DataFrame) -> DataFrame:
    """``column, inferred_type, values, nulls``; a column without a value is ``void``."""
    values = F.col("rows") - F.col("nulls")
    kind = F.when(values == 0, "void")
    for t in LATTICE:
        kind = kind.when(F.col(t) == values, t)
    return counts.select("column", kind.otherwise("string").alias("inferred_type"), values.alias("values"), "nulls")


def drift(counts: DataFrame, schema: T.StructType) -> DataFrame:
    """``column, stored_type, inferred_type, values, nulls, bad_values, status`` for every column of either side.

    ``bad_values`` are those that the stored type cannot hold. Status: ``ok`` (the stored type holds all),
    ``drifted`` (it does not), ``missing`` (not in the data), ``new`` (not in the schema).
    """
    spark = counts.sparkSession
    stored = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "column string, stored_type string")
    fits = F.when(F.col("stored_type") == "string", F.col("values"))
    for t in LATTICE:
        fits = fits.when(F.col("stored_type") == t, F.col(t))
    both = inferred_types(counts).join(counts.drop("nulls"), "column").join(stored, "column", "full_outer")
    checked = both.withColumn("bad_values", F.when(F.col("stored_type").isNotNull() & F.col("rows").isNotNull(), F.col("values") - fits.otherwise(F.lit(None))))
    status = F.when(F.col("rows").isNull(), "missing").when(F.col("stored_type").isNull(), "new").when(F.col("bad_values") > 0, "drifted").otherwise("ok")
    return checked.select("column", "stored_type", "inferred_type", "values", "nulls", "bad_values", status.alias("status"))
