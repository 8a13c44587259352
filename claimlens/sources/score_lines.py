"""Score files (S5, X7): one score per line, either a bare number or a JSON
object with ``score`` (or ``anomaly_score``; neither means 0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_score_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text scan of score files; each row keeps its source file for errors."""
    return spark.read.text(path).withColumn("source", F.col("_metadata.file_path"))


def key_score_lines(lines: DataFrame, sep: str = ",", value_col: str = "value") -> DataFrame:
    """Adds ``claim_id`` to score lines and leaves the score itself in ``value``.

    A line is ``claim_id<sep>score`` (the score in any shape of ``parse_score_lines``) or a JSON
    object with a ``claim_id`` of its own. A line without a key has a null one.
    """
    v = F.trim(F.col(value_col))
    is_object = v.startswith("{")
    at = F.locate(sep, v)
    key = F.when(is_object, F.get_json_object(v, "$.claim_id")).when(at > 0, F.trim(F.substring(v, F.lit(1), at - 1)))
    score = F.when(is_object | (at == 0), v).otherwise(F.substring(v, at + len(sep), F.length(v)))
    return lines.withColumn("claim_id", F.when(key != "", key)).withColumn(value_col, score)


def _json_score(obj: Column) -> Column:
    """Score text from a parsed object: ``score``, else ``anomaly_score``, else "0"."""
    return (
        F.when(F.map_contains_key(obj, "score"), obj["score"])
        .when(F.map_contains_key(obj, "anomaly_score"), obj["anomaly_score"])
        .otherwise(F.lit("0"))
    )


def parse_score_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``raw_score`` and ``parse_error``; blank lines are dropped.

    A line is bad when it is not a number, is broken JSON, or its score is
    JSON ``null``, not numeric or not finite (D14: one bad line never discards the
    rest; a NaN would make every normalised score one).
    """
    v = F.trim(F.col(value_col))
    is_object = v.startswith("{")
    # one parse per line: values come back as their JSON text (null stays null)
    obj = F.from_json(v, "map<string,string>")
    valid_json = obj.isNotNull()
    json_text = F.when(is_object & valid_json, _json_score(obj))
    score = F.when(is_object, json_text.try_cast("double")).otherwise(v.try_cast("double"))
    finite = ~F.isnan(score) & (F.abs(score) != F.lit(float("inf")))
    error = (
        F.when(is_object & ~valid_json, F.lit("invalid json"))
        .when(score.isNull(), F.lit("not a number"))
        .when(~finite, F.lit("not finite"))
    )
    score = F.when(finite, score)
    return (
        lines.filter(v != "")
        .withColumn("raw_score", score)
        .withColumn("parse_error", error)
    )


def split_scores(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, error rows) of ``parse_score_lines`` output."""
    return parsed.filter(F.col("parse_error").isNull()), parsed.filter(F.col("parse_error").isNotNull())
