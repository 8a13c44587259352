"""File sources with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_COLUMN, ENTITY_SCHEMAS, with_corrupt_column


def read_entity_csv(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """CSV with header, the entity's explicit schema, PERMISSIVE mode.

    Malformed rows keep their text in ``_corrupt_record`` instead of failing. A file whose
    header is not the schema's column list, in its order, is an error when it is read
    (``enforceSchema`` off): columns are never taken by position under another name.
    """
    schema = with_corrupt_column(ENTITY_SCHEMAS[entity])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")
        .csv(path)
    )


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """JSON lines (or one JSON array with ``multi_line``); a missing
    path gives an empty frame with the schema."""
    try:
        return spark.read.schema(schema).option("multiLine", multi_line).json(path)
    except Exception as exc:  # missing path is an empty result, like the reference
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def feature_dim(spark: SparkSession, metadata_path: str) -> int:
    """The model input dimension from the feature metadata document.

    Unlike result files, missing metadata is an error: training cannot guess it.
    """
    from ..schemas import FEATURE_METADATA

    rows = read_json_records(spark, metadata_path, FEATURE_METADATA).select("feature_dim").limit(1).collect()
    if not rows or rows[0].feature_dim is None:
        raise FileNotFoundError(f"no feature metadata at {metadata_path}")
    return int(rows[0].feature_dim)


def latest_model(spark: SparkSession, models_dir: str) -> tuple[str, str]:
    """(node table path, model version) of the newest manifest below ``models_dir``.

    Manifests are ``<models_dir>/*/manifest``. No model is an error, not an empty forest.
    """
    from ..schemas import MODEL_MANIFEST

    manifests = read_json_records(spark, f"{models_dir.rstrip('/')}/*/manifest", MODEL_MANIFEST)
    newest = manifests.filter(F.col("created_at").isNotNull()).orderBy(F.desc("created_at"), F.desc("job_name")).limit(1).collect()
    if not newest:
        raise FileNotFoundError(f"no model manifest below {models_dir}")
    return newest[0].model_artifact_s3_path, newest[0].job_name


def latest_manifest(manifests: DataFrame) -> DataFrame:
    """The newest model by its own ``created_at`` (one row; none = empty)."""
    return manifests.agg(
        F.max_by("model_artifact_s3_path", "created_at").alias("model_artifact_s3_path"),
        F.max("created_at").alias("created_at"),
    ).filter(F.col("created_at").isNotNull())
