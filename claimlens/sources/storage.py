"""Paths in shared storage, through Spark's own file systems (never ``os`` or ``open``)."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table or run folder that this program made."""
    target, fs = _filesystem(spark, path)
    fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _filesystem(spark, path)
    return fs.exists(target)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path (a listing, no job); 0 where it does not exist."""
    target, fs = _filesystem(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def listing_digest(spark: SparkSession, path: str) -> str:
    """Digest of names, sizes and times of the files below a path: it changes when the input does."""
    target, fs = _filesystem(spark, path)
    digest = hashlib.sha256(path.encode())
    if not fs.exists(target):
        return digest.hexdigest()[:16]
    files, found = fs.listFiles(target, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    digest.update("\n".join(sorted(found)).encode())
    return digest.hexdigest()[:16]


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A Parquet table, or None where its path does not exist or holds no files.

    Any other failure (permissions, corrupt footers, a lost node) is raised: it must
    not pass for an empty table.
    """
    if not path_exists(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there whole or not at all; an existing one is an error."""
    target, fs = _filesystem(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    draft, _ = _filesystem(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, target):
        raise OSError(f"cannot publish {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a whole."""
    return spark.read.text(path, wholetext=True).first()[0]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none where it does not exist."""
    target, fs = _filesystem(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []
