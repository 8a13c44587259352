"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.storage import delete_path


def scratch_root(spark: SparkSession) -> str:
    """This application's scratch folder below the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/claimlens-llm/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once its results are written elsewhere."""
    drop_stored(spark, [scratch_root(spark)])


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor re-runs only what follows) and fixes
    non-deterministic columns such as generated row ids.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch tables made by :func:`stored` that no later plan reads."""
    for path in paths:
        delete_path(spark, path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def give_back_memory() -> None:
    """Return a worker's freed memory to the system at the end of a task.

    Workers are reused: what Arrow's pool and the C allocator keep would add up over the
    stages of an application, beside the heap of the executor that they share a node with.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def text_udf(per_texts: Callable[[list[str | None]], pa.Array], spark_type: str, slice_bytes: int = 1 << 20) -> Callable[[Column], Column]:
    """An Arrow UDF over a text column that handles about ``slice_bytes`` of texts at once.

    Only the result returns to the JVM, a batch's texts never become Python strings
    together, and the worker gives its memory back when the task ends.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                parts = [per_texts(texts.slice(a, b - a).to_pylist()) for a, b in slices_by_bytes(texts, slice_bytes)]
                yield pa.concat_arrays(parts) if parts else per_texts([])
        finally:
            give_back_memory()

    return F.arrow_udf(run, spark_type)


def utf8(text: str) -> bytes:
    """UTF-8 bytes of a text (Spark strings are valid UTF-8 when they reach Python)."""
    return text.encode("utf-8", "surrogatepass")


def slices_by_bytes(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges ``[from, to)`` of consecutive texts of about ``limit`` bytes each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
