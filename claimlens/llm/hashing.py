"""Hashed character n-grams of many texts at once, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SLICE_CHARS = 1 << 19  # characters whose n-grams are held at once


def remainder_of_id(id_column: Column, modulus: int) -> Column:
    """crc32(id as text) mod ``modulus``; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus


def sampled_rows(rows: DataFrame, per_label: int, most: int, seed: int) -> DataFrame:
    """At most ``per_label`` rows of each ``label``, ``most`` in all, by a seeded hash of ``key``.

    Two passes: counts per label give each label the hash bound below which about four times
    ``per_label`` rows lie; only those rows are ranked. So what is shuffled follows from
    ``per_label`` and not from the number of rows or tasks. Copies of a text have keys of their own.
    """
    counts, _ = stored(rows.groupBy("label").agg(F.count("*").alias("in_label")), "labels")
    at = F.xxhash64("key", F.lit(seed))
    share = at / F.lit(2.0**64) + 0.5  # of the hash range, 0 to 1
    near = rows.withColumn("at", at).join(counts, "label").where(share <= F.lit(4.0 * per_label) / F.col("in_label"))
    order = Window.partitionBy("label").orderBy("at", "key")
    return (
        near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_label)
        .orderBy("n", "at", "label").limit(most).drop("key", "in_label", "n")
    )


def bags(column: pa.ChunkedArray) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Rows of ``array<struct<bucket: array<int>, share: array<float>>>`` as views of Arrow's buffers."""
    out = []
    for chunk in column.chunks:
        outer, items = np.asarray(chunk.offsets), chunk.values
        bucket, share = items.field("bucket"), items.field("share")
        cuts = np.asarray(bucket.offsets)
        buckets, shares = np.asarray(bucket.values), np.asarray(share.values)
        cells = [(buckets[a:b], shares[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        out += [cells[a:b] for a, b in zip(outer[:-1], outer[1:], strict=True)]
    return out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts end to end, offsets of the texts)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return points, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


def runs_of_chars(texts: list[str], limit: int | None = None, each: int = 0) -> list[tuple[int, int]]:
    """Ranges of consecutive texts with about ``limit`` characters each, a text counting ``each`` more."""
    limit = limit or SLICE_CHARS
    out, start, total = [], 0, 0
    for i, t in enumerate(texts):
        size = len(t) + each
        if i > start and total + size > limit:
            out.append((start, i))
            start, total = i, 0
        total += size
    return [*out, (start, len(texts))] if texts else []


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def words_of(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters only, a blank for each run of other characters: (points, offsets, separator?).

    Every text is to begin and end with a blank; its first one stays.
    """
    gap = ~letters()[points]
    keep = np.ones(len(points), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    keep[offsets[:-1][np.diff(offsets) > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    gap = gap[keep]
    return np.where(gap, np.uint32(32), points[keep]), kept[offsets], gap


def gram_buckets(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram at each position (n - 1 fewer than points)."""
    m = len(points) - n + 1
    if m <= 0:
        return np.empty(0, np.int64)
    h = np.full(m, (0x811C9DC5 + 0x9E3779B1 * n) & 0xFFFFFFFF, np.uint32)
    for k in range(n):
        h ^= points[k:m + k]
        h *= np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return (h >> np.uint32(32 - bits)).astype(np.int64)


def grams_inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """For each n-gram position of the joined texts: does the gram lie within one text?"""
    total = int(offsets[-1])
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(total)
    return left[: max(0, total - n + 1)] >= n


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of rows between consecutive offsets (zero for empty segments)."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full) and len(values):
        out[full] = np.add.reduceat(values[: offsets[-1]], offsets[:-1][full], axis=0, dtype=out.dtype)
    return out
