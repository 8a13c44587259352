"""Exact top-k inner products by a three-phase uniform threshold.

The inner product is a sum over slices of the dimensions; a slice's partial products are
its local scores. (1) Every slice contributes its best local entries; of the entries
gathered, the k-th best total is a score that the answer certainly reaches. (2) A total of
at least that cutoff needs a local score of at least cutoff / slices in some slice: this
uniform threshold goes to all tasks, and each collects the entries that reach it. (3) An
entry whose known local scores, with the threshold for the others, stay below the cutoff is
dropped; what remains is resolved to its exact total.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCK_SCORES = 1 << 20  # scores of one slice that a task holds at once
EXACT = 1 << 53  # sums of integers below this are exact in doubles


def quantised(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(id, q, asks)``: floor(scale * x) of each component, one row per (id, vector)."""
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (
        vectors.select(
            F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), is_query.alias("asks")
        )
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & ok)
        .select("id", F.transform("v", lambda x: F.floor(x * float(scale))).alias("q"), F.coalesce("asks", F.lit(False)).alias("asks"))
        .groupBy("id", "q")
        .agg(F.max("asks").alias("asks"))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones padded with zeros."""
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten())
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles, longs or Python integers, as their size allows."""
    bound = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * max(1, queries.shape[1])
    if bound < EXACT:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if bound < 1 << 62:
        return queries @ rows.T
    lowest, highest = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    return np.clip(queries.astype(object) @ rows.T.astype(object), lowest, highest).astype(np.int64)


def _best(scores: np.ndarray, least_ids: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """Which of the ``found`` columns of one query are its k best (score, then least id)."""
    if len(found) <= k:
        return found
    return found[np.lexsort((least_ids[found], -scores[found]))[:k]]


class _Running:
    """The k best (score, least id) entries of each query over all blocks that a task reads."""

    def __init__(self, n: int, k: int):
        self.k, self.entries = k, [([], [], []) for _ in range(n)]

    def add(self, query: int, scores: np.ndarray, classes: np.ndarray, least: np.ndarray) -> None:
        own = self.entries[query]
        for kept, new in zip(own, (scores, classes, least), strict=True):
            kept.extend(new.tolist())
        if len(own[0]) > 4 * self.k:
            self.entries[query] = self._cut(own)

    def _cut(self, own):
        order = np.lexsort((np.array(own[2]), -np.array(own[0], np.int64)))[: self.k].tolist()
        return tuple([kept[i] for i in order] for kept in own)

    def batch(self, names: np.ndarray) -> pa.RecordBatch:
        query, classes, scores = [], [], []
        for i, own in enumerate(self.entries):
            if own[0]:
                s, c, _ = self._cut(own)
                query += [int(names[i])] * len(s)
                classes += c
                scores += s
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (query, classes, scores)], names=["asked", "class", "score"])


def _local_scores(batch: pa.RecordBatch, queries: np.ndarray, slices: list[slice]):
    """Per block of rows: classes, least ids and the local scores of each slice."""
    rows = _matrix(batch.column(1), queries.shape[1])
    classes, least = np.asarray(batch.column(0)), np.asarray(batch.column(2))
    size = max(1, BLOCK_SCORES // max(1, len(queries)))
    for at in range(0, len(rows), size):
        part = rows[at:at + size]
        yield classes[at:at + size], least[at:at + size], [_products(queries[:, s], part[:, s]) for s in slices]


def _gather(classes: DataFrame, names: np.ndarray, queries: np.ndarray, slices: list[slice], k: int) -> DataFrame:
    """Phase 1: the best local entries of every slice, with their totals, the k best per task and query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Running(len(queries), k)
        for batch in batches:
            for own, least, local in _local_scores(batch, queries, slices):
                total = sum(local)
                top = min(k, len(own))
                lists = [np.argpartition(-part, top - 1, axis=1)[:, :top] for part in local]
                for i in range(len(queries)):
                    found = np.unique(np.concatenate([entries[i] for entries in lists]))
                    found = _best(total[i], least, found, k)
                    best.add(i, total[i, found], own[found], least[found])
        yield best.batch(names)

    return classes.select("class", "q", "least").mapInArrow(run, "asked long, class long, score long")


def _collect(
    classes: DataFrame, names: np.ndarray, queries: np.ndarray, slices: list[slice], cutoffs: np.ndarray, k: int
) -> DataFrame:
    """Phases 2 and 3: entries over the uniform threshold, bounded, then resolved exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Running(len(queries), k)
        threshold = -((-cutoffs) // len(slices))  # rounded up: integer local scores below it cannot sum to the cutoff
        for batch in batches:
            for own, least, local in _local_scores(batch, queries, slices):
                reached = [part >= threshold[:, None] for part in local]
                some = np.logical_or.reduce(reached)
                bound = np.zeros(some.shape)
                for part, hit in zip(local, reached, strict=True):
                    bound += np.where(hit, part, threshold[:, None]).astype(np.float64)
                some &= bound + np.abs(bound) * 1e-9 + 1 >= cutoffs[:, None].astype(np.float64)
                for i in np.flatnonzero(some.any(axis=1)).tolist():
                    found = np.flatnonzero(some[i])
                    total = sum(part[i, found] for part in local)
                    good = total >= cutoffs[i]
                    at = _best(total[good], least[found[good]], np.arange(int(good.sum())), k)
                    best.add(i, total[good][at], own[found[good]][at], least[found[good]][at])
        yield best.batch(names)

    return classes.select("class", "q", "least").mapInArrow(run, "asked long, class long, score long")


def top_inner_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    slices: int = 4,
    wave_queries: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products of each query.

    Equal quantised vectors are one class with its k + 1 least ids (a group-limited
    window, so a vector that a third of the rows share costs k + 1 rows a task), and equal
    queries are asked once. Query vectors go to the tasks in waves of about ``wave_queries``,
    the bound on what is broadcast and on the cutoffs that return to the driver (one number
    per query of the wave); a wave reads the vectors twice and never shuffles them: a task
    returns k + 1 entries per query. With a cutoff of ``k + 1`` ids the answer stays whole
    after the query's own id is taken out.

    Ties go to the smaller id. Vectors that are null or hold null or non-finite components,
    and rows without an id, take no part; a shorter vector counts as padded with zeros.
    Rows that repeat an id and its vector count once; a row with the query's id but another
    vector is a candidate like any other (and a query of its own). A query with fewer candidates gets all of them. An empty table, or one
    without queries, gives no rows. Scores beyond a long are held at its limits.
    """
    spark, more = vectors.sparkSession, k + 1
    rows, _ = stored(quantised(vectors, is_query, id_col, vector_col, scale), "quantised")
    result = "query_id long, rank int, vec_id long, score long"
    width = rows.agg(F.max(F.size("q"))).first()[0]
    if width is None:
        return spark.createDataFrame([], result)
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy("id"))).where(F.col("n") <= more)
    classes, _ = stored(
        ranked.groupBy("q").agg(F.sort_array(F.collect_set("id")).alias("ids"))
        .select(F.monotonically_increasing_id().alias("class"), "q", "ids", F.col("ids")[0].alias("least")),
        "classes",
    )
    asking, _ = stored(rows.where("asks").select("id", "q").join(classes, "q").select(F.col("id").alias("query_id"), F.col("class").alias("asked")), "asking")
    asked, _ = stored(asking.select("asked").distinct().join(classes, F.col("asked") == F.col("class")).select("asked", "q"), "asked")
    waves = max(1, -(-asked.count() // wave_queries))
    edges = np.linspace(0, width, min(slices, max(1, width)) + 1).astype(int)
    cuts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    sizes = classes.select("class", F.size("ids").alias("size"))
    found = []
    for wave in range(waves):
        mine = asked.where(F.pmod(F.xxhash64("asked"), F.lit(waves)) == wave).toArrow()
        if not mine.num_rows:
            continue
        mine = mine.combine_chunks()
        names = np.asarray(mine.column("asked").combine_chunks())
        queries = _matrix(mine.column("q").combine_chunks(), width)
        gathered = _gather(classes, names, queries, cuts, more).join(sizes, "class")
        order = Window.partitionBy("asked").orderBy(F.desc("score"))
        safe = (
            gathered.withColumn("reached", F.sum("size").over(order))
            .where(F.col("reached") >= more)
            .groupBy("asked")
            .agg(F.max("score").alias("cutoff"))
            .collect()
        )
        known = {r.asked: r.cutoff for r in safe}
        lowest = -(1 << 62)  # fewer than k + 1 candidates: everything is an answer
        cutoffs = np.array([known.get(int(n), lowest) for n in names], np.int64)
        found.append(stored(_collect(classes, names, queries, cuts, cutoffs, more), "found")[0])
    if not found:
        return spark.createDataFrame([], result)
    entries = found[0]
    for other in found[1:]:
        entries = entries.unionByName(other)
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "least")
    entries = (
        entries.join(classes.select("class", "ids", "least"), "class")
        .withColumn("n", F.row_number().over(best)).where(F.col("n") <= more)
        .select("asked", "class", "score", F.explode("ids").alias("vec_id"))
    )
    by_id = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    entries = entries.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= more).drop("n")
    own = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    return (
        asking.join(entries, "asked")
        .where("vec_id <> query_id or class <> asked")
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
