"""Embedding near-dedup by NN-descent within each label.

A neighbour graph starts from random-projection cells and is refined by joins of neighbours
of neighbours: the lists of the nodes of one cell, forward and reverse, are joined in one
block, whose pairs are all compared. A node whose list holds only links (it is saturated)
gets a longer list. A sample audited by brute force decides when to stop. Edges at or above
the threshold are the links; their components are the near-duplicate groups. Nodes that stay
saturated are compared exactly: with those of the label's other groups, so that links that no
list has room for join them, and then within the joined group for their counts.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stored, stored
from .graph import connected_components

CELL = 128  # nodes that a cell aims at
BLOCK = 512  # nodes of a cell that are compared in one block
STRIP = 512  # rows of a similarity matrix that are held at once
AUDIT_VALUES = 1 << 20  # numbers in the vectors of an audit's sample at most
EDGES = "label_key string, node long, other long, cos double"


def unit_rows(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of length 1, in doubles."""
    column = column.combine_chunks()
    rows = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def pair_cosines(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of row pairs, summed in one fixed order, so a pair has one value wherever it meets."""
    return np.einsum("ij,ij->i", rows[np.minimum(a, b)], rows[np.maximum(a, b)])


def best_pairs(rows: np.ndarray, nodes: np.ndarray, keep: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row, its ``keep`` best others with a cosine above ``floor``: (row, other, cosine).

    The matrix is made strip by strip; ``nodes`` sorts rows, so pairs are summed in node order.
    """
    order = np.argsort(nodes, kind="stable")
    rows, keep, floor = rows[order], keep[order], floor[order]
    most = min(len(rows) - 1, int(keep.max(initial=0)))
    at, to = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if most > 0:
        for start in range(0, len(rows), STRIP):
            cos = rows[start:start + STRIP] @ rows.T
            own = np.arange(len(cos))
            cos[own, start + own] = -2
            top = np.argpartition(-cos, most - 1, axis=1)[:, :most]
            value = np.take_along_axis(cos, top, 1)
            rank = np.argsort(np.argsort(-value, axis=1, kind="stable"), axis=1, kind="stable")
            mine = start + own[:, None]
            good = (rank < keep[mine]) & (value > floor[mine]) & (value > -1.5)
            at.append(np.broadcast_to(mine, top.shape)[good])
            to.append(top[good])
    a, b = np.concatenate(at), np.concatenate(to)
    return order[a], order[b], pair_cosines(rows, a, b)


def _nodes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): every input row with its checked vector, and one node per distinct (label, vector)."""
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists("v", lambda x: x != 0.0)
    rows, _ = stored(
        vectors.select(
            F.col(f"`{id_col}`").cast("long").alias("vec_id"),
            F.col(f"`{label_col}`").cast("string").alias("label"),
            F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
        ).withColumn("v", F.when(F.col("label").isNotNull() & usable, F.col("v")))
        # vectors of different length have no cosine: the length is part of the group
        .withColumn("label_key", F.when(F.col("v").isNotNull(), F.concat_ws(":", F.size("v").cast("string"), "label"))),
        "rows",
    )
    nodes, _ = stored(
        rows.where("v is not null").groupBy("label_key", "v")
        .agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    return rows, nodes


def _cells(nodes: DataFrame, trees: int, seed: int) -> DataFrame:
    """``(label_key, node, tree, cell, part)``: signs of random projections, as many as the
    label's size asks for; a cell that stays large is dealt into parts of about BLOCK nodes."""
    counts = nodes.groupBy("label_key").agg(F.count("*").alias("in_label"))
    sized = nodes.select("label_key", "node", "v").join(counts, "label_key")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = np.diff(np.asarray(batch.column(2).offsets))
            flat = np.asarray(batch.column(2).flatten())
            first = np.concatenate([[0], np.cumsum(wide)[:-1]])
            bits = np.ceil(np.log2(np.maximum(1, np.asarray(batch.column(3)) / CELL))).astype(int).clip(0, 60)
            code = np.zeros((len(batch), trees), np.int64)
            for width in np.unique(wide):
                at = np.flatnonzero(wide == width)
                rows = flat[first[at][:, None] + np.arange(width)[None, :]]
                for tree in range(trees):
                    planes = np.random.default_rng([seed, tree, int(width)]).standard_normal((60, width))
                    signs = (rows @ planes.T > 0) & (np.arange(60)[None, :] < bits[at][:, None])
                    code[at, tree] = signs @ (1 << np.arange(60, dtype=np.int64))
            for tree in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.full(len(batch), tree, np.int32)), pa.array(code[:, tree])],
                    names=["label_key", "node", "tree", "cell"],
                )

    coded, _ = stored(sized.select("label_key", "node", "v", "in_label").mapInArrow(sign, "label_key string, node long, tree int, cell long"), "cells")
    full = coded.groupBy("label_key", "tree", "cell").agg(F.count("*").alias("in_cell")).where(F.col("in_cell") > BLOCK)
    parts = F.ceil(F.coalesce("in_cell", F.lit(1)) / float(BLOCK))
    return coded.join(full, ["label_key", "tree", "cell"], "left").select(
        "label_key", "node", "tree", "cell", F.pmod(F.xxhash64("node", "tree"), parts).cast("int").alias("part")
    )


def _first_lists(nodes: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """The k best neighbours of each node within its cell of every tree."""

    def compare(group: pa.Table) -> pa.Table:
        n = group.num_rows
        found = np.asarray(group.column("node").combine_chunks())
        a, b, cos = best_pairs(unit_rows(group.column("v")), found, np.full(n, k), np.full(n, -2.0))
        label = group.column("label_key").combine_chunks()
        return pa.table({"label_key": label.take(pa.array(a)), "node": found[a], "other": found[b], "cos": cos})

    return (
        cells.join(nodes.select("node", "v"), "node")
        .groupBy("label_key", "tree", "cell", "part")
        .applyInArrow(compare, EDGES)
    )


def _merge(edges: DataFrame, wanted: DataFrame | None, k: int, most: int) -> DataFrame:
    """One row per node: its best neighbours ``near`` (cosine, other), as many as it may keep.

    ``wanted`` has the list lengths of the nodes that were saturated (others keep ``k``).
    No list is longer than ``most``: a group-limited window cuts them before they are gathered.
    """
    best = Window.partitionBy("node").orderBy(F.desc("cos"), F.desc("other"))
    lists = edges.distinct().withColumn("n", F.row_number().over(best)).where(F.col("n") <= most).groupBy("label_key", "node").agg(
        F.sort_array(F.collect_list(F.struct("cos", "other")), asc=False).alias("near")
    )
    if wanted is None:
        return lists.select("label_key", "node", F.lit(k).alias("keep"), F.slice("near", 1, k).alias("near"))
    return lists.join(wanted, "node", "left").withColumn("keep", F.coalesce("keep", F.lit(k))).select(
        "label_key", "node", "keep", F.expr("slice(near, 1, keep)").alias("near")
    )


def _local_join(nodes: DataFrame, lists: DataFrame, cells: DataFrame, tree: int, k: int, threshold: float) -> DataFrame:
    """Better pairs among neighbours of neighbours.

    A cell's block holds its nodes, their neighbours and (k of) the nodes that name them.
    All pairs of a block are compared in one matrix, which covers each node's own join;
    a node takes only what beats the last entry of its list.
    """
    links = lists.select("label_key", "node", F.explode("near").alias("n")).select("label_key", "node", F.col("n.other").alias("other"))
    home = cells.where(F.col("tree") == tree).select("node", "cell", "part")
    own = home.join(lists.select("node", "label_key"), "node").select("label_key", "cell", "part", "node")
    forward = links.join(home, "node").select("label_key", "cell", "part", F.col("other").alias("node"))
    # reverse neighbours: the node that names a host joins the host's block, k of them at most
    some = Window.partitionBy("host").orderBy(F.hash("node", F.lit(tree)), "node")
    named = (
        links.select("label_key", F.col("other").alias("host"), F.col("node"))
        .withColumn("n", F.row_number().over(some)).where(F.col("n") <= k)
    )
    reverse = named.join(home.withColumnRenamed("node", "host"), "host").select("label_key", "cell", "part", "node")
    members = own.unionByName(forward).unionByName(reverse).distinct()
    state = lists.select(
        "node", "keep", F.when(F.size("near") >= F.col("keep"), F.col("near")[F.size("near") - 1]["cos"]).otherwise(F.lit(-2.0)).alias("last")
    )
    full = members.join(state, "node").join(nodes.select("node", "v"), "node")

    def compare(group: pa.Table) -> pa.Table:
        found = np.asarray(group.column("node").combine_chunks())
        keep = np.asarray(group.column("keep").combine_chunks()).astype(np.int64)
        last = np.asarray(group.column("last").combine_chunks())
        floor = np.where(keep > k, np.maximum(last, threshold - 1e-9), last)  # a longer list is for links
        a, b, cos = best_pairs(unit_rows(group.column("v")), found, keep, floor)
        label = group.column("label_key").combine_chunks()
        return pa.table({"label_key": label.take(pa.array(a)), "node": found[a], "other": found[b], "cos": cos})

    return full.groupBy("label_key", "cell", "part").applyInArrow(compare, EDGES)


def _flat(lists: DataFrame) -> DataFrame:
    return lists.select("label_key", "node", F.explode("near").alias("n")).select(
        "label_key", "node", F.col("n.other").alias("other"), F.col("n.cos").alias("cos")
    )


def _saturated(threshold: float) -> Column:
    """Whether a node's list is full of links, so that there may be links it has no room for."""
    return (F.size("near") >= F.col("keep")) & (F.col("near")[F.size("near") - 1]["cos"] >= threshold)


def sampled_links(nodes: DataFrame, threshold: float, sample: int, seed: int) -> DataFrame:
    """``(node, other)``: all links of ``sample`` nodes, by brute force.

    The sampled vectors (a stated number) go to every task, which compares its nodes with them.
    """
    chosen = nodes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(sample).select("label_key", "node", "v").collect()
    by_label: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for label in {r.label_key for r in chosen}:
        mine = [r for r in chosen if r.label_key == label]
        rows = np.array([r.v for r in mine], np.float64)
        by_label[label] = np.array([r.node for r in mine]), rows / np.linalg.norm(rows, axis=1)[:, None]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            out_a, out_b = [], []
            for label in set(labels) & set(by_label):
                at = np.flatnonzero(labels == label)
                names, rows = by_label[label]
                part = batch.column(2).take(pa.array(at))
                own = np.asarray(batch.column(1))[at]
                others = unit_rows(pa.chunked_array([part])).T
                for start in range(0, len(rows), STRIP):
                    hit = rows[start:start + STRIP] @ others >= threshold
                    hit &= names[start:start + STRIP, None] != own[None, :]
                    a, b = np.nonzero(hit)
                    out_a.append(names[start + a])
                    out_b.append(own[b])
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["node", "other"])

    return nodes.select("label_key", "node", "v").mapInArrow(compare, "node long, other long")


def enough_links(nodes: DataFrame, threshold: float, sample: int, least_links: int, seed: int) -> tuple[DataFrame, str]:
    """The stored :func:`sampled_links` of as many nodes, from ``sample`` on, as have ``least_links`` links.

    The sample ends at all nodes or at AUDIT_VALUES numbers; that fewer links were met there is reported.
    """
    total, width = nodes.agg(F.count("*"), F.max(F.size("v"))).first()
    bound = min(total, max(sample, AUDIT_VALUES // max(1, width or 1)))
    sample = min(sample, bound)
    while True:
        truth, path = stored(sampled_links(nodes, threshold, sample, seed), "truth")
        links = truth.count()
        if links >= least_links or sample >= bound:
            if links < least_links and bound < total:
                warnings.warn(f"recall is audited on {links} links of {sample} nodes, fewer than {least_links}", stacklevel=2)
            return truth, path
        drop_stored(nodes.sparkSession, [path])
        sample = min(bound, 4 * sample)


def audited_recall(nodes: DataFrame, lists: DataFrame, threshold: float, sample: int, seed: int) -> float:
    """:func:`recall_of` the links of ``sample`` nodes."""
    return recall_of(sampled_links(nodes, threshold, sample, seed), lists, threshold)


def recall_of(truth: DataFrame, lists: DataFrame, threshold: float) -> float:
    """Share of the links ``truth`` that the graph has, 1 if there are none.

    All of them are expected; those between two saturated nodes are not in the lists but are
    always found, as such nodes are compared exactly afterwards.
    """
    found = _flat(lists).where(F.col("cos") >= threshold).select("node", "other", F.lit(1).alias("hit"))
    found = found.unionByName(found.select(F.col("other").alias("node"), F.col("node").alias("other"), "hit")).distinct()
    full = lists.where(_saturated(threshold)).select("node", F.lit(1).alias("full"))
    total, hits = (
        truth.join(found, ["node", "other"], "left").join(full, "node", "left")
        .join(full.select(F.col("node").alias("other"), F.col("full").alias("other_full")), "other", "left")
        .agg(F.count("*"), F.count(F.coalesce("hit", F.col("full") * F.col("other_full")))).first()
    )
    return 1.0 if not total else hits / total


def neighbour_graph(
    nodes: DataFrame, threshold: float, k: int = 10, most: int = 80, trees: int = 4, rounds: int = 8,
    recall: float = 0.98, sample: int = 256, seed: int = 7, least_links: int = 200, more_rounds: int = 24,
) -> tuple[DataFrame, DataFrame, list[float]]:
    """(lists, saturated nodes at the longest list, recall audited after every round).

    Rounds go on until the audit, on a sample with ``least_links`` links, reaches ``recall`` and
    no list can still be enlarged or changes. Once no list changes, or after ``rounds``
    rounds, a round also compares the cells of ``trees`` new trees. A recall that ``more_rounds``
    of these do not reach is an error. Every round is one stored table.
    """
    cells, _ = stored(_cells(nodes, trees, seed), "parts")
    lists, path = stored(_merge(_first_lists(nodes, cells, k), None, k, most), "lists")
    truth, truth_path = enough_links(nodes, threshold, sample, least_links, seed)
    audits = [recall_of(truth, lists, threshold)]
    changed, added = True, 0
    for round_ in range(rounds + more_rounds):
        saturated = _saturated(threshold)
        wanted, wanted_path = stored(
            lists.select("node", F.when(saturated, F.least(F.col("keep") * 2, F.lit(most))).otherwise(F.col("keep")).alias("keep"), saturated.alias("more"))
            .where((F.col("keep") > k) | F.col("more")), "wanted",
        )
        enlarged = wanted.where(F.col("more") & (F.col("keep") < most)).limit(1).count()
        enough = audits[-1] >= recall
        if enough and (round_ >= rounds or not changed or (not enlarged and round_)):
            break
        longer = lists.drop("keep").join(wanted.select("node", "keep"), "node", "left").withColumn("keep", F.coalesce("keep", F.lit(k)))
        edges, grown = _flat(lists), []
        if not enough and (round_ >= rounds or not changed):
            if added == more_rounds:
                break
            added += 1
            more, more_path = stored(_cells(nodes, trees, seed + added), "parts")
            grown.append(more_path)
            edges = edges.unionByName(_first_lists(nodes, more, k)).unionByName(_local_join(nodes, longer, more, 0, k, threshold))
        else:
            edges = edges.unionByName(_local_join(nodes, longer, cells, round_ % trees, k, threshold))
        following, next_path = stored(_merge(edges, wanted.select("node", "keep"), k, most), "lists")
        size = lambda df: tuple(df.agg(F.count("*"), F.sum(F.aggregate("near", F.lit(0.0), lambda s, n: s + n["cos"]))).first())
        changed = size(lists) != size(following)
        drop_stored(nodes.sparkSession, [path, wanted_path, *grown])
        lists, path = following, next_path
        audits.append(recall_of(truth, lists, threshold))
    drop_stored(nodes.sparkSession, [truth_path])
    if audits[-1] < recall:
        raise RuntimeError(f"recall {audits[-1]:.4f} after {len(audits) - 1} rounds, below {recall}: raise trees, rounds or more_rounds")
    return lists, lists.where(_saturated(threshold)).select("node"), audits


def _joined_groups(nodes: DataFrame, full: DataFrame, threshold: float) -> DataFrame:
    """``(root, joined)`` for each root of ``full(node, root)`` that links between saturated nodes
    of different groups join to others: the links that their lists have no room for.

    A group's saturated nodes are dealt into pieces of about BLOCK. Pieces of one label are
    compared by centre and widest angle, which rules out only pairs that cannot hold a link; the
    nodes of the others are all compared. A pair of pieces returns one row at most, never its links.
    """
    sizes = full.groupBy("root").agg(F.ceil(F.count("*") / float(BLOCK)).cast("int").alias("pieces"))
    dealt, dealt_path = stored(
        full.join(sizes, "root").join(nodes.select("node", "label_key", "v"), "node")
        .select("label_key", "root", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int").alias("piece"), "node", "v"),
        "dealt",
    )

    def ball(group: pa.Table) -> pa.Table:
        rows = unit_rows(group.column("v"))
        centre = rows.mean(axis=0)
        length = np.linalg.norm(centre)
        centre = centre / length if length > 1e-6 else rows[0]
        wide = np.arccos(np.clip(rows @ centre, -1, 1)).max()
        return group.select(["label_key", "root", "piece"]).slice(0, 1).append_column("v", pa.array([centre])).append_column("wide", pa.array([wide]))

    balls, balls_path = stored(
        dealt.groupBy("label_key", "root", "piece").applyInArrow(ball, "label_key string, root long, piece int, v array<double>, wide double"), "balls"
    )
    blocks = balls.groupBy("label_key").agg(F.ceil(F.count("*") / float(BLOCK)).cast("int").alias("blocks"))
    placed = balls.join(blocks, "label_key").withColumn("block", F.pmod(F.xxhash64("root", "piece"), F.col("blocks")).cast("int"))
    paired = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label_key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "root", "piece", "v", "wide"
    )
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6  # the margin covers rounding

    def close(group: pa.Table) -> pa.Table:
        block, root, piece, wide = (np.asarray(group.column(c).combine_chunks()) for c in ("block", "root", "piece", "wide"))
        rows = unit_rows(group.column("v"))
        split = block.min() != block.max()
        at, to = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for start in range(0, len(rows), STRIP):
            strip = slice(start, start + STRIP)
            good = np.arccos(np.clip(rows[strip] @ rows.T, -1, 1)) - wide[strip, None] - wide[None, :] <= reach
            good &= root[strip, None] > root[None, :]
            if split:
                good &= block[strip, None] != block[None, :]  # pairs within a block are met where it meets itself
            a, b = np.nonzero(good)
            at.append(a + start)
            to.append(b)
        a, b = np.concatenate(at), np.concatenate(to)
        return pa.table({"u": root[a], "u_piece": piece[a], "v": root[b], "v_piece": piece[b]})

    near, near_path = stored(paired.groupBy("label_key", "i", "j").applyInArrow(close, "u long, u_piece int, v long, v_piece int"), "near")
    pair = ["u", "u_piece", "v", "v_piece"]
    sides = near.select(*pair, F.col("u").alias("root"), F.col("u_piece").alias("piece")).unionByName(
        near.select(*pair, F.col("v").alias("root"), F.col("v_piece").alias("piece"))
    )
    both = sides.join(dealt.withColumnRenamed("v", "row"), ["root", "piece"])

    def linked(group: pa.Table) -> pa.Table:
        node, root = (np.asarray(group.column(c).combine_chunks()) for c in ("node", "root"))
        order = np.argsort(node, kind="stable")
        rows, root = unit_rows(group.column("row"))[order], root[order]
        u, v = group.column("u")[0].as_py(), group.column("v")[0].as_py()
        ours, theirs = np.flatnonzero(root == u), np.flatnonzero(root == v)
        for start in range(0, len(ours), STRIP):
            a, b = np.nonzero(rows[ours[start:start + STRIP]] @ rows[theirs].T >= threshold - 1e-9)
            if (pair_cosines(rows, ours[start + a], theirs[b]) >= threshold).any():
                return pa.table({"u": [u], "v": [v]})
        return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})

    joined = connected_components(both.groupBy(*pair).applyInArrow(linked, "u long, v long"))
    drop_stored(nodes.sparkSession, [dealt_path, balls_path, near_path])
    return joined.select(F.col("node").alias("root"), F.col("root").alias("joined"))


def _counted_in_blocks(nodes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """``(node, n_links)`` by exact comparison within each group: the way for saturated lists.

    A group's nodes are dealt into blocks of about BLOCK; each pair of blocks is one
    task-sized matrix that returns counts per node, never pairs.
    """
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / float(BLOCK)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "root").join(nodes.select("node", "v", "copies"), "node").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    paired = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "v", "copies"
    )

    def count(group: pa.Table) -> pa.Table:
        block = np.asarray(group.column("block").combine_chunks())
        node = np.asarray(group.column("node").combine_chunks())
        order = np.argsort(node, kind="stable")
        rows, copies = unit_rows(group.column("v"))[order], np.asarray(group.column("copies").combine_chunks())[order]
        block, node = block[order], node[order]
        links = np.zeros(len(node), np.int64)
        split = block.min() != block.max()
        for start in range(0, len(node), STRIP):
            near = rows[start:start + STRIP] @ rows.T
            a, b = np.nonzero(near >= threshold - 1e-9)
            a += start
            good = (a != b) & (pair_cosines(rows, a, b) >= threshold)
            if split:
                good &= block[a] != block[b]  # pairs within a block are counted where it meets itself
            np.add.at(links, a[good], copies[b[good]])
        return pa.table({"node": node, "links": links})

    counted = paired.groupBy("root", "i", "j").applyInArrow(count, "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("others"))


def embedding_groups(
    vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    **graph_options,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors``.

    Rows with equal label and vector are one node with its number of copies, so a vector
    that a third of the rows share costs one node. Links are pairs of rows with one label and a
    cosine of at least ``threshold``, in doubles. ``n_links`` counts linked rows, copies
    included; ``component_id`` is the least vec_id that links reach; ``kept`` marks it. The lists
    are capped, so groups with a saturated node are compared with each other and counted
    exactly, block by block.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a
    label, link with nothing: no links, their own id, kept. Null ids never are a group's
    id while it has another (``kept`` is then false for them). Vectors of different length
    do not link. An empty table gives no rows.
    """
    rows, nodes = _nodes(vectors, id_col, vector_col, label_col)
    lists, saturated, _ = neighbour_graph(nodes, threshold, **graph_options)
    links, _ = stored(
        _flat(lists).where(F.col("cos") >= threshold).select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).distinct(),
        "links",
    )
    parts, _ = stored(connected_components(links), "components")
    full, _ = stored(parts.join(saturated, "node"), "full")
    several = full.select("root").distinct().join(nodes.select(F.col("node").alias("root"), "label_key"), "root").groupBy("label_key").count().where("count > 1")
    if several.limit(1).count():
        parts, _ = stored(
            parts.join(_joined_groups(nodes, full, threshold), "root", "left").select("node", F.coalesce("joined", "root").alias("root")), "joined"
        )
    least = parts.join(nodes.select("node", "least_id"), "node").groupBy("root").agg(F.min("least_id").alias("component_id"))
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    listed = both.join(nodes.select(F.col("node").alias("v"), "copies"), "v").groupBy("u").agg(F.sum("copies").alias("others"))
    dense = parts.join(saturated, "node", "left_semi").select("root").distinct()
    members, _ = stored(parts.join(dense, "root", "left_semi"), "members")
    counted = _counted_in_blocks(nodes, members, threshold)
    others = listed.select(F.col("u").alias("node"), "others").join(members.select("node"), "node", "left_anti").unionByName(counted)
    found, _ = stored(
        nodes.join(parts.join(least, "root").select("node", "component_id", F.lit(True).alias("linked")), "node", "left")
        .join(others, "node", "left")
        .select(
            "label_key", "v", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least_id")).alias("component_id"),
        ),
        "found",
    )
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("v is not null").join(found, ["label_key", "v"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
