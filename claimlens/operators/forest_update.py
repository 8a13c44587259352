"""Forest maintenance (M1): new claims edit the trees that they fall into, instead of a new training run.

Each tree holds the claims of its deal with the smallest hashes (a bottom-k reservoir, which a new claim enters only
by a small enough hash), so what a day changes is a few points of a few trees. A point is
deleted by removing its leaf, and inserted by the random cut of the grown box that would separate it
(Guha et al., ICML 2016), which keeps the distribution of a tree built anew.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark import cloudpickle

from .forest import NODE_SCHEMA

# as in forest.py: Python workers need no install of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGITS = 4  # of the hash, for bottom_k: 65,536 counts a tree
RESERVOIR = "tree_id int, claim_id string, h string, x array<double>"


def md5_deal(trees: int) -> tuple[Column, Column]:
    """(tree, order) of a claim id by MD5: the same in every engine."""
    digest = F.md5("claim_id")
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(trees)).cast("int"), F.substring(digest, 9, 24)


def candidates(features: DataFrame, cols: Sequence[str], trees: int) -> DataFrame:
    """``tree_id, claim_id, h, x``: every claim with its deal."""
    tree, order = md5_deal(trees)
    return features.select(tree.alias("tree_id"), "claim_id", order.alias("h"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))


def bottom_k(rows: DataFrame, samples: int) -> DataFrame:
    """The ``samples`` smallest hashes of each tree.

    Counts by the first digits of the hash say up to which digits a tree's smallest lie; only rows
    up to there (some few over ``samples``) are ranked, so no task sorts or ships the others.
    """
    digits = F.coalesce(F.substring("h", 1, DIGITS), F.lit(""))
    before = Window.partitionBy("tree").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("tree_id").alias("tree"), digits.alias("digits")).agg(F.count(F.lit(1)).alias("rows"))
    needed = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).filter(F.col("before") < samples)
    upto = needed.groupBy("tree").agg(F.max("digits").alias("upto"))  # one row per tree
    near = rows.join(F.broadcast(upto), F.col("tree_id").eqNullSafe(F.col("tree")) & (digits <= F.col("upto"))).select(*rows.columns)
    order = Window.partitionBy("tree_id").orderBy("h", "claim_id")
    return near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= samples).drop("n")


def updated_reservoir(reservoir: DataFrame, delta: DataFrame, samples: int, gone: DataFrame | None = None) -> DataFrame:
    """The reservoir after ``delta`` (:func:`candidates` of new and changed claims) and without the claims of ``gone``.

    Equal to the bottom-k of all claims while claims only come or change; where claims go, keep a reservoir
    with spare points (a greater ``samples`` here than the trees take), as what was cut off earlier is not known.
    """
    kept = reservoir
    for other in [delta] if gone is None else [delta, gone]:  # the reservoir's few ids go to the other's rows
        met = other.select("claim_id").join(F.broadcast(reservoir.select("claim_id")), "claim_id", "left_semi").distinct()
        kept = kept.join(met, "claim_id", "left_anti")
    return bottom_k(kept.select("tree_id", "claim_id", "h", "x").unionByName(delta), samples)


class Tree:
    """One tree as linked nodes ``[parent, dim, cut, left, right, mass, low, high]``."""

    def __init__(self, rows: pd.DataFrame):
        self.nodes: dict[int, list] = {}
        for r in rows.itertuples(index=False):
            self.nodes[int(r.node_id)] = [-1, int(r.dim), float(r.cut), int(r.left), int(r.right), int(r.mass), np.array(r.box_min, float), np.array(r.box_max, float)]
        for i, n in self.nodes.items():
            for child in n[3:5]:
                if child >= 0:
                    self.nodes[child][0] = i
        self.root = 0 if self.nodes else -1
        self.free = max(self.nodes, default=-1) + 1

    def _add(self, node: list) -> int:
        self.nodes[self.free] = node
        self.free += 1
        return self.free - 1

    def _replace(self, old: int, new: int) -> None:
        """``new`` takes the place of ``old`` below its parent."""
        up = self.nodes[old][0]
        if new >= 0:
            self.nodes[new][0] = up
        if up < 0:
            self.root = new
        else:
            self.nodes[up][3 if self.nodes[up][3] == old else 4] = new

    def _mend(self, at: int) -> None:
        """Masses and boxes from ``at`` up to the root, from the children's."""
        while at >= 0:
            n = self.nodes[at]
            a, b = self.nodes[n[3]], self.nodes[n[4]]
            n[5], n[6], n[7] = a[5] + b[5], np.minimum(a[6], b[6]), np.maximum(a[7], b[7])
            at = n[0]

    def delete(self, x: np.ndarray) -> None:
        at = self.root
        while at >= 0 and self.nodes[at][1] >= 0:
            n = self.nodes[at]
            at = n[3] if x[n[1]] <= n[2] else n[4]
        if at < 0 or not np.array_equal(self.nodes[at][6], x):
            raise ValueError("the tree does not hold the point that is to be deleted")
        leaf = self.nodes[at]
        leaf[5] -= 1
        up = leaf[0]
        if leaf[5] == 0:
            if up < 0:
                self.root = -1
            else:
                other = self.nodes[up][4] if self.nodes[up][3] == at else self.nodes[up][3]
                self._replace(up, other)
                grand = self.nodes[other][0]
                del self.nodes[up]
                up = grand
            del self.nodes[at]
        self._mend(up)

    def insert(self, x: np.ndarray, rng: np.random.Generator) -> None:
        if self.root < 0:
            self.root = self._add([-1, -1, 0.0, -1, -1, 1, x, x])
            return
        at = self.root
        while True:
            n = self.nodes[at]
            low, high = np.minimum(n[6], x), np.maximum(n[7], x)
            span = high - low
            if span.sum() <= 0:  # a leaf of this very point
                n[5] += 1
                self._mend(n[0])
                return
            dim = int(rng.choice(len(span), p=span / span.sum()))
            cut = float(rng.uniform(low[dim], high[dim]))
            if cut >= high[dim]:
                cut = float(low[dim])
            before, after = x[dim] <= cut < n[6][dim], n[7][dim] <= cut < x[dim]
            if before or after:  # the cut parts the point from all that the node holds
                leaf = self._add([-1, -1, 0.0, -1, -1, 1, x, x])
                new = self._add([-1, dim, cut, leaf if before else at, at if before else leaf, 0, low, high])
                self._replace(at, new)
                self.nodes[leaf][0] = self.nodes[at][0] = new
                self._mend(new)
                return
            if n[1] < 0:
                continue  # inside a leaf's box there is nothing to cut: draw again
            at = n[3] if x[n[1]] <= n[2] else n[4]

    def rows(self, tree_id: int) -> list[tuple]:
        """Node rows, numbered from the root."""
        out, stack = [], [(self.root, -1, 0)] if self.root >= 0 else []
        while stack:
            at, parent, side = stack.pop()
            n = self.nodes[at]
            number = len(out)
            out.append([tree_id, number, n[1], n[2] if n[1] >= 0 else 0.0, -1, -1, n[5], n[6].tolist(), n[7].tolist()])
            if parent >= 0:
                out[parent][4 + side] = number
            if n[1] >= 0:
                stack += [(n[4], number, 1), (n[3], number, 0)]
        return [tuple(r) for r in out]


def update_forest(nodes: DataFrame, before: DataFrame, after: DataFrame, seed: int = 42) -> DataFrame:
    """The node table of the trees over the reservoir ``after``, from that over ``before``.

    Only trees with a point that comes, goes or moves are edited, each in one task with its few edits; the others'
    rows are passed on as they are. A tree that loses all its points has no rows. Equal inputs give equal trees.
    """
    a, b = (df.select("tree_id", "claim_id", "x", F.lit(v).alias("v")) for df, v in ((before, -1), (after, 1)))
    edits = a.unionByName(b).groupBy("tree_id", "claim_id", "x").agg(F.sum("v").alias("v")).filter("v <> 0")
    touched = edits.select("tree_id").distinct()

    def edit(key: tuple, own: pd.DataFrame, todo: pd.DataFrame) -> pd.DataFrame:
        tree, tree_id = Tree(own), int(key[0])
        todo = todo.sort_values(["v", "claim_id"])  # deletions first, in one order
        for r in todo.itertuples(index=False):
            x = np.array(r.x, float)
            if r.v < 0:
                tree.delete(x)
            else:
                tree.insert(x, np.random.default_rng([seed, tree_id, *r.claim_id.encode()]))
        return pd.DataFrame(tree.rows(tree_id), columns=NODE_SCHEMA.fieldNames())

    own = nodes.join(touched, "tree_id", "left_semi").select(*NODE_SCHEMA.fieldNames())
    edited = own.groupBy("tree_id").cogroup(edits.groupBy("tree_id")).applyInPandas(edit, NODE_SCHEMA)
    return nodes.join(touched, "tree_id", "left_anti").select(*NODE_SCHEMA.fieldNames()).unionByName(edited)
