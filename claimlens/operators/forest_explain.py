"""Why the forest scored a claim as it did (M2, O4): each feature's share of the expected displacement.

The score adds up, node by node, what inserting the claim there would displace. Where the
claim leaves a node's box, that displacement is divided by how far it lies outside in each feature; at a
leaf what is left belongs to the feature whose cut displaced most on the way. The shares of a claim
sum to its score.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import cloudpickle

from ..functions.scalar import top_k_names
from .forest import MAX_FOREST_BYTES, _Forest

# as in forest.py: Python workers need no install of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _tree_shares(f: _Forest, root: int, x: np.ndarray) -> np.ndarray:
    """One tree's displacement of each row of ``x``, by feature: the walk of the score, kept apart by feature."""
    m, d = x.shape
    shares = np.zeros((m, d))
    rows, xa = np.arange(m), x
    node, at_cut = np.full(m, root), np.zeros(m, np.int64)
    pi, r = np.ones(m), np.zeros(m)
    while rows.size:
        box = f.box[node]
        ext = np.maximum(box[:, :d] - xa, 0.0) + np.maximum(xa - box[:, d:], 0.0)
        outside = ext.sum(axis=1)
        whole = f.span[node] + outside + 1e-300
        shares[rows] += ext * (pi * np.maximum(r, f.mass[node]) / whole)[:, None]
        pi = pi * (1.0 - outside / whole)
        leaf = f.is_leaf[node]
        shares[rows[leaf], at_cut[leaf]] += (pi * r)[leaf]
        rows, node, pi, r, at_cut, xa = (v[~leaf] for v in (rows, node, pi, r, at_cut, xa))
        if not rows.size:
            break
        cut = f.split_dim[node]
        side = (xa[np.arange(rows.size), cut] > f.cut[node]).astype(np.intp)
        ratio = f.ratio[node, side]
        at_cut = np.where(ratio > r, cut, at_cut)
        r = np.maximum(r, ratio)
        node = f.children[node, side]
    return shares


def explain_forest(features: DataFrame, nodes: DataFrame, cols: Sequence[str], out: str = "shares") -> DataFrame:
    """``features`` with ``raw_score`` (as by ``score_forest``) and ``out``, an array of the shares of ``cols``.

    Pass only the key and the feature columns. The node table is bounded as in ``score_forest``; rows stay in
    their partitions. A claim with a null feature has null shares and score.
    """
    spark, cols = features.sparkSession, list(cols)
    if nodes.count() * 8 * (7 + 4 * len(cols)) > MAX_FOREST_BYTES:
        raise ValueError(f"the node table takes over {MAX_FOREST_BYTES} bytes: train fewer or smaller trees")
    bc = spark.sparkContext.broadcast(nodes.toPandas())
    schema = T.StructType([*features.schema.fields, T.StructField("raw_score", T.DoubleType()), T.StructField(out, T.ArrayType(T.DoubleType()))])

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = _Forest(bc.value)
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=np.float64)
            known = ~np.isnan(x).any(axis=1)
            total = np.zeros((int(known.sum()), len(cols)))
            for t in forest.trees:
                total += _tree_shares(forest, forest.offset[t], x[known])
            total /= max(1, len(forest.trees))
            score, shares = np.full(len(pdf), None, object), np.full(len(pdf), None, object)
            score[known] = total.sum(axis=1)
            for row, own in zip(np.flatnonzero(known), total, strict=True):
                shares[row] = own.tolist()
            pdf["raw_score"], pdf[out] = score, shares
            yield pdf

    return features.mapInPandas(explain, schema)


def forest_factors(cols: Sequence[str], k: int = 3, shares: str = "shares") -> Column:
    """O4 for a forest score: the names of the k features with the largest shares; ties keep feature order."""
    return top_k_names([(c, F.round(F.col(shares)[i], 6)) for i, c in enumerate(cols)], k)
