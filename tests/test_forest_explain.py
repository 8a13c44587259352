import numpy as np
import pytest

from claimlens.operators.forest import sample_for_trees, score_forest, train_forest
from claimlens.operators.forest_explain import explain_forest, forest_factors

COLS = ["a", "b", "c"]


def points(spark, n=300):
    rng = np.random.default_rng(3)
    rows = [(f"p{i:04d}", *map(float, rng.normal(size=3))) for i in range(n)]
    rows += [("far_a", 30.0, 0.0, 0.0), ("far_bc", 0.0, -20.0, 10.0), ("odd", None, 1.0, 1.0)]
    return spark.createDataFrame(rows, "claim_id string, a double, b double, c double")


def plain(nodes, x):
    """Shares of one row by a walk through each tree, feature by feature."""
    trees = {}
    for n in nodes:
        trees.setdefault(n.tree_id, {})[n.node_id] = n
    total = np.zeros(len(x))
    for tree in trees.values():
        node, pi, r, at = tree[0], 1.0, 0.0, 0
        while True:
            out = [max(lo - v, 0, v - hi) for v, lo, hi in zip(x, node.box_min, node.box_max, strict=True)]
            span = sum(hi - lo for lo, hi in zip(node.box_min, node.box_max, strict=True))
            if sum(out):
                for j, e in enumerate(out):
                    total[j] += pi * e / (span + sum(out)) * max(r, node.mass)
                pi *= 1 - sum(out) / (span + sum(out))
            if node.dim < 0:
                total[at] += pi * r
                break
            left = x[node.dim] <= node.cut
            child, other = tree[node.left if left else node.right], tree[node.right if left else node.left]
            if other.mass / (child.mass + 1) > r:
                r, at = other.mass / (child.mass + 1), node.dim
            node = child
    return total / len(trees)


def test_shares_sum_to_the_score_and_match_a_plain_walk(spark):
    df = points(spark)
    known = df.filter("a is not null")
    nodes = train_forest(sample_for_trees(known, COLS, trees=8, samples=32)).cache()
    scores = {r.claim_id: r.raw_score for r in score_forest(known, nodes, COLS).collect()}
    rows = {r.claim_id: r for r in explain_forest(df, nodes, COLS).withColumn("top", forest_factors(COLS)).collect()}
    stored = nodes.collect()
    for claim, score in scores.items():
        r = rows[claim]
        assert sum(r.shares) == pytest.approx(score, rel=1e-9) == pytest.approx(r.raw_score, rel=1e-9)
        assert r.shares == pytest.approx(plain(stored, [r.a, r.b, r.c]).tolist(), rel=1e-9, abs=1e-12)
    assert rows["far_a"].top[0] == "a" and rows["far_a"].shares[0] > 0.9 * rows["far_a"].raw_score
    assert rows["far_bc"].top[:2] == ["b", "c"]
    assert rows["odd"].raw_score is None and rows["odd"].shares is None


def test_node_table_is_bounded_and_empty_input(spark, monkeypatch):
    from claimlens.operators import forest_explain

    df = points(spark, 40).filter("a is not null")
    nodes = train_forest(sample_for_trees(df, COLS, trees=2, samples=16))
    assert explain_forest(df.limit(0), nodes, COLS).count() == 0
    monkeypatch.setattr(forest_explain, "MAX_FOREST_BYTES", 100)
    with pytest.raises(ValueError, match="bytes"):
        explain_forest(df, nodes, COLS)
