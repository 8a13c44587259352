import numpy as np
import pytest

from claimlens.operators import forest_update as FU
from claimlens.operators.forest import score_forest, train_forest

COLS = ["a", "b"]


def features(spark, ids, seed=0, grid=None):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, grid, (len(ids), 2)).astype(float) if grid else rng.normal(size=(len(ids), 2))
    return spark.createDataFrame([(f"c{i}", float(a), float(b)) for i, (a, b) in zip(ids, values, strict=True)], "claim_id string, a double, b double")


def check_trees(nodes, reservoir):
    """Every node holds exactly the points that its cuts lead to: mass and box, and a leaf one distinct point."""
    points, trees = {}, {}
    for r in reservoir.collect():
        points.setdefault(r.tree_id, []).append(np.array(r.x))
    for n in nodes.collect():
        trees.setdefault(n.tree_id, {})[n.node_id] = n
    assert trees.keys() == points.keys()
    for t, tree in trees.items():
        stack, seen = [(0, points[t])], 0
        while stack:
            i, own = stack.pop()
            n, seen = tree[i], seen + 1
            assert n.mass == len(own) > 0
            assert n.box_min == np.min(own, axis=0).tolist() and n.box_max == np.max(own, axis=0).tolist()
            if n.dim < 0:
                assert n.box_min == n.box_max
            else:
                stack += [(n.left, [p for p in own if p[n.dim] <= n.cut]), (n.right, [p for p in own if p[n.dim] > n.cut])]
        assert seen == len(tree)


def start(spark, df, trees=5, samples=16):
    rows = FU.candidates(df, COLS, trees)
    reservoir = FU.bottom_k(rows, samples).cache()
    return reservoir, train_forest(reservoir.select("tree_id", "claim_id", "x")).cache()


@pytest.mark.parametrize("grid", [None, 4])
def test_edited_trees_hold_the_new_points(spark, grid):
    before, nodes = start(spark, features(spark, range(200), 1, grid))
    check_trees(nodes, before)
    day = features(spark, [*range(200, 320), *range(0, 60)], 2, grid)  # new claims, and changed ones
    after = FU.updated_reservoir(before, FU.candidates(day, COLS, 5), 16).cache()
    edited = FU.update_forest(nodes, before, after).cache()
    check_trees(edited, after)
    again = FU.update_forest(nodes, before.repartition(3), after.repartition(2))
    assert sorted(map(str, again.collect())) == sorted(map(str, edited.collect()))


def test_reservoir_equals_the_bottom_k_of_all(spark):
    first, second = features(spark, range(150), 1), features(spark, range(150, 400), 2)
    before, _ = start(spark, first)
    after = FU.updated_reservoir(before, FU.candidates(second, COLS, 5), 16)
    whole = FU.bottom_k(FU.candidates(first.unionByName(second), COLS, 5), 16)
    assert sorted(map(str, after.collect())) == sorted(map(str, whole.collect()))


def test_untouched_trees_are_as_they_were_and_emptied_ones_go(spark):
    before, nodes = start(spark, features(spark, range(120), 3))
    gone = before.filter("tree_id = 2").select("claim_id")
    after = FU.updated_reservoir(before, FU.candidates(features(spark, []), COLS, 5), 16, gone).cache()
    edited = FU.update_forest(nodes, before, after).cache()
    check_trees(edited, after)
    assert edited.filter("tree_id = 2").count() == 0
    key = lambda df: sorted(map(str, df.filter("tree_id <> 2").collect()))
    assert key(edited) == key(nodes)
    back = FU.update_forest(edited, after, before)  # a tree grows from nothing
    check_trees(back, before)


def test_edited_forest_ranks_like_a_new_one(spark):
    before, nodes = start(spark, features(spark, range(400), 5), trees=10, samples=32)
    after = FU.updated_reservoir(before, FU.candidates(features(spark, range(400, 900), 6), COLS, 10), 32).cache()
    probe = spark.createDataFrame([("near", 0.0, 0.0), ("mid", 2.0, 2.0), ("far", 30.0, -30.0)], "claim_id string, a double, b double")
    score = lambda n: {r.claim_id: r.raw_score for r in score_forest(probe, n, COLS).collect()}
    edited, anew = score(FU.update_forest(nodes, before, after)), score(train_forest(after.select("tree_id", "claim_id", "x")))
    assert sorted(edited, key=edited.get) == sorted(anew, key=anew.get) == ["near", "mid", "far"]
    assert all(abs(edited[c] - anew[c]) < 0.5 * anew[c] + 2 for c in anew)


def test_deleting_what_is_not_there_is_an_error(spark):
    rows = train_forest(start(spark, features(spark, range(20), 1), 1, 8)[0].select("tree_id", "claim_id", "x")).toPandas()
    with pytest.raises(ValueError, match="does not hold"):
        FU.Tree(rows).delete(np.array([99.0, 99.0]))


def test_bottom_k_ranks_only_rows_near_the_smallest(spark):
    """The window's input is cut to the counted digits first: far rows are neither sorted nor shipped."""
    rows = FU.candidates(spark.range(30_000).selectExpr("concat('C', id) AS claim_id", "double(id) AS a"), ["a"], 3)
    got = {(r.tree_id, r.claim_id) for r in FU.bottom_k(rows, 5).collect()}
    by_tree = {}
    for r in rows.collect():
        by_tree.setdefault(r.tree_id, []).append((r.h, r.claim_id))
    assert got == {(t, c) for t, own in by_tree.items() for _, c in sorted(own)[:5]}
    plan = FU.bottom_k(rows, 5)._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("WindowGroupLimit"):]
    assert "Join Inner" in ranked and "upto" in ranked
    assert FU.bottom_k(rows, 50_000).count() == 30_000
