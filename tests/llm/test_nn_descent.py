import random

import numpy as np
import pytest

from claimlens.llm import nn_descent as N

SCHEMA = "vec_id long, embedding array<float>, label int, node string, v int"


def brute(rows, threshold=0.98):
    """(vec_id, n_links, component_id, kept) by comparing all rows."""
    n = len(rows)
    vs = []
    for _, v, label in rows:
        ok = v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        vs.append(np.array(v, np.float32).astype(np.float64) if ok else None)
    parent, links = list(range(n)), [0] * n

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(n):
        for b in range(a):
            x, y = vs[a], vs[b]
            if x is None or y is None or rows[a][2] != rows[b][2] or len(x) != len(y):
                continue
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids, default=None)
        out.append((rows[i][0], links[i], c, rows[i][0] is not None and rows[i][0] == c))
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA)
    return [tuple(r) for r in N.embedding_groups(df, **kw).collect()]


def key(r):
    return tuple((x is not None, x) for x in r)


def clustered(n_alone, groups, dims, rng, spread=0.01):
    rows, i = [], 0
    for size in [1] * n_alone + groups:
        at = rng.standard_normal(dims)
        at /= np.linalg.norm(at)
        for _ in range(size):
            rows.append((i, (at + spread * rng.standard_normal(dims)).tolist(), int(i % 2 if size == 1 else size % 2)))
            i += 1
    random.Random(1).shuffle(rows)
    return rows


def test_groups_larger_than_lists_and_blocks(spark, monkeypatch):
    rows = clustered(300, [2] * 40 + [5] * 6 + [130], 32, np.random.default_rng(5))
    want = sorted(brute(rows))
    assert max(r[1] for r in want) > 100
    assert sorted(run(spark, rows)) == want
    monkeypatch.setattr(N, "BLOCK", 40)  # the group is counted over several blocks
    monkeypatch.setattr(N, "CELL", 16)
    got = sorted(run(spark, rows, k=5, most=20))
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.97 * len(want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.001], 1), (2, [1.0, 0.0], 2), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [None, 1.0], 1),
            (7, [inf, 1.0], 1), (8, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [], 1), (1, [2.0, 0.001], 1),
            (None, [-1.0, 0.0], 3), (None, [-1.0, 0.0], 3)]
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_copies_and_empty_table(spark):
    rows = [(i, [0.5, 0.5, 0.1], 1) for i in range(400)] + [(1000, [0.5, 0.1, 0.5], 1)]
    assert sorted(run(spark, rows)) == sorted([(i, 399, 0, i == 0) for i in range(400)] + [(1000, 0, 1000, True)])
    assert run(spark, []) == []


def clumps(n, rng, dims=32, across=0.985, spread=0.003):
    """Two clumps of ``n`` vectors each, cosine about 0.999 inside a clump and ``across`` between them."""
    a, b = np.linalg.qr(rng.standard_normal((dims, 2)))[0].T
    centres = [a, across * a + np.sqrt(1 - across**2) * b]
    return [(i, (centres[i % 2] + spread * rng.standard_normal(dims)).tolist(), 1) for i in range(2 * n)]


def test_clumps_joined_by_links_that_no_list_has_room_for(spark, monkeypatch):
    rows = clumps(200, np.random.default_rng(3))
    rows += [(1000 + i, v, 2) for i, v, _ in clumps(100, np.random.default_rng(4), across=0.9)]  # two groups that stay apart
    want = sorted(brute(rows))
    assert want[0][1] > 300 and sum(r[3] for r in want) == 3
    assert sorted(run(spark, rows)) == want
    monkeypatch.setattr(N, "BLOCK", 60)  # several pieces a group and several blocks of pieces
    assert sorted(run(spark, rows)) == want


def test_audit_expects_all_links(spark):
    rows = clumps(60, np.random.default_rng(3))
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA)
    _, nodes = N._nodes(df, "vec_id", "embedding", "label")
    cells, _ = N.stored(N._cells(nodes, 1, 7), "parts")
    short = N._merge(N._first_lists(nodes, cells, 5), None, 5, 5).withColumn("keep", N.F.lit(50))  # not full: these lists have lost links
    assert N.audited_recall(nodes, short, 0.98, 256, 7) < 0.2


def test_recall_below_the_goal_has_consequences(spark, monkeypatch):
    rows = clustered(300, [2] * 30, 16, np.random.default_rng(9), spread=0.02)
    df = spark.createDataFrame([(i, v, 1, "x", 1) for i, v, _ in rows], SCHEMA)
    _, nodes = N._nodes(df, "vec_id", "embedding", "label")
    truth, _ = N.enough_links(nodes, 0.98, 4, 20, 7)
    assert truth.count() >= 20  # four nodes have few links or none
    monkeypatch.setattr(N, "CELL", 2)
    with pytest.raises(RuntimeError, match="recall"):
        N.neighbour_graph(nodes, 0.98, trees=1, rounds=0, more_rounds=0)
    _, _, audits = N.neighbour_graph(nodes, 0.98, trees=2, rounds=0)
    assert audits[0] < 0.98 <= audits[-1]
