import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.llm.topk import top_inner_products

SCHEMA = "vec_id long, embedding array<float>, score string, q int, rank int"


def brute(rows, k, step):
    ok = {
        (i, tuple(math.floor(1024 * float(np.float32(x))) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, v in ok:
        if i % step == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in ok if (j, w) != (i, v))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    return sorted(out)


def run(spark, rows, k=10, step=5, **kw):
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA)
    return sorted(map(tuple, top_inner_products(df, F.col("vec_id") % step == 0, k, **kw).collect()))


@pytest.mark.parametrize("dims,slices", [(1, 4), (7, 3), (16, 4)])
def test_matches_brute_force(spark, dims, slices):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(dims)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # a large group of copies
    assert run(spark, rows, slices=slices) == brute(rows, 10, 5)


def test_several_waves(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(120)]
    assert run(spark, rows, step=3, wave_queries=7) == brute(rows, 10, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0, 0.0]), (5, [1.0, -1.0]), (10, None), (15, [nan, 1.0]), (20, [None, 1.0]), (25, [inf, 1.0]), (None, [1.0, 1.0]),
            (30, [0.5]), (35, []), (5, [1.0, -1.0]), (5, [2.0, 0.25]), (1, [-0.3, 0.7]), (2, [1.0, -1.0]), (40, [3e4, -3e4])]
    assert run(spark, rows, k=3) == brute(rows, 3, 5)


def test_ties_everywhere_and_few_rows(spark):
    rows = [(i, [0.0, 0.0, 0.0]) for i in range(40)] + [(100 + i, [0.25, 0.0, 0.0]) for i in range(4)]
    assert run(spark, rows) == brute(rows, 10, 5)
    assert run(spark, rows[:1]) == []
    assert run(spark, rows[:3]) == brute(rows[:3], 10, 5)


def test_scores_beyond_doubles(spark):
    rows = [(i, [(-1) ** i * 2.0**14 + i, 2.0**13 * i, 3.0]) for i in range(30)]
    assert run(spark, rows) == brute(rows, 10, 5)


def test_empty_table_and_no_queries(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0]), (2, [2.0])]) == []
