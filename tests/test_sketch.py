import random

import pytest
from pyspark.sql import functions as F

from claimlens.operators import sketch as SK
from claimlens.operators.stats import lower_medians


def frame(spark, rows):
    return spark.createDataFrame(rows, "day string, a double, b double")


def check(spark, rows, **options):
    df = frame(spark, rows)
    found = {r.name: r.median for r in SK.medians_from_sketches(df, ["a", "b"], SK.value_sketches(df, ["a", "b"], F.col("day")), **options).collect()}
    want = {}
    for i, c in ((1, "a"), (2, "b")):
        values = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        if values:
            want[c] = values[(len(values) + 1) // 2 - 1]
    assert found == want
    assert found == {r.name: r.median for r in lower_medians(df, ["a", "b"]).collect()}


@pytest.mark.parametrize("n", [1, 2, 7, 20_001])
def test_exact_lower_medians(spark, n):
    rng = random.Random(n)
    check(spark, [(f"d{i % 5}", rng.gauss(0, 1), float(rng.randrange(3))) for i in range(n)])


def test_nulls_nan_hot_values_and_no_values(spark):
    nan = float("nan")
    check(spark, [("d", None, 1.0), ("d", nan, nan), (None, 2.0, None)])
    check(spark, [("d", None, None)])
    check(spark, [("d", 5.0 if i % 3 else float(i), -1.0) for i in range(3000)])


def test_a_bracket_that_misses_is_widened(spark):
    rng = random.Random(9)
    check(spark, [(f"d{i % 3}", rng.random(), rng.random()) for i in range(30_000)], margin=1e-9)


def test_sketches_of_other_values_are_refused(spark):
    df = frame(spark, [("d", float(i), 0.0) for i in range(100)])
    other = SK.value_sketches(frame(spark, [("d", -float(i) - 1000, 0.0) for i in range(100)]), ["a"], F.col("day"))
    with pytest.raises(ValueError, match="not of these values"):
        SK.medians_from_sketches(df, ["a"], other).collect()
