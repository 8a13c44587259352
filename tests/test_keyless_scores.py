import os
import random
import tempfile

from pyspark.sql import functions as F

from claimlens.session import session_conf
from claimlens.sources import keyless_scores as KS


def write_scores(files):
    folder = tempfile.mkdtemp(prefix="scores-")
    for name, lines in files.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("".join(f"{x}\n" for x in lines))
    return folder


def features(spark, rows):
    return spark.createDataFrame([(f, n, c) for f, claims in rows.items() for n, c in enumerate(claims)], "file string, line long, claim_id string")


def test_line_numbers_are_exact_over_many_splits(spark):
    rng = random.Random(1)
    files = {f"part-{i}.csv.out": [f"{j}.{'9' * rng.randrange(12)}" for j in range(n)] for i, n in enumerate((20_000, 3, 1, 7000))}
    files["empty.out"] = []
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1k"}):
        lines = KS.numbered_lines(spark, write_scores(files))
        assert spark.read.text(write_scores(files)).rdd.getNumPartitions() > 10
    got = {}
    for r in lines.collect():
        got.setdefault(r.file, {})[r.line] = r.value
    assert got == {name.removesuffix(".out"): dict(enumerate(v)) for name, v in files.items() if v}


def test_alignment_errors_stay_in_their_file(spark):
    rows = features(spark, {"a": ["A0", "A1", "A2"], "b": ["B0", "B1"], "c": ["C0"], "d": ["D0", "D1", "D2"]})
    folder = write_scores({"a.out": ["1.5", '{"score": 2}', '{"anomaly_score": null}'], "b.out": ["1", "2", "3"], "x.out": ["9"], "d.out": ["4", "", "bad"]})
    matched, errors = KS.align_by_line(rows, KS.numbered_lines(spark, folder))
    good = {r.claim_id: (r.raw_score, r.parse_error) for r in matched.collect()}
    assert good == {
        "A0": (1.5, None), "A1": (2.0, None), "A2": (None, "not a number"),
        "D0": (4.0, None), "D1": (None, "not a number"), "D2": (None, "not a number"),
    }
    assert sorted(map(tuple, errors.collect())) == [
        ("b", 0, "count_mismatch"), ("b", 1, "count_mismatch"), ("b", 2, "extra_score"), ("c", 0, "missing_score"), ("x", 0, "unknown_file"),
    ]


def test_rows_of_stored_features_keep_their_place(spark):
    folder = tempfile.mkdtemp(prefix="features-")
    spark.range(500).select(F.format_string("C%03d", "id").alias("claim_id"), F.rand(1).alias("x")).repartition(3).write.mode("overwrite").parquet(folder)
    rows = KS.feature_rows(spark, folder)
    assert rows.count() == 500 and rows.select("file", "line").distinct().count() == 500
    tops = rows.groupBy("file").agg(F.max("line").alias("top"), F.count("*").alias("n")).collect()
    assert len(tops) == 3 and all(r.top == r.n - 1 for r in tops)


def test_empty_inputs(spark):
    none = features(spark, {}).select("file", "line", F.lit("1").alias("value"))
    matched, errors = KS.align_by_line(features(spark, {"a": ["A0"]}), none)
    assert matched.count() == 0 and [tuple(r) for r in errors.collect()] == [("a", 0, "missing_score")]


def test_rows_are_joined_in_every_partition(spark):
    """Narrow rows are not packed into one task, however small their bytes."""
    features = spark.range(4000).selectExpr("'a' AS file", "id AS line", "concat('C', id) AS claim_id")
    lines = spark.range(4000).selectExpr("'a' AS file", "id AS line", "'1.5' AS value")
    matched, _ = KS.align_by_line(features, lines)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2
