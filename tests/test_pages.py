import random
import tempfile

import pytest

from claimlens.operators.query import page_items
from claimlens.sinks import pages as P


def results(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(f"C{i:04d}", rng.choice([0.5, 0.5, 0.25, None, rng.random()]), rng.choice(["b", None, "a"])) for i in rng.sample(range(9000), n)]
    return spark.createDataFrame(rows, "claim_id string, fraud_score double, status string")


@pytest.mark.parametrize("sort_by,descending", [(None, True), ("status", False), ("fraud_score", False)])
def test_pages_equal_the_top_k_path(spark, sort_by, descending):
    df, path = results(spark, 403), tempfile.mkdtemp(prefix="pages-") + "/p"
    assert P.write_pages(df, path, sort_by=sort_by, descending=descending, rows_per_file=30) == 403
    assert P.last_page(spark, path, 50) == 9
    for page in (1, 4, 9, 10):
        got = [tuple(r) for r in P.read_page(spark, path, page, 50).collect()]
        assert got == [tuple(r) for r in page_items(df, page, 50, sort_by=sort_by, descending=descending).collect()]
    assert len(got) == 0


def test_first_and_last_page_open_as_few_files(spark):
    df, path = results(spark, 1000, 2), tempfile.mkdtemp(prefix="pages-") + "/p"
    P.write_pages(df, path, rows_per_file=40)
    total = len(spark.read.parquet(f"{path}/rows").inputFiles())
    opened = [len(P.read_page(spark, path, n, 20).inputFiles()) for n in (1, 25, P.last_page(spark, path, 20))]
    assert total >= 25 and max(opened) <= 2
    assert len(spark.read.parquet(f"{path}/rows").select("claim_id").distinct().collect()) == 1000


def test_empty_results_and_bad_pages(spark):
    path = tempfile.mkdtemp(prefix="pages-") + "/p"
    assert P.write_pages(results(spark, 0), path) == 0 and P.last_page(spark, path) == 1
    assert P.read_page(spark, path).count() == 0
    with pytest.raises(ValueError):
        P.read_page(spark, path, 0)
