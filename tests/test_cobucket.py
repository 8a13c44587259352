import random
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from claimlens.session import session_conf
from claimlens.sinks.cobucket import joined, write_bucketed


def sides(spark, hot_rows=50):
    rng = random.Random(1)
    claims = [(f"c{i}", f"K{rng.randrange(40)}" if i % 3 else "HOT") for i in range(600)] + [("lost", None), ("none", "absent")]
    contracts = [(f"K{i}", i) for i in range(38)] + [("HOT", 99)]
    folder, tag = tempfile.mkdtemp(prefix="cobucket-"), uuid.uuid4().hex[:8]
    left_df = spark.createDataFrame(claims, "claim_id string, contract_id string")
    right_df = spark.createDataFrame(contracts, "contract_id string, start int")
    left = write_bucketed(left_df, f"l_{tag}", f"{folder}/l", "contract_id", 8, hot_rows)
    right = write_bucketed(right_df, f"r_{tag}", f"{folder}/r", "contract_id", 8)
    want = left_df.join(right_df, "contract_id", "left").select("claim_id", "contract_id", "start")
    return left, right, sorted(map(tuple, want.collect()), key=str)


def test_no_exchange_and_same_rows(spark):
    left, right, want = sides(spark)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        regular, apart = joined(spark, left, right, ["start"])
        plan = regular._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        got = sorted(map(tuple, regular.unionByName(apart).collect()), key=str)
    assert got == want


def test_a_hot_contract_is_stored_apart(spark):
    left, right, want = sides(spark)
    regular, apart = joined(spark, left, right, ["start"])
    assert {r.contract_id for r in apart.collect()} == {"HOT", None}
    assert regular.filter(F.col("contract_id") == "HOT").count() == 0 and regular.count() + apart.count() == len(want)


def test_layouts_must_fit(spark):
    left, right, _ = sides(spark, hot_rows=None)
    other = write_bucketed(spark.table(right.name), f"{right.name}_4", f"{right.path}_4", "contract_id", 4)
    with pytest.raises(ValueError, match="same number"):
        joined(spark, left, other, ["start"])
