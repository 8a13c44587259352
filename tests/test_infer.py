import os
import tempfile

from pyspark.sql import types as T

from claimlens.sources import infer as I


def counts(spark, header, *rows):
    path = tempfile.mkdtemp(prefix="infer-")
    with open(os.path.join(path, "a.csv"), "w") as fh:
        fh.write("\n".join([header, *rows]) + "\n")
    return I.type_counts(I.read_texts(spark, path))


def types(df):
    return {r.column: r.inferred_type for r in I.inferred_types(df).collect()}


def test_each_type_is_the_narrowest(spark):
    c = counts(
        spark, "b,i,l,d,dt,ts,s,v,mix,code",
        "true,1,3000000000,1.5,2024-01-10,2024-01-10T01:02:03Z,x,,1,007", "FALSE,-2,4,2e3,2024-02-29,2024-01-10 05:00:00,2024-13-40,,true,12a",
        ",,,,,,,,,",
    )
    assert types(c) == {
        "b": "boolean", "i": "int", "l": "bigint", "d": "double", "dt": "date", "ts": "timestamp", "s": "string", "v": "void", "mix": "string", "code": "string",
    }
    assert {(r.values, r.nulls) for r in I.inferred_types(c).collect() if r.column == "i"} == {(2, 1)}


def test_merging_widens(spark):
    a, b = counts(spark, "x,y,z", "1,2024-01-01,5"), counts(spark, "x,y,z", "2.5,2024-01-01T00:00:00Z,NaN")
    assert types(a) == {"x": "int", "y": "date", "z": "int"}
    assert types(I.merge_counts(a, b)) == {"x": "double", "y": "timestamp", "z": "string"}
    whole = counts(spark, "x,y,z", "1,2024-01-01,5", "2.5,2024-01-01T00:00:00Z,NaN")
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(I.merge_counts(a, b)) == key(I.merge_counts(whole))


def test_drift_lists_every_difference(spark):
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.DateType()), T.StructField("gone", T.StringType())])
    rows = {r.column: r for r in I.drift(counts(spark, "a,b,extra", "1,2024-01-01,x", "2,yesterday,"), schema).collect()}
    assert {c: r.status for c, r in rows.items()} == {"a": "ok", "b": "drifted", "gone": "missing", "extra": "new"}
    assert rows["b"].bad_values == 1 and rows["a"].inferred_type == "int" and rows["a"].bad_values == 0
    assert rows["gone"].inferred_type is None and rows["extra"].stored_type is None and rows["extra"].nulls == 1


def test_header_only(spark):
    assert types(counts(spark, "a,b")) == {"a": "void", "b": "void"}


def test_patterns_do_not_grow_with_the_columns(spark):
    """One compiled expression serves all columns; a plan with all patterns per column ran uncompiled."""
    tried = []
    for n in (2, 30):
        texts = spark.createDataFrame([tuple("1" for _ in range(n))], ", ".join(f"c{i} string" for i in range(n)))
        tried.append(I.type_counts(texts)._jdf.queryExecution().optimizedPlan().toString().count("RLIKE"))
        assert {(r.rows, r.nulls, r.int, r.double, r.date) for r in I.type_counts(texts).collect()} == {(1, 0, 1, 1, 0)}
    assert tried[0] == tried[1]


def test_first_bytes_and_lengths_do_not_hide_a_value(spark):
    values = ["+1", "-2.5e-5", ".5", "1e-5", "TRUE", "False", "0001-01-01", "2024-02-30", "2024-01-01 01:02:03", "2024-01-01Tx", "/1", "trues", "\u017ftrue", "\u0661"]
    got = {r.v: [t for t in I.LATTICE if r[t]] for v in values for r in I.type_counts(spark.createDataFrame([(v,)], "c string")).selectExpr(f"'{v}' AS v", *I.LATTICE).collect()}
    assert got == {
        "+1": ["int", "bigint", "double"], "-2.5e-5": ["double"], ".5": ["double"], "1e-5": ["double"], "TRUE": ["boolean"], "False": ["boolean"],
        "0001-01-01": ["date", "timestamp"], "2024-02-30": [], "2024-01-01 01:02:03": ["timestamp"], "2024-01-01Tx": [], "/1": [], "trues": [], "\u017ftrue": [], "\u0661": [],
    }


def test_texts_of_the_drift_query_are_compressed(spark, sf_small):
    from claimlens.plans.incremental import q_schema_drift
    from claimlens.plans.stages import stage_root
    from claimlens.sources.storage import file_names

    before = set(file_names(spark, stage_root(spark)))
    assert q_schema_drift(spark, sf_small).count() == 11
    folder = next(n for n in file_names(spark, stage_root(spark)) if n.startswith("texts-") and n not in before)
    files = [n for name in ("whole", "damaged") for n in file_names(spark, f"{stage_root(spark)}/{folder}/{name}") if n.startswith("part-")]
    assert files and all(n.endswith(".csv.gz") for n in files)
