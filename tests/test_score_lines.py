from claimlens.sources.score_lines import parse_score_lines, split_scores


def test_score_line_shapes(spark):
    lines = ["1.5", '{"score": 2.25}', '{"anomaly_score": 3}', '{"x":1}', "bad", "{bad", "", "  4 ", '{"score": null}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    out = {r.n: (r.raw_score, r.parse_error) for r in parse_score_lines(df).collect()}
    assert 6 not in out  # blank line skipped
    assert out[0] == (1.5, None) and out[1] == (2.25, None) and out[2] == (3.0, None)
    assert out[3] == (0.0, None) and out[7] == (4.0, None)
    assert out[4][1] == "not a number" and out[5][1] == "invalid json" and out[8][1] == "not a number"
    good, bad = split_scores(parse_score_lines(df))
    assert good.count() == 5 and bad.count() == 3


def test_numbers_that_are_not_finite_are_errors(spark):
    lines = ["NaN", "Infinity", "-inf", '{"score": "NaN"}', "1e400", "2"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    out = {r.n: (r.raw_score, r.parse_error) for r in parse_score_lines(df).collect()}
    assert all(out[i][0] is None and out[i][1] in ("not finite", "not a number") for i in range(5))
    assert out[0][1] == "not finite" and out[5] == (2.0, None)


def test_keyed_score_lines(spark):
    from claimlens.sources.score_lines import key_score_lines

    lines = ["C1,1.5", ' C2 , {"score": 2}', '{"claim_id": "C3", "score": 3}', "4", ",5", "C6,", '{"score": 7}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    out = {r.n: (r.claim_id, r.raw_score) for r in parse_score_lines(key_score_lines(df)).collect()}
    assert out == {0: ("C1", 1.5), 1: ("C2", 2.0), 2: ("C3", 3.0), 3: (None, 4.0), 4: (None, 5.0), 6: (None, 7.0)}
