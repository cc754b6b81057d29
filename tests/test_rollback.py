"""The rollback rule, with the five literal cases of the original service's own unit test."""
import pytest

from recordlog.operators.results import rollback_decision

# (failed, size) at 50 %: 4/5 rolls back, 1/5 keeps, 2/4 rolls back, 1/1 rolls back, 0/1 keeps
CASES = [(4, 5, True), (1, 5, False), (2, 4, True), (1, 1, True), (0, 1, False)]


def _batch(spark, failed, size, bid):
    return [(bid, i >= failed) for i in range(size)]


def _decide(spark, cases, pct, mode):
    rows = []
    for bid, (failed, size, _) in enumerate(cases):
        rows += _batch(spark, failed, size, bid)
    df = spark.createDataFrame(rows, "b int, processed boolean")
    return {r.b: r for r in rollback_decision(df, ["b"], pct, mode).collect()}


def test_five_cases_compat(spark):
    got = _decide(spark, CASES, 50, "compat")
    for bid, (failed, size, expect) in enumerate(CASES):
        assert got[bid].failed == failed and got[bid].batch_size == size
        assert got[bid].rolled_back is expect


def test_strict_differs_only_at_equality(spark):
    got = _decide(spark, CASES, 50, "strict")
    # 2 of 4 is exactly 50 %: compat rolls back, strict keeps
    assert [got[i].rolled_back for i in range(5)] == [True, False, False, True, False]


def test_zero_and_hundred_percent_quirks(spark):
    df = spark.createDataFrame([(0, True), (0, True), (1, False)], "b int, processed boolean")
    zero = {r.b: r.rolled_back for r in rollback_decision(df, ["b"], 0, "compat").collect()}
    assert zero == {0: True, 1: True}            # 0 % rolls back even an all-success batch
    hundred = {r.b: r.rolled_back for r in rollback_decision(df, ["b"], 100, "compat").collect()}
    assert hundred == {0: False, 1: True}        # an all-failed batch reaches 100 %
    assert {r.b: r.rolled_back for r in rollback_decision(df, ["b"], 0, "strict").collect()} == {0: False, 1: True}


def test_null_processed_is_not_counted(spark):
    df = spark.createDataFrame([(0, None), (0, None), (0, True)], "b int, processed boolean")
    r = rollback_decision(df, ["b"], 30, "compat").first()
    assert r.failed == 0 and r.rolled_back is False


@pytest.mark.parametrize("pct", [-1, 101])
def test_threshold_out_of_range(spark, pct):
    df = spark.createDataFrame([(0, True)], "b int, processed boolean")
    with pytest.raises(ValueError):
        rollback_decision(df, ["b"], pct)
