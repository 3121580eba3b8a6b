"""What a physical plan must not contain."""


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def assert_scalable(df, allow_nested_loop: bool = False) -> None:
    plan = physical(df)
    assert "CartesianProduct" not in plan
    assert "Exchange SinglePartition" not in plan
    assert "BatchEvalPython" not in plan
    if not allow_nested_loop:
        assert "BroadcastNestedLoopJoin" not in plan
