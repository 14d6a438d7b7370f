import pytest

from spanloom import slow_executions
from tests.data import executions

MS = 1_000_000


@pytest.mark.parametrize(
    ("own", "default", "total_ns", "kept"),
    [
        (100, -1, 100 * MS, True),
        (100, -1, 100 * MS - 1, False),
        (0, -1, 0, True),
        (-1, 0, 10**12, False),
        (None, -1, 10**12, False),
        (None, 0, 0, True),
        (None, 100, 100 * MS, True),
        (None, 100, 100 * MS - 1, False),
        (2_000_000_000, 0, 2_000_000_000 * MS - 1, False),
        (2_000_000_000, 0, 2_000_000_000 * MS, True),
        (0, 0, None, False),
    ],
)
def test_threshold(spark, own, default, total_ns, kept):
    df = executions(spark, {"min_duration_ms": own, "total_ns": total_ns})
    assert slow_executions(df, default).count() == int(kept)


def test_threshold_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "executions")
    executions(spark, {}).write.parquet(path)
    df = slow_executions(spark.read.parquet(path), 100).select("query_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(total_ns,100000000)" in pushed
    assert "GreaterThanOrEqual(min_duration_ms,0)" in pushed
    assert "source_text" not in plan
