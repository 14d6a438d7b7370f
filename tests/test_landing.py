"""Damaged captures are kept apart, whatever columns are read."""

import json

import pytest

from spanloom.schemas import EXECUTIONS
from spanloom.sources.landing import (
    damage_report,
    read_landed_executions,
    read_landed_plan_nodes,
)

GOOD = [
    {"query_id": 1, "total_ns": 5, "operation": "CMD_SELECT", "source_text": "SELECT 1", "min_duration_ms": 0},
    {"query_id": 2, "unknown": [1, 2]},
    {"query_id": 3, "source_text": "line\nbreak é", "service_name": None},
]
BAD = [
    ('{"query_id": 4, "total_ns": ', "unreadable"),
    ("not json", "unreadable"),
    ('{"query_id": "five"}', "unreadable"),
    ('{"query_id": 6, "total_ns": "many"}', "unreadable"),
    ('{"query_id": 7, "min_duration_ms": 3000000000}', "unreadable"),
    ('{"total_ns": 8}', "no id"),
    ('{"query_id": null}', "no id"),
    ("{}", "no id"),
]


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    lines = [json.dumps(r) for r in GOOD] + [line for line, _ in BAD] + ["", "   "]
    (folder / "a.json").write_text("\n".join(lines) + "\n")
    (folder / "b.json").write_text("broken\n")
    return str(folder)


def test_rows_and_damaged_lines(spark, path):
    rows, damaged = read_landed_executions(spark, path)
    assert rows.schema == EXECUTIONS
    got = {r.query_id: r for r in rows.collect()}
    assert set(got) == {1, 2, 3}
    assert got[1].total_ns == 5 and got[1].min_duration_ms == 0
    assert got[3].source_text == "line\nbreak é"
    wanted = sorted([*BAD, ("broken", "unreadable")])
    assert sorted((r.line, r.reason) for r in damaged.collect()) == wanted


def test_reading_one_column_changes_nothing(spark, path):
    rows, damaged = read_landed_executions(spark, path)
    assert sorted(r.query_id for r in rows.select("query_id").collect()) == [1, 2, 3]
    assert rows.count() == 3 and damaged.select("reason").count() == 9


def test_report(spark, path):
    _, damaged = read_landed_executions(spark, path)
    report = {(r.file.rsplit("/", 1)[1], r.reason): r.lines for r in damage_report(damaged).collect()}
    assert report == {("a.json", "unreadable"): 5, ("a.json", "no id"): 3, ("b.json", "unreadable"): 1}


def test_plan_nodes(spark, tmp_path):
    (tmp_path / "n.json").write_text('{"query_id": 1, "node_id": 2, "rows": 1.5}\n{"query_id": 1, "node_id": "x"}\n')
    rows, damaged = read_landed_plan_nodes(spark, str(tmp_path))
    assert [(r.node_id, r.rows) for r in rows.collect()] == [(2, 1.5)] and damaged.count() == 1


def test_streams_keep_damaged_lines_apart(spark, path, tmp_path):
    rows, damaged = read_landed_executions(spark, path, streaming=True, nested=False)
    for name, df in (("rows", rows), ("damaged", damaged)):
        query = df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-c"))
        query.trigger(availableNow=True).start(str(tmp_path / name)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 3
    assert spark.read.parquet(str(tmp_path / "damaged")).count() == 9
