"""Queries over a capture with a plan that no row holds."""

import datetime
from functools import partial

import pytest

import __spark_entry__ as contract
from spanloom import SpanConfig

MOST, NODES = 8, 12
ORDERS = "o_orderkey long, o_totalprice double, o_orderdate timestamp"
LINES = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
  l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
  l_shipdate timestamp"""
DAY = datetime.datetime(1995, 3, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Order 3 has a plan of more than ``MOST`` nodes, orders 4 to 9 have three nodes each."""
    path = str(tmp_path_factory.mktemp("tables"))
    lines = [(3, n, n % 5, n % 7 + 1) for n in range(NODES)]
    lines += [(order, n, n, n) for order in range(4, 10) for n in range(1, 4)]
    more = (1.0, 100.0, 0.1, 0.2, "N", "O", DAY)
    tables = {
        "orders": ([(order, 200_000.0, DAY) for order in range(3, 10)], ORDERS),
        "lineitem": ([(*line, *more) for line in lines], LINES),
        "supplier": ([(n, f"S{n}", n) for n in range(5)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(n, f"N{n}") for n in range(5)], "n_nationkey int, n_name string"),
    }
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{path}/{name}.parquet")
    return path


def test_streams_keep_plans_that_stay_flat(spark, folder, monkeypatch):
    few = partial(contract.sl.nest_plans, config=SpanConfig(max_tree_nodes=MOST))
    monkeypatch.setattr(contract.sl, "nest_plans", few)
    made = contract.queries()

    def rows(name):
        return sorted(made[name](spark, folder).collect(), key=repr)

    spans = rows("spans")
    assert sum(row.query_id == 3 for row in spans) == NODES + 1
    assert rows("stream_compacted") == spans
    sent = made["stream_otlp"](spark, folder).select("span_id").distinct().collect()
    assert sorted(row.span_id for row in sent) == sorted(row.span_id for row in spans)
