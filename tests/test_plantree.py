"""Both routes through a tree against a plain recursion."""

import random
import time
from collections import Counter

import pytest

from pyspark.sql import functions as F

from spanloom import (
    SpanConfig,
    nest_plans,
    query_table_rows,
    query_tables,
    subtree_table_rows,
    subtree_tables,
    walk_plans,
)
from spanloom.operators import largetrees, plantree
from spanloom.schemas import SPAN_NODE
from spanloom.sources import derived
from tests.data import executions, plan_nodes

SPLIT = SpanConfig(max_tree_nodes=50)


def random_tree(rng: random.Random, query_id: int, size: int, shape: str) -> list[dict]:
    """Node ids are shuffled so that they tell nothing about the shape."""
    ids = rng.sample(range(1, size * 3 + 1), size)
    free, nodes = [], []
    for i, node_id in enumerate(ids):
        parent, side = (None, None) if i == 0 else free.pop(rng.randrange(len(free)))
        sides = {"left": ["L"], "right": ["R"], "any": ["L", "R"]}[shape]
        free += [(node_id, s) for s in sides]
        table = rng.choice([None, "t1", "t2", f"t{rng.randrange(40)}", f"long{'x' * 61}{i % 3}"])
        nodes.append(
            {
                "query_id": query_id,
                "node_id": node_id,
                "parent_node_id": parent,
                "side": side,
                "table_name": table,
                "instrumented": rng.random() < 0.9,
            }
        )
    rng.shuffle(nodes)
    return nodes


def forest() -> list[dict]:
    rng = random.Random(11)
    nodes = []
    for query_id in range(1, 12):
        nodes += random_tree(rng, query_id, rng.randint(1, 60), "any")
    nodes += random_tree(rng, 100, 90, "left")
    nodes += random_tree(rng, 101, 60, "right")
    # Not reachable from the root: a lost parent, an unknown side and a circle.
    broken = random_tree(rng, 102, 12, "any")
    lost = {"query_id": 102, "instrumented": True, "table_name": "unreachable"}
    root = next(n["node_id"] for n in broken if n["parent_node_id"] is None)
    broken += [
        {**lost, "node_id": 1001, "parent_node_id": 999, "side": "L"},
        {**lost, "node_id": 1002, "parent_node_id": 1001, "side": "L"},
        {**lost, "node_id": 1003, "parent_node_id": root, "side": "X"},
        {**lost, "node_id": 1004, "parent_node_id": 1003, "side": "R"},
        {**lost, "node_id": 1005, "parent_node_id": 1006, "side": "L"},
        {**lost, "node_id": 1006, "parent_node_id": 1005, "side": "L"},
    ]
    # No root at all.
    rootless = [{**lost, "query_id": 103, "node_id": 2, "parent_node_id": 1, "side": "L"}]
    return nodes + broken + rootless


def expected(nodes: list[dict]) -> dict:
    """(query, node) -> path, subtree tables, visible, capped tables, emission order."""
    children = {(n["query_id"], n["parent_node_id"], n["side"]): n for n in nodes}
    result, order = {}, {}

    def visit(node, path, visible):
        key = (node["query_id"], node["node_id"])
        visible = visible and node["instrumented"]
        tables = []
        for side, step in (("L", "0"), ("R", "1")):
            child = children.get((*key, side))
            if child is not None:
                tables += visit(child, path + step, visible)
        if node["table_name"] is not None:
            tables.append(node["table_name"])
        tables = list(dict.fromkeys(tables))
        number = None
        if visible:
            number = order[key[0]] = order.get(key[0], 0) + 1
        capped = [t for t in tables if len(t.encode()) <= 64][:12]
        result[key] = (path, tables, visible, capped, number)
        return tables

    for node in nodes:
        if node["parent_node_id"] is None:
            visit(node, "", True)
    return result


@pytest.fixture(scope="module")
def nodes(spark):
    return plan_nodes(spark, *forest(), table_name=True).cache()


@pytest.fixture(scope="module")
def placed(nodes):
    return largetrees.place(nodes, with_paths=True)


def test_hot_ancestors_are_looked_up_apart(nodes, placed, monkeypatch):
    monkeypatch.setattr(largetrees, "HOT_POINTERS", 4)
    some = nodes.filter("query_id > 8")
    again = largetrees.place(some, with_paths=True).nodes
    wanted = placed.nodes.filter("query_id > 8")
    assert sorted(again.select(wanted.columns).collect(), key=repr) == sorted(
        wanted.collect(), key=repr
    )


def subtree_rows(df):
    rows = df.collect()
    got = {(r.query_id, r.node_id): (r.side_path, r.tables or [], r.visible) for r in rows}
    assert len(rows) == len(got)
    return got


@pytest.fixture(scope="module")
def raked(nodes):
    """Placed with the leaves of these few nodes taken off, which larger inputs have done."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(largetrees, "RAKED_LEAVES", 1)
        patch.setattr(largetrees, "RAKED_SHARE", 0.05)
        return largetrees.place(nodes, with_paths=True)


def test_leaves_are_taken_off_before_pointers_move(nodes, placed, raked):
    wanted = placed.nodes
    assert sorted(raked.nodes.select(wanted.columns).collect(), key=repr) == sorted(
        wanted.collect(), key=repr
    )
    # What moves is what is left: the two chains, the circle and little else.
    assert len(raked.levels) >= 4 and raked.left
    assert raked.moved[0] < placed.moved[0] / 2


def test_trees_are_taken_off_whole(spark, nodes, monkeypatch):
    monkeypatch.setattr(largetrees, "RAKED_LEAVES", 1)
    monkeypatch.setattr(largetrees, "RAKED_SHARE", 0.0)
    some = nodes.filter("query_id <= 9")
    placed = largetrees.place(some, with_paths=True)
    assert not placed.left and not placed.moved and not placed.jumps
    wanted = {k: v[:3] for k, v in expected(forest()).items() if k[0] <= 9}
    tables = largetrees.tables_by_subtree(placed, F.col("table_name"))
    assert subtree_rows(placed.nodes.join(tables, largetrees.NODE_KEY, "left")) == wanted
    empty = largetrees.place(nodes.filter("query_id < 0"))
    assert empty.nodes.count() == 0


def test_tables_of_raked_trees(nodes, raked):
    wanted = {k: v[:3] for k, v in expected(forest()).items()}
    tables = largetrees.tables_by_subtree(raked, F.col("table_name"))
    assert subtree_rows(raked.nodes.join(tables, largetrees.NODE_KEY, "left")) == wanted
    check_visible(plantree.walk_large(nodes, raked))


def test_no_leaves_are_taken_off_where_keys_repeat(nodes, monkeypatch):
    monkeypatch.setattr(largetrees, "RAKED_LEAVES", 1)
    one = nodes.filter("query_id = 3")
    again = largetrees.place(one.unionByName(one.limit(1)))
    assert len(again.levels) == 1 and again.left and again.moved
    assert len(largetrees.place(one).levels) > 1


def test_a_level_is_written_once_and_found_in_place(raked):
    parents = raked.levels[1].select(*largetrees.NODE_KEY, "up_round")
    joined = raked.levels[1].select(*largetrees.NODE_KEY, "position").hint("merge").join(
        parents, largetrees.NODE_KEY
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2


def test_subtree_tables_in_rows(nodes):
    wanted = {k: v[:3] for k, v in expected(forest()).items()}
    assert subtree_rows(subtree_tables(nodes)) == wanted


def test_subtree_tables_by_joins(placed):
    wanted = {k: v[:3] for k, v in expected(forest()).items()}
    tables = largetrees.tables_by_subtree(placed, F.col("table_name"))
    assert subtree_rows(placed.nodes.join(tables, largetrees.NODE_KEY, "left")) == wanted


def test_pointers_that_settle_are_not_moved_again(nodes, placed):
    """The chain of 90 nodes takes seven rounds, most trees three."""
    assert placed.moved == sorted(placed.moved, reverse=True)
    assert len(placed.moved) >= 7 and placed.moved[5] < placed.moved[0] / 5
    # Circles move until the number of rounds is used up.
    assert placed.moved[-1] == 2


def test_settled_nodes_are_read_in_place(spark, nodes):
    state = largetrees._State(spark)
    pointed = nodes.select(*largetrees.NODE_KEY, F.col("parent_node_id").alias("up"))
    state.add(pointed, 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = largetrees._look_up(state.moving(0), [state.settled(), state.moving(0)], ["up"], None)
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange") == 1 and plan.count("Bucketed: true") == 2
    assert found.filter("above is not null").count() > 300
    state.forget()


def test_tables_as_rows_on_both_routes(nodes):
    some = nodes.filter("query_id in (3, 100, 102)")
    wanted = sorted(
        (*key, i + 1, table)
        for key, value in expected(forest()).items()
        if key[0] in (3, 100, 102)
        for i, table in enumerate(value[1])
    )
    of_queries = {(key[0], t) for key, v in expected(forest()).items() if v[0] == "" for t in v[1]}
    for config in (SpanConfig(), SPLIT):
        assert sorted(map(tuple, subtree_table_rows(some, config).collect())) == wanted
    rows = query_table_rows(some, SPLIT).collect()
    assert sorted(map(tuple, rows)) == sorted(r for r in of_queries if r[0] in (3, 100, 102))


def check_visible(df):
    wanted = {k: v[3:] for k, v in expected(forest()).items() if v[2]}
    rows = df.collect()
    assert len(rows) == len(wanted)
    got = {(r.query_id, r.node.node_id): (r.plan_tables, r.emit_order) for r in rows}
    assert got == wanted


def test_visible_nodes_in_rows(nodes):
    check_visible(walk_plans(nodes))


def test_visible_nodes_by_joins(nodes, placed):
    check_visible(plantree.walk_large(nodes, placed))


def test_query_tables_on_both_routes(nodes):
    wanted = {k[0]: sorted(v[1]) for k, v in expected(forest()).items() if v[0] == ""}
    for config in (SpanConfig(), SPLIT):
        rows = query_tables(nodes, config).collect()
        assert {r.query_id: r.tables for r in rows} == wanted


def test_nested_plans(spark, nodes):
    runs = executions(spark, {"query_id": 1}, {"query_id": 2, "total_ns": None}, {"query_id": 999})
    rows = nest_plans(runs, nodes).rows.collect()
    assert [r.query_id for r in rows] == [1]
    assert len(rows[0].plan) == sum(n["query_id"] == 1 for n in forest())


def test_unbounded_plans_stay_flat(spark, nodes):
    whole, rest = nest_plans(executions(spark, {}), nodes, SPLIT)
    assert all(len(r.plan) <= SPLIT.max_tree_nodes for r in whole.collect())
    counts = Counter(n["query_id"] for n in forest())
    assert Counter(r.query_id for r in rest.collect()) == Counter(
        {q: n for q, n in counts.items() if n > SPLIT.max_tree_nodes}
    )
    assert nest_plans(executions(spark, {}), nodes).rest is None


def chain(spark, size):
    """A tree of one path, with node ids in no order and as many tables as a span may not list."""
    i = F.col("id").cast("int")
    node_id = ((i + 1) * 7919 % 1_000_003).cast("int")
    return spark.range(size).select(
        F.lit(1).cast("long").alias("query_id"),
        node_id.alias("node_id"),
        F.when(i > 0, i * 7919 % 1_000_003).cast("int").alias("parent_node_id"),
        F.when(i > 0, F.when(i % 3 == 0, "L").otherwise("R")).alias("side"),
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in SPAN_NODE.fields
          if f.name not in {"node_id", "parent_node_id", "side", "instrumented", "table_name"}),
        (i % 1000 < 999).alias("instrumented"),
        F.concat(F.lit("t"), i % 50).alias("table_name"),
    )


def test_a_row_takes_time_in_proportion_to_its_nodes(spark):
    config = SpanConfig(max_tree_nodes=20_000)
    took = {}
    for size in (4_000, 16_000):
        walked = walk_plans(chain(spark, size).repartition(1).cache(), config)
        for _ in range(3):
            start = time.perf_counter()
            rows = walked.select("node.node_id", "plan_tables", "emit_order").collect()
            took[size] = min(took.get(size, 1e9), time.perf_counter() - start)
        # All below the first hidden node are hidden, so those above it are the last in post-order.
        assert sorted(r.emit_order for r in rows) == list(range(1, 1000))
        names = [f"t{i % 50}" for i in range(size - 1, -1, -1)]
        assert {tuple(r.plan_tables) for r in rows} == {tuple(names[:12])}
    assert took[16_000] < 8 * took[4_000]


def test_query_tables_climb_once_and_agree(nodes, monkeypatch):
    some = nodes.filter("query_id <= 8")
    wanted = Counter(map(repr, query_tables(some).collect()))
    climb, climbs = largetrees._climb, []
    monkeypatch.setattr(
        largetrees, "_climb", lambda *a, **more: climbs.append(a[2]) or climb(*a, **more)
    )
    assert Counter(map(repr, query_tables(some, SPLIT).collect())) == wanted
    assert climbs == [[]]


def test_deep_nodes_are_numbered_by_ranges_as_by_a_sort(spark, tmp_path, monkeypatch):
    key = F.col("id")
    rows = spark.range(600).select(
        F.when(key % 97 > 0, key).cast("long").alias("l_orderkey"),
        (key % 7 + 1).cast("long").alias("l_linenumber"),
        F.when(key % 89 > 0, key * 31 % 20).cast("long").alias("l_partkey"),
        (key % 13).cast("long").alias("l_suppkey"),
        *(
            F.col("id").cast("double").alias(f"l_{c}")
            for c in ("quantity", "extendedprice", "discount", "tax")
        ),
        F.when(key % 3 == 0, "R").otherwise("A").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
        F.lit("1995-01-01").cast("date").alias("l_shipdate"),
    )
    rows.union(rows.filter("id % 10 = 0")).write.parquet(f"{tmp_path}/lineitem.parquet")
    wanted = sorted(derived.DeepCapture(spark, str(tmp_path)).plan_nodes.collect(), key=repr)
    monkeypatch.setattr(derived, "SORTED_NODES", 25)
    ranged = derived.DeepCapture(spark, str(tmp_path)).plan_nodes
    assert sorted(ranged.collect(), key=repr) == wanted
    written = [f for f in ranged.inputFiles() if "spanloom-" in f]
    assert written  # the rows of large queries were sorted apart
    counts = Counter(r.query_id for r in wanted)
    assert max(counts.values()) > 25 > min(counts.values()) and None in counts
