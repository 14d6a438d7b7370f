"""Walk plan trees: reachability, visibility, post-order and the tables of every subtree.

A tree is walked inside its row when it is known to be small, and by joins otherwise
(:mod:`spanloom.operators.largetrees`). Both ways give the same columns.

Within a row the walk is a tour that enters and leaves every node. One sort puts each node next to its
children, which tells every event of the tour its successor; the events to the end of the tour are then
counted by pointer doubling. Nothing is compared with all nodes and no key grows with the depth, so a
row takes ``n log n`` steps whatever the shape of its tree. The events that leave a node give the
post-order: a node that is left as number ``position``, and was entered after ``lead`` nodes had been
left, has the nodes ``lead .. position`` as its subtree. So every subtree is one slice of the
post-ordered tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.config import SpanConfig
from spanloom.operators import largetrees
from spanloom.schemas import SPAN_NODE_FIELDS

# Limits of a plan span's table list.
TABLE_NAME_MAX_BYTES = 64
PLAN_TABLES_MAX = 12

# What the walk itself needs of a node.
TREE_FIELDS = ["node_id", "parent_node_id", "side", "instrumented", "table_name"]


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``, also inside nested lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def walk(plan: Column, with_paths: bool = False) -> Column:
    """Reachable nodes of ``plan`` in post-order as ``struct(position, lead, visible, side_path, node)``.

    ``lead`` counts the nodes before the node's subtree; the subtree covers the 0-based positions
    ``lead .. position``. Only left and right children are followed. ``side_path`` is as long as its
    node is deep and null unless asked for.
    """
    return _bind(
        _entries(plan),
        lambda entries: _bind(
            _places(entries), lambda places: _toured(plan, entries, places, with_paths)
        ),
    )


# Kinds of entries: a node itself, then its left and its right child, then children not followed.
_SELF, _LEFT, _RIGHT, _APART = range(4)


def _entries(plan: Column) -> Column:
    """Two entries per node, one under its own id and one under its parent's, sorted by id and kind."""

    def own(node: Column, i: Column) -> Column:
        return F.struct(
            node["node_id"].alias("key"), F.lit(_SELF).alias("kind"), i.alias("node")
        )

    def under_parent(node: Column, i: Column) -> Column:
        kind = F.when(node["side"] == "L", _LEFT).when(node["side"] == "R", _RIGHT)
        is_root = node["parent_node_id"].isNull()
        return F.struct(
            node["parent_node_id"].alias("key"),
            F.when(is_root, _LEFT).otherwise(F.coalesce(kind, F.lit(_APART))).alias("kind"),
            i.alias("node"),
        )

    return F.sort_array(F.concat(F.transform(plan, own), F.transform(plan, under_parent)))


def _places(entries: Column) -> Column:
    """The 1-based places of the two entries of every node, own entry first."""

    def placed(entry: Column, at: Column) -> Column:
        return F.struct(
            entry["node"].alias("node"),
            (entry["kind"] != _SELF).alias("under_parent"),
            (at + 1).alias("at"),
        )

    return F.sort_array(F.transform(entries, placed))


def _toured(plan: Column, entries: Column, places: Column, with_paths: bool) -> Column:
    """The walk; the own entry of a node stands for entering it, the other one for leaving it."""

    def enter(node: Column) -> Column:
        return F.get(places, node * 2)["at"]

    def leave(node: Column) -> Column:
        return F.get(places, node * 2 + 1)["at"]

    def hidden(node: Column) -> Column:
        return F.when(node["instrumented"], 0).otherwise(1)

    def parent(entry: Column, at: Column) -> Column:
        """The own entry of the parent, one or two places before a followed child, or null."""
        near, far = F.get(entries, at - 1), F.get(entries, at - 2)
        found = F.when(near["kind"] == _SELF, near).when(far["kind"] == _SELF, far)
        return F.when((found["key"] == entry["key"]) & (entry["kind"] != _APART), found)

    # next: 1-based place of the next event, 0 behind the root's, -1 where no root is reached.
    def event(entry: Column, at: Column) -> Column:
        after = F.get(entries, at + 1)
        goes_on = (after["key"] == entry["key"]) & after["kind"].isin(_LEFT, _RIGHT)
        entering = entry["kind"] == _SELF
        behind = (
            F.when(entering, leave(entry["node"]))
            .when(entry["key"].isNull(), 0)
            .otherwise(F.coalesce(leave(parent(entry, at)["node"]), F.lit(-1)))
        )
        below = hidden(F.get(plan, entry["node"]))
        followed = goes_on & (entry["kind"] != _APART)
        return F.struct(
            F.when(followed, enter(after["node"])).otherwise(behind).alias("next"),
            F.when(entering, 0).otherwise(1).alias("left"),
            F.when(entering, below).otherwise(-below).alias("hidden"),
        )

    def jump(state: Column, _round: Column) -> Column:
        def jumped(item: Column) -> Column:
            after = F.get(state, item["next"] - 1)
            moved = F.struct(
                after["next"].alias("next"),
                (item["left"] + after["left"]).alias("left"),
                (item["hidden"] + after["hidden"]).alias("hidden"),
            )
            return F.when(item["next"] > 0, moved).otherwise(item)

        return F.transform(state, jumped)

    # A tour of m events is at its end after log2(m) doublings; what moves then runs in a circle.
    rounds = F.sequence(F.lit(1), F.length(F.bin(F.size(plan) * 2 - 1)))
    tour = F.aggregate(rounds, F.transform(entries, event), jump)

    def placed(tour: Column, paths: Column | None) -> Column:
        whole = F.array_max(
            F.transform(tour, lambda item: F.when(item["next"] == 0, item["left"]).otherwise(0))
        )

        def nodes(whole: Column) -> Column:
            def node(item: Column, i: Column) -> Column:
                entered, left = F.get(tour, enter(i) - 1), F.get(tour, leave(i) - 1)
                path = F.lit(None).cast("string") if paths is None else F.get(paths, i)["path"]
                return F.struct(
                    (whole - left["left"]).alias("position"),
                    (whole - entered["left"]).alias("lead"),
                    (entered["hidden"] == hidden(item)).alias("visible"),
                    path.alias("side_path"),
                    (entered["next"] == 0).alias("reached"),
                    item.alias("node"),
                )

            return F.sort_array(F.filter(F.transform(plan, node), lambda item: item["reached"]))

        return _bind(whole, nodes)

    if not with_paths:
        return _bind(tour, lambda tour: placed(tour, None))

    def step(item: Column, i: Column) -> Column:
        at = leave(i) - 1
        above = parent(F.get(entries, at), at)
        return F.struct(
            F.coalesce(above["node"] + 1, F.lit(0)).alias("up"),
            F.when(above.isNull(), "").when(item["side"] == "L", "0").otherwise("1").alias("path"),
        )

    def climb(state: Column, _round: Column) -> Column:
        def climbed(item: Column) -> Column:
            above = F.get(state, item["up"] - 1)
            return F.struct(
                F.coalesce(above["up"], item["up"]).alias("up"),
                F.concat(F.coalesce(above["path"], F.lit("")), item["path"]).alias("path"),
            )

        return F.transform(state, climbed)

    # Nodes in a circle have no path; they are not reached.
    heights = F.sequence(F.lit(1), F.length(F.bin(F.size(plan))))
    climbed = F.aggregate(heights, F.transform(plan, step), climb)
    return _bind(tour, lambda tour: _bind(climbed, lambda paths: placed(tour, paths)))


def tables_between(names: Column, lead: Column, position: Column) -> Column:
    """Distinct non-null ``names`` at the 0-based positions ``lead .. position``, first kept."""
    own = F.slice(names, lead + 1, position - lead + 1)
    return F.array_except(own, F.array(F.lit(None).cast("string")))


def fitting_names(names: Column) -> Column:
    """``names`` with those too long for a span's table list replaced by null."""
    return F.transform(
        names, lambda name: F.when(F.octet_length(name) <= TABLE_NAME_MAX_BYTES, name)
    )


def gather_trees(plan_nodes: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One row per query that has a root, with its nodes as ``plan``.

    Callers take oversized trees out first, see :func:`spanloom.operators.largetrees.split`.
    """
    fields = fields or [c for c in plan_nodes.columns if c != "query_id"]
    return (
        plan_nodes.select("query_id", F.struct(*fields).alias("node"))
        .groupBy("query_id")
        .agg(
            F.collect_list("node").alias("plan"),
            F.bool_or(F.col("node.parent_node_id").isNull()).alias("_rooted"),
        )
        .filter("_rooted")
        .drop("_rooted")
    )


def walked_trees(trees: DataFrame, with_paths: bool = False) -> DataFrame:
    """Replace ``plan`` by its walk; the other columns stay."""
    kept = [c for c in trees.columns if c != "plan"]
    walked = trees.select(*kept, walk(F.col("plan"), with_paths).alias("walk"))
    names = F.col("walk")["node"]["table_name"]
    return walked.select(*kept, "walk", names.alias("names"))


def _no_names() -> Column:
    return F.array().cast("array<string>")


# Trees with more nodes look for the first tables of a subtree in lists that are doubled in length.
SLICED_NODES = 64


def first_tables(names: Column) -> Column:
    """For every position the first 12 distinct non-null ``names`` from there on, as
    ``struct(name, at)`` with their positions.

    The list of ``2 * k`` positions is that of the first ``k`` and then, of the next ``k``, those not
    in it yet. A name among the first of a range is among the first of its part, so cutting in each
    round loses nothing.
    """
    none = F.array().cast("array<struct<name:string,at:int>>")

    def own(name: Column, at: Column) -> Column:
        return F.when(name.isNull(), none).otherwise(
            F.array(F.struct(name.alias("name"), at.alias("at")))
        )

    def double(state: Column, power: Column) -> Column:
        reach = F.call_function("shiftleft", F.lit(1), power)

        def longer(found: Column, at: Column) -> Column:
            after = F.filter(
                F.coalesce(F.get(state, at + reach), none),
                lambda item: ~F.array_contains(found["name"], item["name"]),
            )
            return F.slice(F.concat(found, after), 1, PLAN_TABLES_MAX)

        return F.transform(state, longer)

    powers = F.sequence(F.lit(0), F.length(F.bin(F.size(names))) - 1)
    return F.aggregate(powers, F.transform(names, own), double)


def visible_nodes(walked: Column, names: Column) -> Column:
    """Visible nodes of a walk in emission order, each with its ``plan_tables``: the first 12
    distinct tables of its subtree in post-order, leaving out names over 64 bytes."""
    shown = F.filter(walked, lambda item: item["visible"])

    def with_tables(item: Column, tables: Column) -> Column:
        return F.struct(item["node"].alias("node"), tables.alias("plan_tables"))

    def sliced(fitting: Column) -> Column:
        def tables(item: Column) -> Column:
            found = tables_between(fitting, item["lead"], item["position"])
            return with_tables(item, F.slice(found, 1, PLAN_TABLES_MAX))

        return F.transform(shown, tables)

    def listed(firsts: Column) -> Column:
        def tables(item: Column) -> Column:
            own = F.filter(F.get(firsts, item["lead"]), lambda e: e["at"] <= item["position"])
            return with_tables(item, own["name"])

        return F.transform(shown, tables)

    fitting = fitting_names(names)
    return F.when(F.size(names) <= SLICED_NODES, _bind(fitting, sliced)).otherwise(
        _bind(first_tables(fitting), listed)
    )


def walk_plans(
    plan_nodes: DataFrame, config: SpanConfig = SpanConfig(), counted: DataFrame | None = None
) -> DataFrame:
    """Visible nodes as ``node`` structs with ``plan_tables`` and ``emit_order``.

    ``plan_tables`` are the first 12 distinct tables of the subtree in post-order, leaving out names
    over 64 bytes. ``emit_order`` numbers the visible nodes of a query from 1: children before their
    parent, left before right. For ``counted`` see :func:`spanloom.operators.largetrees.split`.
    """
    small, large = largetrees.split(plan_nodes, config, counted)
    trees = walked_trees(gather_trees(small, SPAN_NODE_FIELDS)).select(
        "query_id", visible_nodes(F.col("walk"), F.col("names")).alias("shown")
    )
    # Outer, because the inner form would repeat the whole walk in an inferred filter.
    rows = trees.select("query_id", F.posexplode_outer("shown").alias("order", "item"))
    result = rows.filter(F.col("item").isNotNull()).select(
        "query_id",
        "item.node",
        "item.plan_tables",
        (F.col("order") + 1).cast("bigint").alias("emit_order"),
    )
    if large is None:
        return result
    return result.unionByName(walk_large(large, largetrees.place(large)))


def walk_large(plan_nodes: DataFrame, placed: largetrees.Placed) -> DataFrame:
    """:func:`walk_plans` for trees that do not fit one row, once their nodes are placed."""
    name = F.col("table_name")
    fitting = F.when(F.octet_length(name) <= TABLE_NAME_MAX_BYTES, name)
    tables = largetrees.tables_by_subtree(placed, fitting, first=PLAN_TABLES_MAX)
    orders = largetrees.visible_positions(placed.nodes)
    nodes = plan_nodes.select("query_id", "node_id", F.struct(*SPAN_NODE_FIELDS).alias("node"))
    return (
        nodes.join(orders, largetrees.NODE_KEY)
        .join(tables, largetrees.NODE_KEY, "left")
        .select(
            "query_id",
            "node",
            F.coalesce("tables", _no_names()).alias("plan_tables"),
            F.col("visible_position").alias("emit_order"),
        )
    )


def subtree_tables(
    plan_nodes: DataFrame, config: SpanConfig = SpanConfig(), counted: DataFrame | None = None
) -> DataFrame:
    """Per reachable node: ``side_path``, the distinct ``tables`` of its subtree in post-order and
    whether it is ``visible``; hidden nodes contribute tables too."""
    small, large = largetrees.split(plan_nodes, config, counted)
    walked = walked_trees(gather_trees(small, TREE_FIELDS), with_paths=True)
    rows = walked.select("query_id", "names", F.explode_outer("walk").alias("item"))
    result = rows.filter(F.col("item").isNotNull()).select(
        "query_id",
        "item.node.node_id",
        "item.side_path",
        tables_between(F.col("names"), F.col("item.lead"), F.col("item.position")).alias("tables"),
        "item.visible",
    )
    if large is None:
        return result
    placed = largetrees.place(large, with_paths=True)
    tables = largetrees.tables_by_subtree(placed, F.col("table_name"))
    rest = placed.nodes.join(tables, largetrees.NODE_KEY, "left").select(
        "query_id",
        "node_id",
        "side_path",
        F.coalesce("tables", _no_names()).alias("tables"),
        "visible",
    )
    return result.unionByName(rest)


def subtree_table_rows(
    plan_nodes: DataFrame, config: SpanConfig = SpanConfig(), counted: DataFrame | None = None
) -> DataFrame:
    """The tables of :func:`subtree_tables` as rows ``(query_id, node_id, ordinal, table_name)``.

    A row does not grow with its tree, so this is the form for trees and table lists of any size; a
    list per node is spelled out only by :func:`subtree_tables`. ``ordinal`` counts from 1.
    """
    small, large = largetrees.split(plan_nodes, config, counted)
    walked = walked_trees(gather_trees(small, TREE_FIELDS))
    rows = walked.select("query_id", "names", F.explode_outer("walk").alias("item"))
    listed = rows.filter(F.col("item").isNotNull()).select(
        "query_id",
        "item.node.node_id",
        F.posexplode(
            tables_between(F.col("names"), F.col("item.lead"), F.col("item.position"))
        ).alias("place", "table_name"),
    )
    ordinal = (F.col("place") + 1).alias("ordinal")
    result = listed.select("query_id", "node_id", ordinal, "table_name")
    if large is None:
        return result
    found = largetrees.table_positions(largetrees.place(large), F.col("table_name"))
    order = Window.partitionBy(*largetrees.NODE_KEY).orderBy("position")
    numbered = found.withColumn("ordinal", F.row_number().over(order))
    return result.unionByName(numbered.select("query_id", "node_id", "ordinal", "table_name"))


def query_table_rows(
    plan_nodes: DataFrame, config: SpanConfig = SpanConfig(), counted: DataFrame | None = None
) -> DataFrame:
    """The tables of :func:`query_tables` as rows ``(query_id, table_name)``, none per query without
    tables. A row does not grow with its tree."""
    small, large = largetrees.split(plan_nodes, config, counted)
    walked = walked_trees(gather_trees(small, TREE_FIELDS))
    # Outer, because the inner form would repeat the whole walk in an inferred filter.
    rows = walked.select("query_id", F.explode_outer(sorted_tables(F.col("names"))).alias("table_name"))
    result = rows.filter(F.col("table_name").isNotNull())
    if large is None:
        return result
    nodes = largetrees.reach(large).filter(F.col("table_name").isNotNull())
    return result.unionByName(nodes.select("query_id", "table_name").distinct())


def query_tables(
    plan_nodes: DataFrame, config: SpanConfig = SpanConfig(), counted: DataFrame | None = None
) -> DataFrame:
    """Per query with a plan: the sorted distinct ``tables`` of its whole tree, and how many of its
    nodes are visible (``shown``)."""
    small, large = largetrees.split(plan_nodes, config, counted)
    result = walked_trees(gather_trees(small, TREE_FIELDS)).select(
        "query_id",
        sorted_tables(F.col("names")).alias("tables"),
        F.size(F.filter("walk", lambda item: item["visible"])).cast("bigint").alias("shown"),
    )
    if large is None:
        return result
    nodes = largetrees.reach(large)
    return result.unionByName(large_query_tables(nodes).join(large_shown(nodes), "query_id"))


def sorted_tables(names: Column) -> Column:
    return F.sort_array(F.array_except(names, F.array(F.lit(None).cast("string"))))


def large_shown(reached_nodes: DataFrame) -> DataFrame:
    """Per query the number of its visible nodes."""
    return reached_nodes.groupBy("query_id").agg(F.count_if("visible").alias("shown"))


def large_query_tables(reached_nodes: DataFrame, first: int | None = None) -> DataFrame:
    """The tables of :func:`query_tables` for trees that do not fit one row; a name is gathered once
    per query. With ``first`` only so many of the sorted names are kept, which bounds the list."""
    names = reached_nodes.select("query_id", "table_name").distinct()
    if first is not None:
        order = Window.partitionBy("query_id").orderBy(F.col("table_name").asc_nulls_last())
        names = names.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= first)
    return names.groupBy("query_id").agg(
        F.sort_array(F.collect_list("table_name")).alias("tables")
    )
