"""Walk trees that are too large for one row, with joins keyed on single nodes.

Rounds first take the leaves off the trees as long as these are a good part of what is left: a leaf
tells its parent the size of its subtree and stays behind, a level of its own, bucketed by node. Once the
nodes that remain are placed, the levels are placed from the last to the first, each by what the
parents tell their children, and tables go up from the first to the last. Every node is told and tells
once, so bushy trees of any depth cost a few passes over their nodes.

What remains has few leaves, like a chain, or few nodes. Its nodes point to their parent and the pointers are doubled, so a tree of depth ``d`` takes about
``log2(d)`` rounds whatever its shape. A round joins and groups on ``(query_id, node_id)`` only: a
query that holds a third of all nodes is spread over all tasks, and no ancestor pairs are listed.

After round ``k`` a node has combined what lies on its path to the ancestor 2^k levels up, and has
received what its descendants less than 2^k levels down have sent. A node is settled once its pointer
is past the root. Settled nodes stay where they are, in a table bucketed by node; a round reads them
there and shuffles only the nodes whose pointers still move.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from spanloom.config import SpanConfig
from spanloom.operators.joins import checked_join
from spanloom.operators.lineage import cut_lineage, shared_folder

NODE_KEY = ["query_id", "node_id"]

# An ancestor that more nodes than this point to is looked up by broadcast. The bound grows with the
# input so that at most 1 / HOT_SHARE ancestors are hot in a round.
HOT_POINTERS = 10_000
HOT_SHARE = 1e-4

# Positions of a query that are numbered together.
RANGE_POSITIONS = 4096

# Leaves are taken off while they are at least so many and this share of the nodes that are left.
RAKED_LEAVES, RAKED_SHARE = 10_000, 0.2


class Placed(NamedTuple):
    """Reachable nodes with their places; of those left by the rounds that take leaves off, per round
    ``k`` the ancestors 2^k levels up, and how many pointers moved in every round of the climb to the
    root; the nodes by levels, those of the rounds and then, if any, those left by them."""

    nodes: DataFrame
    jumps: list[DataFrame]
    moved: list[int]
    levels: list[DataFrame]
    left: bool


def oversized(plan_nodes: DataFrame, config: SpanConfig) -> DataFrame | None:
    """Ids of the trees above ``config.max_tree_nodes``, or None.

    One narrow count, combined before its shuffle; such ids are few by definition.
    """
    ids = (
        plan_nodes.groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("_nodes"))
        .filter(F.col("_nodes") > config.max_tree_nodes)
        .select("query_id")
    )
    written = cut_lineage(ids)  # counted once, then looked at
    return None if written.isEmpty() else written


def nodes_of(
    plan_nodes: DataFrame, ids: DataFrame, config: SpanConfig, others: bool = False
) -> DataFrame:
    """The nodes of the trees ``ids``, or those of all other trees."""
    return checked_join(
        plan_nodes,
        ids,
        on=["query_id"],
        spread=["node_id"],
        how="left_anti" if others else "left_semi",
        max_broadcast_bytes=config.max_broadcast_bytes,
        salts=config.join_salts,
    )


def split(
    plan_nodes: DataFrame, config: SpanConfig, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Nodes of trees within ``config.max_tree_nodes``, and the other nodes or None.

    The count runs over ``counted`` where given: a table with at least these nodes that is cheaper to
    read, such as the stored one they were derived from.
    """
    ids = oversized(plan_nodes if counted is None else counted, config)
    if ids is None:
        return plan_nodes, None
    large = cut_lineage(nodes_of(plan_nodes, ids, config))
    return nodes_of(plan_nodes, ids, config, others=True), large


class _State:
    """What is known of every node, in a table bucketed by node to which rounds only append.

    A round's nodes are kept apart by whether they are settled, so that a join by node finds either
    kind in place: neither is shuffled or written again.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.name = f"spanloom_state_{uuid.uuid4().hex}"
        self.path = f"{shared_folder(spark)}/{self.name}"
        # As many as a shuffle has partitions, so that the other side of a join is dealt to them.
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def add(self, nodes: DataFrame, number: int) -> None:
        placed = nodes.withColumns({"round": F.lit(number), "settled": F.col("up").isNull()})
        writer = placed.repartition(self.buckets, *NODE_KEY).write.format("parquet")
        writer = writer.partitionBy("round", "settled").bucketBy(self.buckets, *NODE_KEY)
        writer.option("path", self.path).mode("append").saveAsTable(self.name)

    def settled(self) -> DataFrame:
        return self.spark.table(self.name).filter("settled").drop("round", "settled")

    def moving(self, number: int) -> DataFrame:
        rows = self.spark.table(self.name).filter((F.col("round") == number) & ~F.col("settled"))
        return rows.drop("round", "settled")

    def written(self, number: int) -> DataFrame:
        """:meth:`moving` by its files, for what outlives the table's name."""
        rows = self.spark.read.schema(self.spark.table(self.name).schema).parquet(self.path)
        return rows.filter((F.col("round") == number) & ~F.col("settled"))

    def forget(self) -> None:
        """Drop the table's name; its files stay for what reads them."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _climb(
    nodes: DataFrame,
    carried: dict[str, Callable[[Column, Column], Column]],
    summed: list[str],
    jumps: list[DataFrame] | None = None,
    moved: list[int] | None = None,
) -> DataFrame:
    """Run all rounds over ``nodes`` (``query_id``, ``node_id``, ``up``, values).

    ``carried`` columns are combined along the path to the root as ``f(above, own)``, ``summed``
    columns are added up over the subtree. ``dead`` is set where no root is reached. The pointers of
    every round are put into ``jumps`` and their number into ``moved``.

    A round shuffles the moving nodes twice, by the node they point to and back by their own key, and
    the sums they send once, combined before. What is sent to settled nodes is added up at the end.
    """
    nodes = cut_lineage(nodes)
    known = ["up", "dead", *carried]
    # A tree of n nodes settles within log2(n) + 1 rounds; what moves after that runs in a circle.
    total = nodes.count()
    hot_pointers = max(HOT_POINTERS, int(total * HOT_SHARE))
    state = _State(nodes.sparkSession)
    state.add(nodes.select(*NODE_KEY, *known, *summed), 0)
    late: list[DataFrame] = []
    number, limit = 0, total.bit_length() + 1
    while number < limit and (count := (pending := state.moving(number)).count()):
        if moved is not None:
            moved.append(count)
        if jumps is not None:
            jumps.append(state.written(number).select(*NODE_KEY, "up"))
        sent = cut_lineage(
            pending.groupBy("query_id", F.col("up").alias("node_id")).agg(
                F.count(F.lit(1)).alias("_pointers"), *(F.sum(c).alias(f"_{c}") for c in summed)
            )
        )
        hot = sent.filter(F.col("_pointers") > hot_pointers).select(*NODE_KEY)
        received = sent.drop("_pointers")
        if summed:
            keys = pending.select(*NODE_KEY)
            late.append(received.join(keys, NODE_KEY, "left_anti"))  # runs once, at the end
            pending = pending.join(received, NODE_KEY, "left").select(
                *NODE_KEY,
                *known,
                *((F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in summed),
            )
        sources = [state.settled(), state.moving(number)]
        after = _look_up(pending, sources, known, hot if total > hot_pointers else None)
        above = F.col("above")
        found = above.isNotNull()
        after = after.select(
            *NODE_KEY,
            above["up"].alias("up"),
            F.when(found, F.col("dead") | above["dead"]).otherwise(True).alias("dead"),
            *(
                F.when(found, f(above[c], F.col(c))).otherwise(F.col(c)).alias(c)
                for c, f in carried.items()
            ),
            *summed,
        )
        number += 1
        state.add(after, number)
    circles = state.moving(number).withColumn("dead", F.lit(True))
    done = state.settled().unionByName(circles)
    if late:
        sums = late[0]
        for rows in late[1:]:
            sums = sums.unionByName(rows)
        sums = sums.groupBy(*NODE_KEY).agg(*(F.sum(f"_{c}").alias(f"_{c}") for c in summed))
        done = done.join(sums, NODE_KEY, "left").select(
            *NODE_KEY,
            *known,
            *((F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in summed),
        )
    others = [c for c in nodes.columns if c not in {*known, *summed}]
    climbed = cut_lineage(nodes.select(*others).join(done, NODE_KEY))
    state.forget()
    return climbed


def _look_up(
    pending: DataFrame, sources: list[DataFrame], known: list[str], hot: DataFrame | None
) -> DataFrame:
    """``pending`` with ``above``, what is known of the node they point to.

    A node is in one of the ``sources``, which are joined where they lie. Towards the end of a deep
    tree most nodes point to a few ancestors near the root; those in ``hot`` are broadcast instead.
    """
    pointer = F.col("up")

    def facts(source: DataFrame, name: str) -> DataFrame:
        return source.select(
            F.col("query_id").alias(f"{name}_query"),
            F.col("node_id").alias(f"{name}_node"),
            F.struct(*known).alias(name),
        )

    names = [f"_above{i}" for i in range(len(sources))]
    if hot is not None:
        found = [s.join(F.broadcast(hot), NODE_KEY, "left_semi") for s in sources]
        few = facts(found[0].unionByName(found[1]), "_hot")
        is_hot = (F.col("query_id") == F.col("_hot_query")) & (F.col("up") == F.col("_hot_node"))
        pending = pending.join(F.broadcast(few), is_hot, "left")
        pointer = F.when(F.col("_hot").isNull(), pointer)
        names.append("_hot")
    # Nodes that have found a hot ancestor meet nothing; their own key spreads them.
    pending = pending.withColumn("_at", F.coalesce(pointer, -F.col("node_id") - 1))
    for name, source in zip(names, sources):
        at = (F.col("query_id") == F.col(f"{name}_query")) & (F.col("_at") == F.col(f"{name}_node"))
        pending = pending.join(facts(source, name), at, "left")
    return pending.withColumn("above", F.coalesce(*names))


def _steps_before_end(nodes: DataFrame, size: str) -> DataFrame:
    """Add ``step``: how much earlier than its parent a node comes in post-order."""
    right = nodes.filter(F.col("side") == "R").select(
        "query_id", "parent_node_id", F.col(size).alias("_right")
    )
    skipped = F.when(F.col("side") == "L", F.coalesce("_right", F.lit(0))).otherwise(0)
    step = F.when(F.col("parent_node_id").isNull(), 0).otherwise(skipped + 1)
    children = nodes.filter(F.col("parent_node_id").isNotNull())
    roots = nodes.filter(F.col("parent_node_id").isNull())
    return (
        children.join(right, ["query_id", "parent_node_id"], "left")
        .unionByName(roots, allowMissingColumns=True)
        .withColumn("step", step.cast("bigint"))
        .drop("_right")
    )


def _add(above: Column, own: Column) -> Column:
    return above + own


def _inherit(above: Column, own: Column) -> Column:
    return F.coalesce(above, own)


def _both(above: Column, own: Column) -> Column:
    return above & own


def _pointers(plan_nodes: DataFrame, *more: str | Column) -> DataFrame:
    """Nodes that point to the parent which follows them, with what any climb carries and ``more``."""
    is_root = F.col("parent_node_id").isNull()
    followed = is_root | F.coalesce(F.col("side").isin("L", "R"), F.lit(False))
    return plan_nodes.select(
        *NODE_KEY,
        "table_name",
        F.when(followed, F.col("parent_node_id")).alias("up"),
        (~followed).alias("dead"),
        F.coalesce("instrumented", F.lit(False)).alias("visible"),
        *more,
    )


def reach(plan_nodes: DataFrame) -> DataFrame:
    """Reachable nodes with ``table_name`` and ``visible``, by one climb that adds nothing up.

    For what asks which nodes a tree has and not where they are, see :func:`place`.
    """
    climbed = _climb(_pointers(plan_nodes), {"visible": _both}, [])
    return climbed.filter(~F.col("dead")).drop("dead", "up")


def _kept(nodes: DataFrame) -> DataFrame:
    """``nodes`` written in buckets by node and read back, so that joins by node find them in place."""
    spark = nodes.sparkSession
    name = f"spanloom_level_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = nodes.repartition(buckets, *NODE_KEY).write.format("parquet")
    writer = writer.option("compression", "zstd").bucketBy(buckets, *NODE_KEY)
    writer.option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    kept = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files stay for what reads them
    return kept


def _rake(start: DataFrame) -> tuple[list[DataFrame], DataFrame | None] | None:
    """The leaves taken off in every round, and the nodes that are left or None; no pair where keys
    of nodes repeat.

    Nodes know the ``size`` of what has been taken off below them and themselves, the left and the
    right child among it, when these were taken, and ``left_size``, the size of the left one's subtree.
    """
    pointed = start.filter(F.col("up").isNotNull())
    of_parents = pointed.groupBy("query_id", F.col("up").alias("node_id"))
    children = of_parents.agg(F.count(F.lit(1)).alias("children"))
    none = F.lit(None).cast("int")
    rest = _kept(
        start.join(children, NODE_KEY, "left").select(
            *(F.col(c) for c in start.columns),
            F.coalesce("children", F.lit(0)).alias("children"),
            none.cast("bigint").alias("left_size"),
            *(none.cast(start.schema["node_id"].dataType).alias(c) for c in ("left_id", "right_id")),
            *(none.alias(c) for c in ("left_round", "right_round")),
        )
    )
    if not rest.groupBy(*NODE_KEY).count().filter("count > 1").isEmpty():
        return None
    levels: list[DataFrame] = []
    is_left, is_right = F.col("side") == "L", F.col("side") == "R"
    while True:
        total, leaves = rest.agg(F.count(F.lit(1)), F.count_if(F.col("children") == 0)).first()
        if leaves < max(RAKED_LEAVES, RAKED_SHARE * total):
            return levels, rest if total or not levels else None
        leaf = rest.filter("children = 0")
        told = leaf.filter(F.col("up").isNotNull()).groupBy(
            "query_id", F.col("up").alias("node_id")
        )
        told = told.agg(
            F.count(F.lit(1)).alias("_gone"),
            F.sum("size").alias("_size"),
            F.max(F.when(is_left, F.col("size"))).alias("_left_size"),
            F.max(F.when(is_left, F.col("node_id"))).alias("_left_id"),
            F.max(F.when(is_right, F.col("node_id"))).alias("_right_id"),
        )
        number = F.lit(len(levels))
        changed = {
            "children": F.col("children") - F.coalesce("_gone", F.lit(0)),
            "size": F.col("size") + F.coalesce("_size", F.lit(0)),
            "left_size": F.coalesce("left_size", "_left_size"),
            "left_id": F.coalesce("left_id", "_left_id"),
            "right_id": F.coalesce("right_id", "_right_id"),
            "left_round": F.coalesce("left_round", F.when(F.col("_left_id").isNotNull(), number)),
            "right_round": F.coalesce("right_round", F.when(F.col("_right_id").isNotNull(), number)),
        }
        inner = rest.filter("children > 0").join(told, NODE_KEY, "left")
        columns = rest.columns
        rest = _kept(inner.select(*(changed.get(c, F.col(c)).alias(c) for c in columns)))
        levels.append(leaf)


# What is known of a placed node, besides its key.
_PLACED = [
    *("table_name", "visible", "side_path", "parent_node_id", "up_round", "position", "lead"),
    *("left_size", "left_id", "left_round", "right_id", "right_round"),
]


def _place_rest(rest: DataFrame) -> tuple[DataFrame, list[DataFrame], list[int]]:
    """Nodes that are left by :func:`_rake`, placed by two climbs; their jumps and moved pointers."""
    moved: list[int] = []
    jumps: list[DataFrame] = []
    start = rest.withColumn("parent_node_id", F.col("up")).drop("children")
    climbed = _climb(start, {"side_path": F.concat, "visible": _both}, ["size"], moved=moved)
    placed = climbed.filter(~F.col("dead")).drop("dead", "up")
    lefts = placed.filter(F.col("parent_node_id").isNotNull() & (F.col("side") == "L"))
    lefts = lefts.select(
        "query_id", F.col("parent_node_id").alias("node_id"), F.col("size").alias("_left")
    )
    sized = placed.join(lefts, NODE_KEY, "left")
    sized = sized.withColumn("left_size", F.coalesce("left_size", "_left")).drop("_left")
    # A right child comes after the subtree of the left one, any other node first in its parent's.
    before = sized.filter(F.col("left_size").isNotNull()).select(
        "query_id", F.col("node_id").alias("parent_node_id"), F.col("left_size").alias("_before")
    )
    is_right = F.col("parent_node_id").isNotNull() & (F.col("side") == "R")
    stepped = (
        sized.filter(is_right)
        .join(before, ["query_id", "parent_node_id"], "left")
        .unionByName(sized.filter(~F.coalesce(is_right, F.lit(False))), allowMissingColumns=True)
        .withColumn("lead", F.coalesce("_before", F.lit(0).cast("bigint")))
        .withColumns({"up": F.col("parent_node_id"), "dead": F.lit(False)})
        .drop("_before")
    )
    done = _climb(stepped, {"lead": _add}, [], jumps)
    nodes = done.withColumn("position", F.col("lead") + F.col("size"))
    return nodes.withColumn("up_round", F.lit(None).cast("int")), jumps, moved


def _place_repeated(plan_nodes: DataFrame, step: Column) -> Placed:
    """:func:`place` where keys of nodes repeat: all nodes climb, and those of one key all meet."""
    is_root = F.col("parent_node_id").isNull()
    start = _pointers(
        plan_nodes,
        "parent_node_id",
        "side",
        step.alias("side_path"),
        F.lit(1).cast("bigint").alias("size"),
    )
    moved: list[int] = []
    climbed = _climb(start, {"side_path": F.concat, "visible": _both}, ["size"], moved=moved)
    placed = climbed.filter(~F.col("dead")).drop("dead", "up")

    # Position in post-order = size of the whole tree - steps up to the root.
    root_size = F.when(is_root, F.col("size")).alias("tree_size")
    stepped = _steps_before_end(placed, "size").select(
        "*", F.col("parent_node_id").alias("up"), F.lit(False).alias("dead"), root_size
    )
    jumps: list[DataFrame] = []
    done = _climb(stepped, {"step": _add, "tree_size": _inherit}, [], jumps)
    position = F.col("tree_size") - F.col("step")
    nodes = done.withColumns({"position": position, "lead": position - F.col("size")})
    nodes = nodes.select(*NODE_KEY, *_PLACED[:4], "position", "lead")
    level = nodes.withColumn("up_round", F.lit(None).cast("int"))
    return Placed(nodes, jumps, moved, [level], True)


def _told(above: DataFrame, above_round: int, number: int) -> DataFrame:
    """What the nodes ``above`` tell their children of round ``number``."""

    def told(side: str, lead: Column) -> Column:
        return F.struct(
            F.col(f"{side}_id").alias("node_id"),
            F.col(f"{side}_round").alias("_round"),
            lead.alias("_lead"),
            F.col("visible").alias("_visible"),
            F.col("side_path").alias("_path"),
            F.lit(above_round).alias("up_round"),
        )

    after = F.col("lead") + F.coalesce("left_size", F.lit(0))
    children = F.array(told("left", F.col("lead")), told("right", after))
    own = F.filter(children, lambda child: child["_round"] == number)
    return above.select("query_id", F.inline(own)).drop("_round")


def _told_nothing(nodes: DataFrame) -> DataFrame:
    """The columns of :func:`_told` without rows, for the last leaves, which are roots."""
    ddl = "_lead bigint, _visible boolean, _path string, up_round int"
    key = nodes.select(*NODE_KEY).schema
    told = [StructField(f.name, f.dataType) for f in StructType.fromDDL(ddl)]
    return nodes.sparkSession.createDataFrame([], StructType([*key.fields, *told]))


def place(plan_nodes: DataFrame, with_paths: bool = False) -> Placed:
    """Reachable nodes with ``visible``, ``position``, ``lead`` and, on demand, ``side_path``, which is
    as long as its node is deep.

    Positions count in post-order from 1. The subtree of a node has the positions
    ``lead + 1 .. position``.
    """
    is_root = F.col("parent_node_id").isNull()
    step = F.when(is_root, "").when(F.col("side") == "L", "0").otherwise("1")
    step = step if with_paths else F.lit("")
    start = _pointers(
        plan_nodes,
        "side",
        step.alias("side_path"),
        F.lit(1).cast("bigint").alias("size"),
    )
    leaves = _rake(start)
    if leaves is None:
        return _place_repeated(plan_nodes, step)
    raked, rest = leaves
    jumps: list[DataFrame] = []
    moved: list[int] = []
    # By round; those left come last.
    placed: dict[int, DataFrame] = {}
    if rest is not None:
        nodes, jumps, moved = _place_rest(rest)
        placed[len(raked)] = nodes.select(*NODE_KEY, *_PLACED)
    for number in reversed(range(len(raked))):
        leaf = raked[number]
        told = [_told(above, round_, number) for round_, above in placed.items()]
        told = reduce(DataFrame.unionByName, told or [_told_nothing(leaf)])
        found = F.col("_lead").isNotNull() | (F.col("up").isNull() & ~F.col("dead"))
        lead = F.coalesce("_lead", F.lit(0))
        known = {
            "visible": F.coalesce("_visible", F.lit(True)) & F.col("visible"),
            "side_path": F.concat(F.coalesce("_path", F.lit("")), "side_path"),
            "parent_node_id": F.col("up"),
            "position": lead + F.col("size"),
            "lead": lead,
        }
        nodes = leaf.join(told, NODE_KEY, "left").filter(found)
        columns = (known.get(c, F.col(c)).alias(c) for c in _PLACED)
        placed[number] = _kept(nodes.select(*NODE_KEY, *columns))
    levels = [placed[number] for number in sorted(placed)]
    columns = [*NODE_KEY, *_PLACED[:4], "position", "lead"]
    nodes = reduce(DataFrame.unionByName, levels).select(columns)
    return Placed(nodes, jumps, moved, levels, rest is not None)


def visible_positions(nodes: DataFrame) -> DataFrame:
    """``(query_id, node_id, visible_position)``: the number of visible nodes up to a visible one.

    Two levels of counts: within ranges of positions, and of the ranges before.
    """
    ranged = nodes.filter("visible").select(
        *NODE_KEY, "position", F.expr("(position - 1) div %d" % RANGE_POSITIONS).alias("_range")
    )
    counts = ranged.groupBy("query_id", "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("query_id").orderBy("_range")
    before = F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("query_id", "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    within = Window.partitionBy("query_id", "_range").orderBy("position")
    numbered = ranged.withColumn("_number", F.row_number().over(within))
    return numbered.join(offsets, ["query_id", "_range"]).select(
        *NODE_KEY, (F.col("_number") + F.col("_before")).alias("visible_position")
    )


def table_positions(
    placed: Placed, table_name: Column, first: int | None = None
) -> DataFrame:
    """``(query_id, node_id, table_name, position)``: the distinct ``table_name`` of every subtree and
    where each occurs there first.

    With ``first`` only that many are kept. A table among the first of a subtree is among the first of
    every part of it that holds its first occurrence, so cutting in each round loses nothing.
    """
    spark = placed.nodes.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def merged(found: DataFrame) -> DataFrame:
        # Dealt by node, which groups by node and table, cuts and joins with a level's nodes alike.
        found = found.repartition(buckets, *NODE_KEY)
        result = found.groupBy(*NODE_KEY, "table_name").agg(F.min("position").alias("position"))
        if first is not None:
            order = Window.partitionBy(*NODE_KEY).orderBy("position")
            result = (
                result.withColumn("_n", F.row_number().over(order))
                .filter(F.col("_n") <= first)
                .drop("_n")
            )
        return result

    columns = [*NODE_KEY, "table_name", "position"]
    whole: list[DataFrame] = []
    for number, level in enumerate(placed.levels):
        pointers = level.select(*NODE_KEY, "parent_node_id", "up_round")
        own = level.select(
            *NODE_KEY, table_name.alias("table_name"), "position", "parent_node_id", "up_round"
        )
        own = own.filter(F.col("table_name").isNotNull())
        last = placed.left and number == len(placed.levels) - 1
        if number == 0 and not last:
            whole.append(own)  # the first leaves have their own table only
            continue
        found = own.select(*columns)
        for lower in whole:
            sent = lower.filter(F.col("up_round") == number)
            found = found.unionByName(
                sent.select("query_id", F.col("parent_node_id").alias("node_id"), *columns[2:])
            )
        found = merged(found)
        if not last:
            whole.append(cut_lineage(found.join(pointers, NODE_KEY)))
            continue
        found = cut_lineage(found)
        for jump in placed.jumps:
            sent = found.join(jump, NODE_KEY).select(
                "query_id", F.col("up").alias("node_id"), "table_name", "position"
            )
            found = cut_lineage(merged(found.unionByName(sent)))
        whole.append(found)
    return reduce(DataFrame.unionByName, (found.select(*columns) for found in whole))


def tables_by_subtree(placed: Placed, table_name: Column, first: int | None = None) -> DataFrame:
    """:func:`table_positions` as a list ``tables`` per node, which is as long as it has tables."""
    in_order = F.sort_array(F.collect_list(F.struct("position", "table_name")))
    found = table_positions(placed, table_name, first)
    return found.groupBy(*NODE_KEY).agg(in_order["table_name"].alias("tables"))
