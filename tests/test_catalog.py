from pyspark.sql import functions as F

from spanloom import SpanConfig, resolve_relations
from spanloom.operators.joins import checked_join, hot_keys
from tests.data import catalog, plan_nodes


def names(spark, config=SpanConfig()):
    nodes = plan_nodes(
        spark,
        {"node_id": 1, "relation_oid": 10},
        {"node_id": 2, "relation_oid": 12},
        {"node_id": 3, "relation_oid": 99},
        {"node_id": 4, "relation_oid": None},
        {"node_id": 5, "relation_oid": 10, "plan_type": "T_Sort"},
        {"node_id": 6, "relation_oid": 11, "plan_type": "T_CustomScan"},
    )
    return {r.node_id: r.table_name for r in resolve_relations(nodes, *catalog(spark), config).collect()}


EXPECTED = {1: "public.a", 2: "c", 3: None, 4: None, 5: None, 6: "public.b"}


def test_names(spark):
    assert names(spark) == EXPECTED


def test_large_catalog_is_not_broadcast(spark):
    assert names(spark, SpanConfig(max_broadcast_bytes=0, join_salts=4)) == EXPECTED


def test_salted_joins_agree_with_broadcast(spark):
    hot = spark.range(3000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("key")
    )
    lookup = spark.createDataFrame([(1, "one"), (5, "five")], "key BIGINT, label STRING")

    def run(how, limit):
        df = checked_join(hot, lookup, ["key"], ["row"], how, limit, 8)
        columns = sorted(df.columns)
        return sorted(df.select(columns).collect(), key=repr)

    for how in ("left", "inner", "left_semi", "left_anti"):
        assert run(how, 1 << 20) == run(how, 0)


def test_only_hot_keys_are_salted(spark):
    """One key holds half of all rows; its row of the lookup is repeated, the others are not."""
    large = spark.range(8000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("key")
    )
    lookup = spark.range(9000).select(F.col("id").alias("key"), F.lit("x").alias("label"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (hot,) = hot_keys(large, ["key"], partitions, 32).collect()
    assert hot._salts == -(-4001 * partitions // 8000)  # as many tasks as it fills
    assert hot_keys(lookup, ["key"], partitions, 32).count() == 0
    assert hot_keys(large.filter("false"), ["key"], partitions, 32).count() == 0
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = checked_join(large, lookup, ["key"], ["row"], "inner", 0, 32)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert joined.count() == 8000 and joined.select("row").distinct().count() == 8000
    salts = spark.createDataFrame([(hot._hash, hot._salts)], "_hash long, _salts long")
    repeated = lookup.withColumn("_hash", F.xxhash64("key")).join(salts, "_hash").count()
    assert repeated == 1
