from spanloom.operators.joins import checked_join


def test_rows_that_come_by_key_are_not_dealt_again(spark):
    rows = spark.range(1000).selectExpr("id % 100 AS query_id", "id AS node_id").repartition(4, "query_id")
    lookup = spark.range(50).selectExpr("id AS query_id", "id + 1 AS up")
    for how in ("inner", "left_semi"):
        joined = checked_join(rows, lookup, ["query_id"], ["node_id"], how, 0, 4)
        assert sorted(joined.collect()) == sorted(rows.join(lookup, "query_id", how).collect())
        assert "_salt" not in joined._jdf.queryExecution().executedPlan().toString()
