"""Cut the lineage of iterated tables through the folder that the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanloom.sinks.runs import remove


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else one in the warehouse.

    Executors share both, so whether a job runs does not depend on its data or on a setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/spanloom-scratch"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    A written table survives lost executors. Unlike a checkpointed plan it also carries no inferred
    constraints, whose number would double with every round of an iteration.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/spanloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def passed_on(df: DataFrame, use: Callable[[DataFrame], None]) -> None:
    """``use`` the rows of ``df`` from a table that is written for it and removed after it.

    For what reads its rows more than once and leaves nothing that would read them later.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/spanloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    use(spark.read.schema(df.schema).parquet(path))
    remove(spark, path)
