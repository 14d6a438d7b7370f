"""Lloyd's clustering with vectors and centroids cut into blocks of columns.

Vectors are turned into integers and stored as records of some thousand rows by one block of columns.
A task that reads a record needs the centroids' slice of that block only: it computes the exact
partial distances of the rows to all centroids. The partial distances of a group of rows are added up
over its blocks, which gives exact squared distances, and each row goes to its nearest centroid. The
assignments go back to the records, where every block sums its own columns by centroid and updates
its own slice. Neither vectors nor assignments reach the driver, and no task holds whole centroids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.words import small_batches
from spanloom.operators.lineage import cut_lineage

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
BLOCK_DIMS = 16
# Numbers that a task holds of one group of rows, by block, by centroid or by column.
GROUP_BYTES = 4 << 20
# Records are dealt to tasks by block and by one of so many shares of the groups.
SHARES = 4096
# Slices and facts of centroids, whose size follows from parameters, are broadcast up to this size.
MAX_BROADCAST_BYTES, SALTS = 64 << 20, 32
# Records of one Arrow batch.
BATCH_RECORDS = 32
_LONG_MAX = 2**63 - 1

RECORD_DDL = "group long, block int, vec_ids array<bigint>, width int, columns binary"
PARTIAL_DDL = "group long, width int, partial binary"
ASSIGNED_DDL = "group long, clusters array<int>, distances array<bigint>"
SUMS_DDL = "cluster int, dim int, total long, n long"


def bound(dims: int) -> int:
    """Components are held within this bound, so that a squared distance fits 63 bits."""
    return 1 << ((62 - max(dims - 1, 1).bit_length()) // 2 - 1)


def quantised(component: Column, scale: int, dims: int) -> Column:
    """``floor(scale * x)`` within the bound, as a long."""
    most = float(bound(dims))
    scaled = component.cast("double") * F.lit(float(scale))
    return F.floor(F.greatest(F.least(scaled, F.lit(most)), F.lit(-most)))


def kept_vectors(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """``(vec_id, embedding)`` of the rows with exactly ``dims`` components, none null or not finite."""

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return rows.filter((F.size("embedding") == dims) & F.forall("embedding", usable))


def _packed(matrix: np.ndarray) -> tuple[int, bytes]:
    """A matrix of integers in the narrowest type that holds it, and the type's width."""
    most = int(np.abs(matrix).max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return width, matrix.astype(f"<i{width}").tobytes()


def _unpacked(data: pa.Scalar, width: int, columns: int) -> np.ndarray:
    flat = np.frombuffer(data.as_buffer(), f"<i{width}").astype(np.int64)
    return flat.reshape(-1, columns)


def block_records(
    kept: DataFrame, dims: int, clusters: int, scale: int, block_dims: int
) -> DataFrame:
    """Records of up to some thousand rows by one block of columns; ids go with the first block."""
    rows = max(1, GROUP_BYTES // (8 * max(dims, clusters)))
    starts = range(0, dims, block_dims)
    most = float(bound(dims))

    def cut(batches):
        group = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                part = batch.slice(first, rows)
                values = part["embedding"].flatten().to_numpy().reshape(-1, dims)
                whole = np.floor(np.clip(values * scale, -most, most)).astype(np.int64)
                packed = [_packed(whole[:, s : s + block_dims]) for s in starts]
                ids = [part["vec_id"].to_pylist(), *[None] * (len(packed) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([group] * len(packed), pa.int64()),
                        pa.array(range(len(packed)), pa.int32()),
                        pa.array(ids, pa.list_(pa.int64())),
                        pa.array([width for width, _ in packed], pa.int32()),
                        pa.array([data for _, data in packed], pa.binary()),
                    ],
                    names=["group", "block", "vec_ids", "width", "columns"],
                )
                group += 1

    dealt = kept.mapInArrow(cut, RECORD_DDL)
    return dealt.repartition("block", F.pmod("group", F.lit(SHARES)))


def first_centroids(
    kept: DataFrame, dims: int, clusters: int, scale: int, block_dims: int, seed: int
) -> DataFrame:
    """``(block, cluster, dim, value)`` of the vectors whose seeded hashes are smallest.

    Vectors that share an id, or have none, share a hash; their components decide.
    """
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    hashed = kept.select(F.struct(F.sha2(label, 256).alias("hash"), "embedding").alias("v"))
    chosen = hashed.orderBy("v").limit(clusters)  # the first few of every task, then of those
    listed = chosen.agg(F.sort_array(F.collect_list("v")).alias("all"))
    return listed.select(F.posexplode("all").alias("cluster", "v")).select(
        "cluster", F.posexplode("v.embedding").alias("dim", "x")
    ).select(
        F.floor(F.col("dim") / block_dims).cast("int").alias("block"),
        "cluster",
        "dim",
        quantised(F.col("x"), scale, dims).alias("value"),
    )


def _beside(large: DataFrame, small: DataFrame, key: str, spread: Column, size: int) -> DataFrame:
    """Join on ``key`` with a side of at most ``size`` bytes: broadcast, or salted beyond the bound."""
    if size <= MAX_BROADCAST_BYTES:
        return large.join(F.broadcast(small), key)
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    return salted.join(small.withColumn("_salt", salts), [key, "_salt"]).drop("_salt")


def _partial_distances(batches):
    """Per record the squared distances of its rows to all centroids over its columns."""
    for batch in batches:
        found: dict[int, np.ndarray] = {}
        for i in range(batch.num_rows):
            held = batch["slice"][i]
            columns = batch["slice_columns"][i].as_py()
            centroids = held.values.to_numpy().reshape(-1, columns)
            rows = _unpacked(batch["columns"][i], batch["width"][i].as_py(), columns)
            most = 2 * max(np.abs(rows).max(initial=0), np.abs(centroids).max(initial=0))
            if columns * int(most) ** 2 < 1 << 52:  # doubles hold all sums exactly
                rows, centroids = rows.astype(np.float64), centroids.astype(np.float64)
            partial = rows @ centroids.T
            partial *= -2
            partial += (rows * rows).sum(axis=1)[:, None]
            partial += (centroids * centroids).sum(axis=1)
            group = batch["group"][i].as_py()
            whole = partial.astype(np.int64)
            found[group] = found[group] + whole if group in found else whole
        packed = [_packed(partial) for partial in found.values()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(found), pa.int64()),
                pa.array([width for width, _ in packed], pa.int32()),
                pa.array([data for _, data in packed], pa.binary()),
            ],
            names=["group", "width", "partial"],
        )


def _nearest(clusters: int):
    def add(table: pa.Table) -> pa.Table:
        """The sum of a group's blocks, and the first of the nearest centroids for each of its rows."""
        total = 0
        for partial, width in zip(table["partial"], table["width"].to_pylist()):
            total = total + _unpacked(partial, width, clusters)
        nearest = total.argmin(axis=1).astype(np.int32)
        distances = total[np.arange(len(total)), nearest]
        return pa.table(
            {
                "group": table["group"][:1].combine_chunks(),
                "clusters": pa.array([nearest], pa.list_(pa.int32())),
                "distances": pa.array([distances], pa.list_(pa.int64())),
            }
        )

    return add


def assign(records: DataFrame, centroids: DataFrame, clusters: int, dims: int) -> DataFrame:
    """Per group of rows the nearest centroid of every row and the squared distance."""
    in_order = F.sort_array(F.collect_list(F.struct("cluster", "dim", "value")))
    slices = centroids.groupBy("block").agg(
        in_order["value"].alias("slice"),
        F.count_distinct("dim").cast("int").alias("slice_columns"),
    )
    joined = _beside(
        records.select("group", "block", "width", "columns"),
        slices,
        "block",
        F.col("group"),
        8 * clusters * dims,
    )
    partials = joined.select("group", "width", "columns", "slice", "slice_columns").mapInArrow(
        _partial_distances, PARTIAL_DDL
    )
    return partials.groupBy("group").applyInArrow(_nearest(clusters), ASSIGNED_DDL)


def _block_sums(block_dims: int, dims: int):
    def sums(batches):
        """Per record the sums of its columns by centroid."""
        for batch in batches:
            for i in range(batch.num_rows):
                start = batch["block"][i].as_py() * block_dims
                columns = min(block_dims, dims - start)
                rows = _unpacked(batch["columns"][i], batch["width"][i].as_py(), columns)
                present, at = np.unique(batch["clusters"][i].values.to_numpy(), return_inverse=True)
                totals = np.zeros((len(present), columns), np.int64)
                np.add.at(totals, at, rows)
                n = np.bincount(at, minlength=len(present))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(present, columns), pa.int32()),
                        pa.array(np.tile(np.arange(start, start + columns), len(present)), pa.int32()),
                        pa.array(totals.ravel(), pa.int64()),
                        pa.array(np.repeat(n, columns), pa.int64()),
                    ],
                    names=["cluster", "dim", "total", "n"],
                )

    return sums


def update(
    records: DataFrame, assigned: DataFrame, centroids: DataFrame, block_dims: int, dims: int
) -> DataFrame:
    """``centroids`` moved to the floor of their rows' means; those without rows stay."""
    found = records.select("group", "block", "width", "columns").join(
        assigned.select("group", "clusters"), "group"
    )
    sums = (
        found.mapInArrow(_block_sums(block_dims, dims), SUMS_DDL)
        .groupBy("cluster", "dim")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    mean = F.expr("(total - pmod(total, n)) div n")
    return centroids.join(sums, ["cluster", "dim"], "left").select(
        "block", "cluster", "dim", F.coalesce(mean, F.col("value")).alias("value")
    )


def centroid_facts(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """Per centroid the digest of its components and its inertia; sums beyond a long are held there."""
    rows = assigned.select(F.explode(F.arrays_zip("clusters", "distances")).alias("r"))
    sums = rows.groupBy(F.col("r.clusters").alias("cluster")).agg(
        F.sum(F.col("r.distances").cast("decimal(38,0)")).alias("sum")
    )
    whole = sums.withColumn("all", F.sum("sum").over(Window.partitionBy(F.lit(0))))  # a row each

    def held(column: str) -> Column:
        return F.least(F.col(column), F.lit(_LONG_MAX).cast("decimal(38,0)")).cast("bigint")

    in_order = F.sort_array(F.collect_list(F.struct("dim", "value")))["value"]
    digests = centroids.groupBy("cluster").agg(
        F.sha2(F.array_join(in_order.cast("array<string>"), ","), 256).alias("centroid_sha256")
    )
    return digests.join(whole, "cluster").select(
        "cluster",
        held("sum").alias("cluster_inertia"),
        held("all").alias("inertia"),
        "centroid_sha256",
    )


def cluster_vectors(
    vectors: DataFrame,
    dims: int = DIMS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    block_dims: int = BLOCK_DIMS,
    seed: int = SEED,
) -> DataFrame:
    """One row per kept vector: its centroid, squared distance, inertias and the centroid's digest.

    Vectors that are null, have another length, or a component that is null or not finite are left
    out. Others become integers ``floor(scale * x)``, held within ``bound(dims)``. Repeated rows, null
    ids and ids that occur twice count as vectors of their own. Ties go to the smaller number. With
    fewer vectors than ``clusters`` each is a centroid; an empty table gives an empty result. Only
    ``vec_id`` and ``embedding`` are read, so other columns may have any name.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dims)
    with small_batches(spark, GROUP_BYTES // (8 * dims)):
        records = cut_lineage(block_records(kept, dims, clusters, scale, block_dims))
    first = first_centroids(kept, dims, clusters, scale, block_dims, seed)
    centroids = cut_lineage(first)
    clusters = min(clusters, centroids.filter("dim = 0").count())
    with small_batches(spark, BATCH_RECORDS):
        for _ in range(rounds):
            assigned = cut_lineage(assign(records, centroids, clusters, dims))
            centroids = cut_lineage(update(records, assigned, centroids, block_dims, dims))
        assigned = cut_lineage(assign(records, centroids, clusters, dims))
    facts = cut_lineage(centroid_facts(assigned, centroids))
    ids = records.filter("block = 0").select("group", "vec_ids")
    zipped = F.arrays_zip("vec_ids", "clusters", "distances")
    rows = assigned.join(ids, "group").select(F.explode(zipped).alias("r"))
    found = rows.select(
        F.col("r.vec_ids").alias("vec_id"),
        F.col("r.clusters").alias("cluster"),
        F.col("r.distances").alias("distance"),
    )
    return _beside(found, facts, "cluster", F.col("distance"), 256 * clusters).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
