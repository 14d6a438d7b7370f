"""Mix sources to target weights: capped water-filling, then seeded repetitions.

Water-filling clamps each source at ``max_epochs`` times its size and shares the excess among the
others in proportion to their weights, until no target is above its cap. A source's target is then
met by whole repetitions of all its documents and one fractional repetition: documents are ordered by
a seeded hash, and those below a cut hash are taken once more. The cut is found by three levels of
per-source histograms, so no task ever sorts the documents of a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.words import word_count
from spanloom.operators.joins import checked_join
from spanloom.operators.lineage import cut_lineage

HASH_DIGITS = 15  # hex digits of the hash: 60 bits
LEVEL_BITS = 10
MAX_BROADCAST_BYTES, SALTS = 16 << 20, 32


def seeded_hash(doc_id: Column, seed: int) -> Column:
    """60 bits of the MD5 of the seed and the id."""
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(label), 1, HASH_DIGITS), 16, 10).cast("bigint")


def rank_sources(totals: DataFrame) -> DataFrame:
    """``totals`` with ``rank`` from 0 by the code points of ``source``, null last.

    Sources are range-partitioned; only the counts of partitions meet in one task.
    """
    ordered = totals.withColumn("last", F.col("source").isNull())
    dealt = cut_lineage(
        ordered.repartitionByRange(F.col("last"), F.col("source")).withColumn(
            "part", F.spark_partition_id()
        )
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("part").orderBy("last", "source")
    return (
        dealt.withColumn("number", F.row_number().over(within) - 1)
        .join(offsets, "part")
        .withColumn("rank", F.col("number") + F.col("offset"))
        .drop("last", "part", "number", "offset")
    )


def water_fill(sources: DataFrame, total: int, max_epochs: int) -> DataFrame:
    """``sources`` (``source, source_size, weight``) with their ``target``.

    Each round clamps the sources whose proportional share exceeds their cap and returns the rest
    to the others; one row of sums reaches the driver per round.
    """
    rows = sources.withColumn("cap", F.col("source_size") * max_epochs)
    clamped = F.lit(False)
    seen = -1
    while True:
        sums = rows.agg(
            F.coalesce(F.sum(F.when(clamped, F.col("cap"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0)).alias("weights"),
            F.count(F.when(clamped, 1)).alias("n"),
        ).first()
        left, weights = total - sums["held"], sums["weights"]
        if sums["n"] == seen or not weights:
            break
        seen = sums["n"]
        share = F.col("weight") * F.lit(left).cast("bigint")
        clamped = clamped | (share > F.col("cap") * F.lit(weights).cast("bigint"))
    share = (F.col("weight") * F.lit(left).cast("bigint")).cast("double")
    proportional = share / F.lit(float(weights or 1))
    return rows.withColumn(
        "target", F.when(clamped, F.col("cap").cast("double")).otherwise(proportional)
    )


def _cuts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source the hash up to which documents are taken once more (null: none).

    ``wanted`` has ``source`` and ``need``, the words of the fractional repetition. Each level sums
    sizes by the next hash bits within the bucket in which the running sum passes ``need``; the last
    level works on single hashes and takes the passing one if that ends nearer to ``need``.
    """
    same = F.col("source").eqNullSafe(F.col("of"))
    state = wanted.select(F.col("source").alias("of"), "need", F.lit(0).alias("bucket"))
    bits = 4 * HASH_DIGITS
    for level in (1, 2, 3):
        shift = bits - level * LEVEL_BITS
        here = docs if level == 1 else docs.withColumn("up", F.shiftright("u", shift + LEVEL_BITS))
        key = F.shiftright("u", shift) if level < 3 else F.col("u")
        inside = same if level == 1 else same & (F.col("up") == F.col("bucket"))
        sums = (
            here.join(state, inside)
            .groupBy("of", "need", key.alias("key"))
            .agg(F.sum("size").alias("size"))
        )
        run = Window.partitionBy("of").orderBy("key")
        passed = sums.withColumn("sum", F.sum("size").over(run)).withColumn(
            "before", F.col("sum") - F.col("size")
        )
        if level < 3:
            state = cut_lineage(
                passed.filter((F.col("sum") > F.col("need")) & (F.col("before") <= F.col("need")))
                .groupBy("of")
                .agg(F.min_by(F.struct("key", "before", "need"), "key").alias("b"))
                .select(
                    "of",
                    (F.col("b.need") - F.col("b.before")).alias("need"),
                    F.col("b.key").alias("bucket"),
                )
            )
    nearer = F.abs(F.col("sum") - F.col("need")) <= F.abs(F.col("before") - F.col("need"))
    takes = (F.col("before") < F.col("need")) & nearer
    floor = F.shiftleft(F.shiftright(F.col("key"), bits - 2 * LEVEL_BITS), bits - 2 * LEVEL_BITS)
    return passed.groupBy("of").agg(
        F.coalesce(F.max(F.when(takes, F.col("key"))), F.min(floor) - 1).alias("cut")
    )


def sized_documents(docs: DataFrame, seed: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` as ``doc_id, source, size, u``, or with these and the columns ``keep``."""
    return docs.select(
        *keep,
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        seeded_hash(F.col("doc_id"), seed).alias("u"),
    )


def source_plan(sized: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Per source (``of``) its size, target, whole repetitions and cut."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = rank_sources(totals)
    cycle = F.element_at(
        F.array(*(F.lit(w).cast("bigint") for w in weights)),
        (F.col("rank") % len(weights) + 1).cast("int"),
    )
    weighted = cut_lineage(ranked.withColumn("weight", cycle))
    total = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t")).first()["t"]
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("bigint")
    targets = cut_lineage(
        water_fill(weighted, total, max_epochs)
        .withColumn("whole", whole)
        .select(
            "source",
            "source_size",
            "target",
            "whole",
            (F.col("target") - F.col("whole") * F.col("source_size")).alias("need"),
        )
    )
    cuts = _cuts(sized, targets.filter(F.col("need") > 0).select("source", "need"))
    return cut_lineage(
        targets.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
        .drop("of", "need")
        .withColumnRenamed("source", "of")
    )


def repetitions() -> Column:
    """How often a row with its source's plan is taken."""
    extra = F.when(F.col("u") <= F.coalesce(F.col("cut"), F.lit(-1)), 1).otherwise(0)
    return F.col("whole") + extra


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 17
) -> DataFrame:
    """One row per document: its size in words, its source's size and target, and the words taken.

    Sources in code-point order, null last, get ``weights`` in turn. Targets share the words of all
    documents. Null texts and texts without words have size 0 and give nothing; a null source is a
    source of its own. Rows that share an id share a hash and are taken alike. Without words all
    targets are 0; an empty table gives an empty result.
    """
    sized = cut_lineage(sized_documents(docs, seed))
    plan = source_plan(sized, weights, max_epochs)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repetitions()).alias("taken")
    )


def repeat_documents(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 17
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them; rows without words are not taken.

    Texts are not shuffled: only the plan, a row per source, is joined to them.
    """
    plan = source_plan(cut_lineage(sized_documents(docs, seed)), weights, max_epochs)
    whole_row = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    rows = sized_documents(docs, seed, (whole_row,)).filter(F.col("size") > 0)
    taken = checked_join(
        rows.select("row", "u", _source_key("source").alias("source_key")),
        plan.select("whole", "cut", _source_key("of").alias("source_key")),
        on=["source_key"],
        spread=["u"],
        how="inner",
        max_broadcast_bytes=MAX_BROADCAST_BYTES,
        salts=SALTS,
    )
    times = F.sequence(F.lit(1), repetitions().cast("int"))
    return taken.filter(repetitions() > 0).select("row", F.explode(times)).select("row.*")


def _source_key(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("-"))
