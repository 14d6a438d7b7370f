"""Quality rules: fixed limits, and robust multivariate outliers per language and source.

DataFrame functions only. Each text is reduced to a few counts in one pass; what follows works on
that narrow table. Per (language, source) a minimum-covariance-determinant estimate is found by
concentration steps: from medians and median deviations, the ``SUPPORT`` share of rows with the
smallest Mahalanobis distances gives the next mean and covariance, which never has a larger
determinant. Quantiles come from histograms of a fixed number of bins and moments from plain sums,
so that a hot group is combined before its shuffle and ends as one row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.words import word_array
from spanloom.operators.joins import checked_join
from spanloom.operators.lineage import cut_lineage

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = ("z_length", "z_symbols", "z_lines", "z_repeats")
FEW_REPEATS = 16
_BINS = 64  # histogram bins per doubling of a squared distance
FALSE_REJECTS = 1e-4  # share of normally distributed rows that the cutoff rejects


def chi_square_cutoff(rate: float) -> float:
    """The value that chi-square with four degrees of freedom exceeds with the chance ``rate``."""
    low, high = 0.0, 1500.0
    for _ in range(100):
        middle = (low + high) / 2
        if math.exp(-middle / 2) * (1 + middle / 2) > rate:
            low = middle
        else:
            high = middle
    return high


@dataclass(frozen=True)
class QualityConfig:
    min_words: int = 50
    max_repeat_percent: int = 50
    # Rows that a group needs for an estimate of its own; smaller ones share their language's.
    min_group: int = 200
    # Share of rows that the estimate rests on.
    support: float = 0.75
    steps: int = 4
    # Smallest standard deviations, in units of the transformed statistics. A rate of up to a half
    # in one statistic alone must be able to pass the cutoff: 0.5 / floor ** 2 is above it.
    floors: tuple[float, ...] = (0.05, 0.05, 0.08, 0.08)
    # Squared robust distance beyond which a row is an outlier; medians are scaled to that of
    # chi-square with as many degrees as there are statistics.
    cutoff: float = chi_square_cutoff(FALSE_REJECTS)
    max_broadcast_bytes: int = 8 << 20
    salts: int = 32


CHI_SQUARE_MEDIAN = 3.3567  # four degrees of freedom


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more, by 64-bit hashes of the windows.

    Sorted hashes show the repeated ones. With few of them each window is looked up, else windows
    are sorted with their places; then each repeated window adds the words that the one before it
    does not cover.
    """

    def covered(places: Column) -> Column:
        step = lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n"), at.alias("last")
        )
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def from_hashes(hashes: Column) -> Column:
        def from_sorted(ordered: Column) -> Column:
            return _bound(
                F.array_distinct(
                    F.filter(ordered, lambda h, i: (i > 0) & (h == F.get(ordered, i - 1)))
                ),
                from_repeated,
            )

        def from_repeated(repeated: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(hashes) - 1)
            few = F.filter(places, lambda i: F.array_contains(repeated, F.get(hashes, i)))
            paired = F.array_sort(
                F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            )
            many = _bound(
                paired,
                lambda p: F.array_sort(
                    F.transform(
                        F.filter(
                            p,
                            lambda x, i: (x["h"] == F.get(p, i - 1)["h"])
                            | (x["h"] == F.get(p, i + 1)["h"]),
                        ),
                        lambda x: x["i"],
                    )
                ),
            )
            return (
                F.when(F.size(repeated) == 0, F.lit(0))
                .when(F.size(repeated) <= FEW_REPEATS, covered(few))
                .otherwise(covered(many))
            )

        return _bound(F.sort_array(hashes), from_sorted)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_bound(windows, from_hashes))


def text_counts(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep`` and the counts of every whole text; null has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    worded = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *keep,
        text.alias("_text"),
        word_array(F.col("text")).alias("_words"),
    )
    text, words = F.col("_text"), F.col("_words")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^ \t\x0B\f\r]"))
    long = lambda c: c.cast("bigint")
    return worded.select(
        "doc_id",
        *keep,
        long(F.size(words)).alias("n_words"),
        long(F.aggregate(words, F.lit(0), lambda n, w: n + F.char_length(w))).alias("word_chars"),
        long(F.regexp_count(text, F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        long(_bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).alias("n_dup_lines"),
        long(_repeat_words(words)).alias("n_repeat_words"),
    )


def _statistics(rows: DataFrame, config: QualityConfig) -> DataFrame:
    """Transformed statistics: logarithm of the mean word length, square roots of rates."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = {
        "z_length": F.log((F.col("word_chars") + 1) / n),
        "z_symbols": F.sqrt(F.col("n_symbols") / n),
        "z_lines": F.sqrt(F.col("n_dup_lines") / n),
        "z_repeats": F.sqrt(F.col("n_repeat_words") / n),
    }
    failed = (F.col("n_words") < config.min_words) | (
        100 * F.col("n_repeat_words") > config.max_repeat_percent * F.col("n_words")
    )
    return rows.withColumns(values | {"base_failed": failed})


def _quantile_bin(value: Column) -> Column:
    """The histogram bin of a value of at least 0; bins are ordered like the values."""
    return F.floor(F.log2(value + F.lit(2.0**-10)) * _BINS).cast("int")


def _bin_value(bin_number: Column) -> Column:
    return F.pow(F.lit(2.0), (bin_number + 1) / _BINS) - F.lit(2.0**-10)


def _quantiles(rows: DataFrame, values: dict[str, Column], share: float) -> DataFrame:
    """Per group the ``share`` quantile of each value, by histograms: one shuffle of bin counts."""
    stacked = F.explode(
        F.array(
            *(
                F.struct(F.lit(name).alias("name"), _quantile_bin(value).alias("bin"))
                for name, value in values.items()
            )
        )
    )
    counts = (
        rows.select("lang_key", "source_key", stacked.alias("x"))
        .groupBy("lang_key", "source_key", "x.name", "x.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    group = Window.partitionBy("lang_key", "source_key", "name")
    running = F.sum("n").over(group.orderBy("bin"))
    total = F.sum("n").over(group)
    reached = counts.withColumn("run", running).withColumn("total", total)
    return (
        reached.filter(F.col("run") >= F.col("total") * share)
        .groupBy("lang_key", "source_key", "name")
        .agg(_bin_value(F.min("bin")).alias("v"))
        .groupBy("lang_key", "source_key")
        .pivot("name", list(values))
        .agg(F.first("v"))
    )


def _distance(center: list[Column], covariance: dict[tuple[int, int], Column]) -> Column:
    """Squared Mahalanobis distance by the Cholesky factor, written out for the few dimensions.

    The factor's entries are nested expressions of the group's covariance; ``_factor`` computes them
    once per group, so that a row costs a few multiplications.
    """
    solved: list[Column] = []
    for i, name in enumerate(STATISTICS):
        value = F.col(name) - center[i]
        for j in range(i):
            value = value - covariance[i, j] * solved[j]
        solved.append(value / covariance[i, i])
    return sum((v * v for v in solved[1:]), solved[0] * solved[0])


def _factor(groups: DataFrame, floors: tuple[float, ...]) -> DataFrame:
    """Lower Cholesky factor ``l_i_j`` of the covariance ``c_i_j`` with floors on its diagonal.

    The columns are added one row of the matrix at a time, so that no expression nests the others.
    """
    for i in range(len(STATISTICS)):
        for j in range(i + 1):
            rest = F.col(f"c_{i}_{j}")
            if i == j:
                rest = rest + F.lit(floors[i] ** 2)
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            value = F.sqrt(F.greatest(rest, F.lit(floors[i] ** 2 / 4))) if i == j else (
                rest / F.col(f"l_{j}_{j}")
            )
            groups = groups.withColumn(f"l_{i}_{j}", value)
    return groups


_PAIRS = [(i, j) for i in range(len(STATISTICS)) for j in range(i + 1)]
_PARAMETERS = [f"m_{i}" for i in range(len(STATISTICS))] + [f"l_{i}_{j}" for i, j in _PAIRS]


def _moments(rows: DataFrame) -> DataFrame:
    """Means and covariances per group from sums, of values near zero by their transformation."""
    z = [F.col(name) for name in STATISTICS]
    sums = rows.groupBy("lang_key", "source_key").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(v).alias(f"m_{i}") for i, v in enumerate(z)),
        *(F.covar_pop(z[i], z[j]).alias(f"c_{i}_{j}") for i, j in _PAIRS),
    )
    return sums


def _with_group(rows: DataFrame, groups: DataFrame, config: QualityConfig, how="inner") -> DataFrame:
    return checked_join(
        rows,
        groups,
        on=["lang_key", "source_key"],
        spread=["doc_id"],
        how=how,
        max_broadcast_bytes=config.max_broadcast_bytes,
        salts=config.salts,
    )


def _group_keys(rows: DataFrame, config: QualityConfig) -> DataFrame:
    """Keys of the group whose estimate a row uses: its own, or its language's rest."""
    lang = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    keyed = rows.withColumns({"lang_key": lang, "source_key": source})
    large = (
        keyed.groupBy("lang_key", "source_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("lang_key", "source_key", (F.col("n") >= config.min_group).alias("own"))
    )
    marked = _with_group(keyed, cut_lineage(large), config)
    return marked.withColumn(
        "source_key", F.when(F.col("own"), F.col("source_key")).otherwise(F.lit("rest"))
    ).drop("own")


def robust_estimates(rows: DataFrame, config: QualityConfig) -> DataFrame:
    """Per group the mean, the Cholesky factor and the scale of its distances.

    ``rows`` has ``lang_key``, ``source_key`` and the statistics.
    """
    medians = _quantiles(rows, {n: F.greatest(F.col(n), F.lit(0.0)) for n in STATISTICS}, 0.5)
    centers = cut_lineage(
        medians.select(
            "lang_key", "source_key", *(F.col(n).alias(f"m_{i}") for i, n in enumerate(STATISTICS))
        )
    )
    centered = _with_group(rows, centers, config)
    spread = _quantiles(
        centered, {n: F.abs(F.col(n) - F.col(f"m_{i}")) for i, n in enumerate(STATISTICS)}, 0.5
    )
    start = centers.join(spread, ["lang_key", "source_key"])
    for i, j in _PAIRS:
        value = F.pow(F.col(STATISTICS[i]) * F.lit(1.4826), F.lit(2.0)) if i == j else F.lit(0.0)
        start = start.withColumn(f"c_{i}_{j}", value)
    estimate = cut_lineage(
        _factor(start, config.floors).select("lang_key", "source_key", *_PARAMETERS)
    )
    for step in range(config.steps + 1):
        measured = _with_group(rows, estimate, config).withColumn("d2", _row_distance())
        last = step == config.steps
        share = 0.5 if last else config.support
        limits = cut_lineage(_quantiles(measured, {"d2": F.col("d2")}, share))
        limits = limits.withColumnRenamed("d2", "limit")
        if last:
            scale = F.greatest(F.col("limit"), F.lit(CHI_SQUARE_MEDIAN)) / CHI_SQUARE_MEDIAN
            return cut_lineage(
                estimate.join(limits, ["lang_key", "source_key"])
                .withColumn("scale", scale)
                .drop("limit")
            )
        chosen = _with_group(measured.drop(*_PARAMETERS), limits, config).filter(
            F.col("d2") <= F.col("limit")
        )
        estimate = cut_lineage(
            _factor(_moments(chosen), config.floors).select("lang_key", "source_key", *_PARAMETERS)
        )


def _row_distance() -> Column:
    center = [F.col(f"m_{i}") for i in range(len(STATISTICS))]
    return _distance(center, {(i, j): F.col(f"l_{i}_{j}") for i, j in _PAIRS})


def quality_rules(docs: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """One row per document: its counts, ``base_failed``, its ``distance`` and ``kept``.

    A document fails the base rules with fewer than ``min_words`` words or with more than
    ``max_repeat_percent`` of them in repeated windows. Of the others, those whose scaled squared
    distance from their group exceeds ``cutoff`` are rejected. Null texts have no words and fail;
    null languages and sources are groups of their own; a language's groups below ``min_group`` rows
    share one estimate, and rows of a rest that is itself smaller are kept, with a null distance.
    Rows that share an id are judged apart; an empty table gives an empty result.
    """
    keep = [F.col(c).cast("string").alias(c) for c in ("lang", "source")]
    counted = cut_lineage(text_counts(docs.select("doc_id", "text", *keep), ("lang", "source")))
    rows = _statistics(counted, config)
    passed = rows.filter(~F.col("base_failed"))
    keyed = cut_lineage(
        _group_keys(passed, config).select("doc_id", *COUNTS, "lang_key", "source_key", *STATISTICS)
    )
    enough = cut_lineage(
        keyed.groupBy("lang_key", "source_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= config.min_group)
        .select("lang_key", "source_key")
    )
    fitted = _with_group(keyed, enough, config)
    estimates = robust_estimates(fitted, config)
    distance = _row_distance() / F.col("scale")
    judged = _with_group(keyed, estimates, config, "left").select(
        "doc_id",
        *COUNTS,
        F.lit(False).alias("base_failed"),
        distance.alias("distance"),
        F.coalesce(distance <= config.cutoff, F.lit(True)).alias("kept"),
    )
    failed = rows.filter("base_failed").select(
        "doc_id",
        *COUNTS,
        "base_failed",
        F.lit(None).cast("double").alias("distance"),
        F.lit(False).alias("kept"),
    )
    return judged.unionByName(failed)
