"""Turn the many small folders of a stream into few files by date."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from spanloom.schemas import SPANS
from spanloom.sinks.files import read_spans, write_spans
from spanloom.sinks.runs import commits, folder_names, remove

_RUN = "batches-"
_FOLDER = "batch_id="

# Rows that one task merges into a file by date.
TASK_ROWS = 400_000
# Scans that one job unites; longer compactions put more dates into each.
MAX_SCANS = 200


def compacted_through(spark: SparkSession, table_path: str) -> int:
    """The highest batch that has been compacted, -1 before the first one."""
    ids = F.regexp_extract("run_id", f"^{_RUN}\\d+-(\\d+)$", 1).cast("bigint")
    own = commits(spark, table_path).filter(F.col("run_id").startswith(_RUN))
    last = own.agg(F.max(ids).alias("last")).first()["last"]
    return -1 if last is None else last


def _batches(spark: SparkSession, sink_path: str) -> list[int]:
    names = folder_names(spark, sink_path)
    return sorted(int(n.removeprefix(_FOLDER)) for n in names if n.startswith(_FOLDER))


def _dated_spans_of(spark: SparkSession, sink_path: str, batches: list[int]) -> DataFrame:
    """Spans with the ``span_date`` of their folder."""
    folders = (f"{sink_path}/{_FOLDER}{b}" for b in batches)
    reader = spark.read.schema(SPANS).option("basePath", sink_path)
    return reader.parquet(*folders).drop("batch_id")


def _spans_of(spark: SparkSession, sink_path: str, batches: list[int]) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], SPANS)
    return _dated_spans_of(spark, sink_path, batches).select(SPANS.fieldNames())


def _date_folders(dated: DataFrame, period: str) -> list[Row]:
    """Per ``span_date`` of the folders the ``rows`` and whether they are ``one`` date by ``period``.

    Reads one column; gives one row per date."""
    first, last = (F.date_trunc(period, f("start_ts")).cast("date") for f in (F.min, F.max))
    found = dated.groupBy("span_date").agg(
        F.count(F.lit(1)).alias("rows"), first.eqNullSafe(last).alias("one")
    )
    return found.orderBy("span_date").collect()


def _by_date(dated: DataFrame, folders: list[Row]) -> DataFrame:
    """The rows of ``dated``, those of a date in one task or, if they are many, in tasks of their own.

    Folders tell the dates apart, so a scan of its own per date, or per few small ones that follow each
    other, takes the place of a shuffle.
    """
    most = max(TASK_ROWS, sum(f.rows for f in folders) // MAX_SCANS)
    groups: list[list[Row]] = []
    for folder in folders:
        before = groups[-1] if groups else []
        fits = sum(f.rows for f in before) + folder.rows <= most
        if before and fits and before[0].span_date is not None:
            before.append(folder)
        else:
            groups.append([folder])

    def scan(group: list[Row]) -> DataFrame:
        date = F.col("span_date")
        dates = date.between(group[0].span_date, group[-1].span_date)
        own = dated.filter(date.isNull() if group[0].span_date is None else dates)
        return own.coalesce(ceil(sum(f.rows for f in group) / TASK_ROWS))

    return reduce(DataFrame.unionAll, (scan(group) for group in groups))


def compact_spans(
    spark: SparkSession,
    sink_path: str,
    checkpoint: str,
    table_path: str,
    period: str = "day",
    drop: bool = False,
) -> int:
    """Rewrite the Parquet batches of :func:`spanloom.stream_spans` that are not compacted yet as one
    run by date below ``table_path``; returns the number of spans.

    Only batches that the stream's ``checkpoint`` lists as committed are taken, since the stream may
    replay and overwrite others. The commit of the run is the new high-water mark: whatever dies before
    it is done again, whatever comes after it is not. With ``drop`` compacted folders are removed.

    Files of a date are merged where they are read, without a shuffle. Only where a folder of the
    stream holds several dates, as ``period`` is shorter than the stream's, rows are dealt by date anew.
    """
    done = {int(n) for n in folder_names(spark, f"{checkpoint}/commits") if n.isdigit()}
    mark = compacted_through(spark, table_path)
    found = _batches(spark, sink_path)
    batches = [b for b in found if b > mark and b in done]
    rows = 0
    if batches:
        run_id = f"{_RUN}{batches[0]}-{batches[-1]}"
        spans = _dated_spans_of(spark, sink_path, batches)
        folders = _date_folders(spans, period) if "span_date" in spans.columns else []
        merged = bool(folders) and all(folder.one for folder in folders)
        rows = write_spans(
            (_by_date(spans, folders) if merged else spans).select(SPANS.fieldNames()),
            table_path,
            mode="replace",
            period=period,
            run_id=run_id,
            rebalance=not merged,
        )
        mark = batches[-1] if rows else mark
    if drop:
        for batch in (b for b in found if b <= mark):
            remove(spark, f"{sink_path}/{_FOLDER}{batch}")
    return rows


def read_compacted(spark: SparkSession, sink_path: str, table_path: str) -> DataFrame:
    """All spans of a stream: the compacted ones, and those of batches above the high-water mark."""
    mark = compacted_through(spark, table_path)
    rest = [b for b in _batches(spark, sink_path) if b > mark]
    return read_spans(spark, table_path).unionByName(_spans_of(spark, sink_path, rest))
