"""Runs that are done again or die, batches without spans, and compaction of streams."""

import json

import pytest
from pyspark.sql import functions as F

from spanloom import (
    compact_spans,
    otlp_batches,
    read_compacted,
    read_documents,
    read_executions,
    read_spans,
    spans_from_nested,
    stream_spans,
    write_spans,
)
from spanloom.schemas import SPANS
from spanloom.sinks import files, runs
from spanloom.streaming import compaction
from tests.test_files_and_streams import CONFIG, nested, rows


def span_ids(documents):
    return sorted(
        s["spanId"]
        for r in documents.collect()
        for s in json.loads(r.document)["resourceSpans"][0]["scopeSpans"][0]["spans"]
    )


@pytest.fixture(scope="module")
def spans(spark):
    return spans_from_nested(nested(spark, range(1, 5)), CONFIG).cache()


def test_a_run_of_documents_replaces_its_own(spark, tmp_path, spans):
    path = str(tmp_path / "documents")
    some, all_ids = spans.filter("query_id < 3"), sorted(r.span_id for r in spans.collect())
    assert read_documents(spark, path).count() == 0
    write_spans(otlp_batches(some, 2, CONFIG), path, "otlp_json", "replace", run_id="a")
    write_spans(otlp_batches(spans.filter("query_id >= 3"), 2, CONFIG), path, "otlp_json", "replace", run_id="b")
    for _ in range(2):
        wrote = write_spans(otlp_batches(some, 2, CONFIG), path, "otlp_json", "replace", run_id="a")
    assert wrote == otlp_batches(some, 2, CONFIG).count()
    assert span_ids(read_documents(spark, path)) == all_ids
    assert runs.drop_replaced(spark, path) == 2
    assert span_ids(read_documents(spark, path)) == all_ids


def test_a_run_that_dies_changes_nothing(spark, tmp_path, spans, monkeypatch):
    path = str(tmp_path / "documents")
    documents = otlp_batches(spans, 2, CONFIG)
    write_spans(documents, path, "otlp_json", "replace", run_id="a")
    wanted = span_ids(read_documents(spark, path))

    def dies(spark, path):
        raise RuntimeError("lost after the files and before the commit")

    with monkeypatch.context() as broken:
        broken.setattr(runs, "commits", dies)
        with pytest.raises(RuntimeError):
            write_spans(documents, path, "otlp_json", "replace", run_id="a")
    assert len([n for n in runs.folder_names(spark, path) if n.startswith("run=")]) == 2
    assert span_ids(read_documents(spark, path)) == wanted
    write_spans(documents, path, "otlp_json", "replace", run_id="a")
    assert span_ids(read_documents(spark, path)) == wanted


def test_a_run_without_rows(spark, tmp_path, spans):
    path, none = str(tmp_path / "spans"), spans.filter("false")
    assert write_spans(none, path, mode="replace", run_id="a") == 0
    assert runs.folder_names(spark, path) == []
    assert write_spans(spans, path, mode="replace", run_id="a", period="year") == spans.count()
    assert rows(read_spans(spark, path)) == rows(spans)
    assert write_spans(none, path, mode="replace", run_id="a") == 0
    assert read_spans(spark, path).count() == 0


def test_modes_that_do_not_go_together(spark, tmp_path, spans):
    with pytest.raises(ValueError):
        write_spans(spans, str(tmp_path), run_id="a")
    with pytest.raises(ValueError):
        write_spans(spans, str(tmp_path), "otlp_json", "replace")


def stream(spark, landing, sink, offsets, fmt="parquet"):
    source = read_executions(spark, landing, streaming=True, maxFilesPerTrigger="1")
    query = stream_spans(source, sink, offsets, config=CONFIG, fmt=fmt, available_now=True)
    query.awaitTermination()


@pytest.mark.parametrize("fmt", ["parquet", "otlp_json"])
def test_batches_without_spans_leave_no_folder(spark, tmp_path, monkeypatch, fmt):
    landing, sink, offsets = (str(tmp_path / n) for n in ("landing", "sink", "offsets"))
    source = nested(spark, range(1, 4))
    source.filter("query_id = 1").write.parquet(landing)
    fast = source.filter("query_id > 1").selectExpr("* except (min_duration_ms)", "-1 as min_duration_ms")
    fast.select(source.columns).coalesce(1).write.mode("append").parquet(landing)
    passes = []

    def once(df, write):
        passes.append(1)
        return runs.counted(df, write)

    monkeypatch.setattr(files, "counted", once)
    stream(spark, landing, sink, offsets, fmt)
    assert len(passes) >= 2 and len(runs.folder_names(spark, sink)) == 1
    slow = spans_from_nested(source.filter("query_id = 1"), CONFIG)
    if fmt == "parquet":
        assert rows(spark.read.schema(SPANS).parquet(sink)) == rows(slow)
    else:
        sent = spark.read.text(sink).withColumnRenamed("value", "document")
        assert span_ids(sent) == sorted(r.span_id for r in slow.collect())


def test_compaction(spark, tmp_path, monkeypatch):
    landing, sink, offsets, table = (str(tmp_path / n) for n in ("landing", "sink", "offsets", "table"))
    source = nested(spark, range(1, 7))
    source.filter("query_id < 5").repartition(3).write.parquet(landing)
    stream(spark, landing, sink, offsets)
    wanted = rows(spans_from_nested(source.filter("query_id < 5"), CONFIG))
    assert rows(read_compacted(spark, sink, table)) == wanted
    batches = len(runs.folder_names(spark, sink))

    # It dies once after the files and before the commit, and once before folders are removed.
    with monkeypatch.context() as broken:
        broken.setattr(runs, "commits", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact_spans(spark, sink, offsets, table)
    assert rows(read_compacted(spark, sink, table)) == wanted
    with monkeypatch.context() as broken:
        broken.setattr(compaction, "remove", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact_spans(spark, sink, offsets, table, drop=True)
    assert len(runs.folder_names(spark, sink)) == batches
    assert rows(read_compacted(spark, sink, table)) == wanted
    assert compact_spans(spark, sink, offsets, table, drop=True) == 0
    assert runs.folder_names(spark, sink) == []
    assert rows(read_compacted(spark, sink, table)) == wanted

    # The stream goes on; an unfinished batch is read, but not compacted.
    source.filter("query_id >= 5").coalesce(1).write.mode("append").parquet(landing)
    stream(spark, landing, sink, offsets)
    wanted = rows(spans_from_nested(source, CONFIG))
    assert rows(read_compacted(spark, sink, table)) == wanted
    last = max(int(n) for n in runs.folder_names(spark, f"{offsets}/commits") if n.isdigit())
    runs.remove(spark, f"{offsets}/commits/{last}")
    assert compact_spans(spark, sink, offsets, table, drop=True) == 0
    assert rows(read_compacted(spark, sink, table)) == wanted
    assert len(runs.folder_names(spark, sink)) == 1


def written(place):
    """Number of files by date."""
    days = [p for p in place.glob("**/span_date=*") if p.is_dir()]
    return {d.name.removeprefix("span_date="): len(list(d.glob("*.parquet"))) for d in days}


@pytest.mark.parametrize("task_rows", [1, 400_000])
def test_compaction_merges_dates_without_a_shuffle(spark, tmp_path, monkeypatch, task_rows):
    landing, sink, offsets, table = (str(tmp_path / n) for n in ("landing", "sink", "offsets", "table"))
    source = nested(spark, range(1, 7))
    source.repartition(4).write.parquet(landing)
    stream(spark, landing, sink, offsets)
    monkeypatch.setattr(compaction, "TASK_ROWS", task_rows)
    plans = []

    def planned(df, *args, **kwargs):
        plans.append((df._jdf.queryExecution().toString(), kwargs["rebalance"]))
        return files.write_spans(df, *args, **kwargs)

    monkeypatch.setattr(compaction, "write_spans", planned)
    spans = spans_from_nested(source, CONFIG)
    assert compact_spans(spark, sink, offsets, table, drop=True) == spans.count()
    assert [("Exchange" in plan, dealt) for plan, dealt in plans] == [(False, False)]
    assert rows(read_compacted(spark, sink, table)) == rows(spans)
    assert written(tmp_path / "table") == {f"1970-01-0{d}": 1 for d in range(2, 8)}


def test_compaction_by_a_shorter_period_deals_rows(spark, tmp_path):
    landing, sink, offsets, table = (str(tmp_path / n) for n in ("landing", "sink", "offsets", "table"))
    source = nested(spark, range(1, 4))
    source.repartition(3).write.parquet(landing)
    read = read_executions(spark, landing, streaming=True)
    stream_spans(read, sink, offsets, config=CONFIG, period="year", available_now=True).awaitTermination()
    spans = spans_from_nested(source, CONFIG)
    assert compact_spans(spark, sink, offsets, table, period="day") == spans.count()
    assert rows(read_compacted(spark, sink, table)) == rows(spans)
    assert written(tmp_path / "table") == {f"1970-01-0{d}": 1 for d in range(2, 5)}


def test_compaction_keeps_spans_without_a_time(spark, tmp_path):
    sink, offsets, table = (str(tmp_path / n) for n in ("sink", "offsets", "table"))
    source = spans_from_nested(nested(spark, range(1, 4)), CONFIG)
    no_time = source.filter("query_id = 2").withColumn("start_ts", F.lit(None).cast("timestamp"))
    both = source.filter("query_id <> 2").unionByName(no_time)
    for batch in range(2):
        write_spans(both, f"{sink}/batch_id={batch}", mode="overwrite")
    (tmp_path / "offsets" / "commits").mkdir(parents=True)
    for batch in range(2):
        (tmp_path / "offsets" / "commits" / str(batch)).touch()
    assert compact_spans(spark, sink, offsets, table, drop=True) == 2 * both.count()
    assert rows(read_compacted(spark, sink, table)) == rows(both.unionAll(both))
