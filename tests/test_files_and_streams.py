import json
from collections import Counter
from unittest.mock import Mock

import pytest

from spanloom import (
    SpanConfig,
    few_dates,
    nest_plans,
    otlp_batches,
    read_executions,
    read_plan_nodes,
    resolve_relations,
    spans_from_nested,
    stream_spans,
    write_spans,
)
from spanloom.schemas import SPAN_NODE_FIELDS, SPANS
from spanloom.sinks import files
from spanloom.sinks.files import FEW_DATES
from spanloom.streaming import continuous
from tests.data import catalog, executions, plan_nodes
from tests.test_spans import tree

CONFIG = SpanConfig(default_min_duration_ms=0)
DAY = 86_400_000_000_000


def nested(spark, query_ids):
    runs = [{"query_id": q, "finished_unix_nano": (q + 1) * DAY} for q in query_ids]
    nodes = plan_nodes(spark, *(n for q in query_ids for n in tree(q, 4)))
    named = resolve_relations(nodes, *catalog(spark)).select("query_id", *SPAN_NODE_FIELDS)
    return nest_plans(executions(spark, *runs), named).rows


def rows(df):
    return sorted(df.select(SPANS.fieldNames()).collect(), key=repr)


def read_spans(spark, path):
    return rows(spark.read.schema(SPANS).parquet(path))


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_inputs_have_declared_schemas(spark, tmp_path, fmt):
    runs, nodes = executions(spark, {}), plan_nodes(spark, *tree(1, 3))
    runs.write.format(fmt).save(str(tmp_path / "runs"))
    nodes.write.format(fmt).save(str(tmp_path / "nodes"))
    assert read_executions(spark, str(tmp_path / "runs"), fmt).collect() == runs.collect()
    got = read_plan_nodes(spark, str(tmp_path / "nodes"), fmt)
    assert got.schema == nodes.schema and got.count() == 3
    with pytest.raises(ValueError):
        read_executions(spark, "x", "csv")


def test_parquet_is_written_by_date(spark, tmp_path):
    spans = spans_from_nested(nested(spark, range(1, 4)), CONFIG)
    path = str(tmp_path / "spans")
    write_spans(spans, path)
    assert read_spans(spark, path) == rows(spans)
    days = sorted(p.name for p in (tmp_path / "spans").iterdir() if p.is_dir())
    assert days == ["span_date=1970-01-02", "span_date=1970-01-03", "span_date=1970-01-04"]
    write_spans(spans, path, mode="overwrite", period="year")
    assert [p.name for p in (tmp_path / "spans").iterdir() if p.is_dir()] == ["span_date=1970-01-01"]
    with pytest.raises(ValueError):
        write_spans(spans, path, "csv")


def test_a_rerun_replaces_its_dates(spark, tmp_path):
    path = str(tmp_path / "spans")
    write_spans(spans_from_nested(nested(spark, range(1, 4)), CONFIG), path)
    again = spans_from_nested(nested(spark, range(2, 4)), CONFIG)
    write_spans(again, path, mode="replace")
    write_spans(again, path, mode="replace")
    assert read_spans(spark, path) == rows(spans_from_nested(nested(spark, range(1, 4)), CONFIG))


def test_stream_equals_batch_and_restarts_add_nothing(spark, tmp_path):
    landing, sink, offsets = (str(tmp_path / n) for n in ("landing", "sink", "offsets"))
    source = nested(spark, range(1, 7))
    source.repartition(3).write.parquet(landing)

    def run():
        stream = read_executions(spark, landing, streaming=True, maxFilesPerTrigger="1")
        query = stream_spans(stream, sink, offsets, config=CONFIG, available_now=True)
        query.awaitTermination()

    run()
    wanted = rows(spans_from_nested(source, CONFIG))
    assert read_spans(spark, sink) == wanted
    run()
    assert read_spans(spark, sink) == wanted
    more = nested(spark, range(7, 9))
    more.write.mode("append").parquet(landing)
    run()
    wanted = sorted(wanted + rows(spans_from_nested(more, CONFIG)), key=repr)
    assert read_spans(spark, sink) == wanted


def test_streamed_documents(spark, tmp_path):
    landing, sink, offsets = (str(tmp_path / n) for n in ("landing", "sink", "offsets"))
    source = nested(spark, range(1, 5))
    source.repartition(2).write.parquet(landing)
    stream = read_executions(spark, landing, streaming=True, maxFilesPerTrigger="1")
    query = stream_spans(
        stream, sink, offsets, config=CONFIG, fmt="otlp_json", num_buckets=2, available_now=True
    )
    query.awaitTermination()
    lines = [r.value for r in spark.read.text(sink).collect()]
    sent = [
        s["spanId"]
        for line in lines
        for s in json.loads(line)["resourceSpans"][0]["scopeSpans"][0]["spans"]
    ]
    spans = spans_from_nested(source, CONFIG)
    assert sorted(sent) == sorted(r.span_id for r in spans.collect())
    # Delivering a batch again replaces it.
    write_spans(otlp_batches(spans, 2, CONFIG), f"{sink}/batch_id=0", "otlp_json", "overwrite")
    write_spans(otlp_batches(spans, 2, CONFIG), f"{sink}/batch_id=0", "otlp_json", "overwrite")
    again = [r.value for r in spark.read.text(f"{sink}/batch_id=0").collect()]
    assert sum(json.loads(x)["resourceSpans"][0]["scopeSpans"][0]["spans"].__len__() for x in again) == len(sent)


def test_documents_are_compressed(spark, tmp_path):
    spans = spans_from_nested(nested(spark, [1, 2]), CONFIG)
    batches = otlp_batches(spans, 4, CONFIG)
    write_spans(batches, str(tmp_path / "otlp"), "otlp_json", "overwrite")
    files = list((tmp_path / "otlp").glob("part-*"))
    assert files and all(f.read_bytes()[:2] == b"\x1f\x8b" for f in files)
    read = spark.read.text(str(tmp_path / "otlp"))
    assert sorted(r.value for r in read.collect()) == sorted(
        r.document for r in batches.collect()
    )


def days(spark, path):
    """Number of files by date."""
    files = spark.read.schema(SPANS).parquet(path).inputFiles()
    return Counter(f.split("span_date=")[1].split("/")[0] for f in files)


def test_spans_are_written_where_they_arise(spark, tmp_path):
    apart = spans_from_nested(nested(spark, range(1, 4)), CONFIG).repartition(8)
    write_spans(apart, str(tmp_path / "dealt"))
    write_spans(apart, str(tmp_path / "apart"), rebalance=False)
    dates = ["1970-01-02", "1970-01-03", "1970-01-04"]
    assert days(spark, str(tmp_path / "dealt")) == dict.fromkeys(dates, 1)
    assert sum(days(spark, str(tmp_path / "apart")).values()) > len(dates)
    for name in ("dealt", "apart"):
        assert read_spans(spark, str(tmp_path / name)) == rows(apart)


def test_few_dates(spark):
    runs = [{"query_id": d, "finished_unix_nano": d * DAY} for d in range(1, FEW_DATES + 1)]
    odd = [{"finished_unix_nano": -(2**63), "total_ns": 2**63 - 1}]
    assert few_dates(executions(spark, *runs), "day")
    assert not few_dates(executions(spark, *runs, *odd), "day")
    assert few_dates(executions(spark, *runs, *odd), "year")
    assert few_dates(executions(spark, *runs).limit(0))


@pytest.mark.parametrize("few", [0, 16])
def test_a_batch_with_few_dates_is_not_dealt(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(files, "FEW_DATES", few)
    landing, sink, offsets = (str(tmp_path / n) for n in ("landing", "sink", "offsets"))
    source = nested(spark, range(1, 9))
    source.repartition(4).write.option("maxRecordsPerFile", 1).parquet(landing)
    monkeypatch.setattr(continuous, "write_spans", dealt := Mock(wraps=write_spans))
    stream = read_executions(spark, landing, streaming=True)
    stream_spans(stream, sink, offsets, config=CONFIG, available_now=True).awaitTermination()
    assert read_spans(spark, sink) == rows(spans_from_nested(source, CONFIG))
    assert [call.kwargs["rebalance"] for call in dealt.call_args_list] == [few == 0]
