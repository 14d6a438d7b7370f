"""The pipeline next to its stages by brute force, and the registered queries next to their SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import check_engine, differences
from spanloom.llm.mixing import mix_sources
from spanloom.llm.queries import QUERIES, SQL
from tests.llm.data import documents, table
from tests.llm.test_dedup import brute_components
from tests.llm.test_text import brute_counts

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    rows = [r for r in documents() if r[0] != 50]
    docs, found = table(spark, rows), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(path := f"{tmp_path}/{i}")
        docs = spark.read.parquet(path)
        found.append(docs)
    assert all(f.columns == table(spark, rows).columns for f in found[:-1])
    kept_ids = set()
    for r in rows:
        n, _, _, _, repeats = brute_counts(r[1])
        if n >= 50 and 100 * repeats <= 50 * n:
            kept_ids.add(r[0])
    kept = [r for r in rows if r[0] in kept_ids]
    assert sorted(found[0].collect(), key=str) == sorted(table(spark, kept).collect(), key=str)
    best = {}
    for r in kept:
        key = r[1] or ""
        if key not in best or (best[key][0] is None) or (r[0] is not None and r[0] > best[key][0]):
            best[key] = r
    assert sorted(map(tuple, found[1].collect()), key=str) == sorted(best.values(), key=str)
    rest = list(best.values())
    ids = {d for d, _, c in brute_components(rest, percent=80, size=5) if d == c}
    rest = [r for r in rest if r[0] in ids]
    assert sorted(map(tuple, found[2].collect()), key=str) == sorted(rest, key=str)
    mixed = mix_sources(found[2]).filter("taken > 0").select((F.col("taken") / F.col("size")).alias("n"))
    assert found[3].count() == sum(int(r.n) for r in mixed.collect())
    pieces = found[4].filter("piece = 0").groupBy("doc_id").count().collect()
    taken = found[3].groupBy("doc_id").count().collect()
    assert {tuple(r) for r in pieces} == {tuple(r) for r in taken}


def test_near_takes_five_words_and_80_percent(spark):
    def copy(first, edits, n=200):
        words = [f"w{first}x{i}" for i in range(n)]
        for k in range(edits):
            words[10 + 20 * k] = f"edit{first}x{k}"
        return " ".join(words)

    block = copy(3, 0) + " " + " ".join(f"new{i}" for i in range(40))
    texts = [copy(1, 0), copy(1, 4), copy(2, 0), copy(2, 5), copy(3, 0), block, copy(4, 0), copy(4, 0) + " " + copy(5, 0, 60)]
    # With n - 4 sets of five words: 4 edits give 176 of 216, 5 give 171 of 221, the block 196 of 236.
    rows = [(i, t, "en", "s", None, None) for i, t in enumerate(texts)]
    kept = {r.doc_id for r in corpus_pipeline.near(spark, table(spark, rows), SF_DIR).collect()}
    assert kept == {0, 2, 3, 4, 6, 7}


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_columns_that_clash_and_empty_tables(spark, monkeypatch, limit):
    monkeypatch.setattr(corpus_pipeline, "MAX_BROADCAST_BYTES", limit)
    plain = table(spark, [r for r in documents() if r[0] != 50])
    extra = {"_key": F.lit(1), "_salt": F.lit("s"), "_hash": F.lit(2), "_salts": F.lit(3)}
    docs = plain.withColumns(extra)
    for _, stage in corpus_pipeline.STAGES[:2]:
        kept, wanted = stage(spark, docs, SF_DIR), stage(spark, plain, SF_DIR)
        assert kept.columns == docs.columns
        assert sorted(kept.drop(*extra).collect(), key=str) == sorted(wanted.collect(), key=str)
        assert kept.select(*extra).distinct().collect() == [(1, "s", 2, 3)]
        assert stage(spark, docs.filter("false"), SF_DIR).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns[:2] == ["doc_id", "piece"]


@pytest.fixture(scope="module")
def engine():
    return check_engine(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, engine, name):
    assert differences(spark, engine, SF_DIR, name) is None


def test_all_are_registered():
    assert {int(n.split("_")[0][2:]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
