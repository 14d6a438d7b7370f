"""Places of documents in shards, next to a plain permutation of sorted rows."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import sharding
from tests.llm.data import documents, sort_key, table


def plain_permute(number, count, seed):
    """One number through the network, by Python integers."""
    bits, keys = sharding.half_bits(count), sharding.round_keys(seed)
    mask = (1 << bits) - 1
    while True:
        left, right = number >> bits, number & mask
        for key in keys:
            v = (right + key) % 2**32
            v ^= v >> 16
            v = v * 0x85EBCA6B % 2**32
            v ^= v >> 13
            v = v * 0xC2B2AE35 % 2**32
            v ^= v >> 16
            left, right = right, left ^ (v & mask)
        number = (left << bits) | right
        if number < count:
            return number


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 17, 1000, 4096, 4097, 70_001])
def test_permutation(count):
    numbers = np.arange(count)
    found = sharding.permute(numbers, count, 5)
    assert sorted(found.tolist()) == list(range(count))
    assert (sharding.unpermute(found, count, 5) == numbers).all()
    for i in {0, count // 2, count - 1}:
        assert found[i] == plain_permute(i, count, 5)


def test_permutation_of_large_counts_and_other_seeds():
    count = 10**15 + 7
    numbers = np.arange(count - 2000, count)
    found = sharding.permute(numbers, count)
    assert len(set(found.tolist())) == 2000 and found.max() < count
    assert (sharding.unpermute(found, count) == numbers).all()
    assert (sharding.permute(np.arange(1000), 1000, 1) != sharding.permute(np.arange(1000), 1000, 2)).mean() > 0.9


def test_shuffle_spreads_neighbours():
    places = sharding.permute(np.arange(24_000), 24_000) % np.uint64(24)
    pairs = Counter(zip(places[:-1].tolist(), places[1:].tolist()))
    assert len(pairs) > 24 * 24 * 0.95 and max(pairs.values()) < 5 * 24_000 / 24**2


def brute_shards(rows, shards, seed):
    sizes = [(i, (text or "").encode()) for i, text, *_ in rows]
    places = []
    for n in range(len(rows)):
        p = plain_permute(n, len(rows), seed)
        places.append((p % shards, p // shards))
    return sizes, places


def test_documents(spark):
    rows = documents()
    found = sharding.shard_documents(table(spark, rows), 7, 3).collect()
    sizes, places = brute_shards(rows, 7, 3)
    wanted = Counter((i, len(b) + 8, zlib.crc32(b)) for i, b in sizes)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == wanted
    assert sorted((r["shard"], r.slot) for r in found) == sorted(places)
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}
    counts = Counter(r["shard"] for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1
    # Rows with an id of their own stand where the number of their id puts them.
    ids = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for r in found:
        at = [n for n, row in enumerate(ids) if row[0] == r.doc_id]
        assert (r["shard"], r.slot) in {places[n] for n in at}


def test_reruns_and_other_files_agree(spark):
    rows = documents()
    first = sharding.shard_documents(table(spark, rows).repartition(3)).collect()
    again = sharding.shard_documents(table(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(first, key=sort_key) == sorted(again, key=sort_key)


def test_rows_that_share_all_keys_are_spread(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    found = sharding.place_rows(docs, [F.col("doc_id"), F.col("text")], 24)
    assert found.select("shard", "slot").distinct().count() == 3000
    numbered, count = sharding.number_rows(docs, [F.col("doc_id"), F.col("text")])
    assert count == 3000 and numbered.select("__number").distinct().count() == 3000


def test_empty_table_and_clashing_names(spark):
    assert sharding.shard_documents(table(spark, [])).count() == 0
    named = table(spark).withColumnsRenamed({"label": "text_hash", "size": "number"})
    assert sharding.shard_documents(named.withColumn("slot", F.lit(1))).count() == len(documents())


def test_row_of_a_place():
    count, shards = 1003, 24
    places = sharding.permute(np.arange(count), count)
    for number in (0, 1, 500, 1002):
        shard, slot = int(places[number]) % shards, int(places[number]) // shards
        assert sharding.row_number_at(shard, slot, shards, count) == number


def test_written_shards(spark, tmp_path):
    docs = table(spark)
    sharding.write_shards(docs, path := f"{tmp_path}/shards", 5)
    read = spark.read.parquet(path)
    got = read.select(*docs.columns).collect()
    assert sorted(got, key=sort_key) == sorted(docs.collect(), key=sort_key)
    slots = read.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last")).collect()
    assert len(slots) == 5 and all(r.n == r["last"] + 1 for r in slots)
