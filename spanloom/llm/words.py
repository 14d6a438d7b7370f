"""Words of whole texts, in Arrow batches and as column expressions.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. None of these bytes occurs inside a longer UTF-8 sequence, so bytes and code
points give the same words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
PIECE_BYTES = 2 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES.encode())] = True


def word_array(text: Column) -> Column:
    """The words of ``text`` as an array; empty for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, r"[ \t\n\x0B\f\r]+")
    )


def word_count(text: Column) -> Column:
    """The number of words of ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("bigint")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs that run meanwhile.

    Both sides of a Python task hold whole batches of texts, so smaller ones need less memory.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def lean(task: Callable) -> Callable:
    """``task`` for ``mapInArrow``, after which an idle worker gives back the memory it has freed."""

    def run(batches):
        yield from task(batches)
        give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only glibc has it
        trim(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column end to end and its ``n + 1`` offsets; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def pieces(batches, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text; a longer text is a slice alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(first, last - first)
            first = last


def find_words(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of all words, and the ``n + 1`` positions of the texts' first words."""
    word = ~_IS_SPACE[data]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    begins[inner] |= word[inner]
    stops = word.copy()
    stops[:-1] &= ~word[1:]
    stops[inner - 1] |= word[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def encode_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The distinct spans of ``data`` as an Arrow array, and for each span its index there."""
    keep = np.zeros(len(data) + 1, np.int8)
    keep[starts] += 1
    keep[ends] -= 1
    inside = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return encode_spans(data[inside], offsets)


def encode_spans(data: np.ndarray, offsets: np.ndarray):
    """As ``encode_words``, of spans that follow one another."""
    spans = pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))],
    )
    encoded = spans.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; every distinct word is hashed once."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    distinct, index = encode_words(data, starts, ends)
    hashed = [xxhash.xxh64_intdigest(w, seed) for w in distinct.to_pylist()]
    return np.array(hashed, np.uint64)[index]
