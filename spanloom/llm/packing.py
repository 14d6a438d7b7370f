"""Pack tokenised documents into sequences: best-fit decreasing with a segment tree.

Tokens are counted where the texts are read; only one narrow row per piece moves on. Pieces are
dealt at random into groups of bounded size, each packed by one task: from the longest piece to the
shortest, a segment tree over the remaining capacities finds the tightest open bin that holds it in
logarithmic time. A group wastes at most a part of its last bins, so that many pieces per group keep
the result near that of one packing.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.words import encode_spans, lean, pieces, text_bytes
from spanloom.operators.lineage import cut_lineage

GROUP_PIECES = 100_000
SLICE_BYTES = 4 << 20
CACHED_CHUNKS = 800_000
_JOINED = 2000
_PLAIN = re.compile(rb" (?:[!-~]|\xc3[\x80-\xbf])[^\n]*")

TOKEN_DDL = "doc_id long, ids array<int>"
PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACE_DDL = PIECE_DDL + ", sequence_id long, offset long"


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokenizer.from_file(path)


def vocabulary_path(name: str) -> str:
    """The place of a public vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where the byte-level pattern always starts a new token.

    No match of the pattern goes on with white space after another character. A space byte after a
    printable ASCII byte, or after a letter encoded with the lead byte C3, therefore starts one.
    """
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    if len(data) > 1:
        ascii_before = (data[:-1] > 0x20) & (data[:-1] < 0x7F)
        letter_before = np.zeros(len(data) - 1, bool)
        letter_before[1:] = (data[1:-1] >= 0x80) & (data[:-2] == 0xC3)
        space = (data[1:] == 0x20) | ((data[1:] >= 0x09) & (data[1:] <= 0x0D))
        begins[1:-1] |= space & (ascii_before | letter_before)
    return np.flatnonzero(begins[:-1])


class ChunkCoder:
    """Token ids of texts; chunks that come again are encoded once."""

    def __init__(self, path: str, cached_chunks: int = CACHED_CHUNKS):
        self.cached_chunks = cached_chunks
        self.tokenizer = _tokenizer(path)
        self.line_feed = self._encode(["\n"])[0].ids[0]
        # Strings of added tokens, which have no white space, so that none goes on in another chunk.
        decoder = self.tokenizer.get_added_tokens_decoder()
        self.added = [token.content.encode() for token in decoder.values()]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def _slots(self, chunks: list[bytes]) -> np.ndarray:
        """Where each chunk's ids are: chunk ``i`` of the store is between ``ends[i]`` and the next."""
        missing = [c for c in chunks if c not in self.known]
        if len(self.known) + len(missing) > self.cached_chunks:
            self._forget()
            missing = chunks
        plain = [c for c in missing if _PLAIN.fullmatch(c) and not any(a in c for a in self.added)]
        for at in range(0, len(plain), _JOINED):
            self._learn_joined(plain[at : at + _JOINED])
        self._learn([c for c in missing if c not in self.known])
        return np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))

    def _encode(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _learn(self, chunks: list[bytes]) -> None:
        if chunks:
            ids = [e.ids for e in self._encode(list(map(bytes.decode, chunks)))]
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32)
            self._store(chunks, flat, [len(i) for i in ids])

    def _learn_joined(self, chunks: list[bytes]) -> None:
        """Encode chunks of one space and a word as lines of one text.

        Between a word and a space a line feed is a token of its own, and only there.
        """
        ids = np.array(self._encode([b"\n".join(chunks).decode()])[0].ids, np.uint32)
        feeds = np.flatnonzero(ids == self.line_feed)
        if len(feeds) == len(chunks) - 1:  # else they are learned one by one
            sizes = np.diff(np.concatenate([[-1], feeds, [len(ids)]])) - 1
            self._store(chunks, np.delete(ids, feeds), sizes)

    def _store(self, chunks: list[bytes], ids: np.ndarray, sizes) -> None:
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))
        self.ends.frombytes((np.cumsum(sizes, dtype=np.int64) + len(self.ids)).tobytes())
        self.ids.frombytes(ids.tobytes())

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        data, offsets = text_bytes(texts)
        starts = _chunk_starts(data, offsets)
        if not len(starts):
            return [np.zeros(0, np.uint32)] * (len(offsets) - 1)
        distinct, index = encode_spans(data, np.append(starts, len(data)))
        slots = self._slots(distinct.to_pylist())
        # Views end with this call; the store could not grow under them.
        store, ends = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.ends, np.int64)
        begins, sizes = ends[slots], ends[slots + 1] - ends[slots]
        counts = sizes[index]
        through = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=through[1:])
        places = np.repeat(begins[index] - through[:-1], counts)
        places += np.arange(len(places))
        found = store[places]
        bounds = through[np.searchsorted(starts, offsets)]
        return [found[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


@cache
def _coder(path: str, cached_chunks: int) -> ChunkCoder:
    """One for all tasks of a worker process."""
    return ChunkCoder(path, cached_chunks)


def _with_end(ids: np.ndarray, end_id: int) -> np.ndarray:
    return np.append(ids, np.uint32(end_id)).astype("<u4")


def _tokens(path: str | None, name: str, end_id: int):
    def tokens(batches):
        coder = _coder(path or vocabulary_path(name), CACHED_CHUNKS)
        for part in pieces(batches, most=SLICE_BYTES):
            ids = [_with_end(i, end_id) for i in coder.encode(part["text"])]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return tokens


def _cut(
    path: str | None, name: str, end_id: int, most: int, cached_chunks: int, slice_bytes: int
):
    def cut(batches):
        coder = _coder(path or vocabulary_path(name), cached_chunks)
        for part in pieces(batches, most=slice_bytes):
            rows = []
            for doc_id, found in zip(part["doc_id"].to_pylist(), coder.encode(part["text"])):
                ids = _with_end(found, end_id)
                head = len(ids) % most or most
                bounds = [0, *range(head, len(ids) + 1, most)]
                for piece, (start, stop) in enumerate(zip(bounds, bounds[1:])):
                    crc = zlib.crc32(ids[start:stop].tobytes())
                    rows.append((doc_id, piece, start, stop - start, crc))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in columns[2:]),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


class OpenBins:
    """Open bins by remaining capacity, under a segment tree of which capacities have any."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def _mark(self, capacity: int, held: int) -> None:
        node = capacity + self.leaves
        self.tree[node] = held
        while node > 1:
            node >>= 1
            joined = self.tree[2 * node] | self.tree[2 * node + 1]
            if self.tree[node] == joined:
                return
            self.tree[node] = joined

    def add(self, capacity: int, bin_id: int) -> None:
        self.bins[capacity].append(bin_id)
        if len(self.bins[capacity]) == 1:
            self._mark(capacity, 1)

    def tightest(self, length: int) -> int:
        """The smallest remaining capacity of at least ``length``, or -1."""
        node = length + self.leaves
        if self.tree[node]:
            return length
        while node > 1:  # up to the first node with something to the right, then down to its left
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1

    def take(self, capacity: int) -> int:
        bin_id = self.bins[capacity].pop()
        if not self.bins[capacity]:
            self._mark(capacity, 0)
        return bin_id


def best_fit_decreasing(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; bins are numbered from 0."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins, opened = OpenBins(most), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        capacity = open_bins.tightest(length)
        if capacity < 0:
            bin_id, capacity, opened = opened, most, opened + 1
        else:
            bin_id = open_bins.take(capacity)
        bins[i], offsets[i] = bin_id, most - capacity
        if capacity > length:
            open_bins.add(capacity - length, bin_id)
    return bins, offsets


def _pack(most: int):
    def pack(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, most)
        group = table["bin_group"][0].as_py()
        return table.drop_columns(["bin_group"]).append_column(
            "sequence_id", pa.array(bins + (group << 32), pa.int64())
        ).append_column("offset", pa.array(offsets, pa.int64()))

    return pack


def tokenize(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", path: str | None = None, end_id: int = 0
) -> DataFrame:
    """``(doc_id, ids)``: the token ids of every whole text and ``end_id`` after them."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return chosen.mapInArrow(_tokens(path, vocabulary, end_id), TOKEN_DDL)


def pack_documents(
    docs: DataFrame,
    most: int = 2048,
    vocabulary: str = "byte_bpe_50k.json",
    path: str | None = None,
    end_id: int = 0,
    group_pieces: int = GROUP_PIECES,
    cached_chunks: int = CACHED_CHUNKS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per piece: its place in its document and in a sequence of at most ``most`` tokens.

    A worker takes texts in slices of ``slice_bytes`` and remembers the ids of ``cached_chunks`` words
    at most (about 200 bytes each); with less of both it needs less memory and more time.

    A document of more than ``most`` tokens is cut into pieces of ``most``, the first of which may
    be shorter. A null text counts as empty and is one piece of the end token. Repeated rows are
    packed as often as they come; an empty table gives an empty result.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    pieces_of = _cut(path, vocabulary, end_id, most, cached_chunks, slice_bytes)
    cut = cut_lineage(chosen.mapInArrow(lean(pieces_of), PIECE_DDL))
    groups = max(1, -(-cut.count() // group_pieces))
    salt = F.xxhash64("doc_id", "piece", "ids_crc32", F.lit("pack"))
    dealt = cut.withColumn("bin_group", F.pmod(salt, F.lit(groups)))
    return dealt.groupBy("bin_group").applyInArrow(_pack(most), PLACE_DDL)
