"""Repeats of a fixed length, found by winnowed anchors. Shared by word and byte dedup.

Texts are sequences of symbols (words or bytes). A window is ``length`` symbols of one text; its
anchor is the least hash of the ``gram`` -symbol sequences in it, so that equal windows have equal
anchors. A run is a series of consecutive windows of one text with one anchor.

Texts are packed into pieces of a few megabytes, written once. Only compact arrays are shuffled, a
row per piece and bucket of anchors:

1. Every piece sends codes of 40 bits of the distinct anchors it selects; each bucket sends back those
   that occur at two places or more. Anchors that share a code are only looked at in vain.
2. Pieces send the runs of repeated anchors, equal runs of a piece once; each bucket decides about
   the windows in them and answers in the same order.
3. Pieces apply the answers to their texts.

Rows per piece and bucket bound what a task holds: a run that a third of all texts share reaches its
bucket once per piece.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.words import PIECE_BYTES, pieces, text_bytes
from spanloom.operators.lineage import cut_lineage

PIECE_DDL = "piece long, size long, doc_ids binary, missing binary, offsets binary, data binary"
POST_DDL = "bucket int, piece long, codes binary"
SENT_DDL = "bucket int, piece long, payload binary"
BACK_DDL = "piece long, bucket int, answer binary"
NO_ID = np.iinfo(np.int64).max
BUCKET_BYTES = 24 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
# Bits of the code that stands for an anchor, and symbols that are hashed at a time, for the cache.
CODE_BITS = 40
BLOCK = 1 << 15
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Scheme:
    length: int
    gram: int
    # Symbols of a piece's bytes as 64-bit numbers, and the n + 1 bounds of its texts in symbols.
    symbols: Callable

    @property
    def grams(self) -> int:
        """Grams in a window, and the most windows that one place of an anchor can lead."""
        return self.length - self.gram + 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse."""
    both = np.full((2, n), _MUL, np.uint64)
    both[1] = _INVERSE
    both[:, :1] = 1
    np.cumprod(both, axis=1, out=both)
    return both[0], both[1]


_BLOCK_POWERS = _powers(BLOCK + 1)


def rolling(symbols: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all sequences of ``size`` symbols, by differences of running sums.

    Hashes do not depend on where a sequence stands, so they are found block by block.
    """
    found = np.zeros(max(len(symbols) - size + 1, 0), np.uint64)
    step = max(BLOCK - size + 1, BLOCK // 2)
    powers, inverse = _BLOCK_POWERS if step + size - 1 <= BLOCK else _powers(step + size)
    for at in range(0, len(found), step):
        own = symbols[at : at + step + size - 1]
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(own * powers[: len(own)], out=sums[1:])
        hashes = found[at : at + step]
        np.subtract(sums[size:], sums[: len(hashes)], out=hashes)
        hashes *= inverse[: len(hashes)]
    return found


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[: len(values) - step], values[step:])
        done += step
    return values


def _sliding_blocks(values: np.ndarray, width: int, pick) -> np.ndarray:
    """:func:`_sliding` block by block."""
    found = np.empty(len(values) - width + 1, values.dtype)
    for at in range(0, len(found), BLOCK):
        found[at : at + BLOCK] = _sliding(values[at : at + BLOCK + width - 1], width, pick)
    return found


class Windows:
    """The windows of a piece: starts, anchors, and the places that anchors were selected at."""

    def __init__(self, scheme: Scheme, symbols: np.ndarray, bounds: np.ndarray):
        self.scheme, self.symbols, self.bounds = scheme, symbols, bounds
        # Only hashes across a text's end can mislead; windows that cross one are left out.
        grams = rolling(symbols, scheme.gram)
        for at in range(0, len(grams), BLOCK):
            grams[at : at + BLOCK] = mix(grams[at : at + BLOCK])
        n = len(symbols) - scheme.length + 1
        if n <= 0:
            self.starts, self.anchors = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            self.texts = self.starts
            return
        least = _sliding_blocks(grams, scheme.grams, np.minimum)
        sizes = np.maximum(np.diff(bounds) - scheme.length + 1, 0)
        first = np.cumsum(sizes) - sizes
        self.starts = np.arange(sizes.sum()) + np.repeat(bounds[:-1] - first, sizes)
        self.texts = np.repeat(np.arange(len(sizes)), sizes)
        self.anchors = least[self.starts]
        self._grams = grams

    def selected(self) -> np.ndarray:
        """The grams at all places that some window selects."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        w = self.scheme.grams
        padded = np.zeros(len(self._grams) + w - 1, np.uint64)
        padded[self.starts + w - 1] = self.anchors
        greatest = _sliding_blocks(padded, w, np.maximum)
        return self._grams[greatest == self._grams]

    def runs(self, wanted: np.ndarray, coded: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 window numbers of the runs whose anchor, or its code, is in ``wanted``
        (sorted)."""
        if not len(self.starts) or not len(wanted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Neighbours mostly have one anchor, which is looked up once.
        head = np.flatnonzero(np.append(True, self.anchors[1:] != self.anchors[:-1]))
        anchors = code_of(self.anchors[head]) if coded else self.anchors[head]
        at = np.minimum(np.searchsorted(wanted, anchors), len(wanted) - 1)
        lengths = np.diff(np.append(head, len(self.anchors)))
        active = np.flatnonzero(np.repeat(wanted[at] == anchors, lengths))
        if not len(active):
            return active, active
        new = np.ones(len(active), bool)
        same = (np.diff(active) == 1) & (self.anchors[active[1:]] == self.anchors[active[:-1]])
        new[1:] = ~(same & (self.texts[active[1:]] == self.texts[active[:-1]]))
        # A run that one place cannot lead alone is cut, so that runs have bounded lengths.
        begin = np.flatnonzero(new)
        number = np.arange(len(active)) - np.repeat(begin, np.diff(np.append(begin, len(active))))
        new |= number % self.scheme.grams == 0
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(active))
        return active[begin], active[end - 1] + 1


def bucket_of(anchors: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchors >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def code_of(anchors: np.ndarray) -> np.ndarray:
    return (anchors * _MUL) >> np.uint64(64 - CODE_BITS)


def _least_code(bucket: int, buckets: int) -> int:
    """Buckets of codes are ranges, so that the codes of one lie close together."""
    return -(-(bucket << CODE_BITS) // buckets)


def _pack_codes(codes: np.ndarray, least: int, flags: np.ndarray | None = None) -> bytes:
    """Sorted distinct ``codes`` from ``least`` on, each with a flag if given: their gaps by byte."""
    gaps = np.diff(codes, prepend=np.uint64(least))
    if flags is not None:
        gaps = gaps << np.uint64(1) | flags
    width = 4 if int(gaps.max()) < 1 << 32 else 8
    planes = gaps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack_codes(held: bytes, least: int, flagged: bool = False):
    width, planes = held[0], zstandard.ZstdDecompressor().decompress(held[1:])
    bytes_of = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    gaps = np.ascontiguousarray(bytes_of).view(f"<u{width}").ravel().astype(np.uint64)
    if not flagged:
        return np.cumsum(gaps) + np.uint64(least)
    return np.cumsum(gaps >> np.uint64(1)) + np.uint64(least), (gaps & np.uint64(1)).astype(bool)


def pack_pieces(docs: DataFrame, most: int = PIECE_BYTES) -> DataFrame:
    """The documents as a written table of pieces; null texts count as empty."""

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for part in pieces(batches, most=most):
            data, offsets = text_bytes(part["text"])
            ids = part["doc_id"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().int >> 65], pa.int64()),
                    pa.array([len(data)], pa.int64()),
                    pa.array([ids.fill_null(NO_ID).to_numpy(zero_copy_only=False).tobytes()]),
                    pa.array([ids.is_null().to_numpy(zero_copy_only=False).tobytes()]),
                    pa.array([offsets.tobytes()]),
                    pa.array([squeeze.compress(data.tobytes())]),
                ],
                names=["piece", "size", "doc_ids", "missing", "offsets", "data"],
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return cut_lineage(chosen.mapInArrow(pack, PIECE_DDL))


@dataclass
class Piece:
    number: int
    doc_ids: np.ndarray
    missing: np.ndarray
    offsets: np.ndarray
    data: np.ndarray


def unpack_pieces(batches) -> Iterator[tuple[Piece, dict]]:
    """Pieces one by one, with the other columns of their rows."""
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch[name][i].as_py() for name in batch.schema.names}
            yield (
                Piece(
                    row["piece"],
                    np.frombuffer(row["doc_ids"], np.int64),
                    np.frombuffer(row["missing"], bool),
                    np.frombuffer(row["offsets"], np.int64),
                    np.frombuffer(expand.decompress(row["data"]), np.uint8),
                ),
                row,
            )


def _post(scheme: Scheme, buckets: int):
    def post(batches):
        for piece, _ in unpack_pieces(batches):
            windows = Windows(scheme, *scheme.symbols(piece.data, piece.offsets))
            codes, counts = np.unique(code_of(windows.selected()), return_counts=True)
            least = [_least_code(b, buckets) for b in range(buckets + 1)]
            cuts = np.searchsorted(codes, np.array(least, np.uint64))
            rows = [(b, s, e) for b, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s]
            packed = [_pack_codes(codes[s:e], least[b], counts[s:e] > 1) for b, s, e in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in rows], pa.int32()),
                    pa.array([piece.number] * len(rows), pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=["bucket", "piece", "codes"],
            )

    return post


def _repeated(buckets: int):
    def repeated(table: pa.Table) -> pa.Table:
        """Of one bucket: for each piece the codes that occur at two places or more."""
        least = _least_code(table["bucket"][0].as_py(), buckets)
        sent = [_unpack_codes(x, least, flagged=True) for x in table["codes"].to_pylist()]
        lists, own = zip(*sent)
        _, inverse, counts = np.unique(
            np.concatenate(lists), return_inverse=True, return_counts=True
        )
        again = counts > 1
        again[inverse[np.concatenate(own)]] = True
        flags = again[inverse]
        found, at = [], 0
        for codes in lists:
            wanted = codes[flags[at : at + len(codes)]]
            found.append(_pack_codes(wanted, least) if len(wanted) else b"")
            at += len(codes)
        answer = pa.table(
            {
                "piece": table["piece"],
                "bucket": table["bucket"],
                "answer": pa.array(found, pa.binary()),
            }
        )
        return answer.filter(pa.array([len(f) > 0 for f in found], pa.bool_()))

    return repeated


def with_answers(packed: DataFrame, answers: DataFrame) -> DataFrame:
    """Pieces with the list of their answers ``(bucket, answer)``; null where there is none."""
    gathered = answers.groupBy("piece").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias("answers")
    )
    return packed.join(gathered.hint("merge"), "piece", "left")


def wanted_codes(row: dict, buckets: int) -> np.ndarray:
    lists = [
        _unpack_codes(x["answer"], _least_code(x["bucket"], buckets)) for x in row["answers"] or []
    ]
    return np.sort(np.concatenate(lists)) if lists else np.zeros(0, np.uint64)


def repeated_anchors(
    packed: DataFrame, scheme: Scheme, bucket_bytes: int = BUCKET_BYTES
) -> tuple[DataFrame, int]:
    """Pieces with their repeated anchors, and a number of buckets that fits the input."""
    size = packed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(16, -(-size // bucket_bytes))
    posted = packed.mapInArrow(_post(scheme, buckets), POST_DDL)
    answers = posted.groupBy("bucket").applyInArrow(_repeated(buckets), BACK_DDL)
    return with_answers(packed, answers), buckets
