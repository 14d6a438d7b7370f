"""Substring dedup on words: seed and extend.

Seeds are winnowed anchors of ``GRAM`` words that occur at two places or more (see ``anchors``). Each
place of a seed is extended to both sides, one word after the other, as far as windows of ``length``
words with this seed reach; an extension is a match when the seed and a second hash over the whole
window occur elsewhere, together 128 bits. Overlapping matches of a text join into its maximal
repeats, and the words in them are removed.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spanloom.llm.anchors import (
    BACK_DDL,
    SENT_DDL,
    Scheme,
    Windows,
    bucket_of,
    mix,
    pack_pieces,
    repeated_anchors,
    rolling,
    unpack_pieces,
    wanted_codes,
    with_answers,
)
from spanloom.llm.words import find_words, word_hashes
from spanloom.operators.lineage import cut_lineage

LENGTH, GRAM = 35, 12
KEPT_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _word_symbols(data: np.ndarray, offsets: np.ndarray):
    starts, ends, first = find_words(data, offsets)
    return word_hashes(data, starts, ends), first


def word_scheme(length: int = LENGTH) -> Scheme:
    return Scheme(length, min(GRAM, max(1, length // 2)), _word_symbols)


class _Runs:
    """The distinct runs of a piece, ordered by bucket, and the runs of its windows."""

    def __init__(self, windows: Windows, wanted: np.ndarray, buckets: int):
        self.begin, self.end = windows.runs(wanted, coded=True)
        whole = mix(rolling(windows.symbols, windows.scheme.length))
        self.hashes = whole[windows.starts] if len(whole) else whole
        sizes = self.end - self.begin
        # A run is known by its anchor and the sum over its mixed window hashes and their places.
        places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        each = self.hashes[np.repeat(self.begin, sizes) + places]
        each = mix(each + places.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        at = (np.cumsum(sizes) - sizes)[: len(sizes)]
        total = np.add.reduceat(each, at) if len(sizes) else each
        anchors = windows.anchors[self.begin] if len(sizes) else total
        keys = np.stack([bucket_of(anchors, buckets).astype(np.uint64), anchors, total], axis=1)
        _, self.chosen, self.of, self.counts = np.unique(
            keys, axis=0, return_index=True, return_inverse=True, return_counts=True
        )
        self.bucket = bucket_of(anchors[self.chosen], buckets)
        self.anchors, self.sizes = anchors[self.chosen], sizes[self.chosen]

    def window_hashes(self) -> np.ndarray:
        """Of the chosen runs, one after the other."""
        sizes = self.sizes
        places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.hashes[np.repeat(self.begin[self.chosen], sizes) + places]


def _send(scheme: Scheme, buckets: int):
    def send(batches):
        for piece, row in unpack_pieces(batches):
            wanted = wanted_codes(row, buckets)
            if not len(wanted):
                continue
            windows = Windows(scheme, *scheme.symbols(piece.data, piece.offsets))
            runs = _Runs(windows, wanted, buckets)
            hashes = runs.window_hashes()
            through = np.append(0, np.cumsum(runs.sizes))
            names, payloads = [], []
            cuts = np.searchsorted(runs.bucket, np.arange(buckets + 1))
            for bucket, (s, e) in enumerate(zip(cuts, cuts[1:])):
                if e > s:
                    names.append(bucket)
                    payloads.append(
                        np.int64(e - s).tobytes()
                        + runs.anchors[s:e].tobytes()
                        + runs.sizes[s:e].astype(np.uint16).tobytes()
                        + (runs.counts[s:e] > 1).tobytes()
                        + hashes[through[s] : through[e]].tobytes()
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int32()),
                    pa.array([piece.number] * len(names), pa.int64()),
                    pa.array(payloads, pa.binary()),
                ],
                names=["bucket", "piece", "payload"],
            )

    return send


def _match(table: pa.Table) -> pa.Table:
    """Of one bucket: for each sent window whether it occurs at two places or more."""
    anchors, hashes, repeated, sizes = [], [], [], []
    for payload in table["payload"].to_pylist():
        n = int(np.frombuffer(payload, np.int64, 1)[0])
        seeds = np.frombuffer(payload, np.uint64, n, 8)
        counts = np.frombuffer(payload, np.uint16, n, 8 + 8 * n)
        again = np.frombuffer(payload, bool, n, 8 + 10 * n)
        anchors.append(np.repeat(seeds, counts))
        repeated.append(np.repeat(again, counts))
        hashes.append(np.frombuffer(payload, np.uint64, -1, 8 + 11 * n))
        sizes.append(len(hashes[-1]))
    seeds, windows, found = map(np.concatenate, (anchors, hashes, repeated))
    order = np.lexsort((seeds, windows))
    same = (windows[order[1:]] == windows[order[:-1]]) & (seeds[order[1:]] == seeds[order[:-1]])
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    cuts = np.append(0, np.cumsum(sizes))
    answers = [np.packbits(found[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
    return pa.table(
        {
            "piece": table["piece"],
            "bucket": table["bucket"],
            "answer": pa.array(answers, pa.binary()),
        }
    )


def _remove(scheme: Scheme, buckets: int):
    def remove(batches):
        for piece, row in unpack_pieces(batches):
            starts, ends, first = find_words(piece.data, piece.offsets)
            covered = np.zeros(len(starts) + 1, np.int64)
            if row["found"]:
                symbols = word_hashes(piece.data, starts, ends)
                windows = Windows(scheme, symbols, first)
                runs = _Runs(windows, wanted_codes(row, buckets), buckets)
                through = np.append(0, np.cumsum(runs.sizes))
                cuts = through[np.searchsorted(runs.bucket, np.arange(buckets + 1))]
                hit = np.zeros(through[-1], bool)
                for x in row["found"]:
                    a, b = cuts[x["bucket"]], cuts[x["bucket"] + 1]
                    bits = np.unpackbits(np.frombuffer(x["answer"], np.uint8), count=b - a)
                    hit[a:b] = bits
                sizes = runs.end - runs.begin
                places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                own = hit[np.repeat(through[runs.of.ravel()], sizes) + places]
                matched = windows.starts[(np.repeat(runs.begin, sizes) + places)[own]]
                np.add.at(covered, matched, 1)
                np.add.at(covered, matched + scheme.length, -1)
            gone = np.cumsum(covered)[:-1] > 0
            rows = []
            for doc, doc_id in enumerate(piece.doc_ids.tolist()):
                a, b = first[doc], first[doc + 1]
                removed = int(gone[a:b].sum())
                left = np.flatnonzero(~gone[a:b]) + a
                kept = b" ".join(
                    piece.data[s:e].tobytes() for s, e in zip(starts[left], ends[left])
                )
                owner = None if piece.missing[doc] else doc_id
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((owner, int(b - a), removed, digest, kept.decode()))
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: its words, how many were removed, and the text of those kept.

    A word is removed when a window of ``length`` words that covers it also starts anywhere else,
    in the same document included. Null texts have no words. Repeated rows are documents of their
    own and so repeat each other; an empty table gives an empty result.
    """
    scheme = word_scheme(length)
    packed = pack_pieces(docs)
    seeded, buckets = repeated_anchors(packed, scheme)
    seeded = cut_lineage(seeded.select("piece", "answers")).join(packed, "piece")
    sent = seeded.mapInArrow(_send(scheme, buckets), SENT_DDL)
    found = sent.groupBy("bucket").applyInArrow(_match, BACK_DDL)
    answered = with_answers(seeded.withColumnRenamed("answers", "seeds"), found)
    renamed = answered.withColumnRenamed("answers", "found").withColumnRenamed("seeds", "answers")
    return renamed.mapInArrow(_remove(scheme, buckets), KEPT_DDL)
