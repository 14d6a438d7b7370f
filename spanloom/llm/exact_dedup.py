"""Exact duplicates by a cuckoo-filter index of live digests.

Documents are reduced to SHA-256 digests of their texts. Digests are dealt to tasks by value; every
task keeps a cuckoo filter of the digests that are live in its share. A filter miss proves a digest
new. A hit is only a hint: it is verified against the digests stored in the bucket of the same
prefix. When an insertion finds no free slot, the filter is rebuilt with twice the buckets from the
stored keys, since fingerprints alone cannot be moved to a larger table.

The index is a table ``(digest, keep_id, group_size)`` and can be kept, extended and reduced:
``update_index`` inserts digests into it and deletes digests from it.
"""

from __future__ import annotations

from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.words import lean
from spanloom.operators.lineage import cut_lineage

SLOTS = 4
MAX_KICKS = 200
_MIX = 0x5BD1E995

INDEX_DDL = "digest binary, keep_id long, group_size long"
_STORED, _DELETED, _INSERTED = 0, 1, 2


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a fingerprint has two buckets, each from the other."""

    def __init__(self, buckets: int):
        self.mask = buckets - 1
        self.table = array("H", bytes(2 * SLOTS * buckets))

    def _place(self, digest: bytes) -> tuple[int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        return mark, int.from_bytes(digest[10:16], "little") & self.mask

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * _MIX)) & self.mask

    def _slot(self, bucket: int, mark: int) -> int:
        first = bucket * SLOTS
        for slot in range(first, first + SLOTS):
            if self.table[slot] == mark:
                return slot
        return -1

    def __contains__(self, digest: bytes) -> bool:
        mark, bucket = self._place(digest)
        return self._slot(bucket, mark) >= 0 or self._slot(self._other(bucket, mark), mark) >= 0

    def insert(self, digest: bytes) -> bool:
        """False when the table is too full; it must then be rebuilt, a fingerprint is homeless."""
        mark, bucket = self._place(digest)
        for at in (bucket, self._other(bucket, mark)):
            if (slot := self._slot(at, 0)) >= 0:
                self.table[slot] = mark
                return True
        for kick in range(MAX_KICKS):
            slot = bucket * SLOTS + (mark + kick) % SLOTS
            mark, self.table[slot] = self.table[slot], mark
            bucket = self._other(bucket, mark)
            if (slot := self._slot(bucket, 0)) >= 0:
                self.table[slot] = mark
                return True
        return False

    def delete(self, digest: bytes) -> None:
        """Only for digests that were inserted: equal fingerprints are interchangeable."""
        mark, bucket = self._place(digest)
        slot = self._slot(bucket, mark)
        if slot < 0:
            slot = self._slot(self._other(bucket, mark), mark)
        self.table[slot] = 0


class LiveDigests:
    """A cuckoo filter and the stored digests behind it, bucketed by their first two bytes."""

    def __init__(self, buckets: int = 256):
        self.filter = CuckooFilter(buckets)
        self.stored: dict[bytes, dict[bytes, list]] = {}
        self.resizes = 0

    def find(self, digest: bytes) -> list | None:
        if digest not in self.filter:
            return None
        return self.stored.get(digest[:2], {}).get(digest)

    def insert(self, digest: bytes, keep_id: int | None, size: int) -> None:
        if (entry := self.find(digest)) is not None:
            entry[1] += size
            if keep_id is not None and (entry[0] is None or keep_id > entry[0]):
                entry[0] = keep_id
            return
        self.stored.setdefault(digest[:2], {})[digest] = [keep_id, size]
        if not self.filter.insert(digest):
            self._resize()

    def delete(self, digest: bytes) -> None:
        if self.find(digest) is not None:
            self.filter.delete(digest)
            del self.stored[digest[:2]][digest]

    def _resize(self) -> None:
        buckets = 2 * (self.filter.mask + 1)
        while True:
            self.filter = CuckooFilter(buckets)
            self.resizes += 1
            if all(self.filter.insert(d) for share in self.stored.values() for d in share):
                return
            buckets *= 2

    def entries(self):
        for share in self.stored.values():
            for digest, (keep_id, size) in share.items():
                yield digest, keep_id, size


def _combine(batches):
    """One row per digest and batch, so that a hot text reaches its task once per batch."""
    for batch in batches:
        found = pa.table(batch).group_by("digest").aggregate([("doc_id", "max"), ([], "count_all")])
        named = found.select(["digest", "doc_id_max", "count_all"])
        yield from named.rename_columns(["digest", "keep_id", "group_size"]).to_batches()


def _apply(batches):
    live = LiveDigests()
    for batch in batches:
        for digest, keep_id, size, action in zip(*(batch[i].to_pylist() for i in range(4))):
            if action == _DELETED:
                live.delete(digest)
            else:
                live.insert(digest, keep_id, size)
    rows = list(live.entries())
    for at in range(0, len(rows), 50_000):
        columns = list(zip(*rows[at : at + 50_000]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), *(pa.array(c, pa.int64()) for c in columns[1:])],
            names=["digest", "keep_id", "group_size"],
        )


def text_digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest)`` of every row; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest")
    )


def update_index(
    inserted: DataFrame, index: DataFrame | None = None, deleted: DataFrame | None = None
) -> DataFrame:
    """The index after deleting the digests of ``deleted`` and inserting those of ``inserted``.

    ``inserted`` and ``deleted`` have columns ``doc_id`` and ``digest``. Deletion ends a digest with
    its whole group; deleting a digest that is not live changes nothing.
    """
    combined = inserted.select("digest", "doc_id").mapInArrow(lean(_combine), INDEX_DDL)
    rows = combined.withColumn("action", F.lit(_INSERTED))
    if index is not None:
        rows = rows.unionByName(index.withColumn("action", F.lit(_STORED)))
    if deleted is not None:
        gone = deleted.select("digest").distinct()
        rows = rows.unionByName(
            gone.withColumn("action", F.lit(_DELETED)), allowMissingColumns=True
        )
    dealt = rows.select("digest", "keep_id", "group_size", "action").repartition("digest")
    if index is not None or deleted is not None:
        dealt = dealt.sortWithinPartitions("action")
    return dealt.mapInArrow(lean(_apply), INDEX_DDL)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: which row of its equal texts stays, and how many there are.

    Of equal texts the largest ``doc_id`` stays; null ids lose to all others. Rows that share text
    and id are told apart by a number, and the first of them stays. An empty table gives an empty
    result. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
    """
    digests = cut_lineage(text_digests(docs))
    index = update_index(digests)
    ties = Window.partitionBy("digest", "doc_id").orderBy(F.lit(0))
    numbered = digests.withColumn("tie", F.row_number().over(ties))
    return numbered.join(index, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("tie") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
