"""Exact n-gram Jaccard self-join by partitioning the universe of tokens.

A document is its set of word shingles. Sets are grouped into size bands, such that partners of a
set lie in its own band or the next. In a band two linked sets differ in at most ``H`` tokens, so
when the universe is hashed into ``m > H`` segments, they agree in all of some segment (pigeonhole).
Each set therefore gives one signature per segment for its own band, and one per segment for the band
below, where it may be the larger partner.

Empty segments would make all sets that lack the same one meet. A set of ``n`` tokens differs from its
partners in at most ``H(n) <= H`` tokens, so that any ``H(n) + 1`` of its segments are enough. Bands
have a few segments more than ``H + 1``, and a set gives no signatures of its empty segments while
enough others are left; only the few sets with more empty segments keep them. A pair is found if either
set has enough, by a segment that is not empty, or else both keep all segments.

1. Equal sets become one set.
2. Signatures meet by value. Each set is first compared with one other only, its centre: the set that
   leads most of its signatures, where the one that shares most signatures leads. What links is
   joined into components. A group of thousands of near copies is settled by as many comparisons.
3. Pairs of different components that share a signature are left. Two sets with one centre are known
   by their differences from it: one of them, ``x``, did not link to the centre ``c``, so that
   ``|x ^ c| > r (|x| + |c|)`` with ``r = (100 - percent) / (100 + percent)``. If it links to ``y``,
   their differences share more than ``(|y ^ c| + r (|c| - |y|)) / 2`` tokens, and so one of any
   ``|y ^ c|`` less that many tokens of ``y``'s difference, for which tokens that the centre lacks
   are taken first. Only pairs that meet on such a token are compared. A set that differs from its
   centre more than twice as much as a linked one may is its own centre from here on, so that no list
   of differences is longer than that.
4. All other pairs that share a signature meet. Rows carry parity bits of their sets, whose distance
   is at most that of the sets, so that the join itself drops most pairs that share a passage only.
   Bits grow with the size of a band's sets, as sets far apart flip half of too few. Signatures with
   the same sets count once there. What is left is compared. Where a signature is shared by many sets, the
   allocation changes for the sets that have it: the costly segments are skipped, and as many of
   their cheapest other segments of two tokens or more are raised to one-deletion neighbourhoods, in
   which two sets must differ twice to escape. The sum of what the segments tolerate stays the same,
   so no link is lost. Sets with too few such segments keep their costly ones.

Comparisons are exact, on the sets made from the texts.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.components import component_labels
from spanloom.llm.words import find_words, lean, pieces, text_bytes, word_hashes
from spanloom.operators.lineage import cut_lineage

HOT_MEMBERS = 4096  # pairs of a signature are sifted in its join, so that this many are cheap
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = 40  # bits of a segment number
_CLASSES = 64  # of the sketch
_PARITY = ["parity0", "parity1", "parity2", "parity3"]  # 64 bits each, for signatures of many sets
PARITY_BITS = 4096  # at most, for others

SET_DDL = "doc_id long, n_shingles long, set_key binary, words binary, sketch array<int>, " + ", ".join(
    f"{c} long" for c in _PARITY
)
SIGNATURE_DDL = "key long, place long, set_key binary"
PARITY_DDL = "set_key binary, band long, parity array<long>"
CENTRE_DDL = "a binary, b binary, linked boolean, far boolean, difference array<long>, n_listed int"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _P1
    x = (x ^ (x >> np.uint64(29))) * _P2
    return x ^ (x >> np.uint64(32))


def _lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; texts are lower-cased in A-Z.

    A text with fewer words than a shingle has its whole sequence as the only one.
    """
    data = _lowered(data)
    starts, ends, first = find_words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    n = max(len(hashes) - size + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled = _mix(rolled + hashes[k : k + n])
    found = []
    for doc in range(len(offsets) - 1):
        begin, end = first[doc], first[doc + 1]
        if end - begin >= size:
            found.append(np.unique(rolled[begin : end - size + 1]))
        elif end > begin:
            whole = xxhash.xxh64_intdigest(hashes[begin:end].tobytes(), seed=int(end - begin))
            found.append(np.array([whole], np.uint64))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def _set_key(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """How many tokens fall into each class: sets differ in at least as many as their counts do."""
    return np.bincount((tokens % np.uint64(_CLASSES)).astype(np.int64), minlength=_CLASSES)


def _parities(tokens: np.ndarray, bits: int = 256) -> np.ndarray:
    """Of each of ``bits`` classes whether its tokens are odd in number: a token flips one bit."""
    classes = (tokens >> np.uint64(24) & np.uint64(bits - 1)).astype(np.int64)
    classes = np.bincount(classes, minlength=bits)
    return np.packbits((classes & 1).astype(np.uint8)).view(np.int64)


def most_differing(s: int, t: int, percent: int) -> int:
    """How many tokens linked sets of these sizes differ in at most.

    ``100 I >= percent (s + t - I)`` gives ``I``, and they differ in ``s + t - 2 I``.
    """
    common = -(-percent * (s + t) // (100 + percent))
    return s + t - 2 * common


def spare_segments(needed: int, size: int) -> int:
    """Segments for sets of ``size`` tokens, of which ``needed`` should hold some.

    The fewest that leave three deviations above the mean number of empty ones, up to a quarter more.
    """
    choices = range(needed, needed + needed // 4 + 1)

    def room(m: int) -> float:
        empty = m * (1 - 1 / m) ** size
        return m - needed - empty - 3 * empty**0.5

    enough = [m for m in choices if room(m) >= -0.5]
    return enough[0] if enough else max(choices, key=room)


@cache
def _bands(percent: int, largest: int) -> tuple[list[int], list[int]]:
    """Last sizes of the bands up to ``largest`` and the segments of each; sizes below can't link.

    A band ends where the largest partner of its first size does.
    """
    low = 1
    while most_differing(low, low * 100 // percent, percent) < 1:
        low += 1
    lasts, segments = [low - 1], [0]
    while lasts[-1] < largest:
        last = (lasts[-1] + 1) * 100 // percent
        partner = last * 100 // percent
        most = max(most_differing(last, t, percent) for t in range(last, partner + 1))
        lasts.append(last)
        segments.append(spare_segments(most + 1, last))
    return lasts, segments


def families(size: int, percent: int) -> list[tuple[int, int]]:
    """``(band, segments)`` of a set's own band and of the band below."""
    lasts, segments = _bands(percent, 1 << max(10, size.bit_length()))
    band = int(np.searchsorted(lasts, size))
    return [(b, segments[b]) for b in (band, band - 1) if b > 0]


@cache
def needed_segments(size: int, band: int, percent: int) -> int:
    """How many segments of a band make sure that a set shares one with every partner there."""
    lasts, segments = _bands(percent, 1 << max(10, size.bit_length()))
    largest = min(size * 100 // percent, lasts[band]) if size > lasts[band] else size * 100 // percent
    return min((100 - percent) * (size + largest) // (100 + percent) + 1, segments[band])


def parity_bits(band: int, percent: int) -> int:
    """Bits of a band's parities: a power of two, up to ``PARITY_BITS``.

    Thrice what linked sets of the band differ in, so that sets far apart flip more bits than that.
    """
    lasts, _ = _bands(percent, PARITY_BITS)
    largest = lasts[min(band, len(lasts) - 1)]
    wanted = 6 * largest * (100 - percent) // (100 + percent)
    return min(PARITY_BITS, max(64, 1 << wanted.bit_length()))


def segment_sums(tokens: np.ndarray, band: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Each token's segment, and the sum of the mixed tokens of each segment."""
    mixed = _mix(tokens + np.uint64(band))
    segment = (mixed >> np.uint64(20)) % np.uint64(m)
    sums = np.zeros(m, np.uint64)
    np.add.at(sums, segment.astype(np.int64), mixed)
    return segment.astype(np.int64), sums


def _keys(sums: np.ndarray, band: int, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = (np.int64(band) << _PLACE) | segment.astype(np.int64)
    return _mix(sums ^ _mix(place.astype(np.uint64))).view(np.int64), place


def given_segments(segment: np.ndarray, size: int, band: int, m: int, percent: int) -> np.ndarray:
    """The segments that a set signs: those with tokens, and all where these are too few."""
    filled = np.flatnonzero(np.bincount(segment, minlength=m))
    return filled if len(filled) >= needed_segments(size, band, percent) else np.arange(m)


def _binary(keys: list[bytes], counts=None) -> pa.Array:
    found = pa.array(keys, pa.binary())
    return found if counts is None else found.take(pa.array(np.repeat(np.arange(len(keys)), counts)))


def _describe(size: int):
    def describe(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for part in pieces(batches):
            data, offsets = text_bytes(part["text"])
            sets = shingle_sets(data, offsets, size)
            words = [
                squeeze.compress(data[start:end].tobytes())
                for start, end in zip(offsets[:-1], offsets[1:])
            ]
            parities = np.array([_parities(s) for s in sets], np.int64).reshape(-1, len(_PARITY))
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_key(s) for s in sets], pa.binary()),
                    pa.array(words, pa.binary()),
                    pa.array([_sketch(s) for s in sets], pa.list_(pa.int32())),
                    *(pa.array(column) for column in parities.T.copy()),
                ],
                names=["doc_id", "n_shingles", "set_key", "words", "sketch", *_PARITY],
            )

    return describe


def _sign(size: int, percent: int):
    def sign(batches):
        for part in pieces(batches):
            sets = {_set_key(s): s for s in shingle_sets(*text_bytes(part["text"]), size)}
            owners, counts, keys, places = [], [], [], []
            for set_key, tokens in sets.items():
                for band, m in families(len(tokens), percent):
                    segment, sums = segment_sums(tokens, band, m)
                    given = given_segments(segment, len(tokens), band, m, percent)
                    key, place = _keys(sums[given], band, given)
                    owners.append(set_key)
                    counts.append(len(given))
                    keys.append(key)
                    places.append(place)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys)),
                        pa.array(np.concatenate(places)),
                        _binary(owners, counts),
                    ],
                    names=["key", "place", "set_key"],
                )

    return sign


def _unpacked(blob: bytes, size: int) -> np.ndarray:
    text = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return shingle_sets(text, np.array([0, len(text)]), size)[0]


def _compared(batches, size: int):
    """Batches of ``a, b, a_words, b_words`` with the two sets of each row."""
    known, first = None, np.zeros(0, np.uint64)
    for batch in batches:
        sets = []
        for a, a_words, b_words in zip(*(batch[c].to_pylist() for c in ("a", "a_words", "b_words"))):
            if a != known:
                known, first = a, _unpacked(a_words, size)
            sets.append((first, _unpacked(b_words, size)))
        yield batch.select(["a", "b"]), sets


def _linked(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(first, second, assume_unique=True))
    return 100 * common >= percent * (len(first) + len(second) - common)


def _compare(size: int, percent: int):
    def compare(batches):
        for pairs, sets in _compared(batches, size):
            yield pairs.filter(pa.array([_linked(x, y, percent) for x, y in sets], pa.bool_()))

    return compare


def _compare_centre(size: int, percent: int):
    """Whether ``b`` links to its centre ``a``; its difference, of which the first are listed."""

    def compare(batches):
        for pairs, sets in _compared(batches, size):
            linked, far, differences, listed = [], [], [], []
            for centre, own in sets:
                added = np.setdiff1d(own, centre, assume_unique=True)
                gone = np.setdiff1d(centre, own, assume_unique=True)
                linked.append(_linked(centre, own, percent))
                n = len(added) + len(gone)
                far.append(n * (100 + percent) > 2 * (100 - percent) * (len(own) + len(centre)))
                if far[-1]:
                    listed.append(0)
                    differences.append(gone[:0].view(np.int64))
                    continue
                # floor((n + r (|c| - |y|)) / 2), and more tokens than that are shared
                slack = n * (100 + percent) + (100 - percent) * (len(centre) - len(own))
                listed.append(n - slack // (2 * (100 + percent)))
                differences.append(np.concatenate([added, gone]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *pairs.columns,
                    pa.array(linked, pa.bool_()),
                    pa.array(far, pa.bool_()),
                    pa.array(differences, pa.list_(pa.int64())),
                    pa.array(listed, pa.int32()),
                ],
                names=["a", "b", "linked", "far", "difference", "n_listed"],
            )

    return compare


def _with_words(pairs: DataFrame, blobs: DataFrame) -> DataFrame:
    second = blobs.select(F.col("set_key").alias("b"), F.col("words").alias("b_words"))
    first = blobs.select(F.col("set_key").alias("a"), F.col("words").alias("a_words"))
    both = pairs.select("a", "b").join(second, "b").join(first, "a")
    return both.select("a", "b", "a_words", "b_words")


def _plausible(pairs: DataFrame, blobs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches do not already differ more than linked sets can.

    Linked sets differ in at most ``(100 - percent) / (100 + percent)`` of the sum of their sizes.
    """
    first = blobs.select(F.col("set_key").alias("a"), F.col("sketch").alias("a_sketch"))
    second = blobs.select(F.col("set_key").alias("b"), F.col("sketch").alias("b_sketch"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda n, x: n + x)
    apart = total(F.zip_with("a_sketch", "b_sketch", lambda x, y: F.abs(x - y)))
    sizes = total(F.col("a_sketch")) + total(F.col("b_sketch"))
    near = apart * (100 + percent) <= sizes * (100 - percent)
    return pairs.join(second, "b").join(first, "a").filter(near).select("a", "b")


def verify(pairs: DataFrame, blobs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of set keys that are linked."""
    likely = cut_lineage(_plausible(pairs, blobs, percent))
    compared = _with_words(likely, blobs).mapInArrow(lean(_compare(size, percent)), "a binary, b binary")
    return cut_lineage(compared)


def _centre_pairs(centred: DataFrame) -> DataFrame:
    """Pairs of sets with one centre, one of which does not link to it, that meet on a token."""
    near = centred.filter(~F.col("far"))
    loose = near.filter(~F.col("linked"))
    concerned = near.join(loose.select("a").distinct(), "a", "left_semi")
    probes = loose.select("a", F.col("b").alias("x"), F.explode("difference").alias("token"))
    listed = concerned.select(
        "a", F.col("b").alias("y"), F.explode(F.slice("difference", 1, "n_listed")).alias("token")
    )
    met = probes.join(listed, ["a", "token"]).filter(F.col("x") != F.col("y"))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _delete_one(size: int, percent: int):
    def delete_one(batches):
        for batch in batches:
            for set_key, blob in zip(batch["set_key"].to_pylist(), batch["words"].to_pylist()):
                tokens = _unpacked(blob, size)
                for band, m in families(len(tokens), percent):
                    segment, sums = segment_sums(tokens, band, m)
                    held = np.bincount(segment, minlength=m)
                    filled = np.flatnonzero(held)
                    # No probe has an empty side: only segments of two tokens or more are raised.
                    several = held[segment] > 1
                    less = (sums[segment] - _mix(tokens + np.uint64(band)))[several]
                    full_key, full_place = _keys(sums[filled], band, filled)
                    less_key, less_place = _keys(less, band, segment[several])
                    n = len(full_key) + len(less_key)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([full_key, less_key])),
                            pa.array(np.concatenate([full_place, less_place])),
                            pa.array(np.arange(n) >= len(full_key)),
                            pa.array(np.concatenate([held[filled], held[segment[several]]]) > 1),
                            _binary([set_key], [n]),
                        ],
                        names=["key", "place", "deleted", "several", "set_key"],
                    )

    return delete_one


def _band_parities(size: int, percent: int):
    """The parity bits of a set for its own band and for the band below."""

    def parities(batches):
        for batch in batches:
            keys, bands, found = [], [], []
            for set_key, blob in zip(batch["set_key"].to_pylist(), batch["words"].to_pylist()):
                tokens = _unpacked(blob, size)
                for band, _ in families(len(tokens), percent):
                    keys.append(set_key)
                    bands.append(band)
                    found.append(_parities(tokens, parity_bits(band, percent)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()),
                    pa.array(bands, pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["set_key", "band", "parity"],
            )

    return parities


def _cross(left: DataFrame, right: DataFrame, percent: int, ordered: bool = False) -> DataFrame:
    """Pairs of sets that share a key, with different labels and centres and parities not too far.

    Linked sets differ in at most ``(100 - percent) / (100 + percent)`` of the sum of their sizes.
    ``ordered``: both sides have the same rows, so that one order of a pair is enough.
    """
    carried = ("label", "centre", "n_tokens", "parity")

    def sides(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(
            "key", F.col("set_key").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in carried)
        )

    a, b = sides(left, "x"), sides(right, "y")
    apart = (F.col("x_label") != F.col("y_label")) & (F.col("x_centre") != F.col("y_centre"))
    if ordered:
        apart = (F.col("x") < F.col("y")) & apart
    bits = F.zip_with("x_parity", "y_parity", lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    flipped = F.aggregate(bits, F.lit(0), lambda n, p: n + p)
    sizes = F.col("x_n_tokens") + F.col("y_n_tokens")
    likely = flipped * (100 + percent) <= sizes * (100 - percent)
    met = a.join(b, (a["key"] == b["key"]) & apart & likely)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _hot_pairs(rest: DataFrame, blobs: DataFrame, size: int, percent: int, hot: int) -> DataFrame:
    """Pairs that only shared signatures of many sets would show, by the changed allocation.

    ``rest`` has ``key, place, set_key, label, centre, members`` of shared signatures.
    """
    band = F.shiftright("place", _PLACE)
    rows = rest.withColumn("band", band).withColumn("is_hot", F.col("members") > hot)
    counted = cut_lineage(
        rows.filter("is_hot").groupBy("set_key", "band").agg(F.count("*").alias("n_hot"))
    )
    listed = cut_lineage(
        blobs.join(counted.select("set_key").distinct(), "set_key").mapInArrow(
            lean(_delete_one(size, percent)),
            "key long, place long, deleted boolean, several boolean, set_key binary",
        )
    )
    costs = rows.select("set_key", "place", "members", "is_hot")
    cheapest = Window.partitionBy("set_key", "band").orderBy(
        F.coalesce("members", F.lit(1)), "place"
    )
    ranked = cut_lineage(
        listed.filter("several and not deleted")
        .withColumn("band", band)
        .join(counted, ["set_key", "band"])
        .join(costs, ["set_key", "place"], "left")
        .filter(~F.coalesce("is_hot", F.lit(False)))
        .withColumn("rank", F.row_number().over(cheapest))
        .select("set_key", "band", "place", "n_hot", "rank")
    )
    # A set is forced where fewer segments can be raised than it has hot ones.
    able = ranked.filter("rank = n_hot").select("set_key", "band")
    forced_sets = counted.join(able, ["set_key", "band"], "left_anti").select("set_key", "band")
    narrow = blobs.select("set_key", F.array(*_PARITY).alias("parity"))
    hot_rows = rows.filter("is_hot").join(narrow, "set_key")
    forced = _cross(hot_rows.join(forced_sets, ["set_key", "band"]), hot_rows, percent)
    raised = (
        ranked.join(able, ["set_key", "band"])
        .filter(F.col("rank") <= F.col("n_hot"))
        .select("set_key", "place")
    )
    labels = rows.select("set_key", "label", "centre", "n_tokens").distinct().join(narrow, "set_key")
    probes = listed.join(raised, ["set_key", "place"]).join(labels, "set_key")
    held = listed.join(labels, "set_key")
    near = _cross(probes.filter("deleted"), held.filter(~F.col("deleted")), percent).union(
        _cross(probes.filter(~F.col("deleted")), held.filter("deleted"), percent)
    )
    return forced.union(near)


def describe_sets(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id``, the size and key of each document's set, and its compressed words; written."""
    return cut_lineage(docs.select("doc_id", "text").mapInArrow(lean(_describe(size)), SET_DDL))


def set_links(
    docs: DataFrame,
    described: DataFrame,
    size: int = 3,
    percent: int = 90,
    hot_members: int = HOT_MEMBERS,
) -> DataFrame:
    """Verified links ``(a, b)`` between keys of different sets.

    They connect all sets that the threshold connects; a pair whose members other links already
    connect may be missing.
    """
    signed = docs.select("text").mapInArrow(lean(_sign(size, percent)), SIGNATURE_DDL)
    group = Window.partitionBy("key", "place")
    # Equal sets of different batches give equal rows; they count once.
    shared = cut_lineage(
        signed.withColumn("least", F.min("set_key").over(group))
        .withColumn("most", F.max("set_key").over(group))
        .filter(F.col("least") != F.col("most"))
        .select("key", "place", "set_key")
        .distinct()
    )
    needed = cut_lineage(shared.groupBy("set_key").agg(F.count("*").alias("n_shared")))
    # The wanted keys grow with the input, so both sides are shuffled at any size.
    blobs = cut_lineage(
        described.select("set_key", "words", "sketch", "n_shingles", *_PARITY)
        .join(needed.hint("merge"), "set_key", "left_semi")
        .groupBy("set_key")
        .agg(
            F.first("n_shingles").alias("n_tokens"),
            *(F.first(c).alias(c) for c in ("words", "sketch", *_PARITY)),
        )
    )
    leading = F.max_by("set_key", F.struct("n_shared", "set_key")).over(group)
    led = shared.join(needed, "set_key").withColumn("centre", leading)
    centres = cut_lineage(
        led.groupBy("set_key", "centre")
        .agg(F.count("*").alias("n"))
        .groupBy("set_key")
        .agg(F.max_by("centre", F.struct("n", "centre")).alias("centre"))
    )
    tried = centres.filter(F.col("centre") != F.col("set_key")).select(
        F.col("centre").alias("a"), F.col("set_key").alias("b")
    )
    centred = cut_lineage(
        _with_words(tried, blobs).mapInArrow(lean(_compare_centre(size, percent)), CENTRE_DDL)
    )
    links = centred.filter("linked").select("a", "b")

    labels = component_labels(links).withColumnRenamed("node", "set_key")
    far = centred.filter("far").select(F.col("b").alias("set_key"), F.lit(True).alias("far"))
    placed = cut_lineage(
        centres.join(far, "set_key", "left")
        .withColumn("centre", F.when(F.col("far"), F.col("set_key")).otherwise(F.col("centre")))
        .drop("far")
        .join(blobs.select("set_key", "n_tokens"), "set_key")
    )
    labelled = shared.join(placed, "set_key").join(labels, "set_key", "left").withColumn(
        "label", F.coalesce("label", "set_key")
    )
    rest = cut_lineage(
        labelled.withColumn("least", F.min(F.struct("label", "centre")).over(group))
        .withColumn("most", F.max(F.struct("label", "centre")).over(group))
        .withColumn("members", F.count(F.lit(1)).over(group))
        .withColumn("all1", F.bit_xor(F.xxhash64("set_key")).over(group))
        .withColumn("all2", F.bit_xor(F.xxhash64(F.lit(1), "set_key")).over(group))
        .filter(F.col("least.label") != F.col("most.label"))
        .drop("least", "most")
    )
    cold = rest.filter(F.col("members") <= hot_members)
    # Made from the words of these sets only, and carried no further than through their join.
    parities = cut_lineage(
        blobs.join(cold.select("set_key").distinct().hint("merge"), "set_key", "left_semi")
        .select("set_key", "words")
        .mapInArrow(lean(_band_parities(size, percent)), PARITY_DDL)
    )
    # All sets of signatures with the same sets choose the same one of them.
    cold = (
        cold.withColumn("band", F.shiftright("place", _PLACE))
        .repartition("set_key", "band")
        .groupBy("set_key", "band", "members", "all1", "all2")
        .agg(F.min("key").alias("key"), *(F.first(c).alias(c) for c in ("label", "centre", "n_tokens")))
        .join(parities, ["set_key", "band"])
    )
    pairs = _cross(cold, cold, percent, ordered=True)
    if not rest.filter(F.col("members") > hot_members).isEmpty():
        pairs = pairs.union(_hot_pairs(rest, blobs, size, percent, hot_members))
    apart = pairs.union(_centre_pairs(centred)).distinct()
    known = centred.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    open_pairs = cut_lineage(apart.join(known, ["a", "b"], "left_anti"))
    return links.union(verify(open_pairs, blobs, size, percent))


def jaccard_components(
    docs: DataFrame, size: int = 3, percent: int = 90, hot_members: int = HOT_MEMBERS
) -> DataFrame:
    """One row per document: the size of its shingle set and the least id of its component.

    Documents link when ``100 |A & B| >= percent |A | B|``. Without words (null, empty or blank
    texts) a document has an empty set and is its own component. Null ids are never the least unless
    a component has no other. Rows that share an id are told apart by their sets; an empty table
    gives an empty result.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    described = describe_sets(chosen, size)
    labels = component_labels(set_links(chosen, described, size, percent, hot_members))
    described = described.select("doc_id", "n_shingles", "set_key")
    named = described.filter(F.col("n_shingles") > 0).join(
        labels, F.col("set_key") == F.col("node"), "left"
    )
    labelled = cut_lineage(
        named.select("doc_id", "n_shingles", F.coalesce("label", "set_key").alias("label"))
    )
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    alone = described.filter(F.col("n_shingles") == 0).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return (
        labelled.join(least, "label").select("doc_id", "n_shingles", "component_id").union(alone)
    )
