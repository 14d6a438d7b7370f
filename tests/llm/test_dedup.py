"""Exact, substring, byte and n-gram dedup next to brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

from spanloom.llm.exact_dedup import (
    CuckooFilter,
    LiveDigests,
    exact_dedup,
    text_digests,
    update_index,
)
from spanloom.llm.jaccard_join import families, jaccard_components, most_differing
from spanloom.llm.substring_dedup import remove_repeats
from spanloom.llm.suffix_dedup import least_ids, remove_byte_repeats
from tests.llm.data import documents, sort_key, table

WORD = re.compile("[^ \t-\r]+")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=sort_key)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_exact(spark):
    rows = documents()
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    want, seen = [], Counter()
    for doc_id, text, *_ in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = max(ids) if ids else None
        seen[text or "", doc_id] += 1
        kept = doc_id == keep and seen[text or "", doc_id] == 1
        want.append((doc_id, keep, len(groups[text or ""]), kept, sha((text or "").encode())))
    got = rows_of(exact_dedup(table(spark)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(want, key=sort_key)
    assert exact_dedup(table(spark, [])).count() == 0


def test_cuckoo_filter_resizes_and_deletes():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    live = LiveDigests(buckets=64)
    for i, d in enumerate(digests):
        live.insert(d, i, 1)
    assert live.resizes > 0 and all(live.find(d) == [i, 1] for i, d in enumerate(digests))
    for d in digests[::2]:
        live.delete(d)
    assert [live.find(d) is not None for d in digests] == [i % 2 == 1 for i in range(5000)]
    assert len(list(live.entries())) == 2500
    table = CuckooFilter(1)
    assert not all(table.insert(d) for d in digests[:9])


def test_index_lives_on(spark):
    first, second = table(spark).filter("doc_id < 20"), table(spark).filter("doc_id >= 20")
    index = update_index(text_digests(first))
    index = update_index(text_digests(second), index, text_digests(first.filter("doc_id < 5")))
    texts = {r[1] or "" for r in documents() if r[0] is not None}
    gone = {r[1] or "" for r in documents() if r[0] is not None and r[0] < 5}
    back = {r[1] or "" for r in documents() if r[0] is not None and r[0] >= 20}
    left = {r["digest"] for r in index.collect()}
    assert left == {hashlib.sha256(t.encode()).digest() for t in (texts - gone) | back}


@pytest.mark.parametrize("length", [35, 3])
def test_substring(spark, length):
    rows = documents()
    words = [WORD.findall(r[1] or "") for r in rows]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    want = []
    for row, w in zip(rows, words):
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone |= set(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((row[0], len(w), len(gone), sha(kept.encode()), kept))
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")
    got = rows_of(remove_repeats(table(spark), length), *columns)
    assert got == sorted(want, key=sort_key)
    assert remove_repeats(table(spark, [])).count() == 0


def brute_bytes(rows, length):
    first = {}
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        own = float("inf") if doc_id is None else doc_id
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            first[key] = min(first.get(key, float("inf")), own)
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        own = float("inf") if doc_id is None else doc_id
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < own:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        yield doc_id, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)


def test_bytes(spark):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = rows_of(remove_byte_repeats(table(spark)), *columns)
    assert got == sorted(brute_bytes(documents(), 50), key=sort_key)
    assert remove_byte_repeats(table(spark, [])).count() == 0


@pytest.mark.parametrize("length", [1, 6, 7, 20])
@pytest.mark.parametrize("shard_bytes", [1 << 20, 64])
def test_merged_transforms(monkeypatch, length, shard_bytes):
    import numpy as np

    from spanloom.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
    rng = random.Random(5)
    for _ in range(15):
        strings = [bytes(rng.choices(b"ab\xf4", k=rng.randrange(length, 40))) for _ in range(20)]
        strings = list({*strings, *(s[3:] + strings[0] for s in strings)})
        ids = np.array([rng.randrange(100) for _ in strings])
        found = least_ids(strings, ids, length)
        for s, values in zip(strings, found):
            for i, value in enumerate(values):
                assert value == min(d for t, d in zip(strings, ids) if s[i : i + length] in t)


def test_runs_look_up_an_anchor_once(monkeypatch):
    import numpy as np

    from spanloom.llm import anchors
    from spanloom.llm.suffix_dedup import byte_scheme

    rng = random.Random(3)
    data = np.frombuffer(bytes(rng.choices(b"abcd", k=4000)), np.uint8)
    scheme = byte_scheme()
    windows = anchors.Windows(scheme, *scheme.symbols(data, np.array([0, 1500, 1520, 4000])))
    wanted = np.unique(windows.anchors)[::2]
    looked_up, search = [], np.searchsorted

    def counting(sorted_values, values, *rest, **more):
        looked_up.append(len(values))
        return search(sorted_values, values, *rest, **more)

    monkeypatch.setattr(anchors.np, "searchsorted", counting)
    begin, end = windows.runs(wanted)
    assert sum(looked_up) < len(windows.anchors) / 4
    covered = [i for a, b in zip(begin, end) for i in range(a, b)]
    assert covered == [i for i, x in enumerate(windows.anchors.tolist()) if x in set(wanted.tolist())]
    for a, b in zip(begin, end):
        assert len({*windows.anchors[a:b].tolist()}) == 1 and len({*windows.texts[a:b].tolist()}) == 1


def brute_components(rows, percent=90, size=3):
    sets = []
    for r in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")
        w = WORD.findall(text)
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
        sets.append(windows or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    for i, r in enumerate(rows):
        ids = [q[0] for q, g in zip(rows, group) if g == group[i] and q[0] is not None]
        yield r[0], len(sets[i]), min(ids) if ids else None


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("hot_members", [256, 1])
def test_jaccard(spark, hot_members, size, percent):
    rng = random.Random(9)
    rows = documents()
    template = ["t%d" % i for i in range(80)]
    for i in range(100, 125):  # a shared template, of which single copies link
        words = template + ["own%d" % rng.randrange(10**6) for _ in range(6 + i % 7)]
        rows.append((i, " ".join(words), "en", "src0", None, None))
    got = rows_of(
        jaccard_components(table(spark, rows), size, percent, hot_members),
        "doc_id", "n_shingles", "component_id",
    )
    assert got == sorted(brute_components(rows, percent, size), key=sort_key)


def near_the_threshold(rng, percent, first, last):
    """Two sets of random tokens that differ as much as linked ones may."""
    import numpy as np

    n = rng.randrange(first, last)
    t = rng.randrange(n, n * 100 // percent + 1)
    most = most_differing(n, t, percent)
    gone = (most - (t - n)) // 2
    tokens = [rng.getrandbits(64) for _ in range(n + (t - n) + gone)]
    pair = tokens[:n], tokens[gone:]
    return [np.unique(np.array(x, np.uint64)) for x in pair]


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_given_segment(percent):
    """Segments without tokens are left out, and linked sets still meet."""
    from spanloom.llm.jaccard_join import given_segments, segment_sums

    rng, left_out, kept = random.Random(2), 0, 0
    for _ in range(3000):
        found = []
        for tokens in near_the_threshold(rng, percent, 10, 300):
            keys = set()
            for band, m in families(len(tokens), percent):
                segment, sums = segment_sums(tokens, band, m)
                given = given_segments(segment, len(tokens), band, m, percent)
                empty = m - len(set(segment.tolist()))
                left_out += len(given) < m
                kept += empty > 0 and len(given) == m
                keys |= {(band, int(i), int(sums[i])) for i in given}
            found.append(keys)
        assert found[0] & found[1]
    assert percent == 90 or (left_out > 5000 and kept < 200)


@pytest.mark.parametrize("percent", [80, 90])
def test_parities_part_only_sets_that_differ(percent):
    from spanloom.llm.jaccard_join import _parities, parity_bits

    rng = random.Random(4)
    for _ in range(300):
        x, y = near_the_threshold(rng, percent, 10, 6000)
        band = min(families(len(t), percent)[0][0] for t in (x, y))
        px, py = (_parities(t, parity_bits(band, percent)) for t in (x, y))
        flipped = sum(int(v & (2**64 - 1)).bit_count() for v in (px ^ py).tolist())
        assert flipped * (100 + percent) <= (len(x) + len(y)) * (100 - percent)


def test_sets_that_share_a_passage_do_not_become_pairs(spark, monkeypatch):
    from spanloom.llm import jaccard_join

    rng, opened, verify = random.Random(6), [], jaccard_join.verify

    def counting(pairs, *rest):
        opened.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "verify", counting)
    passage = ["p%d" % rng.randrange(10**6) for _ in range(1100)]
    rows = []
    for i in range(10):
        own = ["w%d" % rng.randrange(10**6) for _ in range(500)]
        rows.append((i, " ".join(passage + own), "en", "src0", None, None))
    got = jaccard_components(table(spark, rows), 5, 80).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got)) == [(i, i) for i in range(10)]
    assert opened == [0]


def test_candidates_grow_with_the_input():
    """Unrelated sets do not meet on empty segments: pairs by them are few for their number."""
    import numpy as np

    from spanloom.llm.jaccard_join import given_segments, segment_sums

    rng = np.random.default_rng(3)
    seen = Counter()
    for size in rng.integers(60, 400, 2000).tolist():
        tokens = rng.integers(0, 2**63, size).astype(np.uint64)
        for band, m in families(size, 80):
            segment, sums = segment_sums(tokens, band, m)
            given = given_segments(segment, size, band, m, 80)
            seen.update((band, int(i), int(sums[i])) for i in given)
    assert sum(n * (n - 1) // 2 for n in seen.values()) < 2000


def test_jaccard_empty(spark):
    assert jaccard_components(table(spark, [])).count() == 0


def test_bands_cover_all_partners():
    for s in range(1, 400):
        for t in range(s, s * 100 // 90 + 1):
            most = most_differing(s, t, 90)
            if most >= 1 and 100 * s >= 90 * t:
                mine, other = dict(families(s, 90)), dict(families(t, 90))
                assert any(mine[b] > most for b in mine.keys() & other.keys()), (s, t)


def test_codes_of_anchors_take_few_bytes():
    import numpy as np

    from spanloom.llm import anchors

    buckets, rng = 7, np.random.default_rng(5)
    codes = np.unique(anchors.code_of(rng.integers(0, 2**59, 50_000).astype(np.uint64)))
    again = rng.random(len(codes)) < 0.3
    bounds = np.array([anchors._least_code(b, buckets) for b in range(buckets + 1)], np.uint64)
    assert codes.max() < bounds[-1] == 1 << anchors.CODE_BITS
    cuts = np.searchsorted(codes, bounds)
    assert np.diff(cuts).min() > len(codes) / buckets / 2
    total = 0
    for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
        least = anchors._least_code(bucket, buckets)
        held = anchors._pack_codes(codes[a:b], least, again[a:b])
        total += len(held)
        got, flags = anchors._unpack_codes(held, least, flagged=True)
        assert (got == codes[a:b]).all() and (flags == again[a:b]).all()
        assert (anchors._unpack_codes(anchors._pack_codes(codes[a:b], least), least) == codes[a:b]).all()
    assert total < 4.5 * len(codes)
    far = np.array([3, 4, 2**40 - 1], np.uint64)
    assert anchors._unpack_codes(anchors._pack_codes(far, 0), 0).tolist() == far.tolist()


def test_rolling_hashes_do_not_depend_on_blocks():
    import numpy as np

    from spanloom.llm import anchors

    symbols = np.random.default_rng(6).integers(0, 2**63, 3 * anchors.BLOCK + 11).astype(np.uint64)
    for size in (1, 16, 35):
        found = anchors.rolling(symbols, size)
        assert len(found) == len(symbols) - size + 1
        for at in (0, anchors.BLOCK - size, anchors.BLOCK, 2 * anchors.BLOCK + 5, len(found) - 1):
            power, wanted = 1, 0
            for x in symbols[at : at + size].tolist():
                wanted, power = (wanted + x * power) % 2**64, power * int(anchors._MUL) % 2**64
            assert found[at] == wanted
    assert len(anchors.rolling(symbols[:3], 4)) == 0
