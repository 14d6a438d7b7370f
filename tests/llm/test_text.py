"""Secrets, languages, quality rules, URLs, packing and mixing."""

import base64
import hashlib
import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm.language import LanguageConfig, Vocabulary, identify_languages, word_scores
from spanloom.llm.mixing import mix_sources
from spanloom.llm.packing import OpenBins, best_fit_decreasing, pack_documents, tokenize, vocabulary_path
from spanloom.llm.quality import QualityConfig, chi_square_cutoff, quality_rules
from spanloom.llm.queries import RULES
from spanloom.llm.secrets import _encoding, base_spans, random_spans, scan_secrets
from spanloom.llm.url_filters import UrlRule, filter_urls
from tests.llm.data import documents, random_words, sort_key, table

WORD = re.compile("[^ \t-\r]+")


def test_secrets(spark):
    rng = random.Random(1)
    blob = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40))
    digest = hashlib.md5(b"x").hexdigest()
    texts = [
        (1, 'é Api_Key = "abcd1234" end'),
        (2, "token=short secret: longenough1"),
        (3, f"AKIA{'A1' * 8} AKIAZZ {digest}"),
        (4, f"run {blob} of nothing"),
        (5, "123e4567-e89b-12d3-a456-426614174000 internationalization-of-everything"),
        (6, None),
        (7, f"{'F' * 40} {'9' * 30}"),
        (1, 'é Api_Key = "abcd1234" end'),
    ]
    rows = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, spans int")
    found = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.spans) for r in scan_secrets(rows).collect()]
    start = texts[2][1].index(digest)
    assert sorted(found) == sorted(
        [
            (1, 1, 0, 0, "assign:2:21"),
            (2, 1, 0, 0, "assign:12:31"),
            (3, 0, 1, 1, f"access:0:20,hex:{start}:{start + 32}"),
            (4, 0, 0, 0, "random:4:44"),
            (5, 0, 0, 0, ""),
            (6, 0, 0, 0, ""),
            (7, 0, 0, 0, ""),
            (1, 1, 0, 0, "assign:2:21"),
        ]
    )
    first = scan_secrets(rows).filter("doc_id = 2").first()
    assert first.base_sha256 == hashlib.sha256(b"assign:12:31").hexdigest()
    assert scan_secrets(rows.limit(0)).count() == 0


def brute_base(text):
    """Base spans by walking along the text, without a pattern for a whole kind."""
    alnum = string.ascii_letters + string.digits
    keys = ["password", "passwd", "secret", "token", "apikey", "api_key"]
    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    found = []

    def walk(kind, match):
        at = 0
        while at < len(text):
            hit = match(at)
            if hit is None:
                at += 1
                continue
            end, counts = hit
            if counts:
                found.append((at, kind, end))
            at = end

    def run(at, letters):
        while at < len(text) and text[at] in letters:
            at += 1
        return at

    def assign(at):
        key = next((k for k in keys if lowered.startswith(k, at)), None)
        if key is None:
            return None
        here = at + len(key)
        here += text[here : here + 1] in ('"', "'") and here < len(text)
        here = run(here, " ")
        if text[here : here + 1] not in (":", "="):
            return None
        here = run(here + 1, " ")
        here += text[here : here + 1] in ('"', "'") and here < len(text)
        end = run(here, alnum + "+/_.=-")
        return (end, end - here >= 8) if end > here else None

    def access(at):
        end = run(at + 4, string.ascii_uppercase + string.digits)
        return (end, end - at >= 16) if text.startswith("AKIA", at) and end > at + 4 else None

    def hexes(at):
        end = run(at, "0123456789abcdef")
        return (end, end - at >= 32) if end > at else None

    for kind, match in enumerate((assign, access, hexes)):
        walk(kind, match)
    return sorted(found)


def test_secrets_of_odd_rows_and_random_texts(spark):
    rng = random.Random(4)
    parts = ["password", "Secret", "TOKEN", "api_key", "ApiKey", "passwd", "=", ":", " ", '"', "'", "é", "\n",
             "AKIA", "AKIAAB12", "a1b2c3d4", "f" * 31, "0" * 33, "xyz/+_-.", "G7" * 9, "="]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(400)]
    texts += [" ".join(hashlib.md5(b"%d" % i).hexdigest() for i in range(3000))]
    rows = documents() + [(1000 + i, t, None, None, None, None) for i, t in enumerate(texts)]
    found = scan_secrets(table(spark, rows))
    assert found.columns[-1] == "n_random"
    wanted = []
    for doc_id, text, *_ in rows:
        base = brute_base(text or "")
        counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        wanted.append((doc_id, *counts, hashlib.sha256(listed.encode()).hexdigest()))
    got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found.collect()]
    assert sorted(got, key=sort_key) == sorted(wanted, key=sort_key)
    for r in found.collect():
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert len(spans) == r.n_assign + r.n_access + r.n_hex + r.n_random
        base = [(int(a), int(b)) for kind, a, b in spans if kind != "random"]
        own = [(int(a), int(b)) for kind, a, b in spans if kind == "random"]
        if len(base) < 200:
            assert all(b <= c or d <= a for a, b in own for c, d in base)


def random_of(text):
    found = random_spans(text, _encoding(vocabulary_path("byte_bpe_50k.tiktoken")), base_spans(text), 2.4)
    return [text[a:b] for a, _, b in sorted(found)]


def random_keys(n, length, seed=3):
    rng = random.Random(seed)
    alphabets = [string.ascii_lowercase, string.ascii_uppercase, string.ascii_letters]
    return ["".join(rng.choices(alphabets[i % 3], k=length)) for i in range(n)]


def test_letter_only_keys_are_found_and_names_are_not():
    keys = random_keys(300, 24)
    assert sum(random_of(f"see {k} there") == [k] for k in keys) >= 297
    names = ["Geschwindigkeitsbegrenzung", "Donaudampfschifffahrtsgesellschaft",
             "POP_JUMP_FORWARD_IF_NOT_NONE", "anticonstitutionnellement", "GRID-UNIT-HEIGHT-PIXELS",
             "internationalization/of/everything", "Kraftfahrzeughaftpflichtversicherung"]
    assert [n for n in names if random_of(n)] == []
    digest = hashlib.sha256(b"x").digest()
    assert random_of("sha256-" + base64.b64encode(digest).decode()) == []
    assert random_of("md5-Zk3vQ9xT2mLp8RwY5bNc7HdJ4sGf6KqWx1Ve0Tu9") != []


def test_keys_inside_longer_runs_are_found():
    path = "//example/documentation/production/services/internal/"
    rng = random.Random(7)
    base62 = ["".join(rng.choices(string.ascii_letters + string.digits, k=20)) for _ in range(100)]
    for before, after in ((path, "/index"), ("config_value=", ""), ("exampledocumentation", "")):
        found = [random_of(f"see {before}{k}{after} there") for k in base62]
        assert sum(any(k[2:-2] in f for f in own) for k, own in zip(base62, found)) >= 97
    letters = random_keys(100, 24)
    assert sum(any(k[2:-2] in f for f in random_of(path + k)) for k in letters) >= 97
    key, digest = base62[0], hashlib.md5(b"x").hexdigest()
    assert random_of(f"AKIA{'A1' * 8}/{key}") == ["/" + key]
    assert random_of(f"{digest}-{key}") == ["-" + key]
    plain = [path + "index", "documentation/production/2024-01-02-2024-03-04/internal"]
    assert [p for p in plain if random_of(p)] == []


def test_forward_sums_all_segmentations():
    vocabulary = Vocabulary(vocabulary_path("byte_bpe_multi_50k.tiktoken"))
    rng = np.random.default_rng(2)
    chances = rng.random((len(vocabulary.words), 2))
    chances /= chances.sum(axis=0)
    ids = {w: i for i, w in enumerate(vocabulary.words)}

    def total(text, lang):
        if not text:
            return 1.0
        return sum(
            chances[ids[text[:n]], lang] * total(text[n:], lang)
            for n in range(1, len(text) + 1)
            if text[:n] in ids
        )

    words = [b"the", "für".encode(), b"x"]
    found = word_scores(words, vocabulary, chances)
    want = [[np.log(total(b" " + w, lang)) for lang in (0, 1)] for w in words]
    assert np.allclose(found, want)


def test_language(spark):
    rng = random.Random(4)
    parts = {"en": ["the", "tion", "ing", "and"], "de": ["der", "ung", "sch", "über"]}
    rows = []
    for i in range(200):
        lang = ("en", "de")[i % 2]
        words = ["".join(rng.choices(parts[lang], k=2)) for _ in range(20)]
        rows.append((i, " ".join(words), lang, "s", None, None))
    rows += [(500, None, "en", None, None, None), (501, "12 34 !", "en", None, None, None)]
    got = identify_languages(table(spark, rows), LanguageConfig(rounds=2)).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred == ("und" if r.doc_id >= 500 else ("en", "de")[r.doc_id % 2])
    nothing = identify_languages(table(spark, [(1, "some text", None, None, None, None)])).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)
    assert identify_languages(table(spark, [])).count() == 0
    assert identify_languages(table(spark)).count() == len(documents())


def brute_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            repeated |= {i, i + 1, i + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated))


def test_quality_counts(spark):
    extra = [(90, "a b c a b c a\nx # <>\nx # <>\n\n \t\nq", "en", "s", None, None)]
    rows = [r for r in documents() if r[0] != 50] + extra
    got = quality_rules(table(spark, rows))
    want = []
    for r in rows:
        counts = brute_counts(r[1])
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        want.append((r[0], *counts, failed, not failed))  # groups too small for an estimate
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = [tuple(r) for r in got.select(*columns, "base_failed", "kept").collect()]
    assert sorted(found, key=sort_key) == sorted(want, key=sort_key)
    assert quality_rules(table(spark, [])).count() == 0


def test_quality_outliers(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(random_words(rng, 120)), "en", "s", None, None) for i in range(300)]
    rows += [(1000 + i, " ".join(w + "###" for w in random_words(rng, 80)), "en", "s", None, None)
             for i in range(30)]
    got = quality_rules(table(spark, rows), QualityConfig(min_group=100)).collect()
    assert {r.doc_id for r in got if not r.kept} == set(range(1000, 1030))


def test_quality_outliers_in_single_statistics(spark):
    def words(doc, n=100):
        return [f"w{doc:04d}{i:03d}" for i in range(n)]

    def symbols(own, n):
        return [w[:-1] + "#" if i < n else w for i, w in enumerate(own)]

    def repeats(own, n):  # n repeated words: the first half of them comes again
        return own[: len(own) - n // 2] + own[: n // 2]

    def lines(own, n):  # one-word lines, which repeat no three words
        return [w + "\nsamesame\n" if i < n else w for i, w in enumerate(own)]

    rows = {i: words(i) for i in range(300)}
    kept = {500: symbols(words(500), 4), 501: repeats(words(501), 10)}
    rejected = {
        600: [w * 2 for w in words(600)],
        601: symbols(words(601), 12),
        602: lines(words(602), 40),
        603: repeats(words(603), 44),
    }
    together = repeats(words(604), 10)  # with the symbols an outlier, alone not
    rejected[604] = together[:60] + symbols(together[60:], 4)
    found = [(i, " ".join(w), "en", "s", None, None) for i, w in (rows | kept | rejected).items()]
    got = quality_rules(table(spark, found)).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == set(rejected)


def test_quality_cutoff_is_a_chi_square_quantile():
    assert round(chi_square_cutoff(0.5), 4) == 3.3567 and round(chi_square_cutoff(0.001), 3) == 18.467
    config = QualityConfig()
    assert all(0.5 / floor**2 > config.cutoff for floor in config.floors)


def test_urls(spark):
    urls = ["http://Www.Example.org/es/1?x", "https://a.org", "ftp://example.org/en/1#t", None,
            "no scheme/org/", "http://x.com/fr/a", "http://notexample.org/es/", "x://fr.com/de/?://q"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, RULES).collect()}
    assert got == {
        0: ("www.example.org", "/es/1", "example.org/es/", "block"),
        1: ("a.org", "", None, "allow"),
        2: ("example.org", "/en/1", "example.org/en/1", "block"),
        3: ("", "", None, "allow"),
        4: ("", "", None, "allow"),
        5: ("x.com", "/fr/a", "com/fr/", "allow"),
        6: ("notexample.org", "/es/", "org/", "allow"),
        7: ("fr.com", "/de/", "com/de/", "block"),
    }
    assert filter_urls(pages.limit(0), RULES).count() == 0
    assert filter_urls(pages, []).filter("verdict = 'allow'").count() == len(urls)


def test_colliding_keys_are_told_apart(spark, monkeypatch, tmp_path):
    from spanloom.llm import url_filters as u

    monkeypatch.setattr(u, "_key", lambda text: 7)
    rules = [UrlRule("a", "/x", "allow"), UrlRule("b", "/y", "block"), UrlRule("a/", "x", "block")]
    u.write_digest_file(rules, tmp_path / "f")
    index = u.DigestArray(str(tmp_path / "f"))
    found = index.find([b"b", b"a", b"c", b"a/"], [b"/y", b"/x", b"/z", b"x"])
    assert [f >= 0 for f in found] == [True, True, False, True]
    assert [index.blocked[f] for f in found if f >= 0] == [1, 0, 1]


def test_segment_tree_finds_the_tightest():
    rng = random.Random(8)
    bins, held = OpenBins(64), []
    for n in range(2000):
        length = rng.randrange(1, 65)
        assert bins.tightest(length) == min((c for c in held if c >= length), default=-1)
        if held and rng.random() < 0.5:
            capacity = rng.choice(held)
            held.remove(capacity)
            bins.take(capacity)
        capacity = rng.randrange(1, 65)
        held.append(capacity)
        bins.add(capacity, n)
    lengths = np.array([5, 4, 3, 3, 2, 1])
    assert best_fit_decreasing(lengths, 6)[0].max() + 1 == 3


@pytest.mark.parametrize("most", [2048, 64])
def test_packing(spark, most):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    odd = ["a\u00a0 b\n\n  c  ", "it's  \u2003 x\tüü é à  z", "\n a", " <|endoftext|> x", "日本 語 \u3000 x",
           "a b <|endoftext|> c d", "x<|endoftext|>", "b  <|endoftext|>\n\n<|endoftext|><|endoftext|>y z"]
    rows = documents() + [(200 + i, t, None, None, None, None) for i, t in enumerate(odd)]
    want = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in rows]
    got = [(r.doc_id, list(r.ids)) for r in tokenize(table(spark, rows)).collect()]
    assert sorted(got, key=sort_key) == sorted(want, key=sort_key)
    placed = pack_documents(table(spark, rows), most, group_pieces=40).collect()
    pieces = []
    for doc_id, ids in want:
        head = len(ids) % most or most
        bounds = [0, *range(head, len(ids) + 1, most)]
        for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            pieces.append((doc_id, n, a, b - a, crc))
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed]
    assert sorted(found, key=sort_key) == sorted(pieces, key=sort_key)
    by_sequence = {}
    for r in placed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= most
    assert pack_documents(table(spark, [])).count() == 0


def test_mixing(spark):
    got = mix_sources(table(spark)).collect()
    rows = documents()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    clamped = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in clamped)
        unit = left / sum(w for s, w in weights.items() if s not in clamped)
        more = {s for s in order if s not in clamped and unit * weights[s] > 3 * sizes[s]}
        if not more:
            break
        clamped |= more
    target = {s: 3 * sizes[s] if s in clamped else unit * weights[s] for s in order}
    assert len(got) == len(rows) and clamped
    by_size = {}
    for r in got:
        assert r.size == 0 or (r.taken % r.size == 0 and r.taken <= 3 * r.size)
        by_size.setdefault(r.source_size, set()).add(round(r.target, 6))
    want = {}
    for s in order:
        want.setdefault(sizes[s], set()).add(round(target[s], 6))
    assert by_size == want
    again = mix_sources(table(spark).repartition(3)).collect()
    assert sorted(map(tuple, got), key=sort_key) == sorted(map(tuple, again), key=sort_key)
    assert mix_sources(table(spark, [])).count() == 0


def test_mixing_comes_near_targets(spark):
    rows = [(i, "w " * (1 + i % 50), None, f"s{i % 3}", None, None) for i in range(3000)]
    taken = (
        mix_sources(table(spark, rows)).groupBy("target").agg(F.sum("taken").alias("n")).collect()
    )
    assert len(taken) == 3 and all(abs(r.n - r.target) <= 50 for r in taken)
