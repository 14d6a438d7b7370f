"""Secrets in texts: fixed patterns, and strings that a tokenizer's vocabulary does not compress.

Words of natural language are made of long tokens; random strings fall into tokens of one to three
characters. The token-efficiency test therefore takes runs of key characters, leaves out those with
a known harmless form (digests, UUIDs, dates and numbers) and reports runs with few characters per
token. Names of plain words are told from letter-only keys by the same test. Where a run as a whole
passes, its parts between ``/ = _ -`` and its windows of ``MIN_RUN`` characters are tested too.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.packing import vocabulary_path
from spanloom.llm.words import pieces

# Fixed values of the base patterns, in the order of their kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGNED, MIN_ACCESS = 8, 16
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

MIN_RUN = 20
MAX_CHARS_PER_TOKEN = 2.4
# Of letters alone, lower-cased and without what joins them: long compounds have 2.3 and more.
MAX_LETTERS_PER_TOKEN = 2.2
LETTERS = re.compile(r"[A-Za-z]+(?:[/_=-]+[A-Za-z]+)*[/_=-]*")
# Of windows inside a longer run, where the lowest of many counts.
MAX_WINDOW_CHARS_PER_TOKEN = 2.0
PART = re.compile(r"[A-Za-z0-9+]{%d,}" % MIN_RUN)
JOINTS = re.compile(r"[/_=-]+")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)

# Harmless forms: hex digests of common lengths, UUIDs, named digests in hex or base64, numbers and
# dates.
_HEX = r"[0-9a-fA-F]"
KNOWN = re.compile(
    rf"(?:{_HEX}{{32}}|{_HEX}{{40}}|{_HEX}{{56}}|{_HEX}{{64}}|{_HEX}{{96}}|{_HEX}{{128}}"
    rf"|{_HEX}{{8}}(?:-{_HEX}{{4}}){{3}}-{_HEX}{{12}}"
    rf"|md5[-=_](?:{_HEX}{{32}}|[A-Za-z0-9+/_-]{{22}}(?:==)?)"
    rf"|sha1[-=_](?:{_HEX}{{40}}|[A-Za-z0-9+/_-]{{27}}=?)"
    rf"|sha256[-=_](?:{_HEX}{{64}}|[A-Za-z0-9+/_-]{{43}}=?)"
    rf"|sha384[-=_](?:{_HEX}{{96}}|[A-Za-z0-9+/_-]{{64}})"
    rf"|sha512[-=_](?:{_HEX}{{128}}|[A-Za-z0-9+/_-]{{86}}(?:==)?)"
    r"|[0-9+/_=-]+)"
)

# Known forms as a field of a longer run; numbers from eight characters.
INNER = re.compile(
    rf"(?<![A-Za-z0-9])(?:{KNOWN.pattern.removesuffix('|[0-9+/_=-]+)')}|[0-9][0-9/_=-]{{6,}}[0-9]))"
    r"(?![A-Za-z0-9])"
)

SPAN_DDL = """doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string,
  n_random long"""


@cache
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns; kinds count from 0 in the order of ``KINDS``."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= MIN_ASSIGNED
        ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= MIN_ACCESS
        ]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def _is_random(run: str, encoding, most: float) -> bool:
    """Whether tokens compress the run little; names are judged by their words in lower case."""
    if not LETTERS.fullmatch(run):
        return len(run) <= most * len(encoding.encode_ordinary(run))
    words = [w.lower() for w in JOINTS.split(run) if w]
    tokens = sum(len(encoding.encode_ordinary(" " + w)) for w in words)
    return sum(map(len, words)) <= min(most, MAX_LETTERS_PER_TOKEN) * tokens


def _outside(start: int, end: int, taken) -> list[tuple[int, int]]:
    """The stretches of ``MIN_RUN`` characters or more of a span outside the spans ``taken``."""
    found = []
    for a, b in [*sorted(x for x in taken if x[0] < end and start < x[1]), (end, end)]:
        if a - start >= MIN_RUN:
            found.append((start, a))
        start = max(start, b)
    return found


def _stretches(run: str, encoding) -> list[tuple[int, int]]:
    """Stretches whose windows of ``MIN_RUN`` characters have few characters per token."""
    tokens = encoding.encode_ordinary(run.lower() if run.isalpha() else run)
    sizes = [len(encoding.decode_single_token_bytes(t)) for t in tokens]
    ends = list(accumulate(sizes))
    found, last = [], 0
    for first in range(len(sizes)):
        start = ends[first] - sizes[first]
        while last < len(sizes) and ends[last] - start < MIN_RUN:
            last += 1
        if last == len(sizes):
            break
        if ends[last] - start < MAX_WINDOW_CHARS_PER_TOKEN * (last + 1 - first):
            if found and first <= found[-1][1]:
                found[-1][1] = last
            else:
                found.append([first, last])
    spans = []
    for first, last in found:
        # Words at the edges are not part of the key.
        while sizes[first] > 3 and ends[last] - ends[first] >= MIN_RUN:
            first += 1
        while sizes[last] > 3 and ends[last - 1] - ends[first] + sizes[first] >= MIN_RUN:
            last -= 1
        spans.append((ends[first] - sizes[first], ends[last]))
    return spans


def _random_inside(run: str, encoding, most: float) -> list[tuple[int, int]]:
    """The random spans of a run: the whole, or parts between joints, or stretches of the others."""
    if KNOWN.fullmatch(run):
        return []
    if _is_random(run, encoding, most):
        return [(0, len(run))]
    known = [m.span() for m in INNER.finditer(run)]
    found = []
    for start, end in _outside(0, len(run), known):
        parts = [(start + m.start(), start + m.end()) for m in PART.finditer(run[start:end])]
        parts = [x for x in parts if not KNOWN.fullmatch(run[slice(*x)])]
        own = [x for x in parts if _is_random(run[slice(*x)], encoding, most)]
        for a, b in _outside(start, end, own):
            # Names are made of words, so that only what stands between joints is looked at.
            inner = PART.finditer(run[a:b]) if LETTERS.fullmatch(run[a:b].strip("/_=-")) else [None]
            for m in inner:
                at, to = (a + m.start(), a + m.end()) if m else (a, b)
                own += [(at + x, at + y) for x, y in _stretches(run[at:to], encoding)]
        found += own
    return sorted(found)


def random_spans(text: str, encoding, base, most: float) -> list[tuple[int, int, int]]:
    """Spans outside the base spans, of runs of key characters, with few characters per token."""
    taken: list[list[int]] = []  # base spans, those that touch as one
    for start, end in sorted((s, e) for s, _, e in base):
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    found, first = [], 0
    for m in RUN.finditer(text):
        while first < len(taken) and taken[first][1] <= m.start():
            first += 1
        last = first
        while last < len(taken) and taken[last][0] < m.end():
            last += 1
        for start, end in _outside(*m.span(), taken[first:last]):
            inside = _random_inside(text[start:end], encoding, most)
            found += [(start + a, 3, start + b) for a, b in inside]
    return found


def _joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _scan(path: str | None, name: str, most: float):
    def scan(batches):
        encoding = _encoding(path or vocabulary_path(name))
        for part in pieces(batches):
            rows = []
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                base = base_spans(text or "")
                added = random_spans(text or "", encoding, base, most)
                counts = [sum(k == kind for _, k, _ in base) for kind in (0, 1, 2)]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((doc_id, *counts, digest, _joined(base + added), len(added)))
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            names = [c.split()[0] for c in SPAN_DDL.split(",")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    return scan


def scan_secrets(
    docs: DataFrame,
    vocabulary: str = "byte_bpe_50k.tiktoken",
    path: str | None = None,
    max_chars_per_token: float = MAX_CHARS_PER_TOKEN,
) -> DataFrame:
    """One row per document: counts per kind and all spans as ``kind:start:end``, in code points.

    A null text counts as empty and has no spans; the digest is then that of the empty string.
    Repeated rows are scanned alike; an empty table gives an empty result.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return chosen.mapInArrow(_scan(path, vocabulary, max_chars_per_token), SPAN_DDL)
