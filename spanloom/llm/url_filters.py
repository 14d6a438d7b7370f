"""URL rules in a sorted digest array.

A rule is a host and a path prefix. Its key is the 64-bit xxhash of ``host`` + ``path``; keys are
sorted into one file together with the rules' strings. The file goes to every executor once
(``SparkContext.addFile``) and tasks map it into memory, so that its pages are shared by the workers
of a machine and its size is not bounded by their memory. A URL is looked up by all suffixes of its
host and all prefixes of its path that have a length found among the rules: one vectorised binary
search per batch, after which the stored string must equal the candidate, so that colliding keys
cannot decide.
"""

from __future__ import annotations

import struct
import uuid
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEAD = struct.Struct("<QQQ")  # rules, distinct path lengths, bytes of strings


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _key(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def write_digest_file(rules: list[UrlRule], path: Path) -> None:
    """Keys, path lengths, string offsets and verdicts, then the strings; all in key order.

    Of rules with one text the first is kept.
    """
    distinct: dict[tuple[str, str], UrlRule] = {}
    for rule in rules:
        distinct.setdefault((rule.host, rule.path), rule)
    entries = sorted(
        (_key(r.text.encode()), r.host.encode(), r.path.encode(), r.verdict == "block")
        for r in distinct.values()
    )
    texts = [host + path for _, host, path, _ in entries]
    offsets = np.zeros(len(entries) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    lengths = np.array(sorted({len(p) for _, _, p, _ in entries}), np.int64)
    with path.open("wb") as out:
        out.write(_HEAD.pack(len(entries), len(lengths), int(offsets[-1])))
        out.write(np.array([e[0] for e in entries], np.uint64).tobytes())
        out.write(lengths.tobytes())
        out.write(offsets.tobytes())
        out.write(np.array([len(e[1]) for e in entries], np.int64).tobytes())
        out.write(np.array([e[3] for e in entries], np.uint8).tobytes())
        out.write(b"".join(texts))


class DigestArray:
    """The memory-mapped file."""

    def __init__(self, path: str):
        mapped = np.memmap(path, np.uint8, "r")
        n, n_lengths, size = _HEAD.unpack(bytes(mapped[: _HEAD.size]))
        at = _HEAD.size

        def take(kind, count):
            nonlocal at
            width = np.dtype(kind).itemsize * count
            at += width
            return mapped[at - width : at].view(kind)

        self.keys = take(np.uint64, n)
        self.path_lengths = take(np.int64, n_lengths)
        self.offsets = take(np.int64, n + 1)
        self.host_bytes = take(np.int64, n)
        self.blocked = take(np.uint8, n)
        self.strings = take(np.uint8, size)

    def text(self, rule: int) -> bytes:
        return bytes(self.strings[self.offsets[rule] : self.offsets[rule + 1]])

    def find(self, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
        """For each candidate the rule with just this host and path, or -1."""
        keys = np.array([_key(h + p) for h, p in zip(hosts, paths)], np.uint64)
        found = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return found
        low = np.searchsorted(self.keys, keys, "left")
        high = np.searchsorted(self.keys, keys, "right")
        for i in np.flatnonzero(high > low):
            for rule in range(low[i], high[i]):
                if self.host_bytes[rule] == len(hosts[i]) and self.text(rule) == hosts[i] + paths[i]:
                    found[i] = rule
                    break
        return found


def _candidates(host: bytes, path: bytes, lengths) -> list[tuple[bytes, bytes]]:
    suffixes, rest = [host], host
    while (dot := rest.find(b".")) >= 0:
        rest = rest[dot + 1 :]
        suffixes.append(rest)
    prefixes = [path[:n] for n in lengths if n <= len(path)]
    return [(s, p) for s in suffixes for p in prefixes]


def _judge(file_name: str, default: str):
    def judge(batches):
        index = DigestArray(SparkFiles.get(file_name))
        lengths = index.path_lengths.tolist()
        for batch in batches:
            owners, hosts, paths = [], [], []
            pairs = zip(batch["host"].to_pylist(), batch["path"].to_pylist())
            for row, (host, path) in enumerate(pairs):
                for suffix, prefix in _candidates(host.encode(), path.encode(), lengths):
                    owners.append(row)
                    hosts.append(suffix)
                    paths.append(prefix)
            best: dict[int, tuple] = {}
            found = index.find(hosts, paths)
            for i in np.flatnonzero(found >= 0):
                rule = found[i]
                rank = (len(hosts[i]) + len(paths[i]), len(hosts[i]), rule)
                if rank > best.get(owners[i], (-1,)):
                    best[owners[i]] = rank
            rules, verdicts = [None] * batch.num_rows, [default] * batch.num_rows
            for row, (_, _, rule) in best.items():
                rules[row] = index.text(rule).decode()
                verdicts[row] = "block" if index.blocked[rule] else "allow"
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return judge


def share_rules(spark: SparkSession, rules: list[UrlRule]) -> str:
    """Write the digest file into Spark's own file folder of the driver and offer it to all tasks."""
    name = f"url-rules-{uuid.uuid4().hex}.bin"
    folder = Path(SparkFiles.getRootDirectory()) / "built"
    folder.mkdir(parents=True, exist_ok=True)
    write_digest_file(rules, folder / name)
    spark.sparkContext.addFile(str(folder / name))
    return name


def filter_urls(pages: DataFrame, rules: list[UrlRule], default: str = "allow") -> DataFrame:
    """One row per page: host, path, the rule that decides (null: none) and the verdict.

    A rule fits its host and all subdomains when the path starts with the rule's path; the longest
    text wins, of equally long ones that with the longer host. Without a rule the verdict is
    ``default``. Null URLs and URLs without ``://`` have an empty host and path and fit no rule that
    names a host. Repeated rows are judged alike; an empty table gives an empty result.
    """
    name = share_rules(pages.sparkSession, rules)
    parsed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
    )
    return parsed.mapInArrow(
        _judge(name, default),
        "page_id long, host string, path string, rule string, verdict string",
    )
