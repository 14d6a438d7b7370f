"""Language identification by unigram pieces, summed over all segmentations.

For each language the pieces of a fixed public vocabulary have probabilities. The probability of a
word, with the space before it, is the sum over all its segmentations into pieces of the product of
their probabilities; the forward algorithm finds it from left to right. A text's log-probability is
the sum over its words, so each distinct word of a batch is scored once, for all languages together,
in arrays over words.

Piece probabilities are fitted by expectation maximisation on the words of a bounded, hash-chosen
sample of labelled documents: forward and backward sums give the expected uses of every piece.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.packing import vocabulary_path
from spanloom.llm.words import encode_words, find_words, pieces, text_bytes
from spanloom.operators.lineage import cut_lineage

MAX_PIECE = 12
BLOCK = 40  # longer words are scored in blocks of so many bytes
_PRIME = np.uint64(0x100000001B3)
_CACHED_WORDS = 300_000

PREDICTION_DDL = "doc_id long, held_out boolean, lang_pred string, score double"
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageConfig:
    vocabulary: str = "byte_bpe_multi_50k.tiktoken"
    vocabulary_file: str | None = None
    # Labelled documents that the fit rests on, chosen by hash; about so many at any input size. Their
    # texts are used whole.
    sample_documents: int = 4000
    rounds: int = 3
    smoothing: float = 0.05
    seed: int = 29


class Vocabulary:
    """Pieces of up to ``MAX_PIECE`` bytes, found by the hash of a span; every byte is a piece."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            words = {base64.b64decode(line.split()[0]) for line in lines if line.strip()}
        words |= {bytes([b]) for b in range(256)}
        self.words = sorted(w for w in words if len(w) <= MAX_PIECE)
        hashes = np.zeros(len(self.words), np.uint64)
        for i, word in enumerate(self.words):
            h = 0
            for byte in word:
                h = (h * int(_PRIME) + byte + 1) & 0xFFFFFFFFFFFFFFFF
            hashes[i] = h
        # Spans of up to 12 bytes may share a hash only by chance; pieces must not.
        assert len(np.unique(hashes)) == len(hashes)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of spans by their hash, -1 for others."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ids[at], -1)


@cache
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _blocks(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Words with the space before them, cut into blocks, and each block's word."""
    blocks, owners = [], []
    for i, word in enumerate(words):
        spaced = b" " + word
        for at in range(0, len(spaced), BLOCK):
            blocks.append(spaced[at : at + BLOCK])
            owners.append(i)
    return blocks, np.array(owners, np.int64)


def _lattice(blocks: list[bytes], vocabulary: Vocabulary):
    """For each end position and piece length: the blocks, and the piece that ends there."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    longest = int(sizes.max(initial=0))
    letters = np.zeros((len(blocks), longest), np.uint64)
    flat = np.frombuffer(b"".join(blocks), np.uint8)
    inside = np.arange(longest)[None, :] < sizes[:, None]
    letters[inside] = flat.astype(np.uint64) + np.uint64(1)
    prefix = np.zeros((len(blocks), longest + 1), np.uint64)
    for at in range(longest):
        prefix[:, at + 1] = prefix[:, at] * _PRIME + letters[:, at]
    powers = np.cumprod(np.full(MAX_PIECE, _PRIME, np.uint64))
    steps = []
    for end in range(1, longest + 1):
        live = np.flatnonzero(sizes >= end)
        found = []
        for size in range(1, min(MAX_PIECE, end) + 1):
            spans = prefix[live, end] - prefix[live, end - size] * powers[size - 1]
            piece = vocabulary.find(spans)
            hit = piece >= 0
            if hit.any():
                found.append((size, live[hit], piece[hit]))
        steps.append(found)
    return sizes, longest, steps


def _forward(blocks: list[bytes], vocabulary: Vocabulary, chances: np.ndarray):
    """Forward sums ``[block, position, language]``; blocks are short enough not to underflow."""
    sizes, longest, steps = _lattice(blocks, vocabulary)
    sums = np.zeros((len(blocks), longest + 1, chances.shape[1]))
    sums[:, 0] = 1.0
    for end, found in enumerate(steps, 1):
        for size, live, piece in found:
            sums[live, end] += sums[live, end - size] * chances[piece]
    return sizes, steps, sums


def word_scores(words: list[bytes], vocabulary: Vocabulary, chances: np.ndarray) -> np.ndarray:
    """Log-probability of each word in each language."""
    blocks, owners = _blocks(words)
    scores = np.zeros((len(words), chances.shape[1]))
    for at in range(0, len(blocks), 20_000):
        part = blocks[at : at + 20_000]
        sizes, _, sums = _forward(part, vocabulary, chances)
        np.add.at(scores, owners[at : at + 20_000], np.log(sums[np.arange(len(part)), sizes]))
    return scores


def expected_uses(
    words: list[bytes], counts: np.ndarray, vocabulary: Vocabulary, chances: np.ndarray
) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words of one language."""
    blocks, owners = _blocks(words)
    uses = np.zeros(len(chances))
    for at in range(0, len(blocks), 20_000):
        part = blocks[at : at + 20_000]
        sizes, steps, sums = _forward(part, vocabulary, chances[:, None])
        forward = sums[:, :, 0]
        backward = np.zeros_like(forward)
        backward[np.arange(len(part)), sizes] = 1.0
        weight = counts[owners[at : at + 20_000]] / forward[np.arange(len(part)), sizes]
        for end in range(len(steps), 0, -1):
            for size, live, piece in steps[end - 1]:
                flow = chances[piece] * backward[live, end]
                backward[live, end - size] += flow
                np.add.at(uses, piece, forward[live, end - size] * flow * weight[live])
    return uses


def _count_words(batches):
    """``(lang, word, n)`` of each batch."""
    for part in pieces(batches):
        data, offsets = text_bytes(part["text"])
        starts, ends, first = find_words(data, offsets)
        if not len(starts):
            continue
        distinct, index = encode_words(data, starts, ends)
        langs = part["lang"].dictionary_encode()
        doc_lang = langs.indices.to_numpy(zero_copy_only=False)
        keys = np.repeat(doc_lang, np.diff(first)).astype(np.int64) * len(distinct) + index
        unique, n = np.unique(keys, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(unique // len(distinct))).cast(pa.string()),
                distinct.take(pa.array(unique % len(distinct))).cast(pa.binary()),
                pa.array(n, pa.int64()),
            ],
            names=["lang", "word", "n"],
        )


def _expect(path: str | None, name: str, model):
    def expect(batches):
        vocabulary = _vocabulary(path or vocabulary_path(name))
        langs, chances = model.value
        uses = np.zeros(chances.shape)
        for batch in batches:
            found = np.array(batch["lang"].to_pylist())
            words, counts = batch["word"].to_pylist(), batch["n"].to_numpy().astype(float)
            for column, lang in enumerate(langs):
                own = np.flatnonzero(found == lang)
                if len(own):
                    uses[:, column] += expected_uses(
                        [words[i] for i in own], counts[own], vocabulary, chances[:, column]
                    )
        piece, column = np.nonzero(uses)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int32()), pa.array(piece, pa.int32()), pa.array(uses[piece, column])],
            names=["lang_id", "piece", "uses"],
        )

    return expect


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from; a null id is not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_languages(labelled: DataFrame, config: LanguageConfig = LanguageConfig()):
    """Language names and piece probabilities ``[piece, language]``.

    ``labelled`` has ``text``, ``lang`` and ``doc_id``. What reaches the driver is one number per
    language and piece of the vocabulary, however large the input is.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    by_lang = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(by_lang)
    vocabulary = _vocabulary(config.vocabulary_file or vocabulary_path(config.vocabulary))
    chances = np.full((len(vocabulary.words), len(langs)), 1.0 / len(vocabulary.words))
    if not langs:
        return langs, chances
    share = config.sample_documents / len(langs)
    scale = 2**31
    limits = F.create_map(
        *(x for lang, n in by_lang.items() for x in (F.lit(lang), F.lit(int(min(1, share / n) * scale))))
    )
    draw = F.pmod(F.xxhash64(F.lit(config.seed), "doc_id"), F.lit(scale))
    sample = usable.filter(draw < limits[F.col("lang")]).select("lang", "text")
    words = cut_lineage(
        sample.mapInArrow(_count_words, "lang string, word binary, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    context = labelled.sparkSession.sparkContext
    for _ in range(config.rounds):
        model = context.broadcast((langs, chances))
        expect = _expect(config.vocabulary_file, config.vocabulary, model)
        found = (
            words.mapInArrow(expect, "lang_id int, piece int, uses double")
            .groupBy("lang_id", "piece")
            .agg(F.sum("uses").alias("uses"))
            .toPandas()
        )
        uses = np.full(chances.shape, config.smoothing)
        uses[found["piece"], found["lang_id"]] += found["uses"]
        chances = uses / uses.sum(axis=0)
        model.unpersist()
    return langs, chances


def _predict(path: str | None, name: str, model):
    def predict(batches):
        vocabulary = _vocabulary(path or vocabulary_path(name))
        langs, chances = model.value
        names = pa.array([*langs, UNKNOWN])
        known: dict[bytes, np.ndarray] = {}
        for part in pieces(batches):
            data, offsets = text_bytes(part["text"])
            starts, ends, first = find_words(data, offsets)
            totals = np.zeros((part.num_rows, len(langs)))
            if len(starts):
                distinct, index = encode_words(data, starts, ends)
                words = distinct.to_pylist()
                missing = [w for w in words if w not in known]
                if len(known) + len(missing) > _CACHED_WORDS:
                    known.clear()
                    missing = words
                known.update(zip(missing, word_scores(missing, vocabulary, chances)))
                scores = np.array([known[w] for w in words])
                np.add.at(totals, np.repeat(np.arange(part.num_rows), np.diff(first)), scores[index])
            best = totals.argmax(axis=1)
            weights = np.exp(totals - totals.max(axis=1, keepdims=True))
            lettered = part["lettered"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    part["held_out"],
                    names.take(pa.array(np.where(lettered, best, len(langs)))),
                    pa.array(np.where(lettered, 1.0 / weights.sum(axis=1), 0.0)),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return predict


def identify_languages(docs: DataFrame, config: LanguageConfig = LanguageConfig()) -> DataFrame:
    """One row per document: the most probable language and its posterior among those learned.

    Fitted on the documents that are not held out and have a language; predictions read only texts.
    Texts that are null or without a letter, and all texts when nothing could be learned, are
    ``und`` with score 0. Ties go to the first language by name. Repeated rows are judged alike; an
    empty table gives an empty result.
    """
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        held_out(F.col("doc_id")).alias("held_out"),
    )
    langs, chances = fit_languages(chosen.filter(~F.col("held_out")), config)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) & F.lit(bool(langs))
    if not langs:
        langs, chances = [UNKNOWN], chances[:, :0].sum(axis=1, keepdims=True) + 1.0 / len(chances)
    model = docs.sparkSession.sparkContext.broadcast((langs, chances))
    return chosen.select("doc_id", "held_out", "text", lettered.alias("lettered")).mapInArrow(
        _predict(config.vocabulary_file, config.vocabulary, model), PREDICTION_DDL
    )
