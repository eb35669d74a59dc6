"""Language identification by unigram pieces, summed over all segmentations.

The vocabulary is a fixed public one (never trained here). Each language has a
probability for every piece, fitted by expectation-maximisation on counted words of
labelled documents. A word's likelihood is the sum over every way to cut it into
pieces, found by the forward algorithm; a text's is the product over its words. The
recursion holds as many positions as the longest piece has characters and rescales
them, so a word may have any length.

Fitting reads a bounded sample of labelled documents (``sample_docs``); everything
else works on all rows and whole texts. Distinct words of a block are scored once.

Defined results: NULL, empty or letter-free text gives ``und`` and score 0; so does
every text if no language could be learned. Words are lower-cased; a long word is
one word, all its segmentations are summed. Equally likely languages: the first by
name. Repeated rows are scored alike; columns named ``lang_pred`` and ``score`` in the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import blocks, coded_words, mixed, remainder, remembered, stage, without, words

CELLS = 1 << 17  # characters whose pieces are looked up at a time
SCORED_BYTES = 2 << 20  # text scored at once: its words and their pieces take many times as much
RESCALE = 16  # positions between rescalings: FLOOR ** RESCALE is far from underflow
FLOOR = 1e-7  # probability of a character no piece covers, alike in all languages
MARK = "▁"  # how the vocabulary writes the start of a word
HASH = np.uint64(0x9E3779B97F4A7C15)
BITS = 22


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary's pieces behind a rolling hash of their characters."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
        texts = sorted(set(map(model.id_to_piece, usable)))
        self.longest = max(map(len, texts), default=1)
        keys = np.zeros(len(texts), np.uint64)
        for k, text in enumerate(texts):
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for ch in text:
                    h = (h + np.uint64(ord(ch)) + np.uint64(1)) * HASH
            keys[k] = h
        order = np.argsort(keys)
        self.texts, self.keys = [texts[i] for i in order], keys[order]
        self.maybe = np.zeros(1 << BITS, bool)
        self.maybe[(mixed(self.keys) >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose hash is a piece's, and those pieces."""
        rows = np.flatnonzero(self.maybe[(mixed(h) >> np.uint64(64 - BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[rows]), len(self.keys) - 1)
        hit = self.keys[at] == h[rows]
        return rows[hit], at[hit]


def pieces_of(path: str) -> Pieces:
    return remembered(Pieces, path)


def by_length(distinct: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of each word, matrix of their characters) for the words of each length; few
    enough of them at a time that what is looked up fits ``CELLS``."""
    found: dict[int, list[int]] = {}
    for k, word in enumerate(distinct):
        found.setdefault(len(word), []).append(k)
    for n, owner in found.items():
        many = max(1, CELLS // (n + 1))
        for lo in range(0, len(owner), many):
            part = owner[lo : lo + many]
            raw = "".join(MARK + distinct[k] for k in part).encode("utf-32-le", "surrogatepass")
            yield np.array(part), np.frombuffer(raw, np.uint32).reshape(-1, n + 1)


def edges(chars: np.ndarray, pieces: Pieces) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, rows, pieces) of every piece that occurs in the words, by start and end."""
    n = chars.shape[1]
    wide = chars.astype(np.uint64) + np.uint64(1)
    some = max(1, CELLS // len(chars))
    for lo in range(0, n, some):
        starts = min(some, n - lo)
        h, found = np.zeros((len(chars), starts), np.uint64), []
        for length in range(1, min(pieces.longest, n - lo) + 1):
            inside = min(starts, n - lo - length + 1)
            h = (h[:, :inside] + wide[:, lo + length - 1 : lo + length - 1 + inside]) * HASH
            at, ids = pieces.find(h.ravel())
            row, start = np.divmod(at, inside)
            found.append(((start + lo) * (pieces.longest + 1) + length, row, ids))
        key, row, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(key, kind="stable")
        key, row, ids = key[order], row[order], ids[order]
        cuts = np.flatnonzero(np.diff(key, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(key)], strict=True):
            start, length = divmod(int(key[a]), pieces.longest + 1)
            yield start, start + length, row[a:b], ids[a:b]


def swept(shape: tuple[int, int], n: int, steps: Iterator[tuple], p: np.ndarray, ring: int, keep: bool) -> np.ndarray:
    """The forward recursion over ``n`` characters: log mass of all segmentations up to the
    end, or up to every position if ``keep``. ``steps`` are edges by start."""
    mass, scale, at, logs = np.zeros((ring + 1, *shape)), np.zeros(shape), 0, []
    mass[0] = 1.0

    def pass_on() -> None:
        nonlocal scale
        here = mass[at % (ring + 1)]
        if at % RESCALE == RESCALE - 1:
            scale = scale + np.log(here)
            mass[np.arange(ring + 1) != at % (ring + 1)] /= here
            here[:] = 1.0
        if keep:
            logs.append(np.log(here) + scale)
        mass[(at + 1) % (ring + 1)] += here * FLOOR
        here[:] = 0.0

    for start, end, rows, ids in steps:
        while at < start:  # every piece that ends at the next position has been added
            pass_on()
            at += 1
        mass[end % (ring + 1), rows] += mass[start % (ring + 1), rows] * p[ids]
    while at < n:
        pass_on()
        at += 1
    last = np.log(mass[n % (ring + 1)]) + scale
    return np.stack([*logs, last]) if keep else last


def word_scores(distinct: list[str], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Log likelihood of each word in each language."""
    out = np.zeros((len(distinct), p.shape[1]))
    for owner, chars in by_length(distinct):
        out[owner] = swept((len(chars), p.shape[1]), chars.shape[1], edges(chars, pieces), p, pieces.longest, False)
    return out


def expected_pieces(distinct: list[str], counts: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in each language, given the words' counts there."""
    total = np.zeros(p.shape)
    for owner, chars in by_length(distinct):
        n, shape, kept = chars.shape[1], (len(chars), p.shape[1]), list(edges(chars, pieces))
        before = swept(shape, n, kept, p, pieces.longest, True)
        turned = sorted(((n - end, n - start, rows, ids) for start, end, rows, ids in kept), key=lambda e: e[:2])
        after = swept(shape, n, turned, p, pieces.longest, True)[::-1]
        for start, end, rows, ids in kept:
            np.add.at(total, ids, p[ids] * np.exp(before[start, rows] + after[end, rows] - before[-1, rows]) * counts[owner[rows]])
    return total


@dataclass
class Model:
    """What identification needs: the vocabulary's path, the languages, their pieces."""

    vocabulary: str
    languages: list[str]
    p: np.ndarray


def fit(docs: DataFrame, vocabulary: str | None = None, sample_docs: int = 4000, rounds: int = 2) -> Model:
    """Piece probabilities per language from about ``sample_docs`` documents of ``docs``
    with a language; fewer if there are fewer. Words are counted by Spark, expected
    piece counts are summed by Spark; only (piece, language) sums reach the driver."""
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = labelled.count()
    if n > sample_docs:
        part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30))
        labelled = labelled.where(part < int(sample_docs / n * (1 << 30)))
    counted = stage(
        labelled.select("lang", F.explode(words(F.lower("text"))).alias("word")).groupBy("word", "lang").agg(F.count("*").alias("n")),
        "word_counts",
    )
    languages = sorted(r[0] for r in counted.select("lang").distinct().collect())
    size = len(pieces_of(vocabulary))
    p = np.full((size, max(1, len(languages))), 1.0 / size)
    index = {lang: k for k, lang in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        current = spark.sparkContext.broadcast(p)

        def expect(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            p, pieces = current.value, pieces_of(vocabulary)
            total = np.zeros(p.shape)
            for batch in batches:
                coded = batch.column("word").dictionary_encode()
                counts = np.zeros((len(coded.dictionary), p.shape[1]))
                lang = [index[x] for x in batch.column("lang").to_pylist()]
                np.add.at(counts, (coded.indices.to_numpy(zero_copy_only=False), lang), batch.column("n").to_numpy(zero_copy_only=False))
                with np.errstate(over="ignore"):
                    total += expected_pieces(coded.dictionary.to_pylist(), counts, pieces, p)
            ids, langs = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(langs, pa.int32()), pa.array(total[ids, langs])], ["piece", "lang", "n"])

        sums = counted.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        p = np.full(p.shape, 0.01)
        p[sums["piece"], sums["lang"]] += sums["n"]
        p /= p.sum(axis=0)
        current.unpersist()
    return Model(vocabulary, languages, p)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all) columns of ``docs`` plus ``lang_pred`` and ``score``, the
    probability of that language among those learned, all equally likely beforehand."""
    docs = without(docs, "lang_pred", "score")
    keep = docs.columns if keep is None else keep
    needed = list(dict.fromkeys([*keep, "text"]))
    # Columns travel by number: given names may hold anything, dots too.
    docs = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(needed)])
    numbered, text = [f"c{needed.index(c)}" for c in keep], f"c{needed.index('text')}"
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in numbered)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        pieces, n_lang = pieces_of(model.vocabulary), len(model.languages)
        for whole in batches:
            for batch in blocks(whole, text, SCORED_BYTES):
                codes, distinct, n = coded_words(batch.column(text), lower=False)
                owner = np.repeat(np.arange(len(n)), n)
                letter = pc.match_substring_regex(distinct, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
                spelled = np.bincount(owner, weights=letter[codes], minlength=len(n)) > 0 if len(codes) else np.zeros(len(n), bool)
                with np.errstate(over="ignore"):
                    each = word_scores(pc.utf8_lower(distinct).to_pylist(), pieces, model.p)
                total = np.stack([np.bincount(owner, weights=each[codes, k], minlength=len(n)) for k in range(max(1, n_lang))], axis=1)
                best = total.argmax(axis=1)
                share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                known = spelled & (n_lang > 0)
                lang = [model.languages[b] if ok else "und" for b, ok in zip(best, known, strict=True)]
                columns = [batch.column(c) for c in numbered]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(np.where(known, share, 0.0))], names=[*numbered, "lang_pred", "score"])
                del codes, distinct, owner, letter, spelled, each, total, best, share, known, columns
                pa.default_memory_pool().release_unused()

    return docs.mapInArrow(predict, f"{schema}, lang_pred string, score double").toDF(*keep, "lang_pred", "score")


def held_out(doc_id):
    """True for the documents nothing may be learned from."""
    return remainder(doc_id, 3) == 1
