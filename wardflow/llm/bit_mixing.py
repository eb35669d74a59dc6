"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its words (A-Z in lower case), each followed by a space, and an end mark. Bytes
are coded in a prefix code that gives common bytes few bits; every bit is predicted from
five contexts inside the word, three of them gated by the last very common word before it
(which tells language and style). Each context has bit counts in a hashed table; their
logits are combined by weights picked by two gates (how well the word so far is known;
which bit of which byte), trained online in small batches with each
word's own occurrence taken out, then refined by an adaptive map from (gate, mixed
probability) to what really came. A word's probability depends on (word, gate) only, so
each distinct pair is scored once and a text's score is a sum over its postings; words
behind the same gate share the work on equal beginnings.

Nothing depends on how rows lie in partitions: counts are sums, whole-word contexts are
admitted by a table summed before, and weights are trained on all learned words in slices
by a hash of the word, as many as the words need, each in a fixed order, then averaged.

What is gathered grows with the corpus: all distinct words with their counts per gate and
postings, and a table whose slots follow the number of words, up to 2^24 (64 MB), which is
the proven size of what is broadcast. Words are dealt by hash into buckets, as many as the
text needs, and summed there; what each block of texts needs of a bucket's scores returns to
the block, whose postings are shuffled once, as packed numbers. Nothing of it is collected.

Defined results: NULL text is empty, and an empty text is its end mark alone. Without
learned texts every bit is even. Rows are kept apart, also with equal or NULL doc_id
(a NULL id is hashed as empty text). Other columns are not read. Words of any length
are scored whole, in linear time. Equally common gate words: the first by name.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import Scratch, blocks, coded_words, mixed, ragged, stage

GATES = 15  # very common words that gate; 0: none so far
CONTEXTS = 5
WHOLE = (3, 4)  # those that hold the whole word so far
LEVELS = np.array([0, 1, 2, 4, 8, 32, 128])  # how well a context is known: the first gate tells these apart
STEPS = 33  # of the refining map
MOST_BITS = 24
START = (0.1, 0.1, 0.2, 0.2, 0.5)  # weights before any training
CHUNK = 1 << 14
PRIOR = 0.4
ADMIT = 2  # occurrences that must share a whole-word context for it to be counted
RATE = 1.0
DAMP = 20.0
FARTHEST = 0.03  # a weight moves in one batch
WORDS_A_BATCH = 1500
WORDS_AT_ONCE = 4000  # of those that are counted or scored
SUMMED = 64  # pieces of a table that one group adds up
BUCKET_BYTES = 8 << 20  # text for each bucket of words
SLICE_WORDS = 40_000  # words that one run of training goes over
COMMON = 1024  # words a block names as its most common
A, B, C, D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93))


@dataclass
class Code:
    """A prefix code of bytes: bits and inner nodes of every byte, by depth."""

    length: np.ndarray
    bit: np.ndarray  # (depth, byte)
    node: np.ndarray  # (depth, byte)


def prefix_code(counts: np.ndarray) -> Code:
    """The code of least length for these counts (every byte counts once more)."""
    heap = [(int(n) + 1, b, b) for b, n in enumerate(counts)]
    heapq.heapify(heap)
    made = 256
    parts: dict[int, tuple] = {}
    while len(heap) > 1:
        one, two = heapq.heappop(heap), heapq.heappop(heap)
        parts[made] = (one[2], two[2])
        heapq.heappush(heap, (one[0] + two[0], made, made))
        made += 1
    paths: dict[int, list[tuple[int, int]]] = {heap[0][2]: []}
    for inner in range(made - 1, 255, -1):
        for bit, child in enumerate(parts[inner]):
            paths[child] = [*paths[inner], (bit, inner - 256)]
    length = np.array([len(paths[b]) for b in range(256)])
    bit, node = np.zeros((length.max(), 256), np.int8), np.zeros((length.max(), 256), np.int64)
    for b in range(256):
        for depth, (x, inner) in enumerate(paths[b]):
            bit[depth, b], node[depth, b] = x, inner
    return Code(length, bit, node)


@dataclass
class Model:
    """Gate words, byte code, hashed counts (as codes), mixing weights, refining map."""

    gates: list[str]
    code: Code
    bits: int
    zeros: np.ndarray | None = None
    ones: np.ndarray | None = None
    by_place: np.ndarray | None = None
    by_node: np.ndarray | None = None
    refined: np.ndarray | None = None
    admitted: np.ndarray | None = None
    both: np.ndarray | None = None  # zeros and ones of a slot side by side, in place of the two

    def counts(self) -> np.ndarray:
        return self.zeros.astype(np.uint16) | (self.ones.astype(np.uint16) << 8) if self.both is None else self.both


def count_code(n: np.ndarray) -> np.ndarray:
    """Counts in a byte: exact to 32, then in steps of 7 %."""
    big = 32 + np.log(np.maximum(n, 32) / 32) / np.log(1.07)
    return np.where(n <= 32, n, np.minimum(255, big)).astype(np.uint8)


LEVEL = np.searchsorted(LEVELS, np.arange(129), side="right") - 1
COUNT = np.array([float(k) if k <= 32 else 32 * 1.07 ** (k - 32) for k in range(256)], np.float32)
NODE = np.arange(512).astype(np.uint64) * C


def evidence(bit: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Logit and level of every pair of count codes (zeros, and ones times 256); with a ``bit``
    given, without one occurrence of it."""
    pair = np.arange(1 << 16)
    one, zero = COUNT[pair >> 8], COUNT[pair & 255]
    one, zero = np.maximum(one - (bit == 1), 0), np.maximum(zero - (bit == 0), 0)
    return np.log((one + PRIOR) / (zero + PRIOR)).astype(np.float32), LEVEL[np.minimum(one + zero, 128).astype(np.uint8)].astype(np.uint8)


LOGIT, KNOWN = evidence(None)
#: The occurrence predicted is not evidence for itself: its bit is bit 16 of the index.
LOGIT_LEFT, KNOWN_LEFT = (np.concatenate(x) for x in zip(evidence(0), evidence(1), strict=True))


@dataclass
class Spelled:
    """Words as bytes, and the contexts of each byte."""

    owner: np.ndarray  # word of each byte
    place: np.ndarray  # position in its word
    byte: np.ndarray
    contexts: list[np.ndarray]


def spell(words: list[bytes], gate: np.ndarray) -> Spelled:
    """``words`` end in their mark already; ``gate`` is each one's."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    byte = np.frombuffer(b"".join(words), np.uint8)
    owner = np.repeat(np.arange(len(n)), n)
    first = np.repeat(np.cumsum(n) - n, n)
    at = np.arange(len(byte))
    place = at - first
    wide = byte.astype(np.uint64) + np.uint64(1)
    gated = ((gate.astype(np.uint64) + np.uint64(1)) * D)[owner]
    before = [np.where(place >= k, wide[np.maximum(at - k, 0)], np.uint64(0)) for k in range(1, 5)]
    h, near = np.zeros(len(byte), np.uint64), []
    for k, b in enumerate(before):
        h = (h + b + np.uint64(k)) * A
        h ^= h >> np.uint64(29)
        near.append(h)
    powers = np.cumprod(np.full(int(n.max()) if len(n) else 0, B))
    upto = np.cumsum(wide * powers[place]) if len(byte) else wide
    # The word so far: a sum of its characters times powers, freed of the words before.
    begun = np.concatenate([[np.uint64(0)], upto])
    prefix = mixed(begun[at] - begun[first])
    contexts = [near[1] + gated, near[2] + gated, near[3], prefix * A + np.uint64(5), prefix * B + gated]
    return Spelled(owner, place, byte, contexts)


def distinct_bytes(text: Spelled) -> tuple[Spelled, np.ndarray]:
    """Bytes that stand behind the same gate and beginning once (all their contexts are equal),
    and which of these each byte is."""
    key = (text.contexts[-1] + text.byte.astype(np.uint64) * C) * A
    which = pa.array(key).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    first = np.zeros(int(which.max()) + 1 if len(which) else 0, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return Spelled(text.owner[first], text.place[first], text.byte[first], [c[first] for c in text.contexts]), which


def slots(context: np.ndarray, k: int, spread: np.ndarray, bits: int) -> np.ndarray:
    """``spread`` is ``NODE`` of the inner nodes."""
    x = context + spread
    x += np.uint64(k + 1) * B
    x *= A
    x ^= x >> np.uint64(32)
    x *= B
    x >>= np.uint64(64 - bits)
    return x.view(np.int64)


def admission(text: Spelled, k: int, bits: int) -> np.ndarray:
    return slots(text.contexts[k], k, NODE[511:], bits)


def add_uses(tables: np.ndarray, text: Spelled, weight: np.ndarray, model: Model) -> None:
    """Count how often each whole-word context is met, whatever byte follows."""
    uses = tables[:, 0]
    for k in WHOLE:
        slot = admission(text, k, model.bits)
        np.add.at(uses, slot, weight)
        uses[slot] = np.minimum(uses[slot], ADMIT)  # more makes no difference


def add_counts(tables: np.ndarray, text: Spelled, weight: np.ndarray, model: Model) -> None:
    """Add the bits of a batch of words to the counts of zeros and ones."""
    flat, admitted = tables.reshape(-1), [None] * CONTEXTS  # zeros and ones of a slot are neighbours
    for k in WHOLE:
        admitted[k] = model.admitted[admission(text, k, model.bits)]
    for depth in range(len(model.code.bit)):
        deep = model.code.length[text.byte] > depth
        if not deep.any():
            break
        for k, context in enumerate(text.contexts):
            here = np.flatnonzero(deep if admitted[k] is None else deep & admitted[k])
            byte = text.byte[here]
            slot = slots(context[here], k, NODE[model.code.node[depth, byte]], model.bits)
            np.add.at(flat, 2 * slot + model.code.bit[depth, byte], weight[here])


def predictions(text: Spelled, model: Model, counts: np.ndarray, depth: int, here: np.ndarray, leave: bool = False):
    """Logits of every context (one row each) and the two gates of the weights. With ``leave``
    the occurrence predicted is left out of the counts."""
    byte = text.byte[here]
    node = model.code.node[depth, byte]
    spread = NODE[node]
    logits, known = np.empty((CONTEXTS, len(here)), np.float32), {}
    bit = model.code.bit[depth, byte] > 0
    own, (logit, level) = bit.astype(np.int64) << 16, (LOGIT_LEFT, KNOWN_LEFT) if leave else (LOGIT, KNOWN)
    for k, context in enumerate(text.contexts):
        pair = counts[slots(context[here], k, spread, model.bits)].astype(np.int64)
        if leave:
            pair |= own
        np.take(logit, pair, out=logits[k], mode="clip")
        if k in WHOLE:
            known[k] = level[pair]
    # The whole word so far, with and without its gate.
    place = (known[WHOLE[1]] * np.uint8(len(LEVELS)) + known[WHOLE[0]]).astype(np.int64)
    return bit, logits, place, node


def mix(logits: np.ndarray, place: np.ndarray, node: np.ndarray, model: Model) -> np.ndarray:
    by_place, by_node = np.ascontiguousarray(model.by_place.T), np.ascontiguousarray(model.by_node.T)
    total = sum(logits[k] * (by_place[k][place] + by_node[k][node]) for k in range(CONTEXTS))
    return np.clip(total, -15, 15)


def refine(mixed: np.ndarray, gate: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of a one after the adaptive map; the map's cell and the share of the next."""
    x = (np.clip(mixed, -7.99, 7.99) + 8) * ((STEPS - 1) / 16)
    cell = x.astype(np.int64)
    share = x - cell
    at = gate * STEPS + cell
    ratio = model.refined[:, 1] / model.refined.sum(axis=1)
    mapped = ratio[at] * (1 - share) + ratio[at + 1] * share
    return 0.5 * mapped + 0.5 / (1 + np.exp(-mixed)), at, share


def fresh(model: Model) -> Model:
    """Equal weights, and a map that changes nothing."""
    model.by_place = np.tile(START, (len(LEVELS) ** 2, 1))
    model.by_node = np.zeros((256, CONTEXTS))
    level = 1 / (1 + np.exp(-np.linspace(-8, 8, STEPS)))
    model.refined = np.tile(np.stack([1 - level, level], axis=1) * 64, (GATES + 1, 1))
    return model


def train(text: Spelled, gate: np.ndarray, weight: np.ndarray, model: Model, rate: float) -> None:
    """One small batch: predict, then move weights and map towards what came. Bytes with the
    same contexts are one event with the sum of their weights."""
    counts, gate = model.counts(), gate[text.owner]
    for depth in range(len(model.code.bit)):
        here = np.flatnonzero(model.code.length[text.byte] > depth)
        if not len(here):
            break
        w = weight[here]
        bit, logits, place, node = predictions(text, model, counts, depth, here, leave=True)
        mixed = mix(logits, place, node, model)
        p = 1 / (1 + np.exp(-mixed))
        error, spread = (bit - p) * w, p * (1 - p) * w
        for k in range(CONTEXTS):  # a damped Newton step for each weight; gates seen rarely move little
            slopes, bends = error * logits[k], spread * logits[k] ** 2
            for table, index in ((model.by_place, place), (model.by_node, node)):
                slope = np.bincount(index, weights=slopes, minlength=len(table))
                bend = np.bincount(index, weights=bends, minlength=len(table))
                step = np.clip(rate / (2 * CONTEXTS) * slope / (bend + DAMP), -FARTHEST, FARTHEST)
                table[:, k] = np.clip(table[:, k] + step, -1.0, 1.5)
        _, at, share = refine(mixed, gate[here], model)
        for offset, part in ((0, 1 - share), (1, share)):
            model.refined += np.bincount((at + offset) * 2 + bit, weights=w * part, minlength=model.refined.size).reshape(model.refined.shape)


def log10_of(text: Spelled, gate: np.ndarray, n_words: int, model: Model) -> np.ndarray:
    """log10 of each word's probability."""
    owner = text.owner
    text, which = distinct_bytes(text)
    counts, gate, of_byte = model.counts(), gate[text.owner], np.zeros(len(text.byte))
    for depth in range(len(model.code.bit)):
        here = np.flatnonzero(model.code.length[text.byte] > depth)
        if not len(here):
            break
        bit, logits, place, node = predictions(text, model, counts, depth, here)
        p, _, _ = refine(mix(logits, place, node, model), gate[here], model)
        of_byte[here] += np.log10(np.where(bit, p, 1 - p))
    return np.bincount(owner, weights=of_byte[which], minlength=n_words)


def marked(words: pa.Array) -> list[bytes]:
    """Words and their mark; the end of a text, kept as a line feed, is its own."""
    mark = pc.if_else(pc.equal(words, "\n"), "", " ")
    return pc.binary_join_element_wise(words, mark, "").cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words, one after the other, and where each word begins (and the end)."""
    words = words.cast(pa.string())
    _, begins, data = words.buffers()
    if not len(words) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(words) + 1, np.int64)
    begins = np.frombuffer(begins, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[begins[0] : begins[-1]], begins - begins[0]


def dealt(words: pa.Array, n: int) -> np.ndarray:
    """A number below ``n`` for each word (none is empty), by a hash of its bytes."""
    data, begins = letters(words)
    sizes = np.diff(begins)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()), B))
        place = np.arange(len(data)) - np.repeat(begins[:-1], sizes)
        hashed = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[place], begins[:-1])
        return (mixed(hashed) % np.uint64(n)).astype(np.int64)


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers, none below zero, in as few bytes each as the largest needs."""
    size = next(k for k in (1, 2, 4, 8) if k == 8 or not len(x) or int(x.max()) < 1 << (8 * k))
    return bytes([size]) + x.astype(f"<u{size}").tobytes()


def widened(rows: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows, and how many each row has."""
    parts = [np.frombuffer(x, f"<u{x[0]}", offset=1).astype(np.int64) for x in rows.to_pylist()]
    return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


#: Words of one row: the words with blanks between, numbers of gates, gates and learned counts.
WORDS = {"words": pa.string(), "n_gates": pa.binary(), "gates": pa.binary(), "learned": pa.binary()}
WORDS_SCHEMA = "words string, n_gates binary, gates binary, learned binary"


def packed_words(words: pa.Array, cuts: np.ndarray, n_gates: np.ndarray, gates: np.ndarray, learned: np.ndarray) -> dict:
    """``WORDS`` of the rows between ``cuts`` (of the words, from none to all)."""
    pair_cuts = np.concatenate([[0], np.cumsum(n_gates)])[cuts]
    each = lambda x, at: pa.array([narrow(x[lo:hi]) for lo, hi in pairwise(at)], pa.binary())
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words), " ")
    return {"words": texts, "n_gates": each(n_gates, cuts), "gates": each(gates, pair_cuts), "learned": each(learned, pair_cuts)}


def unpacked_words(rows: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all rows, numbers of gates, gates, learned counts; pairs of each row."""
    texts = pc.split_pattern(rows.column("words").combine_chunks(), " ")
    (n_gates, _), (gates, n_pairs), (learned, _) = (widened(rows.column(c)) for c in ("n_gates", "gates", "learned"))
    return (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).flatten(), n_gates, gates, learned, n_pairs


def common_words(docs: DataFrame, learn: Column) -> tuple[list[str], np.ndarray]:
    """The most common words of the learned texts and their bytes' counts. Each block names
    its ``COMMON`` most common ones; a word among the few most common of all texts is among
    so many of every block that has it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text"):
                codes, distinct, _ = coded_words(batch.column("text"), lower=True)
                n = np.bincount(codes, minlength=len(distinct))
                often = np.flatnonzero(n >= np.sort(n)[-COMMON]) if len(n) > COMMON else np.arange(len(n))
                names = dict(zip(often.tolist(), distinct.take(pa.array(often)).to_pylist(), strict=True))
                top = sorted(names, key=lambda k: (-n[k], names[k]))[:COMMON]
                spelled, begins = letters(distinct)
                raw = np.bincount(spelled, weights=np.repeat(n, np.diff(begins)), minlength=256).astype(np.int64)
                raw[ord(" ")] += n.sum()
                rows = [(names[k], n[k]) for k in top]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows] + [None] * 256, pa.string()), pa.array([None] * len(rows) + list(range(256)), pa.int32()), pa.array([int(r[1]) for r in rows] + raw.tolist(), pa.int64())], names=["word", "byte", "n"]
                )

    sums = docs.where(learn).select("text").mapInArrow(count, "word string, byte int, n long").groupBy("word", "byte").agg(F.sum("n").alias("n"))
    sums = stage(sums, "common_words")
    top = sums.where("word IS NOT NULL").orderBy(F.desc("n"), "word").limit(GATES).collect()
    counts = np.zeros(256, np.int64)
    for r in sums.where("byte IS NOT NULL").collect():
        counts[r["byte"]] = r["n"]
    return [r["word"] for r in top], counts


def postings(docs: DataFrame, learn: Column, gates: list[str], n_buckets: int) -> DataFrame:
    """Rows of two kinds. A block's words of one bucket (words are dealt by hash), in order: the
    number of gates each is met behind, these gates, learned counts for each (word, gate). A
    block (bucket NULL): its documents, and for each of its (word, gate) pairs, in the order of
    buckets and words, how many documents have it, then which (numbers) and how often."""
    given, longs, raw = pa.array(gates, pa.string()), pa.list_(pa.int64()), pa.binary()
    kinds = {"block": pa.int64(), "bucket": pa.int32()} | WORDS | {"doc_ids": longs, "doc_learned": pa.list_(pa.bool_()), "n_tokens": longs, "n_bytes": longs, "n_docs": raw, "docs": raw, "counts": raw}

    def rows_of(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[c].cast(kind) if c in columns else pa.nulls(n, kind) for c, kind in kinds.items()], names=list(kinds))

    def one(values) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in blocks(whole, "text"):
                block, number = (task << 24) + number, number + 1
                codes, distinct, n_words = coded_words(batch.column("text"), lower=True)
                n_docs, end = len(n_words), len(distinct)
                distinct = pa.concat_arrays([distinct.cast(pa.string()), pa.array(["\n"])])
                in_bucket = dealt(distinct, n_buckets)
                # Words of a bucket in order: neighbours share beginnings, which makes the tables small.
                order = pc.sort_indices(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
                order = order[np.argsort(in_bucket[order], kind="stable")]
                at = np.empty(len(order), np.int64)
                at[order] = np.arange(len(order))
                distinct, in_bucket = distinct.take(pa.array(order)), in_bucket[order]
                own = pc.fill_null(pc.index_in(distinct, given), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
                size = pc.binary_length(distinct).to_numpy(zero_copy_only=False) + 1
                size[at[end]] = 1
                # Every document's words and then its end, in one row.
                flat = np.full(len(codes) + n_docs, at[end], np.int64)
                flat[np.arange(len(codes)) + np.repeat(np.arange(n_docs), n_words)] = at[codes]
                owner = np.repeat(np.arange(n_docs), n_words + 1)
                first = np.concatenate([[0], np.cumsum(n_words + 1)[:-1]])[owner]
                # The gate of a token: the last gate word before it in its document.
                seen = np.where(own[flat] > 0, np.arange(len(flat)), -1)
                last = np.concatenate([[-1], np.maximum.accumulate(seen)[:-1]])
                gate = np.where(last >= first, own[flat[np.maximum(last, 0)]], 0)
                key, count = np.unique((flat * (GATES + 1) + gate) * n_docs + owner, return_counts=True)
                pair, doc = np.divmod(key, n_docs)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(pair)) + 1])
                n_having, pair = np.diff([*cuts, len(doc)]), pair[cuts]
                learned = np.add.reduceat(np.where(batch.column("learn").to_numpy(zero_copy_only=False)[doc], count, 0), cuts)
                n_gates = np.bincount(pair // (GATES + 1), minlength=end + 1)
                there = np.unique(in_bucket)
                by_word = np.searchsorted(in_bucket, [*there, n_buckets])
                yield rows_of(len(there), block=pa.array(np.full(len(there), block)), bucket=pa.array(there), **packed_words(distinct, by_word, n_gates, pair % (GATES + 1), learned))
                n_bytes = np.bincount(owner, weights=size[flat], minlength=n_docs).astype(np.int64)
                tight = {k: pa.array([narrow(x)], pa.binary()) for k, x in (("n_docs", n_having), ("docs", doc), ("counts", count))}
                yield rows_of(1, block=pa.array([block]), doc_ids=one(batch.column("doc_id")), doc_learned=one(batch.column("learn")), n_tokens=one(n_words + 1), n_bytes=one(n_bytes), **tight)

    schema = f"block long, bucket int, {WORDS_SCHEMA}, doc_ids array<long>, doc_learned array<boolean>, n_tokens array<long>, n_bytes array<long>, n_docs binary, docs binary, counts binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", learn.alias("learn")).mapInArrow(post, schema)


def summed_words(rows: DataFrame) -> DataFrame:
    """Rows of two kinds. A word: its bucket, its number there (in order), learned count, gates
    and learned count for each. A block's part of a bucket (word NULL): the numbers of its
    (word, gate) pairs among those of the bucket, as steps from one to the next."""

    def add(bucket: pa.Table) -> pa.Table:
        key = bucket.column("bucket")[0].as_py()
        texts, n_gates, gates, counts, n_pairs = unpacked_words(bucket)
        coded = texts.dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        word = np.repeat(rank[coded.indices.to_numpy(zero_copy_only=False)], n_gates)
        pairs, which = np.unique(word * (GATES + 1) + gates, return_inverse=True)
        learned = np.bincount(which, weights=counts).astype(np.int64)
        cuts = np.searchsorted(pairs // (GATES + 1), np.arange(len(order) + 1))
        sums = np.add.reduceat(learned, cuts[:-1])
        lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))
        ends = np.concatenate([[0], np.cumsum(n_pairs)])
        steps = [narrow(np.diff(which[lo:hi], prepend=0)) for lo, hi in pairwise(ends)]  # they ascend
        n, m = len(order), len(n_pairs)
        both = lambda x, y: pa.chunked_array([x, y])
        return pa.table({
            "bucket": pa.array(np.full(n + m, key), pa.int32()),
            "number": both(pa.array(np.arange(n), pa.int32()), pa.nulls(m, pa.int32())),
            "word": both(coded.dictionary.take(pa.array(order)), pa.nulls(m, pa.string())),
            "c": both(pa.array(sums, pa.int64()), pa.nulls(m, pa.int64())),
            "gates": both(lists(pairs % (GATES + 1), pa.int32()), pa.nulls(m, pa.list_(pa.int32()))),
            "learned": both(lists(learned, pa.int64()), pa.nulls(m, pa.list_(pa.int64()))),
            "block": both(pa.nulls(n, pa.int64()), bucket.column("block").combine_chunks()),
            "steps": both(pa.nulls(n, pa.binary()), pa.array(steps, pa.binary())),
        })

    parts = rows.where("bucket IS NOT NULL").select("bucket", "block", *WORDS)
    return parts.groupBy("bucket").applyInArrow(add, "bucket int, number int, word string, c long, gates array<int>, learned array<long>, block long, steps binary")


def word_batches(batch: pa.RecordBatch, learned_only: bool, size: int) -> Iterator[tuple]:
    """(words with marks, gates, learned counts, pairs of each word) of the (word, gate) pairs
    of ``size`` words at a time; batches without a pair only if all are wanted."""
    for lo in range(0, len(batch), size):
        part = batch.slice(lo, size)
        lists = part.column("gates")
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(n)), n)
        gate, learned = lists.flatten().to_numpy(zero_copy_only=False), part.column("learned").flatten().to_numpy(zero_copy_only=False)
        use = learned > 0 if learned_only else np.ones(len(gate), bool)
        words = marked(part.column("word"))
        if use.any() or not learned_only:
            yield [words[o] for o in owner[use]], gate[use].astype(np.int64), learned[use].astype(np.float32), n


def packed_counts(counts: np.ndarray) -> bytes:
    """Whole numbers bit by bit of their place value, compressed: most are zero or small."""
    places = max(1, int(counts.max()).bit_length())
    planes = [np.packbits((counts.reshape(-1) >> np.uint64(p)) & np.uint64(1) > 0) for p in range(places)]
    return bytes([places]) + zlib.compress(np.concatenate(planes).tobytes(), 1)


def unpacked_counts(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    return sum(np.unpackbits(x).astype(np.uint64) << np.uint64(p) for p, x in enumerate(planes))


def hashed_sums(words: DataFrame, model: Model, tables: int, add_batch) -> np.ndarray:
    """Tables of hashed sums over all learned words, as count codes, side by side. Tasks send
    the chunks of the tables that they touched, compressed; where more than ``SUMMED`` tasks
    do, chunks are summed in two steps, so that no group holds more than that or the root of
    their number."""

    tasks = words.rdd.getNumPartitions()
    mergers = 1 if tasks <= SUMMED else int(np.ceil(np.sqrt(tasks)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((1 << model.bits, tables), np.uint32)
        with np.errstate(over="ignore"):
            for batch in batches:
                for spelled, gate, weight, _ in word_batches(batch, True, WORDS_AT_ONCE):
                    text = spell(spelled, gate)
                    once, which = distinct_bytes(text)
                    add_batch(sums, once, np.bincount(which, weights=weight[text.owner]).astype(np.uint32), model)
        part = TaskContext.get().partitionId() % mergers
        for chunk in range(0, 1 << model.bits, CHUNK):
            piece = sums[chunk : chunk + CHUNK]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([part], pa.int32()), pa.array([packed_counts(piece.astype(np.uint64))], pa.binary())], names=["chunk", "part", "counts"])

    def total(group: pa.Table) -> np.ndarray:
        return sum(unpacked_counts(x.as_py()) for x in group.column("counts"))

    def add(group: pa.Table) -> pa.Table:
        return pa.table({"chunk": group["chunk"][:1], "part": group["part"][:1], "counts": pa.array([packed_counts(total(group))], pa.binary())})

    def coded(group: pa.Table) -> pa.Table:
        return pa.table({"chunk": group["chunk"][:1], "counts": pa.array([count_code(total(group)).tobytes()], pa.binary())})

    sent = words.where("c > 0").select("word", "gates", "learned").mapInArrow(count, "chunk int, part int, counts binary")
    if mergers > 1:
        sent = sent.groupBy("chunk", "part").applyInArrow(add, "chunk int, part int, counts binary")
    scratch = Scratch(words.sparkSession)
    rows = scratch.put(sent.groupBy("chunk").applyInArrow(coded, "chunk int, counts binary"), "hashed_sums").collect()
    scratch.drop("hashed_sums")
    out = np.zeros((1 << model.bits, tables), np.uint8)
    for r in rows:
        out[r["chunk"] : r["chunk"] + CHUNK] = np.frombuffer(r["counts"], np.uint8).reshape(-1, tables)
    return out


def mixing(words: DataFrame, held, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights and map, trained online on all learned words. Words are dealt by hash into
    slices of about ``SLICE_WORDS``; a slice is one run, in a fixed mingled order of its
    words, from the same start.
    Weights are averaged by the words seen, maps are added up."""
    sizes = (len(LEVELS) ** 2 * CONTEXTS, 256 * CONTEXTS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch.column("slice")))
            slices, first = np.unique(batch.column("slice").to_numpy(zero_copy_only=False), return_index=True)
            n_gates = pc.list_value_length(batch.column("gates")).to_numpy(zero_copy_only=False)
            flat = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("gates", "learned"))
            rows = packed_words(batch.column("word"), np.append(first, len(batch)), n_gates, *flat)
            yield pa.RecordBatch.from_arrays([pa.array(slices), *rows.values()], names=["slice", *rows])

    def learn(slice_: pa.Table) -> pa.Table:
        model, total, step = fresh(held.value), 0.0, 0
        start = model.refined.copy()
        texts, n_gates, gates, learned, _ = unpacked_words(slice_)
        ends = pa.array(np.concatenate([[0], np.cumsum(n_gates)]), pa.int32())
        ordered = pa.table({"word": texts, "gates": pa.ListArray.from_arrays(ends, pa.array(gates)), "learned": pa.ListArray.from_arrays(ends, pa.array(learned))}).sort_by("word")
        ordered = ordered.take(np.random.default_rng(0).permutation(len(ordered))).combine_chunks()
        with np.errstate(over="ignore"):
            for batch in ordered.to_batches():
                for spelled, gate, weight, _ in word_batches(batch, True, WORDS_A_BATCH):
                    text = spell(spelled, gate)
                    once, which = distinct_bytes(text)
                    train(once, gate, np.bincount(which, weights=weight[text.owner]), model, RATE / (1 + step / 20) + 0.01)
                    total, step = total + weight.sum(dtype=np.float64), step + 1
        flat = np.concatenate([model.by_place.ravel() * total, model.by_node.ravel() * total, (model.refined - start).ravel(), [total]])
        return pa.table({"at": pa.array(np.arange(len(flat)), pa.int32()), "value": pa.array(flat)})

    n_slices = max(1, -(-n_words // SLICE_WORDS))
    shared = words.where("c > 0").select("word", "gates", "learned", F.pmod(F.xxhash64("word", F.lit("mixing")), F.lit(n_slices)).cast("int").alias("slice")).mapInArrow(deal, f"slice int, {WORDS_SCHEMA}")
    sums = shared.groupBy("slice").applyInArrow(learn, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    model = fresh(Model([], None, 0))
    if len(sums):
        flat = np.zeros(len(sums))
        flat[sums["at"]] = sums["value"]
        a, b = sizes[0], sum(sizes)
        model.by_place = flat[:a].reshape(model.by_place.shape) / flat[-1]
        model.by_node = flat[a:b].reshape(model.by_node.shape) / flat[-1]
        model.refined = model.refined + flat[b:-1].reshape(model.refined.shape)
    return model.by_place, model.by_node, model.refined


def scored_words(words: DataFrame, held) -> DataFrame:
    """Rows of neighbouring words of a bucket: their numbers, learned counts, numbers of gates,
    and log10 probabilities for each of these."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        with np.errstate(over="ignore"):
            for whole in batches:
                logs, n = [np.zeros(0)], [np.zeros(0, np.int64)]
                for spelled, gate, _, pairs in word_batches(whole, False, WORDS_AT_ONCE):
                    logs.append(log10_of(spell(spelled, gate), gate, len(spelled), model))
                    n.append(pairs)
                logs, n = np.concatenate(logs).astype("<f4"), np.concatenate(n)
                bucket, number, c = (whole.column(k).to_numpy(zero_copy_only=False) for k in ("bucket", "number", "c"))
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
                pair_cuts = np.concatenate([[0], np.cumsum(n)])[cuts]
                each = [pa.array([narrow(x[lo:hi]) for lo, hi in pairwise(cuts)], pa.binary()) for x in (number, c, n)]
                scores = pa.array([logs[lo:hi].tobytes() for lo, hi in pairwise(pair_cuts)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]]), *each, scores], names=["bucket", "number", "c", "n_gates", "logs"])

    return words.select("bucket", "number", "word", "c", "gates", "learned").mapInArrow(score, "bucket int, number binary, c binary, n_gates binary, logs binary")


def returned(scored: DataFrame, places: DataFrame) -> DataFrame:
    """For each block and bucket: logs and learned counts of the block's (word, gate) pairs."""

    def look_up(words: pa.Table, parts: pa.Table) -> pa.Table:
        (number, _), (c, _), (n, _) = (widened(words.column(k)) for k in ("number", "c", "n_gates"))
        logs = np.concatenate([np.frombuffer(x, "<f4") for x in words.column("logs").to_pylist()])
        order = np.argsort(number, kind="stable")
        logs, counts = logs[ragged((np.cumsum(n) - n)[order], n[order])], np.repeat(c[order], n[order])
        steps, n_pairs = widened(parts.column("steps"))
        ends = np.concatenate([[0], np.cumsum(n_pairs)])
        upto = np.concatenate([[0], np.cumsum(steps)])
        which = [upto[lo + 1 : hi + 1] - upto[lo] for lo, hi in pairwise(ends)]
        return pa.table({
            "block": parts.column("block"), "bucket": parts.column("bucket"),
            "logs": pa.array([logs[x].tobytes() for x in which], pa.binary()), "learned": pa.array([narrow(counts[x]) for x in which], pa.binary()),
        })

    pairs = scored.groupBy("bucket").cogroup(places.groupBy("bucket"))
    return pairs.applyInArrow(look_up, "block long, bucket int, logs binary, learned binary")


def summed_texts(rows: DataFrame, back: DataFrame, n: int, v: int) -> DataFrame:
    """One row for each document of each block, from its block's pairs."""

    def add(block: pa.Table, parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("bucket")
        ids = pc.list_flatten(block.column("doc_ids"))
        (counts, _), (docs, _), (n_docs, _) = (widened(block.column(k)) for k in ("counts", "docs", "n_docs"))
        (c, _), logs = widened(parts.column("learned")), np.concatenate([np.frombuffer(x, "<f4") for x in parts.column("logs").to_pylist()])
        sums = lambda x: np.bincount(docs, weights=counts * np.repeat(x, n_docs), minlength=len(ids))
        return pa.table({
            "doc_id": ids, "learned": pc.list_flatten(block.column("doc_learned")), "n_tokens": pc.list_flatten(block.column("n_tokens")),
            "n_known": pa.array(sums(c > 0).astype(np.int64)), "base_score": pa.array(sums(np.log10((c + 0.5) / (n + 0.5 * (v + 1))))),
            "score": pa.array(sums(logs.astype(np.float64))), "n_bytes": pc.list_flatten(block.column("n_bytes")),
        })

    held = rows.where("bucket IS NULL").select("block", "doc_ids", "doc_learned", "n_tokens", "n_bytes", "n_docs", "docs", "counts")
    schema = "doc_id long, learned boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
    return held.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(add, schema)


def score_texts(docs: DataFrame, learn: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id, learned, n_tokens, n_known, train_tokens,
    base_score (smoothed unigrams), score (the mixing model), ``bits``, ``n_bytes`` (of its
    words, each with its mark) and ``bits_per_byte``. ``learn`` says which texts may be
    learned from."""
    spark = docs.sparkSession
    gates, bytes_ = common_words(docs, learn)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rows = stage(postings(docs, learn, gates, 1 + size // BUCKET_BYTES), "postings")
    summed = stage(summed_words(rows), "words")
    words, places = summed.where("word IS NOT NULL").drop("block", "steps"), summed.where("word IS NULL").select("bucket", "block", "steps")
    n, v, all_words = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count("*")).first()
    model = Model(gates, prefix_code(bytes_), int(min(MOST_BITS, max(16, np.ceil(np.log2(all_words + 1)) + 3))))
    model.admitted = hashed_sums(words, model, 1, add_uses)[:, 0] >= ADMIT
    model.both = hashed_sums(words, model, 2, add_counts).view("<u2")[:, 0]
    model.admitted = None  # it only decides what is counted
    held = spark.sparkContext.broadcast(model)
    model.by_place, model.by_node, model.refined = mixing(words, held, v)
    held = spark.sparkContext.broadcast(model)
    scored = stage(scored_words(words, held), "scored_words")
    bits = -F.col("score") / np.log10(2.0)
    return summed_texts(rows, returned(scored, places), n, v).select(
        "doc_id", "learned", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits"), "n_bytes", (bits / F.col("n_bytes")).alias("bits_per_byte")
    )
