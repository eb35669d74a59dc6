"""Best-fit packing planned on the histogram of lengths.

Only the number of pieces of every length reaches the driver: at most ``capacity``
rows, whatever the corpus. Best fit decreasing runs over those counts: equal pieces go
into equally filled sequences all at once. The plan says, for every length, which
ranks take which sequences at which offset; each piece learns its rank within its
length from two-level counts (so a length that a third of the pieces share is not one
task's work) and takes its slot.

Defined results: NULL text is empty; an empty text is its closing id alone. Pieces of
one length are interchangeable, so ties and repeated rows change nothing but who takes
which slot. An empty table packs to no rows. Input columns are not carried.
"""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import blocks, coded_words, ragged, remembered, running_total, stage

CAPACITY = 4096
END = 1  # id that closes every document
REMEMBERED = 600_000  # distinct words whose ids a worker keeps from block to block
PACKED_BYTES = 2 << 20  # text worked on at once: its words and ids take many times as much
AT_ONCE = 4096  # words encoded in one call: encodings are far larger than their ids
MARKS = ".,;:!?"
PLAIN = r"^\p{L}+[.,;:!?]?$"  # words that can be encoded many at a time
RANK_CELLS = 1024  # pieces of one length are ranked in so many cells


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of words, remembered between blocks. The tokenizer drops white space and
    never joins what white space parts, so words can be encoded one by one, or many as one
    text where the ids show where each ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.slots: dict[str, int] = {}  # word -> place in ``first`` and ``n``
        self.first, self.n, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # Letters and a mark after them are parts of their own, each closed by an id that shows it.
        self.joins = [int(self.ends[e.ids].sum()) for e in self.tokenizer.encode_batch_fast(["a", "a,"], add_special_tokens=False)] == [1, 2]

    def one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        n = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(itertools.chain.from_iterable(each), np.uint32, int(n.sum())), n

    def as_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters, with one mark behind them at most, as one text. Each part has at
        least one closing id, so as many as there are parts means one each."""
        parts = np.fromiter((1 if w[-1] not in MARKS else 2 for w in words), np.int64, len(words))
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        closing = np.flatnonzero(self.ends[ids])
        if len(closing) != parts.sum():
            return self.one_by_one(words)
        return ids, np.diff(closing[np.cumsum(parts) - 1] + 1, prepend=0)

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        """Ids of all words in one array, how many each has, the words in that order, and
        where in ``words`` each was."""
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False) if self.joins else np.zeros(len(words), bool)
        places = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        order, n_plain = words.take(pa.array(places)).to_pylist(), int(plain.sum())
        ids, n = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for low, high, encode in ((0, n_plain, self.as_one), (n_plain, len(order), self.one_by_one)):
            for k in range(low, high, AT_ONCE):
                some_ids, some_n = encode(order[k : min(k + AT_ONCE, high)])
                ids.append(some_ids)
                n.append(some_n)
        return np.concatenate(ids), np.concatenate(n), order, places

    def of(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all remembered words in one array; where those of ``distinct`` begin; how many."""
        words = distinct.to_pylist()
        slots = np.fromiter(map(self.slots.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = slots < 0
        if new.any():
            if len(self.slots) + int(new.sum()) > REMEMBERED:  # only what this block uses stays
                kept, order = slots[~new], list(itertools.compress(words, ~new))
                ids, n = self.pool[ragged(self.first[kept], self.n[kept])], self.n[kept]
                self.slots = dict(zip(order, range(len(order)), strict=True))
                slots[~new] = np.arange(len(order))
            else:
                ids, n = self.pool, self.n
            new_ids, new_n, new_words, places = self.encoded(distinct.filter(pa.array(new)))
            begin = len(self.slots)
            self.slots.update(zip(new_words, range(begin, begin + len(new_words)), strict=True))
            self.pool, self.n = np.concatenate([ids, new_ids]), np.concatenate([n, new_n])
            self.first = np.cumsum(self.n) - self.n
            slots[np.flatnonzero(new)[places]] = begin + np.arange(len(new_words))
        return self.pool, self.first[slots], self.n[slots]


def word_ids(path: str) -> WordIds:
    return remembered(WordIds, path)


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Every document's ids and the closing id, cut only where longer than ``capacity``:
    doc_id, piece, start, length, ids_crc32."""
    tokenizer = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text", PACKED_BYTES):
                codes, distinct, n_words = coded_words(batch.column("text"), lower=False)
                flat, first, n = word_ids(tokenizer).of(distinct)
                ids = flat[ragged(first[codes], n[codes])].astype("<u4")
                ends = np.cumsum(n[codes]) if len(codes) else np.zeros(0, np.int64)
                ends = np.concatenate([[0], ends])[np.cumsum(n_words)]
                doc, rows = batch.column("doc_id").to_pylist(), defaultdict(list)
                begin = 0
                for k, end in enumerate(ends):
                    own = np.append(ids[begin:end], np.array([END], "<u4"))
                    begin = end
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        for name, value in zip(("doc_id", "piece", "start", "length", "ids_crc32"), (doc[k], piece, start, len(part), zlib.crc32(part.tobytes())), strict=True):
                            rows[name].append(value)
                yield pa.RecordBatch.from_pydict(rows, schema=schema)
                del codes, distinct, flat, first, n, ids, rows
                pa.default_memory_pool().release_unused()

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best fit decreasing over counts. Rows (length, first rank, number, first sequence,
    offset): the pieces ranked first..first+number-1 take that many sequences, one each.
    And the number of sequences. The work depends on the lengths, not on the counts."""
    plan: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> (first sequence, number), all equally full
    free: list[int] = []  # its keys in order
    opened = 0

    def put(left: int, first: int, number: int) -> None:
        if left and number:
            if left not in room:
                insort(free, left)
                room[left] = []
            room[left].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            at = bisect_left(free, length)
            if at == len(free):  # none fits: open as many as these pieces fill
                fit = capacity // length
                full, odd = divmod(rest, fit)
                for first, number, each in ((opened, full, fit), (opened + full, 1 if odd else 0, odd)):
                    for k in range(each if number else 0):
                        plan.append((length, rank, number, first, k * length))
                        rank += number
                    put(capacity - each * length, first, number)
                opened += full + bool(odd)
                break
            left = free[at]
            first, number = room[left].pop()
            if not room[left]:
                del room[left], free[at]
            used = min(number, rest)
            plan.append((length, rank, used, first, capacity - left))
            put(left, first + used, number - used)
            put(left - length, first, used)
            rank, rest = rank + used, rest - used
    return plan, opened


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (a stored table with a ``length`` of 1 to ``capacity``) plus sequence_id and offset."""
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan, _ = best_fit(counts, capacity)
    by_length: dict[int, list] = defaultdict(list)
    for length, *row in plan:
        by_length[length].append(row)
    slots = spark.sparkContext.broadcast({length: np.array(sorted(rows), np.int64) for length, rows in by_length.items()})
    keyed = cut.withColumn("_one", F.lit(1).cast("long")).withColumn("_order", F.xxhash64("doc_id", "piece"))
    cell = F.floor((F.col("_order") / F.lit(2.0**63) + 1) * (RANK_CELLS / 2))
    ranked = running_total(keyed, ["length"], ["_order", "doc_id", "piece"], cell, "_one", "_rank").drop("_one", "_order")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                rows, table = np.flatnonzero(length == n), slots.value[int(n)]
                at = np.searchsorted(table[:, 0], rank[rows], side="right") - 1
                sequence[rows] = table[at, 2] + rank[rows] - table[at, 0]
                offset[rows] = table[at, 3]
            kept = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row for each piece of each document, with the place it takes."""
    return pack(stage(pieces(docs, capacity, tokenizer), "pieces"), capacity)
