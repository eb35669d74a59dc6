"""Phrases counted by an FM-index per shard, and the collocations among them.

Documents are cut into shards of about ``SHARD_WORDS`` words of one language; a shard's words
are numbered and its text and reversed text are each kept as a Burrows-Wheeler transform, the
two of a bidirectional FM-index. A phrase is an interval in both: extending it by a word on one
side is a step through that side's transform, and what sorts before that word moves the other
interval. Phrases grow by a word on the right, then on the left, in turn. An extension counts
only if its other end is in the level before, which its new interval tells: it must lie in the
interval of a phrase one word shorter.

Shards tell phrases as 62-bit hashes with counts, sorted, as gaps; these are summed in parts of
the range of hashes (as many as the words call for), and every shard hears which of its hashes
are frequent. First come all words and pairs; then phrases of three words or more whose pairs
are all frequent (a longer phrase is no more frequent than its pairs, so none is missed). In the
end one shard names each frequent phrase. Indexes are stored by shard and never shuffled.
Equal hashes are taken as equal phrases.

A shard is one row and one task's work at a time; language and words may be as skewed as they
like.

Defined results: NULL text is empty; a NULL language is ``und``. Texts without words give
nothing. Repeated rows count as often as they occur. A text is cut into shards only between
texts, so one longer than a shard makes a longer shard. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import blocks, mixed, ragged, stage, stage_by

SHARD_WORDS = 1 << 20
BREAK = r"[.,;:!?\x0A-\x0D]"  # ends a piece; no word holds a ".", so it stands for all of them
INDEX = "shard long, lang string, n long, words array<string>, forward array<int>, backward array<int>"
SCORE = """(CAST(1000 AS DECIMAL(4,0)) * CAST(f AS DECIMAL(15,0)) * CAST(n AS DECIMAL(19,0)))
    div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"""  # exact: products have up to 38 digits
HASHES = "shard long, lang string, part int, gaps array<long>, n array<int>"
HEARD = "shard long, keys array<long>, f array<long>"  # f: total of a hash this shard is to name, else 0
NAMED = "lang string, phrase string, words int, f long"
PART_WORDS = 8 << 20  # words for each part of the hashes
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def transform_of(ids: np.ndarray, depth: int) -> np.ndarray:
    """The Burrows-Wheeler transform of ``ids``, which end with a 0, its rows sorted by their
    first ``depth`` words at least (by prefix doubling; ties in text order)."""
    rank, reach = ids.astype(np.int64), 1
    while reach < depth:
        after = np.concatenate([rank[reach:], np.zeros(min(reach, len(rank)), np.int64)])
        _, rank = np.unique(rank * (after.max(initial=0) + 1) + after, return_inverse=True)
        reach *= 2
    return ids[np.argsort(rank, kind="stable") - 1]


def words_of(texts: pa.Array) -> pa.Array:
    """The words of all texts in order, a "." after every piece and every text."""
    lowered = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    dot, space = (pa.scalar(s, pa.large_string()) for s in ". ")
    ended = pc.binary_join_element_wise(pc.replace_substring_regex(lowered, BREAK, " . "), dot, space)
    flat = pc.ascii_split_whitespace(ended).flatten()
    return flat.filter(pc.greater(pc.binary_length(flat), 0))


def index_shards(docs: DataFrame, depth: int, shard_words: int) -> DataFrame:
    """One row per shard: its language, its words, the transforms of its text both ways."""

    def build(shard: int, lang: str, parts: list[pa.Array]) -> pa.RecordBatch:
        coded = pa.chunked_array(parts).combine_chunks().dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        stop = words.index(".").as_py()
        ids = np.where(codes == stop, 0, codes + 1).astype(np.int32)
        both = [transform_of(ids, depth), transform_of(np.concatenate([ids[-2::-1], ids[-1:]]), depth)]
        return table_of(INDEX, [shard], [lang], [np.count_nonzero(ids)], [words.cast(pa.string())], *[[b] for b in both])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[pa.Array]] = {}
        shard = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in blocks(whole, "text"):
                langs = pc.fill_null(batch.column("lang"), "und")
                for lang in pc.unique(langs).to_pylist():
                    parts = waiting.setdefault(lang, [])
                    parts.append(words_of(batch.column("text").filter(pc.equal(langs, lang))))
                    if sum(map(len, parts)) >= shard_words:
                        yield build(shard, lang, waiting.pop(lang))
                        shard += 1
        for lang, parts in waiting.items():
            yield build(shard, lang, parts)
            shard += 1

    return docs.select("text", "lang").mapInArrow(index, INDEX)


def word_codes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def table_of(schema: str, *columns) -> pa.RecordBatch:
    """A record batch of a schema of plain names and types."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    names, types = zip(*[field.split(" ") for field in schema.split(", ")], strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) if not isinstance(c, pa.Array) else c.cast(kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def steps(bwt: np.ndarray) -> np.ndarray:
    """From each row of the index to the row of the text one word longer."""
    step = np.empty(len(bwt), np.int64)
    step[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    return step


def extended(bwt: np.ndarray, step: np.ndarray, lo: np.ndarray, other: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Extend intervals of ``bwt`` by the word it holds. Returns, per extension: which interval,
    which word, its own and its other interval's begin, its count. Only extensions that lie in
    one of the given intervals are returned."""
    inside = np.zeros(len(bwt) + 1, np.int64)
    np.add.at(inside, lo, 1)
    np.add.at(inside, lo + size, -1)
    inside = np.cumsum(inside) > 0
    rows, owner = ragged(lo, size), np.repeat(np.arange(len(lo)), size)
    key = owner * (int(bwt.max(initial=0)) + 1) + bwt[rows]
    by_word = np.argsort(key, kind="stable")
    rows, key = rows[by_word], key[by_word]  # owners are sorted already
    first = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0])) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(key)))
    owner, word, begin = owner[first], bwt[rows[first]], step[rows[first]]
    smaller = first - (np.cumsum(size) - size)[owner]  # rows of the interval with smaller words
    real = (word > 0) & inside[begin]
    return owner[real], word[real], begin[real], (other[owner] + smaller)[real], n[real]


def key_of(code: np.ndarray) -> np.ndarray:
    return (code >> np.uint64(2)).view(np.int64)


def levels(words: pa.Array, forward: np.ndarray, backward: np.ndarray, depth: int, heard: np.ndarray | None = None, heard_words: int = 0) -> Iterator[tuple]:
    """A shard's phrases by length: (hashes, counts, word numbers by place). Phrases of up to
    ``heard_words`` words are kept, and extended, if their hash is in ``heard``."""
    of_word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))
    # Numbers follow the dictionary, in which "." has a place but no number of its own.
    n = np.bincount(forward, minlength=len(words) + 1)
    lo, number = np.cumsum(n) - n, np.flatnonzero(n[1:]) + 1
    ends, n, code, phrase = [lo[number], lo[number]], n[number], mixed(of_word[number - 1]), [number]
    sides = [(forward, steps(forward)), (backward, steps(backward))]
    for size in range(1, depth + 1):
        if size > 1:
            right = 1 - size % 2
            owner, word, begin, beside, n = extended(*sides[right], ends[right], ends[1 - right], n)
            ends = [beside, begin] if right else [begin, beside]
            with np.errstate(over="ignore"):
                code = mixed(code[owner] * K1 + of_word[word - 1] * K2)
            phrase = [p[owner] for p in phrase]
            phrase.insert(len(phrase) if right else 0, word)
        if size <= heard_words:
            kept = np.flatnonzero(np.isin(key_of(code), heard))
            ends, n, code, phrase = [e[kept] for e in ends], n[kept], code[kept], [p[kept] for p in phrase]
        yield key_of(code), n, phrase


def table_of(schema: str, *columns) -> pa.RecordBatch:
    """A record batch of a schema of plain names and types."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    names, types = zip(*[field.split(" ") for field in schema.split(", ")], strict=True)
    return pa.RecordBatch.from_arrays([c.cast(kinds[t]) if isinstance(c, pa.Array) else pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def runs(first: np.ndarray, end: int) -> list[tuple[int, int]]:
    """(begin, end) of the runs that begin at ``first``."""
    edges = np.append(first, end)
    return list(zip(edges[:-1], edges[1:], strict=True))


def told(shard: int, lang: str, found: list[tuple], parts: int) -> pa.RecordBatch:
    """One row per part of the hashes."""
    key, of = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    n = np.bincount(of, weights=np.concatenate([f[1] for f in found]), minlength=len(key)).astype(np.int64)
    part = key % parts
    order = np.argsort(part, kind="stable")
    key, n = key[order], n[order]
    some, first = np.unique(part[order], return_index=True)
    cuts = runs(first, len(key))
    return table_of(HASHES, [shard] * len(some), [lang] * len(some), some, [np.diff(key[lo:hi], prepend=0) for lo, hi in cuts], [n[lo:hi] for lo, hi in cuts])


def opened(shards: pa.Table | pa.RecordBatch, row: int = 0) -> tuple:
    """A shard's id, language, words and transforms."""
    lists = [shards.column(c)[row].values for c in ("words", "forward", "backward")]
    return shards.column("shard")[row].as_py(), shards.column("lang")[row].as_py(), lists[0], lists[1].to_numpy(), lists[2].to_numpy()


def frequent_hashes(hashes: DataFrame, least: int) -> DataFrame:
    """(shard, keys, f): the hashes of every shard that occur ``least`` times in all of its language."""

    def agree(group: pa.Table) -> pa.Table:
        keys = [np.cumsum(gaps.values.to_numpy()) for gaps in group.column("gaps").combine_chunks()]
        n = np.concatenate([ns.values.to_numpy() for ns in group.column("n").combine_chunks()])
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        key = np.concatenate(keys)
        every, first, of = np.unique(key, return_index=True, return_inverse=True)
        f = np.bincount(of, weights=n).astype(np.int64)
        names = np.zeros(len(key), np.int64)
        names[first] = f
        kept = f[of] >= least
        key, names, owner = key[kept], names[kept], owner[kept]
        some, first = np.unique(owner, return_index=True)
        cuts = runs(first, len(key))
        shard = group.column("shard").combine_chunks().take(pa.array(some, pa.int64()))
        return pa.Table.from_batches([table_of(HEARD, shard, [key[lo:hi] for lo, hi in cuts], [names[lo:hi] for lo, hi in cuts])])

    return stage(hashes.groupBy("lang", "part").applyInArrow(agree, HEARD), "frequent_hashes")


def phrase_counts(docs: DataFrame, least: int, depth: int = 5, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f): all phrases of up to ``depth`` words that occur ``least`` times
    or more within pieces of one language; and (lang, n): the number of its words."""
    index = stage_by(index_shards(docs, depth, shard_words), "shard")
    totals = stage(index.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"), "totals")
    parts = 1 + (totals.agg(F.max("n")).first()[0] or 0) // PART_WORDS

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, lang, *parts_of_it = opened(batch, row)
                yield told(shard, lang, [f[:2] for f in levels(*parts_of_it, min(depth, 2))], parts)

    def long(shards: pa.Table, heard: pa.Table) -> pa.Table:
        if not shards.num_rows or not heard.num_rows:
            return pa.Table.from_batches([table_of(HASHES, *[[]] * 5)])
        shard, lang, *parts_of_it = opened(shards)
        keys = np.concatenate([k.values.to_numpy() for k in heard.column("keys").combine_chunks()])
        found = [f[:2] for f in levels(*parts_of_it, depth, keys, 2)][2:]
        return pa.Table.from_batches([told(shard, lang, found, parts)])

    def name(shards: pa.Table, heard: pa.Table) -> pa.Table:
        empty = [table_of(NAMED, *[[]] * 4)]
        if not shards.num_rows or not heard.num_rows:
            return pa.Table.from_batches(empty)
        _, lang, words, *both = opened(shards)
        keys, f = (np.concatenate([k.values.to_numpy() for k in heard.column(c).combine_chunks()]) for c in ("keys", "f"))
        mine = np.argsort(keys[f > 0])
        mine, f = keys[f > 0][mine], f[f > 0][mine]
        made = empty
        for found, _, phrase in levels(words, *both, depth, keys, depth):
            at = np.flatnonzero(np.isin(found, mine))
            parts_of_it = [words.take(pa.array(p[at] - 1)).cast(pa.string()) for p in phrase]
            named = pc.binary_join_element_wise(*parts_of_it, " ") if len(phrase) > 1 else parts_of_it[0]
            made.append(table_of(NAMED, [lang] * len(at), named, [len(phrase)] * len(at), f[np.searchsorted(mine, found[at])]))
        return pa.Table.from_batches(made)

    heard = frequent_hashes(index.mapInArrow(short, HASHES), least)
    by_shard = index.groupBy("shard")
    if depth > 2:
        hashes = by_shard.cogroup(heard.select("shard", "keys").groupBy("shard")).applyInArrow(long, HASHES)
        heard = heard.unionByName(frequent_hashes(hashes, least))
    return stage(by_shard.cogroup(heard.groupBy("shard")).applyInArrow(name, NAMED), "counts"), totals


def cut(at: Column, size: Column) -> Column:
    return F.array_join(F.slice("parts", at, size), " ")


def collocations(docs: DataFrame, least: int = 100, depth: int = 5, most: int | None = 2000, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, left, right): the phrases of two words or more
    that no longer phrase explains, each language's best ``most`` of them. ``score`` is
    floor(1000 a n / (l r)) at the weakest cut into ``l`` and ``r`` occurrences; ``left`` and
    ``right`` count the most frequent extension by a word on that side (0 if below ``least``)."""
    counts, totals = phrase_counts(docs, least, depth, shard_words)
    parts = counts.withColumn("parts", F.split("phrase", " "))
    one, size = F.lit(1), F.col("words")
    longer = parts.where("words > 1")
    sides = [longer.select("lang", cut(at, size - 1).alias("phrase"), F.lit(side).alias("side"), "f") for side, at in (("left", one + 1), ("right", one))]
    beside = sides[0].unionByName(sides[1]).groupBy("lang", "phrase")
    beside = beside.agg(*[F.coalesce(F.max(F.when(F.col("side") == s, F.col("f"))), F.lit(0)).alias(s) for s in ("left", "right")])
    open_ = parts.where("words > 1").join(beside, ["lang", "phrase"], "left").na.fill(0, ["left", "right"])
    # A phrase inside a much longer one of the same count is also inside one a word longer.
    open_ = open_.where(F.greatest("left", "right") < F.col("f"))

    cuts = open_.select("*", F.explode(F.sequence(one, size - 1)).alias("k"))
    cuts = cuts.withColumns({"head": cut(one, F.col("k")), "tail": cut(F.col("k") + 1, size - F.col("k"))})
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    cuts = cuts.withColumn("score", F.expr(SCORE))
    worst = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "f", "n", "left", "right")).alias("c")).select("lang", "phrase", "c.*")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    ranked = worst.withColumn("rank", F.row_number().over(best).cast("long"))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score", "left", "right")
