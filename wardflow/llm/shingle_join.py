"""Set-similarity join of word shingles by prefixes of token combinations.

Two sets with Jaccard similarity t share all but few tokens, so they share one within
the first few of a global order (a prefix). Here frequent tokens come last in that order
and are indexed only in pairs: a prefix is extended until, with k tokens of a class
counting for k-1 when the class is indexed in pairs, it outweighs the tokens a partner
may lack; then partners share a rare token or a pair of frequent ones of one class. The
classes of frequent tokens are cut by hash, finer for larger sets, so that a set of
frequent tokens only has a few pairs per token; sets meet in the size band of the smaller.
Which tokens are frequent changes the cost, never the result.

Equal sets are one node. Within a bucket nodes are compared with a first hub, then with
more hubs at a time, the most typical first (fewest rare tokens of their own), but never with
nodes known to be in their component nor with those whose own tokens rule it out: groups
of thousands of copies collapse in the first rounds. Every node of a bucket that is not in a
hub's component is compared with it in the end, so no component is missed: in a bucket of
n nodes that are alike in nothing but its key, n * n / 2 pairs at worst, which only a key
that is neither frequent nor ruled out by the prefixes can make.

Each set has a sketch: one bit for each slot a token may hash to, telling whether it got an
odd number of them. Two sketches differ in no more bits than the sets differ in tokens, so
a pair whose sketches differ too much is none, and nothing similar is lost. Only what is
left is verified, on whole sets made again from the texts. Tokens are 64-bit hashes; equal hashes are taken as equal.

Defined results: NULL, empty or blank text has an empty set, linked with nothing. Fewer
words than a shingle make one shingle of all. Repeated rows are equal sets; a NULL doc_id
takes part but is no component's name unless nothing else is there (then NULL). Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import Scratch, blocks, coded_words, mixed, stage
from wardflow.llm.components import components

SET_BYTES = 2 << 20  # text made into sets at once: its hashes take many times as much
FREQUENT_BYTES = 4 << 20  # text in which frequent tokens are looked for
FREQUENT_HERE = 6  # documents of one such block that make a token a candidate for "frequent"
FREQUENT_MOST = 1 << 16  # tokens treated as frequent; the others are rare
FIRST_HUBS, MORE_HUBS = 2, 8  # hubs of the first round; each later round takes so many times as many
SHORT_SLOTS = 256
K1, K2, K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def token_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    codes, distinct, n_words = coded_words(texts, lower=True)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.cast(pa.binary()).to_pylist()), np.uint64, len(distinct))
    flat = hashes[codes]
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(flat) - size + 1), np.uint64)
        for k in range(size):
            rolled = mixed(rolled * K1 + flat[k : k + len(rolled)])
        out, end = [], 0
        for n in n_words:
            begin, end = end, end + int(n)
            if n >= size:
                out.append(np.unique(rolled[begin : end - size + 1]))
            elif n:
                short = np.array([n], np.uint64)
                for h in flat[begin:end]:
                    short = mixed(short * K1 + h)
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def allowed_misses(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that a similar set may lack."""
    return n - (percent * n + 99) // 100


def size_band(n: int, percent: int) -> int:
    """Similar sets are in the same band or in neighbours (bands are a little too wide)."""
    return int(math.log(n) / -math.log((percent - 1) / 100))


def subclasses(band: int, percent: int) -> int:
    smallest = math.floor(((percent - 1) / 100) ** -band)
    return max(1, allowed_misses(smallest, percent) // 4)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Index keys of a set: rare tokens of its prefix (even), pairs of frequent ones (odd)."""
    n = len(tokens)
    if 100 * n < percent * (n + 1):  # so small that only equal sets are similar
        return np.zeros(0, np.uint64)
    most = allowed_misses(n, percent)
    rare = tokens[~frequent][: most + 1]
    singles = rare & ~np.uint64(1)
    if len(rare) > most:
        return np.unique(singles)
    need, common, own = most + 1 - len(rare), tokens[frequent], size_band(n, percent)
    found = [singles]
    with np.errstate(over="ignore"):
        for band in (own, own - 1):
            if band < 0:
                continue
            group = (mixed(common + K2) % np.uint64(subclasses(band, percent))).astype(np.int64)
            order = np.argsort(group, kind="stable")
            first = np.concatenate([[True], np.diff(group[order]) != 0])
            counts_as = np.ones(len(common), np.int64)
            counts_as[order[first]] = 0  # the first of a class in the order adds nothing
            length = int(np.searchsorted(np.cumsum(counts_as), need)) + 1
            order = order[order < length]
            group, kept = group[order], common[order]
            step = 1
            while step < len(kept):
                same = group[step:] == group[:-step]
                if not same.any():
                    break
                found.append(mixed(kept[:-step][same] * K1 + kept[step:][same] * K2 + np.uint64(band + 1) * K3) | np.uint64(1))
                step += 1
    return np.unique(np.concatenate(found))


def node_of(tokens: np.ndarray) -> int:
    """The id equal sets share."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def sketch_of(tokens: np.ndarray) -> bytes:
    """A bit for each slot: does an odd number of tokens fall into it? As many slots as the
    next power of two above the tokens, 64 at least."""
    slots = max(64, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 64
    odd = np.bincount((tokens & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def short_sketch(tokens: np.ndarray) -> np.ndarray:
    """The same in ``SHORT_SLOTS`` slots, whatever the set's size, as longs: what goes with a
    node into the join of its buckets."""
    odd = np.bincount((tokens % np.uint64(SHORT_SLOTS)).astype(np.int64), minlength=SHORT_SLOTS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def sketch_distance(x: bytes, y: bytes) -> int:
    """Bits two sketches differ in: at most the tokens one set has and the other lacks. The
    longer sketch is folded to the length of the shorter."""
    if len(x) < len(y):
        x, y = y, x
    short = np.frombuffer(y, np.uint64)
    folded = np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, len(short)), axis=0)
    return int(np.bitwise_count(folded ^ short).sum())


def frequent_tokens(docs: DataFrame, size: int) -> np.ndarray:
    """At most ``FREQUENT_MOST`` tokens that many documents have, the most frequent first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text", FREQUENT_BYTES):
                sets = token_sets(batch.column("text"), size)
                token, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                many = n >= FREQUENT_HERE
                yield pa.RecordBatch.from_arrays([pa.array(token[many].view(np.int64)), pa.array(n[many])], names=["token", "n"])
                del sets, token, n, many
                pa.default_memory_pool().release_unused()

    totals = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = totals.orderBy(F.desc("n"), "token").limit(FREQUENT_MOST).select("token").toPandas()
    return np.sort(rows["token"].to_numpy(np.int64).view(np.uint64))


def is_frequent(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), bool)
    return frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens


def indexed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, node, keys, sketch): what each document is found by; how many keys
    are rare tokens, and whether those are all rare tokens it has."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, size))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text", SET_BYTES):
                sets = token_sets(batch.column("text"), size)
                keys = [signatures(s, is_frequent(s, frequent.value), percent).view(np.int64) for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
                singles = [int((k & 1 == 0).sum()) for k in keys]
                whole_rare = [m <= allowed_misses(len(s), percent) for m, s in zip(singles, sets, strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(list(map(node_of, sets)), pa.int64()), pa.array(singles, pa.int32()), pa.array(whole_rare), lists, pa.array(list(map(sketch_of, sets)), pa.binary()), pa.array(list(map(short_sketch, sets)), pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "node", "singles", "whole_rare", "keys", "sketch", "bits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(index, "doc_id long, n_shingles long, node long, singles int, whole_rare boolean, keys array<long>, sketch binary, bits array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, tokens) of the nodes in ``wanted`` (doc_id, node), made again from their texts.
    A bitmap of hashed ids (2 MB) picks the documents; a join removes what it lets slip."""
    bits = 1 << 24
    place = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(bits)).cast("long")
    rows = wanted.groupBy(F.bitmap_bucket_number(place + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits")).collect()
    bitmap = docs.sparkSession.sparkContext.broadcast({r["bucket"]: np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little") for r in rows})

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.column("place").to_numpy(zero_copy_only=False)
            hit = np.zeros(len(at), bool)
            bucket = at // (8 * 4096) + 1
            for b in np.unique(bucket):
                if b in bitmap.value:
                    hit[bucket == b] = bitmap.value[b][at[bucket == b] % (8 * 4096)] > 0
            for batch in blocks(whole.filter(pa.array(hit)), "text", SET_BYTES):
                sets = token_sets(batch.column("text"), size)
                yield pa.RecordBatch.from_arrays([pa.array(list(map(node_of, sets)), pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "tokens"])

    made = docs.select(place.alias("place"), "text").mapInArrow(make, "node long, tokens array<long>")
    return made.join(wanted.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens"))


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``nodes`` (node, doc_id, n, sketch) that the sketches do not rule
    out, with the doc_id of either."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.fromiter(map(sketch_distance, batch.column("x").to_pylist(), batch.column("y").to_pylist()), np.int64, batch.num_rows)
            near = (100 + percent) * apart <= (100 - percent) * batch.column("all").to_numpy()
            yield batch.select(["a", "b", "doc_a", "doc_b"]).filter(pa.array(near))

    left = nodes.select(F.col("node").alias("a"), F.col("doc_id").alias("doc_a"), F.col("n").alias("n_a"), F.col("sketch").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("doc_id").alias("doc_b"), F.col("n").alias("n_b"), F.col("sketch").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "doc_a", "doc_b", (F.col("n_a") + F.col("n_b")).alias("all"), "x", "y")
    return both.mapInArrow(sift, "a long, b long, doc_a long, doc_b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar."""
    left, right = sets.toDF("a", "x"), sets.toDF("b", "y")
    sized = pairs.join(left, "a").join(right, "b").select("a", "b", F.size(F.array_intersect("x", "y")).alias("both"), (F.size("x") + F.size("y")).alias("all"))
    return sized.where(100 * F.col("both") >= percent * (F.col("all") - F.col("both"))).select("a", "b")


def possible(percent: int) -> Column:
    """Can a node and a hub be similar, by what their prefixes tell? Of two prefixes the one
    that ends first in the order shows which of its tokens the other set lacks. Prefixes with
    all rare tokens both show it. Short sketches rule out the most of what is alike in the key
    only. Of two nodes the one earlier in the order of hubs is the hub, so a pair meets once."""
    need = F.ceil((F.col("n") + F.col("hub_n")) * percent / (100 + percent) - 1e-9)
    here, there = F.col("n") - F.col("own"), F.col("hub_n") - F.col("hub_own")
    most = F.when(F.col("whole_rare") & F.col("hub_whole_rare"), F.least(here, there)).otherwise(F.greatest(here, there))
    apart = sum(F.bit_count(F.get("bits", F.lit(k)).bitwiseXOR(F.get("hub_bits", F.lit(k)))) for k in range(SHORT_SLOTS // 64))
    near = (100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("hub_n"))
    earlier = (F.col("hub_own") < F.col("own")) | ((F.col("hub_own") == F.col("own")) & (F.col("hub") < F.col("node")))
    return (need <= most) & (need <= F.least("n", "hub_n")) & earlier & near


def still_open(members: DataFrame, percent: int) -> DataFrame:
    """Members of buckets with several components, less those that lack too much of any
    other: where all show what they lack, the smallest set of the bucket is the bound."""
    buckets = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least_n"), F.every("whole_rare").alias("all_show"))
    joined = members.join(buckets.where("low <> high"), "key")
    need = F.ceil((F.col("n") + F.greatest("least_n", F.ceil(F.col("n") * percent / 100 - 1e-9))) * percent / (100 + percent) - 1e-9)
    hopeless = F.col("all_show") & (need > F.col("n") - F.col("own"))
    return joined.where(~hopeless).select(*members.columns)


def links(docs: DataFrame, index: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component) of the nodes that have a link."""
    scratch = Scratch(docs.sparkSession)
    keys = index.select("node", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("key")
    members = scratch.put(keys.join(shared, "key").distinct(), "shared_keys")
    # Rare tokens of a prefix that no other prefix has count as the node's own.
    matched = members.groupBy("node").agg(F.count_if(F.col("key") % 2 == 0).alias("matched"))
    known = index.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("singles").alias("singles"), F.first("whole_rare").alias("whole_rare"), F.first("bits").alias("bits"))
    known = known.join(matched, "node").select("node", "n", (F.col("singles") - F.col("matched")).alias("own"), "whole_rare", "bits")
    members = scratch.put(still_open(members.join(known, "node").withColumn("component", F.col("node")), percent), "members")
    scratch.drop("shared_keys")
    nodes = index.join(members.select("node").distinct(), "node", "left_semi").groupBy("node")
    nodes = scratch.put(nodes.agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "nodes")
    # Members of buckets that still hold several components; a hub leaves after its round.
    tried, found, labels, hubs = None, None, None, FIRST_HUBS
    typical = Window.partitionBy("key").orderBy("own", "node")
    while not members.isEmpty():
        ranked = members.withColumn("rank", F.row_number().over(typical)).where(F.col("rank") <= hubs)
        hub = scratch.put(ranked.select("key", F.col("node").alias("hub"), *[F.col(c).alias(f"hub_{c}") for c in ("n", "own", "whole_rare", "bits")], F.col("component").alias("hub_component")), "hubs")
        may = possible(percent) & (F.col("component") != F.col("hub_component"))
        met = members.alias("m").join(hub.alias("h"), (F.col("m.key") == F.col("h.key")) & may)
        pairs = met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        pairs = stage(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        near = scratch.put(likely(pairs, nodes, percent), "likely")
        new = near.select("a", "b")
        if not near.isEmpty():
            wanted = near.select(F.col("a").alias("node"), F.col("doc_a").alias("doc_id")).union(near.select("b", "doc_b")).distinct()
            sets = scratch.put(sets_of(docs, wanted, size), "sets")
            new = stage(verified(new, sets, percent), "links")
            scratch.drop("sets")
        rest = members.join(hub.select("key", F.col("hub").alias("node")), ["key", "node"], "left_anti")
        if not new.isEmpty():
            found = new if found is None else found.union(new)
            labels = components(found, scratch)
        if labels is not None:
            rest = rest.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        members = scratch.put(still_open(rest, percent), "members")
        hubs *= MORE_HUBS
    return labels


def similar_sets(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, node, component_id): one row per row of ``docs``. ``node`` is
    alike for equal sets; ``component_id`` is the smallest doc_id reachable by links."""
    index = stage(indexed(docs, size, percent), "index")
    labels = links(docs, index, size, percent)
    nodes = index.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    if labels is not None:
        nodes = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        names = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
        nodes = nodes.join(names, "component").select("node", "component_id")
    else:
        nodes = nodes.withColumnRenamed("least", "component_id")
    full = index.where("n_shingles > 0").select("doc_id", "n_shingles", "node").join(nodes, "node").select("doc_id", "n_shingles", "node", "component_id")
    empty = index.where("n_shingles = 0").select("doc_id", "n_shingles", "node", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that name their component; the others are near copies of them.
    Rows that share the naming doc_id all stay."""
    groups = similar_sets(docs, size, percent)
    copies = groups.where("doc_id <> component_id OR (doc_id IS NULL AND component_id IS NOT NULL)").select("doc_id").distinct()
    return docs.join(copies, docs["doc_id"].eqNullSafe(copies["doc_id"]), "left_anti")
