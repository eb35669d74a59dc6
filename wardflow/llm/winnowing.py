"""Passages that documents share with test items, found by winnowing.

Every window of ``span`` consecutive words chooses the smallest hash of its k-grams as its
fingerprint (k is half the span), so two texts that share a window share a fingerprint,
and a text has about two fingerprints for every span-k words. Three steps:

1. distinct fingerprints of documents are joined with those of the items;
2. a hit is extended to the whole windows that chose the fingerprint: only in documents with
   a hit, each window is looked up with its fingerprint and the hash of all its words;
3. windows found are merged into spans, and windows into the items that have them.

Items shorter than a span are one window of all their words; each such length is winnowed
on its own. Items are small beside documents, but nothing rests on it: every join may
shuffle, Spark broadcasts a side only by its own size check, and no two texts are paired.
Documents that share a set of windows look up their items once.

Defined results: NULL, empty or wordless texts have no words, no spans, no items. A NULL
item_id counts as empty text; rows that repeat an item_id are one item. Repeated documents
each get their result, as do rows with a NULL doc_id. Words of any length and texts of any
length are taken whole; a text is one row's arrays of hashes. Other columns are not read.
Equal 64-bit hashes of a fingerprint and of its window's words together are taken as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import lower_ascii, stage

SPAN = 10
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what separates words, before A-Z are lowered
KEY = ("_id", "_text")


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def word_hashes(text: Column) -> Column:
    """One hash a word; only words beyond ASCII take the slower lowering."""
    ascii_only = lambda w: F.length(w) == F.octet_length(w)
    return F.transform(split_words(text), lambda w: F.xxhash64(F.when(ascii_only(w), F.lower(w)).otherwise(lower_ascii(w))))


def hashed(docs: DataFrame) -> DataFrame:
    """The key of a row (its id and text) and its word hashes."""
    key = [F.coalesce("_doc", F.lit(0)).alias("_id"), F.xxhash64("text", F.isnull("_doc")).alias("_text")]
    return docs.select(F.col("doc_id").cast("long").alias("_doc"), "text").select(*key, word_hashes(F.col("text")).alias("h"))


def _from(array: str, first: Column, n: int) -> list[Column]:
    return [F.get(F.col(array), first + k) for k in range(n)]


def _positions(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def windows(rows: DataFrame, length: int) -> DataFrame:
    """``rows`` (with word hashes ``h``) and, per window of ``length`` words, its fingerprint
    (``print``) and the hash of its words (``whole``)."""
    gram = (length + 1) // 2
    starts = F.size("h") - (length - 1)
    grams = F.transform(_positions(F.when(starts > 0, F.size("h") - (gram - 1)).otherwise(0)), lambda i: F.xxhash64(F.lit(length), *_from("h", i, gram)))
    chosen = length - gram + 1
    least = lambda i: F.least(*_from("g", i, chosen)) if chosen > 1 else F.get("g", i)
    rows = rows.withColumn("g", grams).withColumn("print", F.transform(_positions(starts), least))
    return rows.withColumn("whole", F.transform(_positions(starts), lambda i: F.xxhash64(*_from("h", i, length)))).drop("g")


def item_windows(items: DataFrame, span: int) -> DataFrame:
    """(item_id, length, print, whole): every window of every item."""
    hashed_items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), word_hashes(F.col("text")).alias("h"))
    hashed_items = stage(hashed_items.withColumn("length", F.least(F.size("h"), F.lit(span))).where("length > 0"), "items")
    parts = []
    for (length,) in hashed_items.select("length").distinct().collect():  # at most ``span`` lengths
        made = windows(hashed_items.where(F.col("length") == length), length)
        parts.append(made.select("item_id", "length", F.inline(F.arrays_zip("print", "whole")).alias("print", "whole")))
    if not parts:
        return items.sparkSession.createDataFrame([], "item_id string, length int, print long, whole long")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return stage(whole.distinct(), "item_windows")


def spans_of(found: DataFrame) -> DataFrame:
    """(key, spans): the windows (start, length) of every document merged where they meet."""
    ends = found.select(*KEY, "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    order = Window.partitionBy(*KEY).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = ends.withColumn("opens", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    merged = opened.withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = merged.groupBy(*KEY, "span").agg(F.min("start").alias("begin"), F.max("end").alias("end"))
    return spans.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def items_of(found: DataFrame, known: DataFrame) -> DataFrame:
    """(key, items): the items whose windows a document has, looked up once a set of windows."""
    sets = found.groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("length", "print", "whole"))).alias("windows"))
    sets = stage(sets.select(*KEY, F.sha2(F.to_json("windows"), 256).alias("set"), "windows"), "window_sets")
    each = sets.groupBy("set").agg(F.any_value("windows").alias("windows")).select("set", F.inline("windows"))
    items = each.join(known, ["length", "print", "whole"]).select("set", "item_id").distinct()
    items = items.groupBy("set").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    return sets.select(*KEY, "set").join(items, "set").drop("set")


def shared_passages(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, n_words, spans, items): one row per row of ``docs``; ``spans`` are the
    stretches of words [begin, end) inside windows of items, ``items`` their ids, sorted."""
    known = item_windows(items, span)
    prints = known.select("length", "print").distinct()
    rows = hashed(docs)
    lengths = sorted(length for (length,) in known.select("length").distinct().collect())
    result = docs.select("doc_id", F.col("doc_id").cast("long").alias("_doc"), "text").select(
        "doc_id", F.coalesce("_doc", F.lit(0)).alias("_id"), F.xxhash64("text", F.isnull("_doc")).alias("_text"), F.size(split_words(F.col("text"))).cast("long").alias("n_words")
    )
    none = {"spans": "array<struct<begin:int,end:int>>", "items": "array<string>"}
    if not lengths:
        return result.select("doc_id", "n_words", *[F.array().cast(t).alias(c) for c, t in none.items()])
    hits, found = None, None
    for length in lengths:
        each = windows(rows, length).select(*KEY, F.explode(F.array_distinct("print")).alias("print"))
        hit = each.join(prints.where(F.col("length") == length), "print", "left_semi").select(*KEY).distinct()
        hits = hit if hits is None else hits.unionByName(hit)
    hits = stage(hits.distinct(), "hits")
    near = rows.join(hits, list(KEY), "left_semi")
    for length in lengths:
        place = F.posexplode(F.arrays_zip("print", "whole")).alias("start", "window")
        each = windows(near, length).select(*KEY, place).select(*KEY, "start", F.lit(length).alias("length"), "window.*")
        part = each.join(known.select("length", "print", "whole").distinct(), ["length", "print", "whole"], "left_semi")
        found = part if found is None else found.unionByName(part)
    found = stage(found.distinct(), "windows_found")
    told = spans_of(found).join(items_of(found, known), list(KEY))
    told = stage(told, "passages")
    return result.join(told, list(KEY), "left").select("doc_id", "n_words", *[F.coalesce(c, F.array().cast(t)).alias(c) for c, t in none.items()])


def clean(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """The rows of ``docs`` that share no window with an item, with all their columns."""
    dirty = shared_passages(docs, items, span).where(F.size("spans") > 0).select("doc_id").distinct()
    return docs.join(dirty, docs["doc_id"].eqNullSafe(dirty["doc_id"]), "left_anti")
