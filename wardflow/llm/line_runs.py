"""Line dedup by a suffix array over line-ID sequences.

Documents are sequences of line ids (ranks of distinct lines); lines without a word are
not part of them. Prefix doubling sorts the suffixes: a suffix's rank by its first 2^k
lines and the rank of the suffix 2^k lines on give its rank by 2^(k+1) lines. A suffix
alone in its interval, or cut off by its document's end, is dropped: what stays at level k
are the intervals of suffixes that share 2^k lines, so the work shrinks with the level.

A run of lines is a repeat when it has ``min_words`` words or more and stands earlier too
(by doc_id, then text hash, then line). Each line of a repeat lies in the shortest long
enough window that starts at the repeat's first line or ends at the line itself, so only
those two windows of a line are looked up: two overlapping blocks of 2^k lines name a
window of any length, and windows of one name form its interval. All but the earliest of
an interval are later copies and are deleted. That deletes the union of all maximal
repeated runs, short lines between long ones too. DataFrame functions only; intervals are
counted before they are joined, and ranks come from two-level totals, so a line that
stands in a third of all documents is not one task's work.

Only documents that may lose a line are joined with what they lose: a bitmap of ``BITS``
hashed keys tells the others apart in the scan, and their texts are never shuffled.

Defined results: NULL text stays NULL, the empty text empty. Rows alike in doc_id and text
stand as one document. A NULL doc_id comes first. Lines are compared by 64-bit hashes.
``n_lines`` and ``n_removed`` replace input columns of those names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import let, running_total, stage, without, words

MIN_WORDS = 50
CELLS = 1024
BITS = 1 << 24  # 2 MB, whatever the number of documents; beyond some millions, more texts are joined
DOC = ["_doc", "_hash"]


def has_word(line: Column) -> Column:
    return F.translate(line, " \t\n\x0b\f\r", "") != ""


def shortest(counts: Column, min_words: int) -> Column:
    """How many of the first ``counts`` reach ``min_words``; 0 if all do not."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
    step = lambda a, x: F.when(a.sum >= min_words, a).otherwise(F.struct((a.sum + x).alias("sum"), (a.n + 1).alias("n")))
    return F.aggregate(counts, start, step, lambda a: F.when(a.sum >= min_words, a.n).otherwise(F.lit(0)))


def numbered_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, pos, line, ahead, back): line hashes; lines the window from, or up to, here takes."""
    lines = F.filter(F.split("text", "\n"), has_word)
    sized = docs.select(*DOC, let(lines, lambda x: F.struct(F.transform(x, lambda line: F.xxhash64(line)).alias("line"), F.transform(x, lambda line: F.size(words(line))).alias("n"))).alias("of"))
    # A line has a word at least, so a window has ``min_words`` lines at most.
    ahead = let(F.col("of.n"), lambda n: F.transform(n, lambda _, i: shortest(F.slice(n, i + 1, F.lit(min_words)), min_words)))
    back = let(F.col("of.n"), lambda n: F.transform(n, lambda _, i: shortest(F.reverse(F.slice(n, F.greatest(i + 2 - min_words, F.lit(1)), F.least(i + 1, F.lit(min_words)))), min_words)))
    rows = sized.select(*DOC, F.posexplode(F.arrays_zip(F.col("of.line").alias("line"), ahead.alias("ahead"), back.alias("back"))).alias("pos", "l"))
    return rows.select(*DOC, "pos", F.col("l.line").alias("line"), F.col("l.ahead").alias("ahead"), F.col("l.back").alias("back"))


def first_level(lines: DataFrame) -> DataFrame:
    """Lines that stand twice or more, with ``rank``: 1 + the number of smaller ones."""
    repeated = lines.groupBy("line").agg(F.count("*").alias("n")).where("n > 1")
    cell = F.floor((F.col("line") / F.lit(2.0**63) + 1) * (CELLS / 2))
    ranks = running_total(repeated, [], ["line"], cell, "n", "before").select("line", (F.col("before") + 1).alias("rank"))
    return lines.join(ranks, "line").drop("line")


def next_level(level: DataFrame, step: int, suffixes: int) -> DataFrame:
    """From ranks by ``step`` lines to ranks by twice as many, of repeated blocks only."""
    second = level.select(*DOC, (F.col("pos") - step).alias("pos"), F.col("rank").alias("second"))
    pairs = stage(level.join(second, [*DOC, "pos"]), "pairs")
    groups = pairs.groupBy("rank", "second").agg(F.count("*").alias("n"))
    cell = F.floor(F.col("second") * CELLS / (suffixes + 1))
    ranked = running_total(groups, ["rank"], ["second"], cell, "n", "before").where("n > 1")
    joined = pairs.join(ranked.select("rank", "second", "before"), ["rank", "second"])
    return joined.select(*DOC, "pos", (F.col("rank") + F.col("before")).alias("rank"))


def later_copies(level: DataFrame, window: DataFrame) -> DataFrame:
    """Windows (doc, first, lines, k) that stand earlier too; ``level``: all levels, by k."""
    ends = [level.select(*DOC, F.col("pos").alias(at), "k", F.col("rank").alias(name)) for at, name in (("first", "head"), ("last", "tail"))]
    named = window.withColumn("last", F.col("first") + F.col("lines") - F.expr("shiftleft(1, k)"))
    named = stage(named.join(ends[0], [*DOC, "first", "k"]).join(ends[1], [*DOC, "last", "k"]).select(*DOC, "first", "lines", "head", "tail"), "windows")
    place = F.struct(*DOC, "first")
    earliest = named.groupBy("lines", "head", "tail").agg(F.min(place).alias("_earliest"), F.count("*").alias("n")).where("n > 1")
    return named.join(earliest, ["lines", "head", "tail"]).where(place > F.col("_earliest")).select(*DOC, "first", "lines")


def repeated_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, removed): positions, among lines with a word, of later copies."""
    lines = stage(numbered_lines(docs, min_words).distinct(), "lines")
    repeated = stage(first_level(lines), "level")
    suffixes, longest = repeated.agg(F.count("*"), F.coalesce(F.max(F.greatest("ahead", "back")), F.lit(0))).first()
    levels, step = [repeated.select(*DOC, "pos", "rank")], 1
    while 2 * step <= longest:
        deeper = stage(next_level(levels[-1], step, suffixes), "level")
        if deeper.isEmpty():
            break
        levels.append(deeper)
        step *= 2
    level = None
    for k, one in enumerate(levels):
        one = one.withColumn("k", F.lit(k))
        level = one if level is None else level.unionByName(one)
    k = lambda n: F.floor(F.log2(F.col(n) + 0.5)).cast("int")
    ahead = repeated.where("ahead > 0").select(*DOC, F.col("pos").alias("first"), F.col("ahead").alias("lines"), k("ahead").alias("k"))
    back = repeated.where("back > 1").select(*DOC, (F.col("pos") - F.col("back") + 1).alias("first"), F.col("back").alias("lines"), k("back").alias("k"))
    copies = later_copies(level, ahead.unionByName(back).distinct())
    covered = copies.select(*DOC, F.explode(F.sequence(F.col("first"), F.col("first") + F.col("lines") - 1)).alias("pos"))
    return covered.groupBy(*DOC).agg(F.collect_set("pos").alias("_removed"))


def bitmap(keys: DataFrame) -> Column:
    """The places of keys as one array of 64-bit words: a subquery of one value."""
    place = F.pmod(F.xxhash64(*DOC), F.lit(BITS))
    words_ = keys.groupBy(F.floor(place / 64).alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits"))
    every = keys.sparkSession.range(0, BITS // 64, 1, 1).join(words_, "id", "left")
    dense = every.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("words"))
    return stage(dense.select(F.col("words.bits").alias("words")), "bitmap").scalar()


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies taken out of ``text``, plus ``n_lines`` and ``n_removed``."""
    docs = without(docs, "n_lines", "n_removed")
    keys = [F.coalesce("doc_id", F.lit(-(2**63))).alias("_doc"), F.xxhash64("doc_id", "text").alias("_hash")]
    removed = stage(repeated_lines(docs.where("text IS NOT NULL").select(*keys, "text"), min_words), "removed")
    place = F.pmod(F.xxhash64(*DOC), F.lit(BITS))
    hit = F.getbit(F.get(bitmap(removed), F.floor(place / 64).cast("int")), (place % 64).cast("int")) == 1
    # All given columns are one, so none clashes with the keys.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *keys).withColumn("_hit", hit)
    losing = rows.where("_hit").drop("_hit").join(removed, DOC, "left")
    whole = rows.where("NOT _hit").drop("_hit").withColumn("_removed", F.lit(None).cast("array<int>"))
    text = F.col("row")["text"]
    lines = F.split(text, "\n")

    def kept(x: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(x) - 1)
        spoken = F.filter(every, lambda i: has_word(F.get(x, i)))
        gone = let(spoken, lambda s: F.transform(F.col("_removed"), lambda p: F.get(s, p)))
        return F.array_join(F.transform(F.array_except(every, gone), lambda i: F.get(x, i)), "\n")

    def finished(part: DataFrame, texts: Column) -> DataFrame:
        columns = [texts.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
        return part.select(*columns, F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.coalesce(F.size("_removed"), F.lit(0)).alias("n_removed"))

    mended = F.when(F.col("_removed").isNull(), text).otherwise(let(lines, kept))
    return finished(losing, mended).unionByName(finished(whole, text))
