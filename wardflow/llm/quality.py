"""Quality rules with thresholds that follow the data.

Two fixed rules (too few words, too much repetition) come first. All else is judged
against quantiles of the document's own language and source: a sketch of logarithmic
buckets per group and measure, whose counts add up when groups are merged. Every sketch
is blended with its parent's (source with language, language with everything), which
counts as ``PRIOR`` documents: a source of few documents is judged mostly by its
language, one of many by itself, and nothing switches in between. Each quantile is within
``ACCURACY`` of a true one, relatively. A document falls when a measure lies beyond the
tail quantile of its group by more than ``REACH`` times the way there from the median
plus what chance may add in a text of that length (``SURE`` standard errors of a rate),
so short texts are judged more mildly. Fences are joined back. DataFrame functions only.

Defined results: NULL text has no words and fails the first rule. NULL language or source
is a group like another. An empty table gives no rows. Repeated rows are judged each.
Very long texts are measured whole. Equal values share a bucket.
Other columns are not read, so clashing names do no harm.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import SPACE, let, stage, words

ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
ZERO = -10_000  # bucket of values that are 0
WINDOW = 8  # words of a repeated window
PRIOR = 100  # documents that a parent's sketch counts as
TAIL = 0.90  # the upper quantile; the lower one is as far from the other end
REACH = 2.0
SURE = 4.0
RARE = 0.04  # added to a rate before its standard error is taken
#: measure: (what it is counted in, is there a lower fence)
MEASURES = {"symbols_per_char": ("word_chars", False), "dup_lines_per_line": ("n_lines", False), "echoes_per_word": ("n_words", False), "chars_per_word": ("n_words", True)}


def repeated_words(w: Column) -> Column:
    """Number of words inside ``WINDOW``-word windows that the text has twice or more."""

    def marked(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda o: F.sort_array(F.transform(F.filter(o, lambda x, k: (F.get(o, k + 1).h == x.h) | (F.get(o, k - 1).h == x.h)), lambda x: x.i)))
        return let(starts, lambda s: F.aggregate(F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))

    windows = F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))))
    found = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(marked(h)))
    return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(found).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts of every whole text, its lines with a word and
    its words that only repeat the word before."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.length(F.translate(text, " \t\n\x0b\f\r", ""))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\n\x0b\f\r", "") != "")
    counted = docs.select(
        "doc_id", "lang", "source", bare.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
        let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeat"), F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))).cast("long").alias("echo"))).alias("words"),
    )
    return counted.select(
        "doc_id", "lang", "source", F.col("words.n").alias("n_words"), "word_chars", "n_symbols", F.col("lines.dup").cast("long").alias("n_dup_lines"),
        F.col("words.repeat").alias("n_repeat_words"), F.col("lines.n").cast("long").alias("n_lines"), F.col("words.echo").alias("n_echoes"),
    )


def measures() -> list[Column]:
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return [
        per("n_symbols", "word_chars").alias("symbols_per_char"), per("n_dup_lines", "n_lines").alias("dup_lines_per_line"),
        per("n_echoes", "n_words").alias("echoes_per_word"), per("word_chars", "n_words").alias("chars_per_word"),
    ]


def sketches(values: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the counts that make a group's sketches."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])).alias("m")
    bucket = F.when(F.col("m.value") > 0, F.ceil(F.log("m.value") / math.log(GAMMA))).otherwise(ZERO).cast("int")
    return values.select("lang", "source", each).groupBy("lang", "source", F.col("m.measure").alias("measure"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, measure, n, cells): one row a group and measure. Cells are (bucket, n) and no
    more than there are buckets, however many documents a group has."""
    summed = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    cell = F.struct("bucket", F.col("n").cast("double").alias("n"))
    return summed.groupBy(*keys, "measure").agg(F.sum("n").cast("double").alias("n"), F.collect_list(cell).alias("cells"))


def blend(cells: Column, parent: Column, n_parent: Column) -> Column:
    """A sketch and its parent's, the latter as ``PRIOR`` documents."""
    return F.concat(cells, F.transform(parent, lambda c: F.struct(c.bucket.alias("bucket"), (c.n * PRIOR / n_parent).alias("n"))))


def quantile(cells: Column, q: float) -> Column:
    """The value below which a share ``q`` of a sketch lies."""
    total = F.aggregate(cells, F.lit(0.0), lambda a, c: a + c.n)
    step = lambda a, c: F.struct((a.upto + c.n).alias("upto"), F.when(a.upto < q * a.total, c.bucket).otherwise(a.at).alias("at"), a.total.alias("total"))
    start = F.struct(F.lit(0.0).alias("upto"), F.lit(ZERO).alias("at"), total.alias("total"))
    at = F.aggregate(F.array_sort(cells), start, step, lambda a: a.at)
    return let(at, lambda b: F.when(b == ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), b) * 2 / (1 + GAMMA)))


def fences(values: DataFrame) -> DataFrame:
    """(lang, source, then low, middle and high of every measure) for every group."""
    by_source = stage(sketches(values), "quality_sketches")
    own, language, every = merged(by_source, "lang", "source").alias("o"), merged(by_source, "lang").alias("l"), merged(by_source).alias("e")
    joined = own.join(language, F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.measure") == F.col("l.measure"))).join(every, F.col("o.measure") == F.col("e.measure"))
    of_language = blend(F.col("l.cells"), F.col("e.cells"), F.col("e.n"))
    cells = blend(F.col("o.cells"), of_language, F.col("l.n") + PRIOR)
    each = joined.select("o.lang", "o.source", "o.measure", *[quantile(cells, q).alias(name) for name, q in (("low", 1 - TAIL), ("middle", 0.5), ("high", TAIL))])
    return each.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == m, F.struct("low", "middle", "high"))).alias(m) for m in MEASURES])


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and ``failed_measures`` of every document."""
    base = stage(measure(docs), "quality_measures")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    values = base.select("*", failed.alias("base_failed"), *measures())
    # Documents that fail anyway do not shape the fences of the others.
    limits = fences(values.where(~F.col("base_failed")))
    on = F.col("d.lang").eqNullSafe(F.col("f.lang")) & F.col("d.source").eqNullSafe(F.col("f.source"))
    joined = values.alias("d").join(limits.alias("f"), on, "left")
    beyond = []
    for m, (unit, lower) in MEASURES.items():
        value, low, middle, high = F.col(f"d.{m}"), *[F.col(f"f.{m}.{q}") for q in ("low", "middle", "high")]
        chance = SURE * F.sqrt((high + RARE) / F.greatest(F.col(f"d.{unit}"), F.lit(1)))
        far = value > high + REACH * (high - middle) + chance
        beyond.append(F.when(far | (value < low - REACH * (middle - low) - chance) if lower else far, F.lit(m)))
    names = F.array_compact(F.array(*beyond))
    return joined.select(
        "d.doc_id", "d.n_words", "d.word_chars", "d.n_symbols", "d.n_dup_lines", "d.n_repeat_words", "d.base_failed",
        (~F.col("d.base_failed") & (F.size(names) == 0)).alias("kept"), F.concat_ws(",", names).alias("failed_measures"),
    )
