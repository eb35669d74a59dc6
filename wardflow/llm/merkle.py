"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a stretch of text up to a sentence or line end (of at most 200 other
characters, so unbroken text is cut too); nothing is left out, so the paragraphs joined
are the text. Sixteen paragraphs make a section. Leaves are paragraph digests, a section
hashes its leaves, the root hashes the sections: equal texts have equal roots.

The fingerprint is ``root:sections:leaves`` in hex, 8 digits for each section and leaf,
so two fingerprints are compared without their texts: roots for equality, then sections,
then leaves of differing sections to locate edits. DataFrame functions only.

Defined results: NULL text is empty; the empty text has a root and no branches. Rows
alike in doc_id and text give one row each, and stand as one in the order of documents.
A NULL doc_id comes last. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import let, stage

PARAGRAPH = r"(?s)[^.!?\n]{1,200}[.!?\n]* ?|[.!?\n]+ ?"
FAN_OUT = 16
DIGITS = 8


def fingerprint(text: Column) -> Column:
    paragraphs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), 0)

    def tree(leaves: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(leaves), F.lit(1)), F.lit(FAN_OUT)), lambda _: F.size(leaves) > 0)
        sections = F.transform(starts, lambda s: F.sha2(F.concat_ws("", F.slice(leaves, s, F.lit(FAN_OUT))).cast("binary"), 256))
        return let(sections, lambda sections: F.concat(F.sha2(F.concat_ws("", sections).cast("binary"), 256), F.lit(":"), short(sections), F.lit(":"), short(leaves)))

    return let(F.transform(paragraphs, lambda p: F.md5(p.cast("binary"))), tree)


def short(digests: Column) -> Column:
    return F.concat_ws("", F.transform(digests, lambda d: F.substring(d, 1, DIGITS)))


def branches(print_: Column, level: int) -> Column:
    """Digests of a fingerprint's sections (1) or leaves (2)."""
    return F.regexp_extract_all(F.element_at(F.split(print_, ":"), level + 1), F.lit(f".{{{DIGITS}}}"), 0)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: distinct leaves in common over those of the richer text; 1 only if equal."""
    share = let(branches(a, 2), lambda x: let(branches(b, 2), lambda y: F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_distinct(x)), F.size(F.array_distinct(y)), F.lit(1))))
    return F.when(F.element_at(F.split(a, ":"), 1) == F.element_at(F.split(b, ":"), 1), F.lit(1.0)).otherwise(share * (1 - 1e-9))


def edited_sections(a: Column, b: Column) -> Column:
    """Positions (from 0) of sections of ``a`` that differ from those of ``b``."""
    return differing(branches(a, 1), branches(b, 1))


def edited_paragraphs(a: Column, b: Column) -> Column:
    """Positions (from 0) of paragraphs of ``a`` that ``b`` has not there, looked for only
    below sections that differ."""
    sections = edited_sections(a, b)
    return let(
        branches(a, 2),
        lambda x: let(
            branches(b, 2),
            lambda y: F.flatten(F.transform(sections, lambda s: F.transform(
                differing(F.slice(x, s * FAN_OUT + 1, F.lit(FAN_OUT)), F.slice(y, s * FAN_OUT + 1, F.lit(FAN_OUT))), lambda k: k + s * FAN_OUT))),
        ),
    )


def differing(x: Column, y: Column) -> Column:
    return F.array_compact(let(y, lambda y: F.transform(x, lambda d, k: F.when(~F.get(y, k).eqNullSafe(d), k))))


def follow(docs: DataFrame) -> DataFrame:
    """For every distinct document (``_id``, ``_h``; ``_n`` code points, ``_copies`` rows): the
    next one in descending order (``to``: struct), after the last the first. Only keys are sorted, by
    range; a window works within a range and the ranges' first rows link them."""
    keys = docs.select("_id", "_h", F.length("text").alias("_n")).groupBy("_id", "_h", "_n").agg(F.count(F.lit(1)).alias("_copies"))
    ranges = stage(keys.repartitionByRange(F.desc("_id"), F.desc("_h")).withColumn("_part", F.spark_partition_id()), "key_ranges")
    row = F.struct("_id", "_h", "_n")
    firsts = ranges.groupBy("_part").agg(F.max(row).alias("first"))
    every = Window.orderBy("_part")  # one row a range
    firsts = firsts.select("_part", F.coalesce(F.lead("first").over(every), F.first("first").over(every)).alias("onward"))
    inside = ranges.withColumn("next", F.lead(row).over(Window.partitionBy("_part").orderBy(F.desc("_id"), F.desc("_h"))))
    return inside.join(firsts, "_part").select("_id", "_h", "_n", "_copies", F.coalesce("next", "onward").alias("to"))


def edit_check(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how like they are."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("_id"), F.xxhash64("doc_id", text).alias("_h"))
    order = stage(follow(docs), "document_order")
    # Both joins use the same columns of the documents, so their texts are shuffled once.
    each = docs.groupBy("_id", "_h").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    incoming = order.select(F.col("to._id").alias("_id"), F.col("to._h").alias("_h"), F.col("_id").alias("_to_id"), F.col("_h").alias("_to_h"), F.col("_n").alias("_to_n"), "_copies")
    sent = each.join(incoming, ["_id", "_h"]).select(
        F.col("doc_id").alias("next_doc_id"), "_copies",
        F.col("_to_id").alias("_id"), F.col("_to_h").alias("_h"), F.left("text", F.floor(F.col("_to_n") / 2).cast("int")).alias("_head"), fingerprint(F.col("text")).alias("_next")
    )
    n = F.length("text")
    joined = each.join(sent, ["_id", "_h"]).select(
        "doc_id", "next_doc_id", "_copies", "_next", n.cast("long").alias("n_chars"), "text", F.concat(F.left("text", n - F.floor(n / 2).cast("int")), "_head").alias("_edited")
    )
    printed = joined.select(
        "doc_id", "next_doc_id", "_copies", "_next", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("_edited")).alias("edited_fingerprint"),
    )
    compared = printed.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"), F.size(edited_paragraphs(F.col("fingerprint"), F.col("edited_fingerprint"))).alias("n_edited_paragraphs"), "next_doc_id", "_copies",
    )
    return compared.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))).drop("_copies", "_copy")
