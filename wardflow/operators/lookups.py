"""Does a referenced key exist? One marker join, without pairing rows and parents.

``fk NOT IN (subquery) OR other`` makes Spark pair every row with every parent,
so existence is a left join to the distinct parent keys that yields a flag with
SQL's three values:

* TRUE  - the key is among the parents,
* FALSE - it is not (text that is no number is never among them), or the
  reference is NULL and there are no parents at all,
* NULL  - the reference is NULL and parents exist: neither IN nor NOT IN holds.

Spark broadcasts small parents by its own size check. Larger ones are shuffled by
the referenced key. One parent may own a large share of the rows, and rows without
a reference share one place too; Spark's adaptive skew join splits such a partition
by the map tasks it came from. The joined keys are distinct, so only the side of the
rows is ever split, and a task that runs again reads the same blocks again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.casts import try_key, whole_number


def parent_keys(parents: DataFrame, name: str, *, small: bool = False, shuffled: bool = False) -> DataFrame:
    """The keys of the one-column ``parents``, none of them NULL. ``small`` says the
    caller has bounded their number; ``shuffled`` rules a broadcast out."""
    keys = parents.select(whole_number(F.col(parents.columns[0])).alias(name)).where(F.col(name).isNotNull())
    if small:
        return F.broadcast(keys)
    return keys.hint("shuffle_merge") if shuffled else keys


def mark_exists(
    child: DataFrame,
    column: str,
    parents: DataFrame,
    flag: str,
    *,
    parents_unique: bool = False,
    parents_small: bool = False,
    parents_empty: Column | bool | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Add the boolean ``flag``: is ``column`` among the one-column ``parents``?
    ``parents_empty``, if known, saves looking whether there are any."""
    key, parent_key = f"_{flag}_key", f"_{flag}_parent"
    child_columns = child.columns
    rows = child.withColumn(key, try_key(F.col(column)))
    if not parents_unique:
        parents = parents.distinct()
    keys = parent_keys(parents, parent_key, small=parents_small, shuffled=shuffled)
    if parents_empty is None:
        some = parents.where(F.col(parents.columns[0]).isNotNull()).limit(1)
        parents_empty = some.agg((F.count(F.lit(1)) == 0).alias("empty")).scalar()
    elif isinstance(parents_empty, bool):
        parents_empty = F.lit(parents_empty)
    joined = rows.join(keys, F.col(key) == F.col(parent_key), "left")

    unknown = F.col(column).isNull() & ~parents_empty
    marked = F.when(F.col(parent_key).isNotNull(), True).when(unknown, F.lit(None).cast("boolean")).otherwise(False)
    return joined.select(*child_columns, marked.alias(flag))


def semi(child: DataFrame, column: str, parents: DataFrame, *, shuffled: bool = False) -> DataFrame:
    """Rows whose reference exists (``column IN parents``): a semi join, which
    needs neither distinct parents nor a test whether there are any."""
    key, parent_key = f"_{column}_key", f"_{column}_parent"
    rows = child.withColumn(key, try_key(F.col(column))).where(F.col(key).isNotNull())
    keys = parent_keys(parents, parent_key, shuffled=shuffled)
    return rows.join(keys, F.col(key) == F.col(parent_key), "left_semi").select(*child.columns)


def not_in(child: DataFrame, column: str, parents: DataFrame, **options) -> DataFrame:
    """Rows for which ``column NOT IN parents`` is true, NULLs as in SQL."""
    return mark_exists(child, column, parents, "_found", **options).where("NOT _found").drop("_found")
