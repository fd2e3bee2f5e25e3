"""Keyed merge: fold a batch to one row per key, then join it into the table.

Stock Spark has no row-level MERGE for Parquet, so a merge is a join that yields
the table's next version.  After the fold both sides hold at most one row per
key, so no key can be hot in the join; the fold itself is an aggregate with
map-side combine.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.operators.skew import split_null_keys

Rule = Callable[[Column, Column], Column]


def keep(old: Column, new: Column) -> Column:
    return old


def take(old: Column, new: Column) -> Column:
    return new


def fill(old: Column, new: Column) -> Column:
    """The new value unless it is null."""
    return F.coalesce(new, old)


def add(old: Column, new: Column) -> Column:
    return F.coalesce(old, F.lit(0)) + new


def larger(old: Column, new: Column) -> Column:
    return F.greatest(old, new)


def fold(
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    last: Sequence[str] = (),
    last_known: Sequence[str] = (),
) -> DataFrame:
    """Collapse rows of one key as if applied one after another.

    The first row (by ``order``) supplies every column except ``last`` (taken
    from the last row) and ``last_known`` (last non-null value).
    """
    seq = F.struct(*order)
    later = set(last) | set(last_known)
    first_cols = [c for c in batch.columns if c not in keys and c not in later]
    aggs = []
    if first_cols:
        aggs.append(F.min_by(F.struct(*first_cols), seq).alias("_first"))
    if last:
        aggs.append(F.max_by(F.struct(*last), seq).alias("_last"))
    aggs += [
        F.max_by(c, F.when(F.col(c).isNotNull(), seq)).alias(c) for c in last_known
    ]
    folded = batch.groupBy(*keys).agg(*aggs)

    def source(c: str) -> Column:
        if c in keys or c in last_known:
            return F.col(c)
        return F.col("_last" if c in last else "_first")[c].alias(c)

    return folded.select(*[source(c) for c in batch.columns])


def keyed_merge(
    stored: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Rule],
    small_batch: bool = False,
    loose: DataFrame | None = None,
) -> DataFrame:
    """``stored`` with ``batch`` (one row per key) merged in.

    Columns without a rule keep the stored value; new keys are inserted as given,
    with null for columns the batch lacks.  Rows with a null in the key never
    match: stored ones stay, batch ones are inserted, and neither is shuffled.  A
    caller that has split them off already passes them as ``loose``.

    ``small_batch`` joins the batch to the table from the left and finds the new
    keys with an anti join on the key columns alone.  Spark may then broadcast the
    batch under its own size threshold and leave the wide table unshuffled.  The
    default is one full outer join.
    """
    keys = list(keys)
    columns = stored.columns
    old_rows, old_loose = split_null_keys(stored, keys)
    new_rows, new_loose = (batch, loose) if loose is not None else split_null_keys(batch, keys)
    given = set(batch.columns)

    def inserted(rows: DataFrame) -> DataFrame:
        return rows.select(
            *[
                (F.col(c) if c in given else F.lit(None)).cast(stored.schema[c].dataType).alias(c)
                for c in columns
            ]
        )

    old = old_rows.select(*keys, F.struct(*columns).alias("_old"))
    new = new_rows.select(*keys, F.struct(*batch.columns).alias("_new"))

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        was = F.col("_old")[c]
        now = F.col("_new")[c] if c in given else F.lit(None).cast(stored.schema[c].dataType)
        rule = rules.get(c, keep)
        merged = (
            F.when(F.col("_old").isNull(), now)
            .when(F.col("_new").isNull(), was)
            .otherwise(rule(was, now))
        )
        return merged.cast(stored.schema[c].dataType).alias(c)

    if small_batch:
        updated = old.join(new, keys, "left").select(*[value(c) for c in columns])
        fresh = inserted(new_rows.join(old_rows.select(*keys), keys, "left_anti"))
        merged = updated.unionByName(fresh)
    else:
        merged = old.join(new, keys, "full_outer").select(*[value(c) for c in columns])
    return merged.unionByName(old_loose).unionByName(inserted(new_loose))


def insert_absent(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the table lacks (the rows to append)."""
    return batch.join(stored.select(*keys), list(keys), "left_anti").select(*batch.columns)
