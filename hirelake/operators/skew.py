"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.01


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys holding at least ``share`` of the rows.

    At most ``1 / share`` keys can qualify, which bounds what reaches the driver.
    """
    rows = df.where(F.col(key).isNotNull()).select(key)
    total = rows.count()
    top = rows.groupBy(key).count().orderBy(F.desc("count")).limit(int(1 / share)).collect()
    return [r[key] for r in top if r["count"] >= share * total]


def heavy_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> dict:
    """Keys holding at least about ``share`` of the rows, with the share they hold.

    One pass with a sketch of frequent items: nothing but one sketch per task is moved,
    however many keys there are.  It tells shares to within a tenth of ``share``.
    """
    tracked = int(40 / share)
    found = df.where(F.col(f"`{key}`").isNotNull()).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(`{key}`, {int(1 / share) + 1}, {tracked})").alias("top")
    ).first()
    return {r["item"]: r["count"] / found["n"] for r in found["top"] or () if r["count"] >= share * found["n"]}


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    row_id: str,
    hot: Sequence | None = None,
    salts: int | None = None,
    how: str = "left",
) -> DataFrame:
    """Join ``facts`` to ``dim`` (unique on ``key``) with hot and null keys spread.

    Fact rows of a hot key go to several partitions and only the hot dimension rows are
    repeated; null keys match nothing and are spread over all.  Hot keys are found
    here by a pass over the facts' keys, each with twice as many pieces as its share asks
    for; a caller that knows them gives them as ``hot`` (none: an empty list), and
    these have ``salts`` pieces, by default one per shuffle partition.
    """
    salts = salts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if hot is None:
        pieces = {k: min(salts, max(2, ceil(2 * part * salts))) for k, part in heavy_keys(facts, key).items()}
    else:
        pieces = dict.fromkeys(hot, salts)
    of = F.lit(1)
    for n in sorted(set(pieces.values())):
        of = F.when(F.col(key).isin([k for k, m in pieces.items() if m == n]), n).otherwise(of)
    many = F.coalesce(of, F.lit(1))
    slot = F.pmod(F.xxhash64(row_id), F.when(F.col(key).isNull(), salts).otherwise(many)).cast("int")
    salted = facts.withColumn("_salt", slot)
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), many - 1)))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns behind a barrier the optimiser does not push filters through.

    A filter on a computed column is otherwise moved below the projection, where
    the expression is evaluated a second time for every row.  The price: a column
    behind the barrier is computed even where a query does not use it.
    """
    for name, expression in columns.items():
        kept = [c for c in df.columns if c != name]
        df = df.select(*kept, F.explode(F.array(expression)).alias(name))
    return df


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and rows with a null in it (which match nothing)."""
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return df.where(complete), df.where(~complete)
