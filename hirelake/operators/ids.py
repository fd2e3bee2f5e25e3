"""Dense surrogate ids without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.sources.tables import settled

ROWS_PER_SLICE = 1_000_000
_MAX_SLICES = 4_096


def next_id(table: DataFrame, id_col: str = "id") -> int:
    return (table.agg(F.max(id_col)).first()[0] or 0) + 1


def assign_ids(
    rows: DataFrame,
    order_by: str,
    tie: str,
    start: int,
    id_col: str = "id",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number ``rows`` from ``start`` in (``order_by``, ``tie``) order.

    ``order_by`` is numeric and close to unique.  Approximate quantiles cut the
    rows into ranges that are numbered independently; each range then starts
    where the earlier ones end.  The rows are computed once, and the cut points are
    fixed numbers in the plan, so a recomputed task gives the same ids.
    """
    rows = settled(rows)
    total = rows.count()
    slices = min(max(-(-total // rows_per_slice), 1), _MAX_SLICES)
    cuts: list = []
    if slices > 1:
        shares = [i / slices for i in range(1, slices)]
        cuts = sorted(set(rows.agg(F.percentile_approx(order_by, shares, 100_000)).first()[0]))
    points = F.array(*[F.lit(c) for c in cuts]).cast("array<double>")
    at = F.col(order_by).cast("double")
    sliced = rows.withColumn("_slice", F.size(F.filter(points, lambda p: p < at)))
    order = Window.partitionBy("_slice").orderBy(order_by, tie)
    numbered = sliced.withColumn("_rank", F.row_number().over(order))
    if not cuts:
        return numbered.withColumn(id_col, F.col("_rank") + F.lit(start - 1)).drop(
            "_slice", "_rank"
        )
    # One row per slice, at most _MAX_SLICES rows: a single ordered window is fine.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        sliced.groupBy("_slice")
        .count()
        .select("_slice", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        numbered.join(offsets, "_slice")
        .withColumn(id_col, F.col("_offset") + F.col("_rank") + F.lit(start - 1))
        .drop("_slice", "_rank", "_offset")
    )
