"""Ordered computations over groups of any size: streaks and sliding counts.

A plain window would sort a whole group in one task.  Both operators cut the
order axis into blocks, work inside a block and carry one row per block across.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.sources import values as V

PAGE_BLOCK = 1_000


def early_stop(
    ratios: DataFrame,
    pages_in_row: int = V.EARLY_STOP_PAGES,
    threshold: float = V.EARLY_STOP_RATIO,
    block: int = PAGE_BLOCK,
) -> DataFrame:
    """First page ending ``pages_in_row`` consecutive seen-only pages.

    ``ratios``: one row per (source_site, keyword, page) with ``seen_ratio`` and
    ``total_count``.  Groups that never stop are absent; 0 disables the rule.
    """
    group = ["source_site", "keyword"]
    if pages_in_row <= 0:
        return ratios.select(*group, F.col("page").alias("stop_page")).where(F.lit(False))
    cell = [*group, "_block"]
    passed = (F.col("total_count") > 0) & (F.col("seen_ratio") >= threshold)
    inside = Window.partitionBy(*cell).orderBy("page")
    local = (
        ratios.select(*group, "page", passed.alias("_pass"))
        .withColumn("_block", F.floor(F.col("page") / block))
        .withColumn("_pos", F.row_number().over(inside))
    )
    blocks = local.groupBy(*cell).agg(
        F.count("*").alias("_size"),
        F.max(F.when(~F.col("_pass"), F.col("_pos"))).alias("_fail"),
    )
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    started = blocks.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    carried = started.select(
        *cell,
        "_start",
        F.coalesce(F.max(F.col("_start") + F.col("_fail")).over(before), F.lit(0)).alias("_prev"),
    )
    position = F.col("_start") + F.col("_pos")
    fails = F.max(F.when(~F.col("_pass"), F.col("_pos"))).over(
        inside.rowsBetween(Window.unboundedPreceding, 0)
    )
    last_fail = F.coalesce(F.col("_start") + F.col("_last"), F.col("_prev"))
    return (
        local.withColumn("_last", fails)
        .join(carried, cell)
        .where(position - last_fail >= pages_in_row)
        .groupBy(*group)
        .agg(F.min("page").alias("stop_page"))
    )


def rate_audit(requests: DataFrame, capacity: Mapping[str, int], default: int) -> DataFrame:
    """Requests of the last 60 seconds at every request instant of a site.

    ``requests``: ``source_site, ts``.  Instants are counted first; each one then
    joins its own minute and the next as context, so a window never spans more
    than two minutes of distinct instants.
    """
    instants = requests.groupBy("source_site", "ts").agg(F.count("*").alias("requests"))
    minute = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    cells = instants.withColumn("_minute", minute).withColumn("_us", micros).withColumn(
        "_cell", F.explode(F.array(F.col("_minute"), F.col("_minute") + 1))
    )
    # A request exactly 60 s old has left the window.
    recent = Window.partitionBy("source_site", "_cell").orderBy("_us").rangeBetween(
        -59_999_999, Window.currentRow
    )
    limits: Column = F.create_map(*[F.lit(x) for kv in capacity.items() for x in kv])
    limit = F.coalesce(F.try_element_at(limits, F.col("source_site")), F.lit(default))
    return (
        cells.withColumn("requests_in_window", F.sum("requests").over(recent))
        .where(F.col("_cell") == F.col("_minute"))
        .select(
            "source_site",
            "ts",
            "requests",
            "requests_in_window",
            limit.alias("capacity"),
            F.greatest(limit - F.col("requests_in_window"), F.lit(0)).alias("remaining"),
            (F.col("requests_in_window") / limit * 100).alias("utilization_percent"),
        )
    )
