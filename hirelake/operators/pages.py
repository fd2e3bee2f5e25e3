"""Raw page store: content hashing and duplicate suppression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import byte_size, content_hash


def content_winners(pages: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """Ids of the pages whose content is new: earliest per hash, unknown to the store.

    Works on (id, time, hash) only.  The per-hash minimum is combined on the map
    side, so a page copied a billion times sends one row per task.
    """
    seen = (
        pages.select("id", "scraped_at", content_hash(F.col("raw_html")).alias("content_hash"))
        .groupBy("content_hash")
        .agg(F.min(F.struct("scraped_at", "id")).alias("first"))
    )
    if store is not None:
        known = store.where(~F.col("is_duplicate")).select("content_hash")
        seen = seen.join(known, "content_hash", "left_anti")
    return seen.select(F.col("first.id").alias("id"))


def store_pages(pages: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """Rows to append to the page store.

    A repeat keeps its hash and size but not its text.  The join back is on the
    page id, unique on both sides, so equal pages never meet in one task; it is with
    the repeats, mostly few, so that Spark may broadcast them under its own size check
    and leave the pages where they are.
    """
    repeats = (
        pages.select("id").join(content_winners(pages, store), "id", "left_anti").withColumn("_repeat", F.lit(True))
    )
    html = F.col("raw_html")
    # The hash and the size come from the text before it is blanked.
    measured = pages.withColumns(
        {"content_hash": content_hash(html), "html_size": byte_size(html)}
    )
    return (
        measured.join(repeats, "id", "left")
        .withColumn("is_duplicate", F.col("_repeat").isNotNull())
        .withColumn("raw_html", F.when(F.col("_repeat"), F.lit("")).otherwise(html))
        .drop("_repeat")
    )
