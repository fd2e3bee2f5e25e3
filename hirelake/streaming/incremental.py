"""Streaming forms of tracking, deduplication and daily counts.

Event times must be ``timestamp`` (cast NTZ columns first).  State is bounded by
watermarks, or lives in a table that ``foreachBatch`` merges into.  Streams into a
``BucketTable`` rewrite only the buckets that a micro-batch touches, and merge so that a
batch which is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from hirelake.functions.text import content_hash
from hirelake.operators.metrics import deactivate_stale
from hirelake.operators.tracking import first_occurrences, track_urls, upsert_postings
from hirelake.sources import values as V
from hirelake.sources.buckets import BucketTable
from hirelake.sources.tables import TableStore


def unique_discoveries(found: DataFrame, delay: str = "1 day") -> DataFrame:
    """One row per (session, URL) within the watermark."""
    return found.withWatermark("ts", delay).dropDuplicatesWithinWatermark(
        ["scrape_session_id", "job_url"]
    )


def new_content(pages: DataFrame, delay: str = "1 day") -> DataFrame:
    """Pages whose content was not seen within the watermark.

    Only the hash and the row's key are held in state.
    """
    return (
        pages.withColumn("content_hash", content_hash(F.col("raw_html")))
        .withWatermark("ts", delay)
        .dropDuplicatesWithinWatermark(["content_hash"])
    )


def request_rates(requests: DataFrame, delay: str = "2 minutes") -> DataFrame:
    """Requests per site in one-minute windows sliding by ten seconds."""
    return (
        requests.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 minute", "10 seconds"), "source_site")
        .agg(F.count("*").alias("requests"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "source_site",
            "requests",
        )
    )


def daily_counts(rows: DataFrame, delay: str = "1 day") -> DataFrame:
    """Rows per day and site."""
    return (
        rows.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day"), "source_site")
        .agg(F.count("*").alias("count"))
        .select(F.col("window.start").alias("day"), "source_site", "count")
    )


def _absent(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose key ``other`` lacks; null is a key like any other."""
    same = reduce(lambda x, y: x & y, [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys])
    return rows.alias("r").join(other.select(*keys).alias("o"), same, "left_anti")


def _into_buckets(rows: DataFrame, table: BucketTable, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataStreamWriter:
    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read twice: for the buckets it touches, and for the merge
        try:
            table.merge(batch, merge)
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(apply)


def first_rows_stream(rows: DataFrame, table: BucketTable, order: Sequence[str]) -> DataStreamWriter:
    """Keep the first row of each key of ``table``, however long ago that came.

    There is no state besides the table: a micro-batch is folded to one row per key, the
    least by ``order``, and meets only the buckets that hold its keys.  Later rows of a
    key change nothing, nor does a replayed batch.  Null is a key like any other.
    """

    def merge(old: DataFrame, batch: DataFrame) -> DataFrame:
        fresh = first_occurrences(batch, table.keys, list(order)).select(*table.schema.names)
        return old.unionByName(_absent(fresh, old, table.keys))

    return _into_buckets(rows, table, merge)


def totals_stream(totals: DataFrame, table: BucketTable) -> DataStreamWriter:
    """Keep a stream's aggregates in ``table``, keyed by what they are grouped by.

    In update mode each micro-batch brings the groups that it changed, with their totals
    so far, which take the place of the stored ones.  So windows that are still open are
    there too; those behind the watermark leave the state and stay in the table.
    """

    def merge(old: DataFrame, batch: DataFrame) -> DataFrame:
        return _absent(old, batch, table.keys).unionByName(batch.select(*table.schema.names))

    return _into_buckets(totals, table, merge).outputMode("update")


def track_buckets(found: DataFrame, table: BucketTable, order: Sequence[str]) -> DataStreamWriter:
    """First and last sighting per URL, in a tracking table keyed by ``job_url``.

    Sightings without a URL are left out.  A replayed batch gives the same rows, provided
    that batches come in the order of their sightings.
    """
    known = found.where(F.col("job_url").isNotNull())
    return _into_buckets(known, table, lambda old, batch: track_urls(old, batch, list(order), small_batch=True))


def _merge_into(store: TableStore, table: str, stream: str, merge, keep: int):
    """A ``foreachBatch`` function merging each batch of ``stream`` exactly once.

    The batch id is committed together with the version it produced, under the
    stream's name, so a batch replayed after a failure is recognised and skipped, and
    other streams into the same table don't meddle.  All but the last ``keep``
    versions are dropped.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        if store.applied(table).get(stream, -1) < batch_id:
            base = store.version(table)
            store.replace(table, merge(store.read(table, base), batch), batch=(stream, batch_id), base=base)
            store.vacuum(table, keep)

    return apply


def track_stream(
    found: DataFrame, store: TableStore, order: list[str], stream: str = "discoveries", keep: int = 2
) -> DataStreamWriter:
    """Merge a discovery stream into the URL tracking table.

    ``stream`` names it: one name for each checkpoint folder, a new one with a new
    folder, as batch ids then start again.
    """

    def merge(old: DataFrame, batch: DataFrame) -> DataFrame:
        return track_urls(old, batch, order, small_batch=True)

    return found.writeStream.foreachBatch(_merge_into(store, "job_tracking", stream, merge, keep))


def posting_stream(
    found: DataFrame, store: TableStore, order: list[str], stream: str = "postings", keep: int = 2
) -> DataStreamWriter:
    """Upsert a posting stream into the posting table; ``stream`` as for ``track_stream``."""

    def merge(old: DataFrame, batch: DataFrame) -> DataFrame:
        return upsert_postings(old, batch, order, small_batch=True)

    return found.writeStream.foreachBatch(_merge_into(store, "job_postings", stream, merge, keep))


def expire(store: TableStore, as_of: date, days: int = V.STALE_DAYS) -> DataFrame:
    """Periodic staleness pass over the streamed postings, as a new version."""
    return store.replace("job_postings", deactivate_stale(store.read("job_postings"), as_of, days))
