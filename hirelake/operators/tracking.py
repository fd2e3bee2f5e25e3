"""Discovery log, URL and company tracking, progress (keyed by natural keys)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.operators.merge import fill, fold, insert_absent, keyed_merge, take
from hirelake.operators.skew import lookup, split_null_keys
from hirelake.sources import values as V


def _day(as_of: date | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def first_occurrences(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by ``order``.

    The rank filter is planned with a local limit before the shuffle, so a hot key
    sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def new_discoveries(log: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """Discoveries to append: one per (session, URL), not yet in the log."""
    keys = ["scrape_session_id", "job_url"]
    return insert_absent(log, first_occurrences(batch, keys, order), keys)


def track_urls(
    tracking: DataFrame,
    found: DataFrame,
    order: list[str],
    key: str = "job_url",
    small_batch: bool = False,
) -> DataFrame:
    """First/last sighting per URL.

    ``found`` has the key, ``source_site``, ``session``, ``day`` and the ``order``
    columns.  A known URL gets the last sighting and becomes active again.
    """
    seq = F.struct(*order)
    sightings = found.groupBy(key).agg(
        F.min_by(F.struct("source_site", "session", "day"), seq).alias("a"),
        F.max_by(F.struct("session", "day"), seq).alias("z"),
    )
    batch = sightings.select(
        key,
        F.col("a.source_site").alias("source_site"),
        F.col("a.session").alias("first_seen_session"),
        F.col("z.session").alias("last_seen_session"),
        F.col("a.day").alias("first_seen_date"),
        F.col("z.day").alias("last_seen_date"),
        *_new_url_defaults(key),
    )
    rules = {"last_seen_session": take, "last_seen_date": take, "is_active": take}
    return keyed_merge(tracking, batch, [key], rules, small_batch)


def _new_url_defaults(key: str) -> list[Column]:
    if key == "job_url":
        return [
            F.lit(True).alias("is_active"),
            F.lit(False).alias("detail_scraped"),
            F.lit(0).alias("detail_scrape_count"),
        ]
    return [F.lit(False).alias("profile_scraped"), F.lit(0).alias("profile_scrape_count")]


def track_companies(tracking: DataFrame, found: DataFrame, order: list[str]) -> DataFrame:
    known = found.where(F.col("company_url").isNotNull())
    return track_urls(tracking, known, order, key="company_url")


def mark_scraped(
    tracking: DataFrame,
    attempts: DataFrame,
    as_of: date | Column,
    key: str = "job_url",
    kind: str = "detail",
) -> DataFrame:
    """Apply scrape attempts ``(key, success)``; unknown URLs change nothing.

    A success sets the flag for good; every attempt counts and dates the row.
    """
    flag = "detail_scraped" if kind == "detail" else "profile_scraped"
    when, count = f"last_{kind}_scrape_date", f"{kind}_scrape_count"
    tally = attempts.groupBy(key).agg(
        F.bool_or("success").alias("_any"), F.count("*").cast("int").alias("_n")
    )
    tried = F.col("_n").isNotNull()
    return (
        tracking.join(tally, key, "left")
        .withColumn(flag, F.col(flag) | F.coalesce("_any", F.lit(False)))
        .withColumn(when, F.when(tried, _day(as_of)).otherwise(F.col(when)))
        .withColumn(count, F.col(count) + F.coalesce("_n", F.lit(0)))
        .select(*tracking.columns)
    )


def seen_urls(tracking: DataFrame, urls: DataFrame) -> DataFrame:
    """The given URLs that are already tracked."""
    return urls.select("job_url").distinct().join(tracking.select("job_url"), "job_url", "left_semi")


def detail_worklist(tracking: DataFrame, limit: int | None = V.DETAIL_BATCH) -> DataFrame:
    """Active URLs without details, oldest first (URL as tie-breaker)."""
    todo = tracking.where(~F.col("detail_scraped") & F.col("is_active")).select(
        "job_url", "source_site", "first_seen_date", "detail_scrape_count"
    )
    return todo if limit is None else todo.orderBy("first_seen_date", "job_url").limit(limit)


def profile_worklist(tracking: DataFrame, limit: int | None = V.PROFILE_BATCH) -> DataFrame:
    todo = tracking.where(~F.col("profile_scraped")).select(
        "company_url", "source_site", "first_seen_date", "profile_scrape_count"
    )
    return todo if limit is None else todo.orderBy("first_seen_date", "company_url").limit(limit)


def with_handler(worklist: DataFrame, handlers: dict[str, str]) -> DataFrame:
    """Name the extraction rule set for each row's site."""
    names = F.create_map(*[F.lit(x) for kv in handlers.items() for x in kv])
    return worklist.withColumn("handler", F.try_element_at(names, F.col("source_site")))


def update_progress(progress: DataFrame, pages: DataFrame) -> DataFrame:
    """Latest successful page per site from ``(source_site, page, at, session)``."""
    batch = (
        pages.groupBy("source_site")
        .agg(F.max_by(F.struct("page", "at", "session"), F.struct("at", "page")).alias("l"))
        .select(
            "source_site",
            F.col("l.page").alias("last_success_page"),
            F.col("l.at").alias("last_success_at"),
            F.col("l.session").alias("last_session_id"),
        )
    )
    rules = dict.fromkeys(["last_success_page", "last_success_at", "last_session_id"], take)
    return keyed_merge(progress, batch, ["source_site"], rules)


def last_success_page(progress: DataFrame, site: str) -> DataFrame:
    """One row: the site's last page, 0 when it has none."""
    return progress.where(F.col("source_site") == site).agg(
        F.coalesce(F.max("last_success_page"), F.lit(0)).alias("last_success_page")
    )


def seen_ratio(listing: DataFrame, tracking: DataFrame, hot: Sequence | None = None) -> DataFrame:
    """Share of a listing page's URLs that are tracked already.

    ``listing`` has one row per link: ``source_site, keyword, page, job_url``.
    The numerator counts distinct URLs, the denominator every link.
    """
    page = ["source_site", "keyword", "page"]
    links = listing.groupBy(*page, "job_url").agg(F.count("*").alias("_n")).withColumn(
        "_row", F.xxhash64(*page)
    )
    known = tracking.select("job_url", F.lit(1).alias("_seen"))
    flagged = lookup(links, known, "job_url", "_row", hot)
    return flagged.groupBy(*page).agg(
        F.count("_seen").alias("seen_count"),
        F.sum(F.when(F.col("job_url").isNotNull(), F.col("_n")).otherwise(0)).alias("total_count"),
    ).withColumn(
        "seen_ratio",
        F.when(F.col("total_count") > 0, F.col("seen_count") / F.col("total_count")).otherwise(0.0),
    )


def fold_postings(batch: DataFrame, order: list[str]) -> DataFrame:
    return fold(
        batch,
        ["source_site", "external_id"],
        order,
        last=["last_seen_date"],
        last_known=["raw_scrape_id", "description_persian", "company_name_raw", "location_raw"],
    )


def upsert_postings(
    postings: DataFrame, batch: DataFrame, order: list[str], small_batch: bool = False
) -> DataFrame:
    """Posting upsert on (site, external id).

    A known posting gets the new last sighting, becomes active and has four
    columns refreshed where the batch knows a value; all else stays, including the
    deactivation date.  Rows without an external id are always inserted.
    """
    keys = ["source_site", "external_id"]
    extra = [c for c in order if c not in postings.columns]
    complete, loose = split_null_keys(batch, keys)
    ready = posting_defaults(fold_postings(complete, order).drop(*extra))
    unkeyed = posting_defaults(loose.drop(*extra))
    rules = {
        "last_seen_date": take,
        "is_active": lambda old, new: F.lit(True),
        "raw_scrape_id": fill,
        "description_persian": fill,
        "company_name_raw": fill,
        "location_raw": fill,
    }
    return keyed_merge(postings, ready, keys, rules, small_batch, unkeyed)


def posting_defaults(batch: DataFrame) -> DataFrame:
    """Defaults of a new posting row."""
    defaults = {
        "is_active": F.lit(True),
        "processing_status": F.lit("pending"),
        "employment_type": F.lit(V.UNKNOWN),
        "experience_level": F.lit(V.UNKNOWN),
        "gender_requirement": F.lit(V.UNKNOWN),
        "education_level": F.lit(V.UNKNOWN),
        "salary_currency_original": F.lit(V.DEFAULT_CURRENCY),
    }
    filled = {
        c: F.coalesce(F.col(c), d) if c in batch.columns else d for c, d in defaults.items()
    }
    return batch.withColumns(filled)

