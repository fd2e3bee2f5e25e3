"""Daily rollups that answer the headline reports of any range without the postings.

Two tables, both by first sighting day and site:

* counts: ``(first_seen_date, source_site, measure, label, n)``.  Counts of days add up.
* companies: ``(first_seen_date, source_site, is_active, part, companies)``.  ``companies`` is
  a bitmap of the company ids of one ``part`` (32,768 ids), so distinct companies of any set
  of days are the ones set in the bitwise or, and are exact.

A posting keeps its first sighting day for good, so a change of postings concerns their
days only: ``Rollups.refresh`` counts these anew and replaces them in bucketed tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.operators.metrics import days_before
from hirelake.sources import values as V
from hirelake.sources.buckets import BucketTable

DAY, SITE = "first_seen_date", "source_site"
COUNTS = T.StructType().add(DAY, "date").add(SITE, "string").add("measure", "string").add("label", "string").add("n", "long")
COMPANIES = (
    T.StructType().add(DAY, "date").add(SITE, "string").add("is_active", "boolean").add("part", "long").add("companies", "binary")
)
#: Columns whose values are counted; a null is a value of its own.
LABELS = ["employment_type", "experience_level", "processing_status", "deactivated_date"]
#: Bitmaps a file: 16 MB before compression, which makes them some thirty times smaller.
FILE_BITMAPS = 4096


def count_rollup(postings: DataFrame) -> DataFrame:
    """Postings per day, site and label of each measure, all in one pass.

    The measures are ``is_active`` and the columns ``LABELS``; each posting counts once under
    each of them.  Rows without a day or a site are counted under null.  The grouping sets are combined in the tasks, so what is
    shuffled grows with days, sites and labels, not with postings.
    """
    rows = postings.select(DAY, SITE, "is_active", *[F.col(c).cast("string").alias(c) for c in LABELS])
    measures = ["is_active", *LABELS]
    columns = [F.col(c) for c in (DAY, SITE, *measures)]
    sets = [[F.col(DAY), F.col(SITE), F.col(c)] for c in measures]
    which = F.grouping_id(DAY, SITE, *measures)
    counted = rows.groupingSets(sets, *columns).agg(which.alias("_which"), F.count("*").alias("n"))
    # In a set, the bits of all measures but its own are on.
    full = (1 << len(measures)) - 1
    parts = [
        F.when(F.col("_which") == full ^ (1 << (len(measures) - 1 - i)), F.struct(F.lit(c).alias("measure"), F.col(c).cast("string").alias("label")))
        for i, c in enumerate(measures)
    ]
    return counted.select(DAY, SITE, F.coalesce(*parts).alias("m"), "n").select(DAY, SITE, "m.*", "n")


def company_rollup(postings: DataFrame) -> DataFrame:
    """Bitmaps of the companies with postings per day, site and activity; null companies are none.

    Ids are shuffled before they become bitmaps: a task's part of a day has few companies, and
    each such part would be a bitmap of 4 KB on its way.
    """
    company = F.col("company_id").cast("long")
    keys = [DAY, SITE, "is_active", "part"]
    return (
        postings.where(company.isNotNull())
        .select(DAY, SITE, "is_active", F.bitmap_bucket_number(company).alias("part"), F.bitmap_bit_position(company).alias("_bit"))
        .repartition(*keys)
        .groupBy(*keys)
        .agg(F.bitmap_construct_agg("_bit").alias("companies"))
    )


class Rollups:
    """Both rollups as bucketed tables under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.counts = BucketTable(spark, f"{path}/counts", COUNTS, [DAY], buckets)
        self.companies = BucketTable(spark, f"{path}/companies", COMPANIES, [DAY], buckets, file_rows=FILE_BITMAPS)

    def refresh(self, postings: DataFrame, changed: DataFrame) -> None:
        """Count the days of ``changed`` anew from ``postings``, the state after the change.

        The same refresh done twice gives the same, also after a crash between the tables.
        """
        days = changed.select(F.col(DAY).alias("_day")).distinct()
        # The calendar bounds the days, so they may be broadcast; a busy day then stays spread.
        touched = postings.join(F.broadcast(days), F.col(DAY).eqNullSafe(F.col("_day")), "left_semi")
        for stored, fresh in ((self.counts, count_rollup(touched)), (self.companies, company_rollup(touched))):
            stored.merge(days.select(F.col("_day").alias(DAY)), lambda old, new, fresh=fresh: _replaced(old, new, fresh))


def _replaced(old: DataFrame, days: DataFrame, fresh: DataFrame) -> DataFrame:
    new = days.select(F.col(DAY).alias("_day"))
    return old.join(new, F.col(DAY).eqNullSafe(F.col("_day")), "left_anti").unionByName(fresh)


def _ranged(rollup: DataFrame, as_of: date, site: str, days: int | None) -> DataFrame:
    if site != "all":
        rollup = rollup.where(F.col(SITE) == site)
    return rollup if days is None else rollup.where(F.col(DAY) >= days_before(as_of, days))


def _n(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def distinct_companies(companies: DataFrame) -> DataFrame:
    """One row ``(companies)``: how many distinct ones the given days and sites have."""
    per_part = companies.groupBy("part").agg(F.bitmap_count(F.bitmap_or_agg("companies")).alias("k"))
    return per_part.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("companies"))


def market_stats(counts: DataFrame, companies: DataFrame, as_of: date, site: str = "all", days: int | None = 30) -> DataFrame:
    """Headline numbers as ``reports.market_stats`` gives them."""
    rows = _ranged(counts, as_of, site, days).where(F.col("measure") == "is_active")
    return rows.agg(
        _n(F.lit(True)).alias("total_jobs"),
        _n(F.col("label") == "true").alias("active_jobs"),
        _n(F.col(DAY) >= days_before(as_of, V.NEW_DAYS)).alias("new_this_week"),
    ).select(
        "total_jobs", "active_jobs",
        distinct_companies(_ranged(companies, as_of, site, days)).scalar().alias("companies"),
        "new_this_week",
    )


def summary_snapshot(counts: DataFrame, companies: DataFrame, as_of: date) -> DataFrame:
    """The nightly snapshot as ``metrics.summary_snapshot`` gives it, over all days."""
    measure, label = F.col("measure"), F.col("label")
    active = measure == "is_active"
    return counts.agg(
        _n(active).alias("total_jobs"),
        _n(active & (label == "true")).alias("active_jobs"),
        _n(active & (F.col(DAY) >= days_before(as_of, V.NEW_DAYS))).alias("new_last_7d"),
        _n((measure == "deactivated_date") & (label == as_of.isoformat())).alias("deactivated_today"),
        _n((measure == "processing_status") & (label == "processed")).alias("processed_jobs"),
        _n((measure == "processing_status") & (label == "pending")).alias("pending_jobs"),
    ).select(
        "total_jobs", "active_jobs", "new_last_7d", "deactivated_today",
        distinct_companies(companies.where("is_active")).scalar().alias("active_companies"),
        "processed_jobs", "pending_jobs",
    )


def daily_by_site(counts: DataFrame, as_of: date, site: str = "all", days: int | None = V.ALL_RANGE_DAYS_SERIES) -> DataFrame:
    """Postings per day and site as ``reports.daily_by_site`` gives them."""
    rows = _ranged(counts, as_of, site, days).where(F.col("measure") == "is_active")
    return (
        rows.groupBy(DAY, SITE)
        .agg(F.sum("n").alias("count"))
        .select(F.col(DAY).cast("string").alias("date"), SITE, "count")
        .orderBy("date", SITE)
    )


def breakdowns(counts: DataFrame, as_of: date, site: str = "all", days: int | None = 30) -> DataFrame:
    """The three breakdowns as ``reports.breakdowns`` gives them."""
    rows = _ranged(counts, as_of, site, days)
    by_site = F.col("measure") == "is_active"
    return (
        rows.where(F.col("measure").isin("employment_type", "experience_level", "is_active"))
        .groupBy(
            F.when(by_site, SITE).otherwise(F.col("measure")).alias("dimension"),
            F.when(by_site, F.col(SITE)).otherwise(F.col("label")).alias("raw"),
        )
        .agg(F.sum("n").alias("count"))
        .select(
            "dimension",
            F.when(F.col("dimension") == SITE, F.col("raw")).otherwise(F.coalesce("raw", F.lit(V.UNKNOWN))).alias("label"),
            "count",
        )
        .orderBy("dimension", F.desc("count"), "label")
    )
