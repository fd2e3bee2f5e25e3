"""Posting lifecycle, company metrics, snapshots and run statistics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.sources import values as V


def days_before(as_of: date, days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), days)


def is_stale(as_of: date, days: int = V.STALE_DAYS) -> Column:
    return (F.col("last_seen_date") < days_before(as_of, days)) & F.col("is_active")


def deactivate_stale(postings: DataFrame, as_of: date, days: int = V.STALE_DAYS) -> DataFrame:
    """Close postings unseen for more than ``days`` days: a projection, no shuffle."""
    stale = F.coalesce(is_stale(as_of, days), F.lit(False))
    return postings.withColumns(
        {
            "is_active": F.when(stale, F.lit(False)).otherwise(F.col("is_active")),
            "deactivated_date": F.when(stale, F.lit(as_of).cast("date")).otherwise(
                F.col("deactivated_date")
            ),
        }
    )


def company_activity(postings: DataFrame, as_of: date) -> DataFrame:
    recent = F.col("first_seen_date") >= days_before(as_of, V.VELOCITY_DAYS)
    return (
        postings.where(F.col("is_active") & F.col("company_id").isNotNull())
        .groupBy("company_id")
        .agg(F.count("*").alias("active_count"), F.count_if(recent).alias("count_30d"))
        .withColumn("velocity_30d", velocity(F.col("count_30d")))
    )


def velocity(count: Column) -> Column:
    return F.round(count / F.lit(float(V.VELOCITY_DAYS)), 4)


def refresh_companies(companies: DataFrame, postings: DataFrame, as_of: date) -> DataFrame:
    """Recompute activity of companies with active postings; zero the others that
    were active before.  A company already at zero keeps its velocity."""
    activity = company_activity(postings, as_of).select(
        F.col("company_id").alias("id"), "active_count", "velocity_30d"
    )
    live = F.col("active_count").isNotNull()
    zeroed = F.col("active_job_postings") > 0
    return (
        companies.join(activity, "id", "left")
        .withColumns(
            {
                "active_job_postings": F.when(live, F.col("active_count"))
                .when(zeroed, F.lit(0))
                .otherwise(F.col("active_job_postings"))
                .cast(companies.schema["active_job_postings"].dataType),
                "hiring_velocity_30d": F.when(live, F.col("velocity_30d"))
                .when(zeroed, F.lit(0.0))
                .otherwise(F.col("hiring_velocity_30d")),
                "last_activity_date": F.when(live, F.lit(as_of).cast("date")).otherwise(
                    F.col("last_activity_date")
                ),
            }
        )
        .select(*companies.columns)
    )


def inactive_companies(companies: DataFrame, postings: DataFrame) -> DataFrame:
    """Companies marked active that have no active posting."""
    active = postings.where(F.col("is_active")).select(F.col("company_id").alias("id")).distinct()
    return companies.where("active_job_postings > 0").join(active, "id", "left_anti")


def summary_snapshot(postings: DataFrame, as_of: date) -> DataFrame:
    active = F.col("is_active")
    return postings.agg(
        F.count("*").alias("total_jobs"),
        F.count_if(active).alias("active_jobs"),
        F.count_if(F.col("first_seen_date") >= days_before(as_of, V.NEW_DAYS)).alias("new_last_7d"),
        F.count_if(F.col("deactivated_date") == F.lit(as_of)).alias("deactivated_today"),
        F.count_distinct(F.when(active, F.col("company_id"))).alias("active_companies"),
        F.count_if(F.col("processing_status") == "processed").alias("processed_jobs"),
        F.count_if(F.col("processing_status") == "pending").alias("pending_jobs"),
    )


def _rate(good: Column, done: Column) -> Column:
    return F.when(done > 0, good / done * 100).otherwise(F.lit(0.0))


def run_stats(attempts: DataFrame, total_jobs: int | Column, seconds: Column | None = None) -> DataFrame:
    """Totals, success rate and throughput of a run from its attempts.

    Without ``seconds`` the run lasts from the first to the last attempt.
    """
    total = F.lit(total_jobs) if isinstance(total_jobs, int) else total_jobs
    stats = attempts.agg(
        total.cast("bigint").alias("total_jobs"),
        F.count("success").alias("completed_jobs"),
        F.count_if(~F.col("success")).alias("failed_jobs"),
        (F.max("ts").cast("double") - F.min("ts").cast("double")).alias("_span"),
    )
    took = F.col("_span") if seconds is None else seconds
    return stats.select(
        "total_jobs",
        "completed_jobs",
        "failed_jobs",
        (F.col("completed_jobs") - F.col("failed_jobs")).alias("successful"),
        (F.col("total_jobs") - F.col("completed_jobs")).alias("remaining_jobs"),
        _rate(F.col("completed_jobs") - F.col("failed_jobs"), F.col("completed_jobs")).alias(
            "success_rate"
        ),
        took.alias("duration_seconds"),
        F.when(took > 0, F.col("total_jobs") / took).otherwise(0.0).alias("jobs_per_second"),
    )


def worker_tallies(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("worker_id").agg(
        F.count_if(F.col("success")).alias("completed"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def discovered_by_site(urls: DataFrame) -> DataFrame:
    """Distinct URLs per site with a grand total row (``all``).

    Duplicates are removed once per (site, URL); the total is the sum of the
    sites' counts.
    """
    per_site = urls.select("source_site", "job_url").distinct()
    return (
        per_site.rollup("source_site")
        .agg(F.count("*").alias("discovered"), F.grouping("source_site").alias("_all"))
        .select(
            F.when(F.col("_all") == 1, "all").otherwise(F.col("source_site")).alias("site"),
            "discovered",
        )
    )


def url_totals(urls: DataFrame) -> DataFrame:
    return urls.agg(
        F.count("job_url").alias("total_urls"), F.count_distinct("job_url").alias("unique_urls")
    )


def enrichment_counters(enriched: DataFrame) -> DataFrame:
    """Eight counters of an enrichment run, from its result rows."""
    ok = F.col("processing_status") == "processed"
    return enriched.agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("processed"),
        F.count_if(F.col("processing_status") == "failed").alias("failed"),
        F.count_if(ok & F.col("title_english").isNotNull()).alias("translated_title"),
        F.count_if(ok & F.col("description_english").isNotNull()).alias("translated_description"),
        F.count_if(ok & F.col("company_id").isNotNull()).alias("companies_linked"),
        F.count_if(ok & F.col("location_id").isNotNull()).alias("locations_linked"),
        F.coalesce(
            F.sum(F.when(ok, F.size(F.coalesce("skills", F.array().cast("array<string>"))))),
            F.lit(0),
        ).alias("skills_linked"),
    )
