"""Nightly refresh: close stale postings, refresh companies, take a snapshot."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.operators.metrics import (
    company_activity,
    deactivate_stale,
    is_stale,
    refresh_companies,
    summary_snapshot,
)
from hirelake.sources import values as V
from hirelake.sources.exports import log_event
from hirelake.sources.tables import TableStore


@dataclass
class Refreshed:
    postings: DataFrame
    companies: DataFrame
    summary: DataFrame


def refresh(
    postings: DataFrame, companies: DataFrame, as_of: date, stale_days: int = V.STALE_DAYS
) -> Refreshed:
    """The companies and the snapshot see the postings after deactivation."""
    current = deactivate_stale(postings, as_of, stale_days)
    return Refreshed(
        postings=current,
        companies=refresh_companies(companies, current, as_of),
        summary=summary_snapshot(current, as_of),
    )


def run_refresh(
    store: TableStore, as_of: date, at: datetime, stale_days: int = V.STALE_DAYS
) -> DataFrame:
    """Refresh the store; returns the snapshot.  A failure is logged and raised."""
    name = "analytics_engine"

    def log(status: str, message: str, **more) -> None:
        store.append(
            "processing_logs",
            log_event(store.spark, "analysis", name, status, message, at, **more),
        )

    log("started", "Analytics job starting")
    try:
        before = store.read("job_postings")
        closed = before.where(is_stale(as_of, stale_days)).count()
        current = store.replace("job_postings", deactivate_stale(before, as_of, stale_days))
        store.replace("companies", refresh_companies(store.read("companies"), current, as_of))
        updated = company_activity(current, as_of).count()
        summary = summary_snapshot(current, as_of)
        details = summary.select(
            F.to_json(
                F.struct(
                    F.lit("completed").alias("status"),
                    F.lit(closed).alias("deactivated_jobs"),
                    F.lit(updated).alias("companies_updated"),
                    F.struct("*").alias("summary"),
                )
            )
        ).first()[0]
        log(
            "completed",
            f"Analytics complete: deactivated={closed}, companies_updated={updated}",
            processed=closed + updated,
            details=details,
        )
        return summary
    except Exception as exc:
        log("failed", f"Analytics failed: {exc}", failed=1, error=str(exc))
        raise
