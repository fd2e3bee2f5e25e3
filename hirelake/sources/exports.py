"""JSON exports and run logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.text import error_text
from hirelake.sources import values as V
from hirelake.sources.schemas import SCHEMAS


def as_json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON text (``value``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def export_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, optionally one folder per value of ``by``."""
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(by)
    writer.json(path)


def export_each(df: DataFrame, path: str, key: str) -> None:
    """One folder per posting, named by its external id.

    Without one the name is ``job_`` and the hash of the URL.  Rows are spread by
    name first, so a task opens only its own folders.
    """
    unnamed = F.concat(F.lit("job_"), F.sha2("source_url", 256))
    named = df.withColumn("file", F.coalesce(F.nullif(F.col(key), F.lit("")), unnamed))
    named.repartition("file").write.mode("overwrite").partitionBy("file").json(path)


def discovered_url_summary(urls: DataFrame, session_id: str, at: datetime) -> DataFrame:
    """Header of a discovered-URL export; the URLs themselves go to ``export_json``."""
    return urls.agg(
        F.lit(session_id).alias("session_id"),
        F.lit(at.isoformat()).alias("timestamp"),
        F.count("job_url").alias("total_urls"),
        F.count_distinct("job_url").alias("unique_urls"),
    )


def failures(attempts: DataFrame, reason: Column | None = None) -> DataFrame:
    """``(url, reason)`` of failed attempts."""
    why = F.lit("no_data") if reason is None else reason
    return attempts.where(~F.col("success")).select(F.col("job_url").alias("url"), why.alias("reason"))


def session_summary(
    discoveries: DataFrame,
    attempts: DataFrame,
    session_id: str,
    scraper: str,
    start: datetime,
    end: datetime,
    limit_pages: int | None = None,
    limit_jobs: int | None = None,
) -> DataFrame:
    """One row describing a run: both phases, limits and duration."""
    found = discoveries.agg(
        F.count("job_url").alias("total_discovered"),
        F.count_distinct("job_url").alias("unique_discovered"),
        F.count_distinct("found_on_page").alias("pages_scraped"),
    ).select(F.struct("*").alias("phase_1_discovery"))
    tried = attempts.agg(
        F.count("*").alias("total_attempted"),
        F.count_if(F.col("success")).alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
    )
    rate = F.when(
        F.col("total_attempted") > 0, F.col("successful") / F.col("total_attempted") * 100
    ).otherwise(0.0)
    details = tried.withColumn("success_rate", rate).select(F.struct("*"))
    return found.select(
        F.lit(session_id).alias("session_id"),
        F.lit(scraper).alias("scraper"),
        F.lit(start.isoformat()).alias("start_time"),
        F.lit(end.isoformat()).alias("end_time"),
        F.lit((end - start).total_seconds()).alias("duration_seconds"),
        "phase_1_discovery",
        details.scalar().alias("phase_2_detail_scraping"),
        F.struct(
            F.lit(limit_pages).cast("int").alias("limit_pages"),
            F.lit(limit_jobs).cast("int").alias("limit_jobs"),
        ).alias("limits"),
    )


def log_event(
    spark: SparkSession,
    process_type: str,
    process_id: str,
    status: str,
    message: str,
    at: datetime,
    processed: int = 0,
    failed: int = 0,
    details: str | None = None,
    error: str | None = None,
) -> DataFrame:
    """One row for the processing log."""
    row = {
        "process_type": process_type, "process_id": process_id, "status": status,
        "message": message, "details_json": details, "records_processed": processed,
        "records_failed": failed, "error_details": error[:V.ERROR_TEXT_LIMIT] if error else None,
        "timestamp": at,
    }
    schema = SCHEMAS["processing_logs"]
    return spark.createDataFrame([tuple(row.get(n) for n in schema.names)], schema)


def failure_log(failed: DataFrame, process_id: str, at: datetime) -> DataFrame:
    """Log rows for failed postings ``(id, error)``."""
    schema = SCHEMAS["processing_logs"]
    given = {
        "process_type": F.lit("processing"),
        "process_id": F.lit(process_id),
        "entity_type": F.lit("job_posting"),
        "entity_id": F.col("id"),
        "status": F.lit("failed"),
        "message": F.concat(F.lit("Failed processing job_posting id="), F.col("id").cast("string")),
        "records_processed": F.lit(0),
        "records_failed": F.lit(1),
        "error_details": error_text(F.col("error")),
        "timestamp": F.lit(at),
    }
    return failed.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
