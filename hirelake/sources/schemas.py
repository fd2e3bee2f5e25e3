"""Table schemas, natural keys, references and constraint rules.

Schemas are declared, never inferred.  Constraints are data: each rule names a
violation and gives the condition a valid row meets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.sources import values as V

_DDL = {
    "raw_scrapes": (
        "id bigint, source_site string, source_url string, page_type string, "
        "scrape_session_id string, raw_html string, html_size int, response_status int, "
        "content_hash string, is_duplicate boolean, processing_status string, "
        "error_message string, scraped_at timestamp_ntz"
    ),
    "locations": (
        "id int, city_persian string, location_normalized string, location_type string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "skills": (
        "id int, skill_name_english string, skill_category string, first_seen_date date, "
        "last_seen_date date, is_active boolean, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"
    ),
    "companies": (
        "id int, display_name_persian string, canonical_name string, first_seen_date date, "
        "last_activity_date date, is_active boolean, total_job_postings int, "
        "active_job_postings int, hiring_velocity_30d double, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"
    ),
    "job_postings": (
        "id bigint, raw_scrape_id bigint, external_id string, source_site string, "
        "source_url string, title_persian string, title_english string, "
        "title_normalized string, description_persian string, description_english string, "
        "company_name_raw string, company_url string, company_id int, location_raw string, "
        "location_id int, employment_type string, experience_level string, "
        "gender_requirement string, education_level string, salary_min_original double, "
        "salary_max_original double, salary_currency_original string, "
        "skills_required array<string>, skills_preferred array<string>, "
        "technologies_mentioned array<string>, posted_date date, first_seen_date date, "
        "last_seen_date date, is_active boolean, deactivated_date date, "
        "processing_status string"
    ),
    "job_discoveries": (
        "id bigint, scrape_session_id string, job_url string, company_url string, "
        "source_site string, found_on_page string, discovered_at timestamp_ntz"
    ),
    "job_tracking": (
        "job_url string, source_site string, first_seen_session string, "
        "last_seen_session string, first_seen_date date, last_seen_date date, "
        "is_active boolean, disappeared_date date, disappeared_session string, "
        "detail_scraped boolean, last_detail_scrape_date date, detail_scrape_count int"
    ),
    "job_skills": (
        "job_posting_id bigint, skill_id int, requirement_type string, "
        "proficiency_level string, confidence_score double, extraction_method string"
    ),
    "company_tracking": (
        "company_url string, source_site string, first_seen_session string, "
        "last_seen_session string, first_seen_date date, last_seen_date date, "
        "profile_scraped boolean, last_profile_scrape_date date, profile_scrape_count int"
    ),
    "processing_logs": (
        "process_type string, process_id string, scrape_session_id string, "
        "entity_type string, entity_id bigint, status string, message string, "
        "details_json string, records_processed int, records_failed int, "
        "error_details string, timestamp timestamp_ntz"
    ),
    "translation_cache": (
        "source_text_hash string, source_text string, source_language string, "
        "target_language string, translated_text string, translation_service string, "
        "translation_confidence double, last_used_at timestamp_ntz, usage_count int"
    ),
    "scrape_progress": (
        "source_site string, last_success_page int, last_success_at timestamp_ntz, "
        "last_session_id string"
    ),
}

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(), "array<string>": T.ArrayType(T.StringType()),
}


def _struct(ddl: str) -> T.StructType:
    """``StructType.fromDDL`` needs a running session; modules are imported before it."""
    columns = (column.split(" ") for column in ddl.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


SCHEMAS: dict[str, T.StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}

# Append-only tables are partitioned by the run that wrote them.
APPEND_ONLY = {
    "raw_scrapes": ["scrape_session_id"],
    "job_discoveries": ["scrape_session_id"],
    "processing_logs": ["process_type"],
}

NATURAL_KEYS = {
    "locations": ["location_normalized"],
    "skills": ["skill_name_english"],
    "companies": ["canonical_name"],
    "job_postings": ["source_site", "external_id"],
    "job_discoveries": ["scrape_session_id", "job_url"],
    "job_tracking": ["job_url"],
    "job_skills": ["job_posting_id", "skill_id"],
    "company_tracking": ["company_url"],
    "translation_cache": ["source_text_hash"],
    "scrape_progress": ["source_site"],
}

# child table, child column, parent table, parent column
REFERENCES = [
    ("job_postings", "raw_scrape_id", "raw_scrapes", "id"),
    ("job_postings", "company_id", "companies", "id"),
    ("job_postings", "location_id", "locations", "id"),
    ("job_skills", "job_posting_id", "job_postings", "id"),
    ("job_skills", "skill_id", "skills", "id"),
]

_ENUMS: dict[str, dict[str, tuple[str, ...]]] = {
    "raw_scrapes": {
        "source_site": V.SITES, "page_type": V.PAGE_TYPES,
        "processing_status": V.PROCESSING_STATUSES,
    },
    "locations": {"location_type": V.LOCATION_TYPES},
    "skills": {"skill_category": V.SKILL_CATEGORIES},
    "job_postings": {"source_site": V.SITES, "processing_status": V.PROCESSING_STATUSES},
    "job_discoveries": {"source_site": V.SITES},
    "job_tracking": {"source_site": V.SITES},
    "job_skills": {
        "requirement_type": V.REQUIREMENT_TYPES, "proficiency_level": V.PROFICIENCY_LEVELS,
        "extraction_method": V.EXTRACTION_METHODS,
    },
    "company_tracking": {"source_site": V.SITES},
    "processing_logs": {
        "process_type": V.PROCESS_TYPES, "entity_type": V.ENTITY_TYPES,
        "status": V.LOG_STATUSES,
    },
}

_REQUIRED = {
    "raw_scrapes": ["source_site", "source_url"],
    "skills": ["skill_name_english", "skill_category", "first_seen_date", "last_seen_date"],
    "companies": ["first_seen_date"],
    "job_postings": [
        "source_site", "source_url", "title_persian", "first_seen_date", "last_seen_date",
    ],
    "job_discoveries": ["scrape_session_id", "job_url", "source_site"],
    "job_tracking": [
        "job_url", "source_site", "first_seen_session", "last_seen_session",
        "first_seen_date", "last_seen_date",
    ],
    "job_skills": ["job_posting_id", "skill_id", "requirement_type"],
    "company_tracking": [
        "company_url", "source_site", "first_seen_session", "last_seen_session",
        "first_seen_date", "last_seen_date",
    ],
    "processing_logs": ["process_type", "status"],
    "translation_cache": ["source_text_hash", "source_text"],
    "scrape_progress": ["source_site", "last_success_page"],
}


def rules(table: str, enums: dict[str, tuple[str, ...]] | None = None) -> dict[str, Column]:
    """Violation name -> condition a valid row meets.

    ``enums`` replaces or widens value lists, e.g. for another set of sites.  As
    with a CHECK constraint, a null passes an enum rule.
    """
    allowed = {**_ENUMS.get(table, {}), **(enums or {})}
    out = {f"{c}_missing": F.col(c).isNotNull() for c in _REQUIRED.get(table, [])}
    for c, options in allowed.items():
        out[f"{c}_not_allowed"] = F.col(c).isNull() | F.col(c).isin(*options)
    if table == "job_skills":
        score = F.col("confidence_score")
        out["confidence_score_range"] = score.isNull() | score.between(0, 1)
    return out


def with_violations(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Add ``violations``: names of the rules a row breaks, empty when valid."""
    broken = [F.when(~ok, F.lit(name)) for name, ok in conditions.items()]
    found = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn("violations", found)


def split_valid(df: DataFrame, conditions: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the rejected ones with their ``violations``."""
    checked = with_violations(df, conditions)
    bad = F.size("violations") > 0
    return checked.where(~bad).drop("violations"), checked.where(bad)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows pointing at a missing parent; null references are fine.

    Distinct references meet the parent keys first, so a reference shared by many
    children is checked once.
    """
    refs = child.where(F.col(column).isNotNull()).select(column).distinct()
    keys = parent.select(F.col(parent_column).alias(column))
    missing = refs.join(keys, column, "left_anti")
    return child.join(missing, column, "left_semi")


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Schema evolution: the table's next version without ``columns``."""
    return df.drop(*columns)
