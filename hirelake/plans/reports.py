"""Reporting queries over postings.

Each takes the posting table (any superset of the columns it names) and returns a
DataFrame.  Site and date filters are plain predicates on literals, so they reach
the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.labels import site_label
from hirelake.functions.text import blank_to_null, display_date, first_filled
from hirelake.operators.metrics import days_before
from hirelake.sources import values as V


def positive_int(value: str | int | None, default: int) -> int:
    """A positive integer from a request parameter (leading digits count)."""
    text = str(value if value is not None else "").strip()
    digits = ""
    for ch in text.removeprefix("+"):
        if not ("0" <= ch <= "9"):
            break
        digits += ch
    number = int(digits) if digits else 0
    return number if number > 0 else default


def range_days(choice: str | int, everything: int | None = V.ALL_RANGE_DAYS) -> int | None:
    """Days behind a range choice (7, 30, 90, all)."""
    return everything if choice == "all" else positive_int(choice, 30)


def within(df: DataFrame, as_of: date, site: str = "all", days: int | None = 30) -> DataFrame:
    """Postings of a site first seen in the last ``days`` days (inclusive)."""
    if site != "all":
        df = df.where(F.col("source_site") == site)
    if days is not None:
        df = df.where(F.col("first_seen_date") >= days_before(as_of, days))
    return df


def market_stats(
    postings: DataFrame, as_of: date, site: str = "all", choice: str | int = 30
) -> DataFrame:
    rows = within(postings, as_of, site, range_days(choice))
    return rows.agg(
        F.count("*").alias("total_jobs"),
        F.count_if(F.col("is_active")).alias("active_jobs"),
        F.count_distinct("company_id").alias("companies"),
        F.count_if(F.col("first_seen_date") >= days_before(as_of, V.NEW_DAYS)).alias(
            "new_this_week"
        ),
    )


def daily_by_site(
    postings: DataFrame, as_of: date, site: str = "all", choice: str | int = 30
) -> DataFrame:
    """Postings per day and site; "all" means one year here."""
    rows = within(postings, as_of, site, range_days(choice, V.ALL_RANGE_DAYS_SERIES))
    return (
        rows.groupBy("first_seen_date", "source_site")
        .agg(F.count("*").alias("count"))
        .select(F.col("first_seen_date").cast("string").alias("date"), "source_site", "count")
        .orderBy("date", "source_site")
    )


def daily_pivot(daily: DataFrame, sites: Sequence[str]) -> DataFrame:
    """Day x site table for plotting; a missing cell stays null."""
    return (
        daily.groupBy("date")
        .pivot("source_site", list(sites))
        .agg(F.sum("count"))
        .withColumn("label", F.date_format(F.to_date("date"), "MM-dd"))
        .orderBy("date")
    )


def breakdowns(
    postings: DataFrame, as_of: date, site: str = "all", choice: str | int = 30
) -> DataFrame:
    """Employment, experience and site counts in one pass.

    Grouping is on the raw value: a null and a stored ``unknown`` are two rows
    with the same label.
    """
    rows = within(postings, as_of, site, range_days(choice)).select(
        "employment_type", "experience_level", "source_site"
    )
    sets = [["employment_type"], ["experience_level"], ["source_site"]]
    cols = [F.col(c) for s in sets for c in s]
    which = F.grouping_id("employment_type", "experience_level", "source_site")
    counted = rows.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(
        which.alias("_which"), F.count("*").alias("count")
    )
    name = (
        F.when(F.col("_which") == 3, "employment_type")
        .when(F.col("_which") == 5, "experience_level")
        .otherwise("source_site")
    )
    raw = F.coalesce("employment_type", "experience_level", "source_site")
    return counted.select(
        name.alias("dimension"),
        F.when(F.col("_which") == 6, raw).otherwise(F.coalesce(raw, F.lit(V.UNKNOWN))).alias("label"),
        "count",
    ).orderBy("dimension", F.desc("count"), "label")


def top_values(
    rows: DataFrame, column: str, label: str, k: int = V.TOP_K
) -> DataFrame:
    """Most frequent non-empty values; equal counts are ordered by label."""
    return (
        rows.where(F.col(column).isNotNull() & (F.col(column) != ""))
        .groupBy(F.col(column).alias(label))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), label)
        .limit(k)
    )


def top_companies(
    postings: DataFrame, as_of: date, site: str = "all", choice: str | int = 30, k: int = V.TOP_K
) -> DataFrame:
    rows = within(postings, as_of, site, range_days(choice))
    return top_values(rows, "company_name_raw", "company", k)


def top_locations(
    postings: DataFrame, as_of: date, site: str = "all", choice: str | int = 30, k: int = V.TOP_K
) -> DataFrame:
    rows = within(postings, as_of, site, range_days(choice))
    return top_values(rows, "location_raw", "location", k)


def top_skills(
    postings: DataFrame,
    job_skills: DataFrame,
    skills: DataFrame,
    as_of: date,
    site: str = "all",
    choice: str | int = 30,
    k: int = V.TOP_K,
) -> DataFrame:
    """Most mentioned skills.

    Mentions are counted per skill id before names are joined, so the name join
    sees one row per skill however often a skill occurs.
    """
    ids = within(postings, as_of, site, range_days(choice)).select(
        F.col("id").alias("job_posting_id")
    )
    per_id = (
        job_skills.select("job_posting_id", "skill_id")
        .join(ids, "job_posting_id")
        .groupBy("skill_id")
        .agg(F.count("*").alias("_n"))
    )
    names = skills.select(F.col("id").alias("skill_id"), F.col("skill_name_english").alias("skill"))
    return (
        per_id.join(names, "skill_id")
        .groupBy("skill")
        .agg(F.sum("_n").alias("count"))
        .orderBy(F.desc("count"), "skill")
        .limit(k)
    )


def ascending(top: DataFrame) -> DataFrame:
    """Chart order of a top-k table (at most k rows)."""
    label = next(c for c in top.columns if c != "count")
    return top.orderBy("count", F.desc(label))


@dataclass(frozen=True)
class Search:
    """Filters of the posting list; ``%`` and ``_`` in texts are wildcards."""

    site: str = "all"
    choice: str | int = 30
    text: str = ""
    company: str = ""
    location: str = ""
    employment: str = "all"
    experience: str = "all"
    active_only: bool = True


LISTING_COLUMNS = [
    "id", "source_site", "source_url", "title_persian", "title_english",
    "description_persian", "description_english", "company_name_raw", "company_url",
    "location_raw", "employment_type", "experience_level", "posted_date",
    "first_seen_date", "last_seen_date", "is_active", "processing_status",
]
TEXT_COLUMNS = ["title_persian", "title_english", "description_persian", "description_english"]


def search_conditions(search: Search, as_of: date) -> list[Column]:
    out: list[Column] = []
    if search.site != "all":
        out.append(F.col("source_site") == search.site)
    days = range_days(search.choice, None)
    if days is not None:
        out.append(F.col("first_seen_date") >= days_before(as_of, days))
    if search.active_only:
        out.append(F.col("is_active"))
    for column, word in [("company_name_raw", search.company), ("location_raw", search.location)]:
        if word.strip():
            out.append(F.col(column).ilike(f"%{word}%"))
    for column, choice in [
        ("employment_type", search.employment),
        ("experience_level", search.experience),
    ]:
        if choice != "all":
            out.append(F.col(column) == choice)
    if search.text.strip():
        hits = [F.col(c).ilike(f"%{search.text}%") for c in TEXT_COLUMNS]
        out.append(reduce(lambda a, b: a | b, hits))
    return out


def search_postings(postings: DataFrame, search: Search, as_of: date) -> DataFrame:
    """All matching postings, list columns only."""
    for condition in search_conditions(search, as_of):
        postings = postings.where(condition)
    english = F.col("title_english").isNotNull() | F.col("description_english").isNotNull()
    return postings.select(*LISTING_COLUMNS, english.alias("has_english"))


def _listing_order() -> list[Column]:
    shown = F.coalesce("posted_date", "first_seen_date")
    return [shown.desc(), F.col("first_seen_date").desc(), F.col("id").desc()]


def posting_page(
    found: DataFrame, page: int | str | None = 1, page_size: int | str | None = 20
) -> DataFrame:
    """One page of a search, newest first; at most 100 rows a page."""
    number = positive_int(page, 1)
    size = min(positive_int(page_size, 20), 100)
    return found.orderBy(*_listing_order()).offset((number - 1) * size).limit(size)


def posting_page_after(
    found: DataFrame, shown: date, first_seen: date, last_id: int, page_size: int = 20
) -> DataFrame:
    """The page behind a known last row: deep pages cost the same as the first."""
    key = F.struct(F.coalesce("posted_date", "first_seen_date"), "first_seen_date", "id")
    last = F.struct(
        F.lit(shown).cast("date"), F.lit(first_seen).cast("date"), F.lit(last_id).cast("bigint")
    )
    return found.where(key < last).orderBy(*_listing_order()).limit(page_size)


def match_count(found: DataFrame) -> DataFrame:
    return found.agg(F.count("*").alias("count"))


def page_numbers(total: int, page: int = 1, page_size: int = 20) -> dict[str, int]:
    return {
        "total_pages": max(1, -(-total // page_size)),
        "shown_from": (page - 1) * page_size + 1,
        "shown_to": min(page * page_size, total),
    }


def pending_batch(postings: DataFrame, limit: int | None = V.ENRICH_BATCH) -> DataFrame:
    """Postings waiting for enrichment, oldest id first; all of them without a limit."""
    todo = postings.where(F.col("processing_status") == "pending")
    return todo if limit is None else todo.orderBy("id").limit(limit)


def newest_pending(postings: DataFrame, limit: int = 100) -> DataFrame:
    """Newest waiting postings (id as tie-breaker)."""
    return (
        postings.where(F.col("processing_status") == "pending")
        .select(
            "id", "title_persian", "description_persian", "company_name_raw", "location_raw",
            "source_site", "external_id", "first_seen_date",
        )
        .orderBy(F.desc("first_seen_date"), "id")
        .limit(limit)
        .drop("first_seen_date")
    )


def shown_in_language(listing: DataFrame, language: str = "en") -> DataFrame:
    """Display texts of listed postings in the reader's language, with fallbacks."""
    first, second = ("persian", "english") if language == "fa" else ("english", "persian")
    date_shown = F.coalesce("posted_date", "first_seen_date")
    return listing.select(
        "id",
        first_filled(F.col(f"title_{first}"), F.col(f"title_{second}"), default=V.EMPTY_LABEL).alias("title"),
        F.coalesce(
            blank_to_null(F.col(f"description_{first}")),
            blank_to_null(F.col(f"description_{second}")),
            F.lit(""),
        ).alias("description"),
        (F.lit(language == "en") & ~F.col("has_english")).alias("missing_translation"),
        first_filled(F.col("company_name_raw"), default="Unknown company").alias("company"),
        first_filled(F.col("location_raw"), default="Location unknown").alias("location"),
        first_filled(F.col("employment_type"), default="Unspecified").alias("employment"),
        first_filled(F.col("experience_level"), default="Any level").alias("experience"),
        site_label(F.col("source_site")).alias("site"),
        display_date(date_shown).alias("date"),
    )
