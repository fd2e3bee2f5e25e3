"""All reports of one dashboard load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from hirelake.plans import reports as R


def dashboard(
    postings: DataFrame,
    job_skills: DataFrame,
    skills: DataFrame,
    as_of: date,
    site: str = "all",
    choice: str | int = 30,
) -> dict[str, DataFrame]:
    """Six reports over one filter.

    They stay lazy and independent: each scan reads only its own few columns of
    the filtered date range, which is cheaper than caching the union of them for
    one use each.
    """
    args = (as_of, site, choice)
    return {
        "stats": R.market_stats(postings, *args),
        "jobs_over_time": R.daily_by_site(postings, *args),
        "top_companies": R.top_companies(postings, *args),
        "top_skills": R.top_skills(postings, job_skills, skills, *args),
        "top_locations": R.top_locations(postings, *args),
        "breakdowns": R.breakdowns(postings, *args),
    }
