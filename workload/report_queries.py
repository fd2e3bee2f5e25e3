"""Reports, selections and refresh metrics over the postings view."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.functions.labels import site_label
from hirelake.operators import metrics as M
from hirelake.plans import reports as R
from hirelake.plans.dashboard import dashboard
from hirelake.plans.refresh import refresh
from hirelake.sources import values as V
from hirelake.sources.exports import as_json_rows
from workload import sql as S
from workload import views as W
from workload.registry import query

P = f"({S.POSTINGS}) p"
RECENT = f"first_seen_date >= {S.AS_OF} - 30"


def dates_as_text(df):
    return df.select(
        *[F.col(f.name).cast("string") if f.dataType.simpleString() == "date" else F.col(f.name)
          for f in df.schema.fields]
    )


@query("market_stats", f"""
SELECT count(*) AS total_jobs, count(*) FILTER (is_active) AS active_jobs,
  count(DISTINCT company_id) AS companies,
  count(*) FILTER (first_seen_date >= {S.AS_OF} - 7) AS new_this_week
FROM {P} WHERE {RECENT}""")
def market_stats(spark, d):
    return R.market_stats(W.postings(spark, d, names=False), W.AS_OF)


@query("market_stats_site", f"""
SELECT count(*) AS total_jobs, count(*) FILTER (is_active) AS active_jobs,
  count(DISTINCT company_id) AS companies,
  count(*) FILTER (first_seen_date >= {S.AS_OF} - 7) AS new_this_week
FROM {P} WHERE source_site = 'jobinja' AND first_seen_date >= {S.AS_OF} - 36500""")
def market_stats_site(spark, d):
    return R.market_stats(W.postings(spark, d, names=False), W.AS_OF, "jobinja", "all")


@query("daily_by_site", f"""
SELECT CAST(first_seen_date AS VARCHAR) AS date, source_site, count(*) AS count
FROM {P} WHERE first_seen_date >= {S.AS_OF} - 365 GROUP BY 1, 2""")
def daily_by_site(spark, d):
    return R.daily_by_site(W.postings(spark, d, names=False), W.AS_OF, choice="all")


@query("daily_pivot", f"""
SELECT CAST(first_seen_date AS VARCHAR) AS date, strftime(first_seen_date, '%m-%d') AS label,
  {", ".join(f"nullif(count(*) FILTER (source_site = '{s}'), 0) AS {s}" for s in V.SITES)}
FROM {P} WHERE {RECENT} GROUP BY first_seen_date""")
def daily_pivot(spark, d):
    return R.daily_pivot(R.daily_by_site(W.postings(spark, d, names=False), W.AS_OF), V.SITES)


BREAKDOWNS = f"""
SELECT CASE grouping(employment_type, experience_level, source_site)
    WHEN 3 THEN 'employment_type' WHEN 5 THEN 'experience_level' ELSE 'source_site' END AS dimension,
  coalesce(employment_type, experience_level, source_site, 'unknown') AS label, count(*) AS count
FROM {P} WHERE first_seen_date >= {S.AS_OF} - 36500
GROUP BY GROUPING SETS ((employment_type), (experience_level), (source_site))"""


@query("breakdowns", BREAKDOWNS)
def breakdowns(spark, d):
    return R.breakdowns(W.postings(spark, d), W.AS_OF, choice="all")


@query("top_companies", f"""
SELECT company_name_raw AS company, count(*) AS count FROM {P}
WHERE first_seen_date >= {S.AS_OF} - 36500 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def top_companies(spark, d):
    return R.top_companies(W.postings(spark, d), W.AS_OF, choice="all")


@query("top_locations", f"""
SELECT location_raw AS location, count(*) AS count FROM {P}
WHERE first_seen_date >= {S.AS_OF} - 36500 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def top_locations(spark, d):
    return R.top_locations(W.postings(spark, d), W.AS_OF, choice="all")


TOP_SKILLS = f"""
SELECT p_name AS skill, count(*) AS count
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
JOIN part ON p_partkey = l_partkey
JOIN orders ON o_orderkey = l_orderkey
WHERE CAST(o_orderdate AS DATE) >= {S.AS_OF} - 36500
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""


def _top_skills(spark, d):
    return R.top_skills(
        W.postings(spark, d, names=False), W.posting_skills(spark, d), W.skill_table(spark, d),
        W.AS_OF, choice="all",
    )


@query("top_skills", TOP_SKILLS)
def top_skills(spark, d):
    return _top_skills(spark, d)


@query("top_skills_ascending", f"SELECT * FROM ({TOP_SKILLS})")
def top_skills_ascending(spark, d):
    return R.ascending(_top_skills(spark, d))


@query("dashboard_load", f"""
SELECT 'top_skills' AS report, skill AS label, count FROM ({TOP_SKILLS})
UNION ALL SELECT * FROM (SELECT 'top_companies', company_name_raw, count(*) AS count FROM {P}
  WHERE first_seen_date >= {S.AS_OF} - 36500 GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 15)
UNION ALL SELECT * FROM (SELECT 'top_locations', location_raw, count(*) AS count FROM {P}
  WHERE first_seen_date >= {S.AS_OF} - 36500 GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 15)
UNION ALL SELECT 'stats', unnest(['total_jobs', 'active_jobs', 'companies', 'new_this_week']),
  unnest([count(*), count(*) FILTER (is_active), count(DISTINCT company_id),
    count(*) FILTER (first_seen_date >= {S.AS_OF} - 7)]) FROM {P} WHERE first_seen_date >= {S.AS_OF} - 36500
UNION ALL SELECT 'jobs_over_time', CAST(first_seen_date AS VARCHAR) || ' ' || source_site, count(*)
  FROM {P} WHERE first_seen_date >= {S.AS_OF} - 365 GROUP BY 2
UNION ALL SELECT 'breakdowns', dimension || ' ' || label, count FROM ({BREAKDOWNS})""")
def dashboard_load(spark, d):
    six = dashboard(
        W.postings(spark, d), W.posting_skills(spark, d), W.skill_table(spark, d), W.AS_OF,
        choice="all",
    )

    def part(name, label):
        return six[name].select(F.lit(name).alias("report"), label.alias("label"), "count")

    measures = six["stats"].columns
    stats = six["stats"].unpivot([], measures, "label", "count").select(F.lit("stats").alias("report"), "label", "count")
    return (
        part("top_skills", F.col("skill"))
        .union(part("top_companies", F.col("company")))
        .union(part("top_locations", F.col("location")))
        .union(stats)
        .union(part("jobs_over_time", F.concat_ws(" ", "date", "source_site")))
        .union(
            part("breakdowns", F.concat(F.col("dimension"), F.lit(" "), F.col("label")))
        )
    )


SEARCH = R.Search(
    choice="all", text="urgent", company="00_", location="_1", active_only=True, site="irantalent"
)
SEARCH_SQL = f"""source_site = 'irantalent' AND is_active AND company_name_raw ILIKE '%00_%'
  AND location_raw ILIKE '%_1%' AND (title_persian ILIKE '%urgent%' OR title_english ILIKE '%urgent%'
  OR description_persian ILIKE '%urgent%' OR description_english ILIKE '%urgent%')"""
LISTED = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c.endswith("_date") else c for c in R.LISTING_COLUMNS
) + ", (title_english IS NOT NULL OR description_english IS NOT NULL) AS has_english"


@query("posting_search", f"SELECT {LISTED} FROM {P} WHERE {SEARCH_SQL}")
def posting_search(spark, d):
    return dates_as_text(R.search_postings(W.postings(spark, d), SEARCH, W.AS_OF))


@query("posting_page", f"""
SELECT {LISTED} FROM {P} WHERE is_active
ORDER BY coalesce(p.posted_date, p.first_seen_date) DESC, p.first_seen_date DESC, id DESC
LIMIT 20 OFFSET 40""")
def posting_page(spark, d):
    found = R.search_postings(W.postings(spark, d), R.Search(choice="all"), W.AS_OF)
    return dates_as_text(R.posting_page(found, "3", "20"))


@query("posting_count", f"SELECT count(*) AS count FROM {P} WHERE {SEARCH_SQL}")
def posting_count(spark, d):
    return R.match_count(R.search_postings(W.postings(spark, d), SEARCH, W.AS_OF))


@query("posting_page_after", f"""
SELECT {LISTED} FROM {P} WHERE is_active
  AND (coalesce(p.posted_date, p.first_seen_date), p.first_seen_date, id)
    < (DATE '2000-06-30', DATE '2000-06-30', 5000)
ORDER BY coalesce(p.posted_date, p.first_seen_date) DESC, p.first_seen_date DESC, id DESC LIMIT 50""")
def posting_page_after(spark, d):
    from datetime import date

    found = R.search_postings(W.postings(spark, d), R.Search(choice="all"), W.AS_OF)
    at = date(2000, 6, 30)
    return dates_as_text(R.posting_page_after(found, at, at, 5000, 50))


@query("preferred_language", f"""
SELECT id, coalesce(nullif(title_english, ''), nullif(title_persian, ''), '—') AS title,
  coalesce(nullif(description_english, ''), nullif(description_persian, ''), '') AS description,
  title_english IS NULL AND description_english IS NULL AS missing_translation,
  coalesce(nullif(company_name_raw, ''), 'Unknown company') AS company,
  coalesce(nullif(location_raw, ''), 'Location unknown') AS location,
  coalesce(nullif(employment_type, ''), 'Unspecified') AS employment,
  coalesce(nullif(experience_level, ''), 'Any level') AS experience,
  CASE source_site WHEN 'irantalent' THEN 'IranTalent' WHEN 'jobinja' THEN 'Jobinja' ELSE 'JobVision' END AS site,
  strftime(coalesce(posted_date, first_seen_date), '%b %d, %Y') AS date
FROM {P}""")
def preferred_language(spark, d):
    everything = R.Search(choice="all", active_only=False)
    return R.shown_in_language(R.search_postings(W.postings(spark, d), everything, W.AS_OF), "en")


@query("site_labels", f"""
SELECT source_site, CASE source_site WHEN 'irantalent' THEN 'IranTalent' WHEN 'jobinja' THEN 'Jobinja'
  ELSE 'JobVision' END AS site, count(*) AS postings FROM {P} GROUP BY 1, 2""")
def site_labels(spark, d):
    rows = W.postings(spark, d, names=False)
    return rows.groupBy("source_site").agg(F.count("*").alias("postings")).select(
        "source_site", site_label(F.col("source_site")).alias("site"), "postings"
    )


@query("pending_batch", f"""
SELECT id, title_persian FROM {P} WHERE processing_status = 'pending' ORDER BY id LIMIT 200""")
def pending_batch(spark, d):
    return R.pending_batch(W.postings(spark, d, names=False)).select("id", "title_persian")


@query("newest_pending", f"""
SELECT id, title_persian, description_persian, company_name_raw, location_raw, source_site, external_id
FROM {P} WHERE processing_status = 'pending' ORDER BY first_seen_date DESC, id LIMIT 100""")
def newest_pending(spark, d):
    return R.newest_pending(W.postings(spark, d))


@query("json_rows", f"""
SELECT '{{"id":' || id || ',"source_site":"' || source_site || '","is_active":' || is_active || '}}' AS value
FROM {P}""")
def json_rows(spark, d):
    return as_json_rows(W.postings(spark, d, names=False).select("id", "source_site", "is_active"))


# --- lifecycle and metrics -------------------------------------------------


@query("deactivate_stale", f"""
SELECT id, CASE WHEN is_active AND last_seen_date < {S.AS_OF} - 14 THEN false ELSE is_active END AS is_active,
  CAST(CASE WHEN is_active AND last_seen_date < {S.AS_OF} - 14 THEN {S.AS_OF} ELSE deactivated_date END
    AS VARCHAR) AS deactivated_date
FROM {P}""")
def deactivate_stale(spark, d):
    out = M.deactivate_stale(W.postings(spark, d, names=False), W.AS_OF)
    return dates_as_text(out.select("id", "is_active", "deactivated_date"))


@query("company_activity", f"""
SELECT company_id, count(*) AS active_count, count(*) FILTER ({RECENT}) AS count_30d,
  round(count(*) FILTER ({RECENT}) / 30.0::DOUBLE, 4) AS velocity_30d
FROM {P} WHERE is_active AND company_id IS NOT NULL GROUP BY 1""")
def company_activity(spark, d):
    return M.company_activity(W.postings(spark, d, names=False), W.AS_OF)


def _refreshed(source: str) -> str:
    return f"""
SELECT c.id, display_name_persian,
  CAST(CASE WHEN n IS NOT NULL THEN n WHEN active_job_postings > 0 THEN 0 ELSE active_job_postings END AS INT)
    AS active_job_postings,
  CASE WHEN n IS NOT NULL THEN round(m / 30.0::DOUBLE, 4) WHEN active_job_postings > 0 THEN 0.0::DOUBLE
    ELSE hiring_velocity_30d END AS hiring_velocity_30d,
  CAST(CASE WHEN n IS NOT NULL THEN {S.AS_OF} ELSE last_activity_date END AS VARCHAR) AS last_activity_date
FROM ({S.COMPANIES}) c LEFT JOIN (
  SELECT company_id AS id, count(*) AS n, count(*) FILTER ({RECENT}) AS m
  FROM {source} WHERE is_active AND company_id IS NOT NULL GROUP BY 1) a ON a.id = c.id"""


CURRENT = f"""(SELECT * REPLACE (is_active AND NOT last_seen_date < {S.AS_OF} - 14 AS is_active,
  CASE WHEN is_active AND last_seen_date < {S.AS_OF} - 14 THEN {S.AS_OF} ELSE deactivated_date END
    AS deactivated_date) FROM {P})"""


@query("refresh_companies", _refreshed(P))
def refresh_companies(spark, d):
    return dates_as_text(
        M.refresh_companies(
            W.company_table(spark, d), W.postings(spark, d, names=False), W.AS_OF
        )
    )


@query("nightly_companies", _refreshed(CURRENT))
def nightly_companies(spark, d):
    out = refresh(W.postings(spark, d, names=False), W.company_table(spark, d), W.AS_OF)
    return dates_as_text(out.companies)


def _snapshot(source: str) -> str:
    return f"""
SELECT count(*) AS total_jobs, count(*) FILTER (is_active) AS active_jobs,
  count(*) FILTER (first_seen_date >= {S.AS_OF} - 7) AS new_last_7d,
  count(*) FILTER (deactivated_date = {S.AS_OF}) AS deactivated_today,
  count(DISTINCT company_id) FILTER (is_active) AS active_companies,
  count(*) FILTER (processing_status = 'processed') AS processed_jobs,
  count(*) FILTER (processing_status = 'pending') AS pending_jobs FROM {source}"""


@query("summary_snapshot", _snapshot(P))
def summary_snapshot(spark, d):
    return M.summary_snapshot(W.postings(spark, d, names=False), W.AS_OF)


@query("nightly_snapshot", _snapshot(CURRENT))
def nightly_snapshot(spark, d):
    out = refresh(W.postings(spark, d, names=False), W.company_table(spark, d), W.AS_OF)
    return out.summary


@query("inactive_companies", f"""
SELECT id, active_job_postings FROM ({S.COMPANIES}) c WHERE active_job_postings > 0
  AND id NOT IN (SELECT company_id FROM {P} WHERE is_active AND company_id IS NOT NULL)""")
def inactive_companies(spark, d):
    out = M.inactive_companies(W.company_table(spark, d), W.postings(spark, d, names=False))
    return out.select("id", "active_job_postings")


@query("run_stats", f"""
SELECT (SELECT count(*) FROM customer) + count(*) AS total_jobs, count(*) AS completed_jobs,
  count(*) FILTER (NOT success) AS failed_jobs, count(*) FILTER (success) AS successful,
  (SELECT count(*) FROM customer) AS remaining_jobs,
  count(*) FILTER (success) / count(*)::DOUBLE * 100 AS success_rate
FROM ({S.ATTEMPTS})""")
def run_stats(spark, d):
    tried = W.attempts(spark, d)
    planned = tried.select(F.lit(1).alias("k")).unionAll(
        W.table(spark, d, "customer").select(F.lit(1).alias("k"))
    )
    total = planned.agg(F.count("*")).scalar()
    return M.run_stats(tried, total).drop("duration_seconds", "jobs_per_second")


@query("run_throughput", f"""
SELECT count(*) AS total_jobs,
  CAST(round(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6) AS BIGINT) AS seconds,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS jobs_per_second
FROM ({S.ATTEMPTS})""")
def run_throughput(spark, d):
    tried = W.attempts(spark, d)
    stats = M.run_stats(tried, F.count("*"))
    return stats.select(
        "total_jobs",
        F.round("duration_seconds").cast("bigint").alias("seconds"),
        F.round("jobs_per_second", 6).alias("jobs_per_second"),
    )


@query("worker_tallies", f"""
SELECT worker_id, count(*) FILTER (success) AS completed, count(*) FILTER (NOT success) AS failed
FROM ({S.ATTEMPTS}) GROUP BY 1""")
def worker_tallies(spark, d):
    return M.worker_tallies(W.attempts(spark, d))


@query("site_rollup", f"""
SELECT coalesce(source_site, 'all') AS site, count(*) AS discovered
FROM (SELECT DISTINCT source_site, job_url FROM ({S.DISCOVERIES})) GROUP BY ROLLUP (source_site)""")
def site_rollup(spark, d):
    return M.discovered_by_site(W.discoveries(spark, d))


@query("url_totals", f"""
SELECT count(*) AS total_urls, count(DISTINCT job_url) AS unique_urls FROM ({S.DISCOVERIES})""")
def url_totals(spark, d):
    return M.url_totals(W.discoveries(spark, d))
