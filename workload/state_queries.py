"""Stateful merges, dimensions, streaks, validation, enrichment and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hirelake.functions import skills as K
from hirelake.functions.text import canonical_company
from hirelake.operators import dimensions as D
from hirelake.operators import streaks
from hirelake.operators import tracking as Tr
from hirelake.plans import enrichment as E
from hirelake.sources import exports as Ex
from hirelake.sources import schemas as Sc
from workload import sql as S
from workload import views as W
from workload.registry import query
from workload.report_queries import dates_as_text

ENTRIES = [K.SkillEntry(n, c, tuple(p)) for n, c, p in W.PROSE_SKILLS]
CUT = W.SESSION_CUT


# --- discovery and tracking --------------------------------------------------


@query("first_seen_order", f"""
SELECT scrape_session_id, source_site, job_url, min(seq) AS seq FROM ({S.DISCOVERIES}) GROUP BY 1, 2, 3""")
def first_seen_order(spark, d):
    keys = ["scrape_session_id", "source_site", "job_url"]
    return Tr.first_occurrences(W.discoveries(spark, d), keys, ["seq"]).select(*keys, "seq")


@query("discovery_log", f"""
WITH f AS ({S.DISCOVERIES}), log AS (SELECT DISTINCT scrape_session_id, job_url FROM f WHERE seq % 3 = 0)
SELECT scrape_session_id, job_url, min(seq) AS seq, arg_min(found_on_page, seq) AS found_on_page
FROM f ANTI JOIN log USING (scrape_session_id, job_url) GROUP BY 1, 2""")
def discovery_log(spark, d):
    found = W.discoveries(spark, d)
    log = found.where(F.col("seq") % 3 == 0)
    return Tr.new_discoveries(log, found, ["seq"]).select(
        "scrape_session_id", "job_url", "seq", "found_on_page"
    )


LATE = f"""SELECT job_url, arg_min(source_site, seq) AS source_site, arg_min(scrape_session_id, seq) AS s1,
  arg_max(scrape_session_id, seq) AS s2, arg_min(day, seq) AS d1, arg_max(day, seq) AS d2
  FROM ({S.DISCOVERIES}) WHERE scrape_session_id >= '{CUT}' GROUP BY 1"""
TRACKED = f"""
SELECT coalesce(t.job_url, n.job_url) AS job_url, coalesce(t.source_site, n.source_site) AS source_site,
  coalesce(t.first_seen_session, s1) AS first_seen_session, coalesce(s2, t.last_seen_session) AS last_seen_session,
  CAST(coalesce(t.first_seen_date, d1) AS VARCHAR) AS first_seen_date,
  CAST(coalesce(d2, t.last_seen_date) AS VARCHAR) AS last_seen_date,
  CASE WHEN n.job_url IS NOT NULL THEN true ELSE t.is_active END AS is_active,
  coalesce(t.detail_scraped, false) AS detail_scraped, coalesce(t.detail_scrape_count, 0) AS detail_scrape_count
FROM ({S.TRACKING}) t FULL JOIN ({LATE}) n ON n.job_url = t.job_url"""
_TRACK_COLUMNS = [
    "job_url", "source_site", "first_seen_session", "last_seen_session", "first_seen_date",
    "last_seen_date", "is_active", "detail_scraped", "detail_scrape_count",
]


def _late(spark, d):
    return W.late(W.discoveries(spark, d)).withColumn("session", F.col("scrape_session_id"))


@query("track_urls", TRACKED)
def track_urls(spark, d):
    out = Tr.track_urls(W.url_tracking(spark, d), _late(spark, d), ["seq"])
    return dates_as_text(out.select(*_TRACK_COLUMNS))


@query("track_urls_small_batch", TRACKED)
def track_urls_small_batch(spark, d):
    out = Tr.track_urls(W.url_tracking(spark, d), _late(spark, d), ["seq"], small_batch=True)
    return dates_as_text(out.select(*_TRACK_COLUMNS))


@query("mark_scraped", f"""
SELECT job_url, detail_scraped OR coalesce(ok, false) AS detail_scraped,
  CAST(CASE WHEN n IS NOT NULL THEN {S.EVENT_DAY} END AS VARCHAR) AS last_detail_scrape_date,
  CAST(detail_scrape_count + coalesce(n, 0) AS INT) AS detail_scrape_count
FROM ({S.TRACKING}) t LEFT JOIN (SELECT job_url AS u, bool_or(success) AS ok, count(*) AS n
  FROM ({S.ATTEMPTS}) GROUP BY 1) a ON u = job_url""")
def mark_scraped(spark, d):
    out = Tr.mark_scraped(W.url_tracking(spark, d), W.attempts(spark, d), W.EVENT_DAY)
    return dates_as_text(
        out.select("job_url", "detail_scraped", "last_detail_scrape_date", "detail_scrape_count")
    )


COMPANY_TRACKING = f"""
SELECT company_url, arg_min(source_site, seq) AS source_site, arg_min(scrape_session_id, seq) AS first_seen_session,
  arg_max(scrape_session_id, seq) AS last_seen_session, min(day) AS first_seen_date, arg_max(day, seq) AS last_seen_date
FROM ({S.DISCOVERIES}) WHERE company_url IS NOT NULL GROUP BY 1"""


def _company_tracking(spark, d):
    """Two sessions' sightings merged one after the other."""
    found = W.discoveries(spark, d).withColumn("session", F.col("scrape_session_id"))
    empty = spark.createDataFrame([], Sc.SCHEMAS["company_tracking"])
    first = Tr.track_companies(empty, W.early(found), ["seq"])
    return Tr.track_companies(first, W.late(found), ["seq"])


@query("company_tracking", f"""
SELECT company_url, source_site, first_seen_session, last_seen_session,
  CAST(first_seen_date AS VARCHAR) AS first_seen_date, CAST(last_seen_date AS VARCHAR) AS last_seen_date
FROM ({COMPANY_TRACKING})""")
def company_tracking(spark, d):
    return dates_as_text(
        _company_tracking(spark, d).select(
            "company_url", "source_site", "first_seen_session", "last_seen_session",
            "first_seen_date", "last_seen_date",
        )
    )


@query("mark_companies", f"""
SELECT company_url, ok AS profile_scraped, CAST(n AS INT) AS profile_scrape_count
FROM ({COMPANY_TRACKING}) JOIN (SELECT company_url AS u, bool_or(keyword <> 'error') AS ok, count(*) AS n
  FROM ({S.DISCOVERIES}) GROUP BY 1) ON u = company_url""")
def mark_companies(spark, d):
    tried = (
        W.discoveries(spark, d).select("company_url", (F.col("keyword") != "error").alias("success"))
    )
    out = Tr.mark_scraped(
        _company_tracking(spark, d), tried, W.EVENT_DAY, key="company_url", kind="profile"
    )
    return out.select("company_url", "profile_scraped", "profile_scrape_count")


def _tracked(spark, d):
    """Tracking after all sessions, the late ones merged into the early ones' state."""
    return Tr.track_urls(W.url_tracking(spark, d), _late(spark, d), ["seq"])


@query("detail_worklist", f"""
SELECT job_url, source_site, first_seen_date, detail_scrape_count
FROM ({TRACKED}) t WHERE NOT detail_scraped AND is_active ORDER BY t.first_seen_date, job_url LIMIT 100""")
def detail_worklist(spark, d):
    return dates_as_text(Tr.detail_worklist(_tracked(spark, d)))


@query("profile_worklist", f"""
SELECT company_url, source_site, CAST(first_seen_date AS VARCHAR) AS first_seen_date
FROM ({COMPANY_TRACKING}) t ORDER BY t.first_seen_date, company_url LIMIT 50""")
def profile_worklist(spark, d):
    out = Tr.profile_worklist(_company_tracking(spark, d))
    return dates_as_text(out.drop("profile_scrape_count"))


@query("worklist_handlers", f"""
SELECT source_site, CASE source_site WHEN 'irantalent' THEN 'a' WHEN 'jobinja' THEN 'b' ELSE 'c' END AS handler,
  count(*) AS urls FROM ({TRACKED}) WHERE NOT detail_scraped AND is_active GROUP BY 1, 2""")
def worklist_handlers(spark, d):
    todo = Tr.detail_worklist(_tracked(spark, d), limit=None)
    named = Tr.with_handler(todo, {"irantalent": "a", "jobinja": "b", "jobvision": "c"})
    return named.groupBy("source_site", "handler").agg(F.count("*").alias("urls"))


@query("seen_urls", f"""
SELECT DISTINCT job_url FROM ({S.DISCOVERIES}) WHERE scrape_session_id >= '{CUT}'
  AND job_url IN (SELECT job_url FROM ({S.TRACKING}))""")
def seen_urls(spark, d):
    return Tr.seen_urls(W.url_tracking(spark, d), W.late(W.discoveries(spark, d)))


@query("progress", f"""
SELECT source_site, arg_max(page, (ts, page)) AS last_success_page, arg_max(s, (ts, page)) AS last_session_id
FROM (SELECT source_site, CAST(seq % 40 AS INT) AS page, ts, scrape_session_id AS s FROM ({S.DISCOVERIES}))
GROUP BY 1""")
def progress(spark, d):
    pages = W.discoveries(spark, d).select(
        "source_site", (F.col("seq") % 40).cast("int").alias("page"), F.col("ts").alias("at"),
        F.col("scrape_session_id").alias("session"),
    )
    empty = spark.createDataFrame([], Sc.SCHEMAS["scrape_progress"])
    done = Tr.update_progress(empty, pages.where(F.col("session") < CUT))
    done = Tr.update_progress(done, pages.where(F.col("session") >= CUT))
    return done.select("source_site", "last_success_page", "last_session_id")


@query("progress_read", f"""
SELECT arg_max(seq % 40, ts) AS last_success_page FROM ({S.DISCOVERIES}) WHERE source_site = 'jobvision'""")
def progress_read(spark, d):
    pages = W.discoveries(spark, d).select(
        "source_site", (F.col("seq") % 40).cast("int").alias("page"), F.col("ts").alias("at"),
        F.col("scrape_session_id").alias("session"),
    )
    done = Tr.update_progress(spark.createDataFrame([], Sc.SCHEMAS["scrape_progress"]), pages)
    return Tr.last_success_page(done, "jobvision").select(F.col("last_success_page").cast("bigint"))


RATIOS = f"""
SELECT source_site, keyword, page, count(DISTINCT job_url) FILTER (known) AS seen_count, count(*) AS total_count,
  count(DISTINCT job_url) FILTER (known) / count(*)::DOUBLE AS seen_ratio
FROM (SELECT l.*, t.job_url IS NOT NULL AS known FROM ({S.LISTING}) l
  LEFT JOIN (SELECT job_url FROM ({S.TRACKING}) WHERE NOT is_active) t ON t.job_url = l.job_url)
GROUP BY 1, 2, 3"""


def _ratios(spark, d):
    known = W.url_tracking(spark, d).where(~F.col("is_active"))
    return Tr.seen_ratio(W.listing(spark, d), known)


@query("seen_ratio", RATIOS)
def seen_ratio(spark, d):
    return _ratios(spark, d)


def _streak_sql(n: int, threshold: float) -> str:
    return f"""
WITH r AS (SELECT source_site, keyword, page, total_count > 0 AND seen_ratio >= {threshold} AS ok FROM ({RATIOS})),
  g AS (SELECT *, count(*) FILTER (NOT ok) OVER (PARTITION BY source_site, keyword ORDER BY page) AS island FROM r),
  s AS (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY source_site, keyword, island ORDER BY page) AS streak FROM g)
SELECT source_site, keyword, min(page) AS stop_page FROM s WHERE streak >= {n} GROUP BY 1, 2"""


@query("early_stop", _streak_sql(3, 0.45))
def early_stop(spark, d):
    return streaks.early_stop(_ratios(spark, d), 3, 0.45)


@query("early_stop_blocks", _streak_sql(2, 0.4))
def early_stop_blocks(spark, d):
    return streaks.early_stop(_ratios(spark, d), 2, 0.4, block=4)


@query("rate_audit", f"""
WITH i AS (SELECT source_site, ts, count(*) AS requests FROM ({S.DISCOVERIES}) GROUP BY 1, 2),
  w AS (SELECT *, CAST(sum(requests) OVER (PARTITION BY source_site ORDER BY epoch_us(ts)
    RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS BIGINT) AS n,
    CASE source_site WHEN 'jobinja' THEN 2 ELSE 3 END AS capacity FROM i)
SELECT source_site, epoch_us(ts) AS at_us, requests, n AS requests_in_window, capacity,
  greatest(capacity - n, 0) AS remaining, n / capacity::DOUBLE * 100 AS utilization_percent FROM w""")
def rate_audit(spark, d):
    out = streaks.rate_audit(W.discoveries(spark, d), {"jobinja": 2}, 3)
    return out.withColumn("at_us", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")


# --- posting upsert ----------------------------------------------------------

BATCH = """
SELECT o_custkey AS k, o_orderkey AS seq, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p,
  o_orderkey % 3 = 0 AS has, o_orderstatus AS st FROM orders"""


def _stored_postings(spark, d):
    key = F.col("c_custkey")
    # Every customer is stored, under twice its number, so that half of the batch is new.
    external = (2 * key).cast("string")
    return W.table(spark, d, "customer").select(
        key.alias("id"), F.lit(None).cast("bigint").alias("raw_scrape_id"),
        external.alias("external_id"), F.lit("jobinja").alias("source_site"),
        F.concat(F.lit("u/"), external).alias("source_url"),
        F.col("c_name").alias("title_persian"),
        F.when(key % 4 == 0, F.lit("old text")).alias("description_persian"),
        F.col("c_name").alias("company_name_raw"),
        F.lit(None).cast("string").alias("location_raw"),
        F.lit("unknown").alias("employment_type"), F.lit("unknown").alias("experience_level"),
        F.lit("unknown").alias("gender_requirement"), F.lit("unknown").alias("education_level"),
        F.lit("IRR").alias("salary_currency_original"),
        F.lit(W.AS_OF).alias("first_seen_date"), F.lit(W.AS_OF).alias("last_seen_date"),
        F.lit(False).alias("is_active"), F.lit(W.AS_OF).alias("deactivated_date"),
        F.lit("processed").alias("processing_status"),
    )


def _posting_batch(o):
    key = F.col("o_custkey").cast("string")
    day = F.to_date("o_orderdate")
    has = F.col("o_orderkey") % 3 == 0
    return o.select(
        F.col("o_orderkey").alias("seq"), F.col("o_orderkey").alias("raw_scrape_id"),
        key.alias("external_id"), F.lit("jobinja").alias("source_site"),
        F.concat(F.lit("u/"), key).alias("source_url"), F.col("o_orderpriority").alias("title_persian"),
        F.when(has, F.concat(F.lit("text "), F.col("o_orderkey").cast("string"))).alias("description_persian"),
        F.lit(None).cast("string").alias("company_name_raw"),
        F.col("o_orderstatus").alias("location_raw"),
        day.alias("first_seen_date"), day.alias("last_seen_date"),
    )


UPSERTED = f"""
WITH b AS (SELECT CAST(k AS VARCHAR) AS external_id, max(seq) AS raw, arg_min(p, seq) AS title, arg_min(d, seq) AS d1,
    arg_max(d, seq) AS d2, max('text ' || seq) FILTER (false) AS nothing,
    'text ' || max(seq) FILTER (has) AS descr, arg_max(st, seq) AS loc FROM ({BATCH}) GROUP BY 1),
  s AS (SELECT CAST(2 * c_custkey AS VARCHAR) AS external_id, c_custkey, c_name FROM customer)
SELECT coalesce(s.external_id, b.external_id) AS external_id, b.raw AS raw_scrape_id,
  CASE WHEN s.external_id IS NULL THEN title ELSE c_name END AS title_persian,
  coalesce(descr, CASE WHEN c_custkey % 4 = 0 THEN 'old text' END) AS description_persian,
  c_name AS company_name_raw, loc AS location_raw,
  CAST(CASE WHEN s.external_id IS NULL THEN d1 ELSE {S.AS_OF} END AS VARCHAR) AS first_seen_date,
  CAST(coalesce(d2, {S.AS_OF}) AS VARCHAR) AS last_seen_date, b.external_id IS NOT NULL AS is_active,
  CAST(CASE WHEN s.external_id IS NOT NULL THEN {S.AS_OF} END AS VARCHAR) AS deactivated_date,
  CASE WHEN s.external_id IS NULL THEN 'pending' ELSE 'processed' END AS processing_status
FROM s FULL JOIN b ON b.external_id = s.external_id"""


def _upserted(spark, d, small):
    out = Tr.upsert_postings(_stored_postings(spark, d), _posting_batch(W.table(spark, d, "orders")), ["seq"], small)
    return dates_as_text(
        out.select(
            "external_id", "raw_scrape_id", "title_persian", "description_persian",
            "company_name_raw", "location_raw", "first_seen_date", "last_seen_date", "is_active",
            "deactivated_date", "processing_status",
        )
    )


@query("posting_upsert", UPSERTED)
def posting_upsert(spark, d):
    return _upserted(spark, d, False)


@query("posting_upsert_small_batch", UPSERTED)
def posting_upsert_small_batch(spark, d):
    return _upserted(spark, d, True)


# --- dimensions --------------------------------------------------------------

RAW_COMPANY = "' شرکت ' || c_name || ' & Co., Ltd. '"
COMPANY_KEYS = f"""SELECT o_orderkey AS id, {S.canonical("raw")} AS key, {S.strip("raw")} AS raw
  FROM (SELECT o_orderkey, {RAW_COMPANY} AS raw FROM orders JOIN customer ON c_custkey = o_custkey)"""


def _named_postings(spark, d):
    raw = F.concat(F.lit(" شرکت "), F.col("company_name_raw"), F.lit(" & Co., Ltd. "))
    return W.postings(spark, d, costly=True).withColumn("company_name_raw", raw)


def _known_companies(spark, d):
    """Every fifth customer is known already."""
    key = F.col("c_custkey")
    raw = F.concat(F.lit(" شرکت "), F.col("c_name"), F.lit(" & Co., Ltd. "))
    return W.table(spark, d, "customer").where(key % 5 == 0).select(
        key.cast("int").alias("id"), F.lit("known").alias("display_name_persian"),
        canonical_company(raw).alias("canonical_name"),
        F.lit(None).cast("date").alias("first_seen_date"), F.lit(None).cast("date").alias("last_activity_date"),
        F.lit(True).alias("is_active"), F.lit(10).alias("total_job_postings"),
        F.lit(3).alias("active_job_postings"),
    )


COMPANY_DIM = f"""
WITH k AS ({COMPANY_KEYS}), b AS (SELECT key, arg_min(raw, id) AS raw, min(id) AS first_id, count(*) AS n FROM k
    WHERE key IS NOT NULL GROUP BY 1),
  s AS (SELECT c_custkey AS id, {S.canonical(RAW_COMPANY)} AS key FROM customer WHERE c_custkey % 5 = 0),
  top AS (SELECT max(id) AS m FROM s)
SELECT coalesce(s.id, m + row_number() OVER (PARTITION BY s.id IS NULL ORDER BY first_id, b.key)) AS id,
  coalesce(s.key, b.key) AS canonical_name, CASE WHEN s.id IS NULL THEN raw ELSE 'known' END AS display_name,
  CASE WHEN s.id IS NULL THEN n ELSE 10 + coalesce(n, 0) END AS total_job_postings,
  CASE WHEN s.id IS NULL THEN n ELSE 3 + coalesce(n, 0) END AS active_job_postings,
  CAST(CASE WHEN b.key IS NOT NULL THEN {S.AS_OF} END AS VARCHAR) AS last_activity_date
FROM s FULL JOIN b ON b.key = s.key CROSS JOIN top"""


@query("canonical_company", COMPANY_DIM)
def company_dimension(spark, d):
    keys = D.company_keys(_named_postings(spark, d))
    out = D.upsert_companies(_known_companies(spark, d), keys, W.AS_OF)
    return out.select(
        F.col("id").cast("bigint").alias("id"), "canonical_name",
        F.col("display_name_persian").alias("display_name"),
        F.col("total_job_postings").cast("bigint").alias("total_job_postings"),
        F.col("active_job_postings").cast("bigint").alias("active_job_postings"),
        F.col("last_activity_date").cast("string").alias("last_activity_date"),
    )


@query("company_lookup", f"""
SELECT k.id, c.id AS company_id FROM ({COMPANY_KEYS}) k JOIN ({COMPANY_DIM}) c ON c.canonical_name = k.key""")
def company_lookup(spark, d):
    """Dimension ids per posting; hot keys are found by the lookup."""
    keys = D.company_keys(_named_postings(spark, d))
    companies = D.upsert_companies(_known_companies(spark, d), keys, W.AS_OF)
    found = D.resolve(keys, companies, "company_key", "canonical_name", "company_id")
    return found.select("id", F.col("company_id").cast("bigint").alias("company_id"))


@query("location_dim", f"""
SELECT row_number() OVER (ORDER BY first_id, key) AS id, key AS location_normalized, raw AS city_persian, 'city' AS location_type
FROM (SELECT key, arg_min(raw, id) AS raw, min(id) AS first_id FROM (
  SELECT o_orderkey AS id, nullif({S.normalize("n_name || ' (' || c_mktsegment || ')'")}, '') AS key,
    {S.strip("n_name || ' (' || c_mktsegment || ')'")} AS raw
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey) GROUP BY 1)""")
def location_dim(spark, d):
    place = F.concat_ws("", F.col("location_raw"), F.lit(" ("), F.col("experience_level"), F.lit(")"))
    rows = W.postings(spark, d).withColumn("location_raw", place)
    empty = spark.createDataFrame([], Sc.SCHEMAS["locations"])
    out = D.upsert_locations(empty, D.location_keys(rows))
    return out.select(
        F.col("id").cast("bigint").alias("id"), "location_normalized", "city_persian", "location_type"
    )


MENTIONS = f"""SELECT doc_id AS id, unnest({S.skills('text')}) AS skill FROM documents"""
CATEGORY = "CASE skill " + " ".join(
    f"WHEN {S.text(n)} THEN {S.text(c)}" for n, c, _ in W.PROSE_SKILLS[::2]
) + " ELSE 'domain_knowledge' END"
SKILL_DIM = f"""
SELECT row_number() OVER (ORDER BY first_id, skill) AS id, skill, {CATEGORY} AS category
FROM (SELECT skill, min(id) AS first_id FROM ({MENTIONS}) GROUP BY 1)"""


def _mentions(spark, d):
    found = K.match_skills(F.col("text"), ENTRIES)
    return W.texts(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.explode(found).alias("skill")
    )


def _skills(spark, d):
    empty = spark.createDataFrame([], Sc.SCHEMAS["skills"])
    listed = K.skill_category(F.col("skill"), ENTRIES[::2])
    return D.upsert_skills(empty, _mentions(spark, d), listed, W.AS_OF)


@query("skill_dim", SKILL_DIM)
def skill_dim(spark, d):
    return _skills(spark, d).select(
        F.col("id").cast("bigint").alias("id"), F.col("skill_name_english").alias("skill"),
        F.col("skill_category").alias("category"),
    )


@query("skill_bridge", f"""
SELECT coalesce(n.job_posting_id, s.job_posting_id) AS job_posting_id,
  CAST(coalesce(n.skill_id, s.skill_id) AS BIGINT) AS skill_id,
  greatest(coalesce(n.c, s.c), coalesce(s.c, n.c)) AS confidence_score
FROM (SELECT m.id AS job_posting_id, k.id AS skill_id, 0.7::DOUBLE AS c FROM ({MENTIONS}) m JOIN ({SKILL_DIM}) k USING (skill)) n
FULL JOIN (SELECT doc_id AS job_posting_id, 1 AS skill_id, CASE WHEN doc_id % 2 = 0 THEN 0.9 ELSE 0.1 END::DOUBLE AS c
  FROM documents) s ON s.job_posting_id = n.job_posting_id AND s.skill_id = n.skill_id""")
def skill_bridge(spark, d):
    rows = D.bridge_rows(_mentions(spark, d), _skills(spark, d))
    stored = W.texts(spark, d, "documents").select(
        F.col("doc_id").alias("job_posting_id"), F.lit(1).alias("skill_id"),
        F.lit("mentioned").alias("requirement_type"), F.lit("unknown").alias("proficiency_level"),
        F.when(F.col("doc_id") % 2 == 0, 0.9).otherwise(0.1).alias("confidence_score"),
        F.lit("keyword_match").alias("extraction_method"),
    )
    out = D.upsert_bridge(stored, rows)
    return out.select(
        "job_posting_id", F.col("skill_id").cast("bigint").alias("skill_id"), "confidence_score"
    )


MEMORY = f"""
WITH u AS (SELECT sha256('fa|en|' || {S.strip('text')}) AS h, {S.strip('text')} AS t, doc_id FROM documents
    WHERE {S.strip('text')} <> ''),
  s AS (SELECT DISTINCT h, 'known ' || h AS tr FROM u WHERE doc_id % 3 = 0)
SELECT u.h AS source_text_hash, coalesce(any_value(s.tr), sha256(any_value(t))) AS translation,
  CAST(count(*) + CASE WHEN any_value(s.tr) IS NULL THEN 0 ELSE 5 END AS BIGINT) AS usage_count
FROM u LEFT JOIN s ON s.h = u.h GROUP BY 1"""


def _texts(spark, d):
    return W.texts(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")


def _memory(spark, d):
    uses = D.text_uses(_texts(spark, d), ["text"])
    known = uses.where(F.col("id") % 3 == 0).groupBy("source_text_hash").agg(
        F.first("source_text").alias("source_text")
    )
    return known.select(
        "source_text_hash", "source_text", F.lit("fa").alias("source_language"),
        F.lit("en").alias("target_language"),
        F.concat(F.lit("known "), F.col("source_text_hash")).alias("translated_text"),
        F.lit("google").alias("translation_service"), F.lit(0.8).alias("translation_confidence"),
        F.lit(datetime(2001, 1, 1)).cast("timestamp_ntz").alias("last_used_at"), F.lit(5).alias("usage_count"),
    )


@query("translation_memory", MEMORY)
def translation_memory(spark, d):
    out = D.remember_translations(
        _memory(spark, d), D.text_uses(_texts(spark, d), ["text"]), W.RUN_AT
    )
    known = F.col("translated_text").startswith("known ")
    return out.select(
        "source_text_hash",
        F.when(known, F.col("translated_text")).otherwise(F.sha2("translated_text", 256)).alias("translation"),
        F.col("usage_count").cast("bigint").alias("usage_count"),
    )


@query("translated_texts", f"""
WITH u AS (SELECT doc_id, sha256('fa|en|' || {S.strip('text')}) AS h, {S.strip('text')} AS t FROM documents),
  s AS (SELECT DISTINCT h FROM u WHERE doc_id % 3 = 0)
SELECT doc_id AS id, CASE WHEN s.h IS NULL THEN sha256(nullif(t, '')) ELSE 'known ' || s.h END AS translation
FROM u LEFT JOIN s ON s.h = u.h""")
def translated_texts(spark, d):
    rows = _texts(spark, d)
    hits = D.known_translations(_memory(spark, d), D.text_uses(rows, ["text"]))
    out = D.translated(rows, hits, {"text": "english"})
    known = F.col("english").startswith("known ")
    return out.select("id", F.when(known, F.col("english")).otherwise(F.sha2("english", 256)).alias("translation"))


# --- validation and exports --------------------------------------------------


@query("validate_rows", f"""
SELECT seq, array_to_string(list_filter([CASE WHEN job_url IS NULL THEN 'job_url_missing' END,
  CASE WHEN source_site NOT IN ('irantalent', 'jobvision', 'jobinja') THEN 'source_site_not_allowed' END],
  lambda v: v IS NOT NULL), '|') AS violations
FROM (SELECT seq, CASE WHEN seq % 7 <> 0 THEN job_url END AS job_url,
  CASE WHEN seq % 5 = 0 THEN keyword ELSE source_site END AS source_site FROM ({S.DISCOVERIES}))""")
def validate_rows(spark, d):
    seq = F.col("seq")
    rows = W.discoveries(spark, d).withColumns(
        {
            "job_url": F.when(seq % 7 != 0, F.col("job_url")),
            "source_site": F.when(seq % 5 == 0, F.col("keyword")).otherwise(F.col("source_site")),
        }
    )
    out = Sc.with_violations(rows, Sc.rules("job_discoveries"))
    return out.select("seq", F.array_join("violations", "|").alias("violations"))


@query("orphan_rows", """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def orphan_rows(spark, d):
    """Documents without a label."""
    docs = W.table(spark, d, "documents").select("doc_id", "source")
    return Sc.orphans(docs, "doc_id", W.table(spark, d, "labels"), "doc_id")


@query("session_report", f"""
SELECT count(*) AS total_discovered, count(DISTINCT job_url) AS unique_discovered,
  count(DISTINCT found_on_page) AS pages_scraped, count(*) AS total_attempted,
  count(*) FILTER (keyword <> 'error') AS successful, count(*) FILTER (keyword = 'error') AS failed,
  count(*) FILTER (keyword <> 'error') / count(*)::DOUBLE * 100 AS success_rate,
  3600.0::DOUBLE AS duration_seconds FROM ({S.DISCOVERIES})""")
def session_report(spark, d):
    out = Ex.session_summary(
        W.discoveries(spark, d), W.attempts(spark, d), "s", "all",
        datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 1),
    )
    return out.select("phase_1_discovery.*", "phase_2_detail_scraping.*", "duration_seconds")


@query("failed_urls", f"""
SELECT job_url AS url, 'no_data' AS reason, count(*) AS n FROM ({S.ATTEMPTS}) WHERE NOT success GROUP BY 1""")
def failed_urls(spark, d):
    return Ex.failures(W.attempts(spark, d)).groupBy("url", "reason").agg(F.count("*").alias("n"))


# --- enrichment --------------------------------------------------------------

_LO, _HI = S.salary("salary_min_original", S.strip("description_persian"))
_DESC = S.strip("description_persian")
ENRICHED = f"""
WITH p AS (SELECT * FROM ({S.DOC_POSTINGS}) WHERE source_site <> 'elsewhere'),
  ck AS (SELECT id, {S.canonical("company_name_raw")} AS key FROM p),
  cd AS (SELECT key, row_number() OVER (ORDER BY min(id), key) AS company_id FROM ck WHERE key IS NOT NULL GROUP BY 1),
  lk AS (SELECT id, nullif({S.normalize("location_raw")}, '') AS key FROM p),
  ld AS (SELECT key, row_number() OVER (ORDER BY min(id), key) AS location_id FROM lk WHERE key IS NOT NULL GROUP BY 1)
SELECT p.id, nullif({S.strip("title_persian")}, '') AS title_english, sha256({_DESC}) AS description_hash,
  nullif({S.normalize("title_persian")}, '') AS title_normalized,
  CASE WHEN e <> 'unknown' THEN e ELSE employment_type END AS employment_type,
  CASE WHEN x <> 'unknown' THEN x ELSE experience_level END AS experience_level,
  coalesce(lo, salary_min_original) AS salary_min, hi AS salary_max,
  array_to_string(list_sort(list_distinct(list_concat({S.skills('description_persian')}, coalesce(tags, [])))), '|') AS skills,
  cd.company_id, ld.location_id
FROM (SELECT *, {S.label("employment_type", S.V.EMPLOYMENT_LABELS)} AS e,
    {S.label("experience_level", S.V.EXPERIENCE_LABELS)} AS x, {_LO} AS lo, {_HI} AS hi FROM p) p
JOIN ck ON ck.id = p.id LEFT JOIN cd ON cd.key = ck.key JOIN lk ON lk.id = p.id LEFT JOIN ld ON ld.key = lk.key"""


def _enriched(spark, d):
    rows = W.document_postings(spark, d)
    missing = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in Sc.SCHEMAS["job_postings"].fields
        if f.name not in rows.columns
    ]
    names = ["companies", "locations", "skills", "job_skills", "translation_cache"]
    empty = {n: spark.createDataFrame([], Sc.SCHEMAS[n]) for n in names}
    return E.Enriched(rows.select("*", *missing), empty, ENTRIES, W.AS_OF, W.RUN_AT)


@query("enriched_postings", ENRICHED)
def enriched_postings(spark, d):
    return _enriched(spark, d).postings.select(
        "id", "title_english", F.sha2("description_english", 256).alias("description_hash"),
        "title_normalized", "employment_type", "experience_level",
        F.col("salary_min_original").alias("salary_min"), F.col("salary_max_original").alias("salary_max"),
        F.array_join("skills", "|").alias("skills"),
        F.col("company_id").cast("bigint").alias("company_id"),
        F.col("location_id").cast("bigint").alias("location_id"),
    )


@query("enrichment_counters", f"""
WITH e AS ({ENRICHED})
SELECT (SELECT count(*) FROM documents) AS total, count(*) AS processed,
  (SELECT count(*) FROM documents) - count(*) AS failed, count(title_english) AS translated_title,
  count(description_hash) AS translated_description, count(company_id) AS companies_linked,
  count(location_id) AS locations_linked,
  CAST(sum(CASE WHEN skills = '' THEN 0 ELSE len(string_split(skills, '|')) END) AS BIGINT) AS skills_linked
FROM e""")
def enrichment_counters(spark, d):
    return _enriched(spark, d).counters
