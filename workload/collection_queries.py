"""Collection over the given pages: searches with early stop, and details.

The links of a page's navigation are its postings; pages are dealt to searches by
their number.  Links of short words count as known from an earlier session.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hirelake.operators import extract as X
from hirelake.plans import collection as C
from hirelake.sources import values as V
from hirelake.sources.schemas import SCHEMAS
from hirelake.sources.tables import settled
from workload import sql as S
from workload import views as W
from workload.registry import query
from workload.text_queries import EXTRACTED, _site_pages

KNOWN, IN_ROW, RATIO = 4, 2, 0.5
_LINK = '<li><a href="/'


def _listing(spark, d):
    """Pages in each site's listing layout, with their search."""
    p, html = F.col("page_id"), F.col("html")
    site = W.site_of(p)
    card = F.replace(F.replace(html, F.lit(_LINK), F.lit('<li><new-position-card><a href="/en/job/')),
                     F.lit("</a></li>"), F.lit("</a></new-position-card></li>"))
    laid = (
        F.when(site == "irantalent", card)
        .when(site == "jobinja", F.replace(html, F.lit(_LINK), F.lit('<li><a class="c-jobListView__titleLink" href="/companies/')))
        .otherwise(F.replace(html, F.lit(_LINK), F.lit('<li><a href="/jobs/')))
    )
    return W.texts(spark, d, "pages").select(
        p.alias("id"), site.alias("source_site"), F.col("url").alias("source_url"), laid.alias("raw_html"),
        F.concat(F.lit("k"), F.pmod(F.floor(p / 3), F.lit(4)).cast("string")).alias("keyword"),
        (F.floor(p / 12) + 1).alias("page"),
    )


def _known(spark, d):
    """Tracking before the session: URLs that end in a short word."""
    links = X.listing_links(_listing(spark, d)).select("job_url", "source_site").distinct()
    short = links.where(F.length(F.substring_index("job_url", "/", -1)) <= KNOWN)
    fixed = {
        "first_seen_session": "s0", "last_seen_session": "s0", "is_active": False, "detail_scraped": True, "detail_scrape_count": 1,
    }
    return short.select(
        *[
            (F.col(f.name) if f.name in short.columns else F.lit(fixed.get(f.name))).cast(f.dataType).alias(f.name)
            for f in SCHEMAS["job_tracking"].fields
        ]
    )


def _discovery(spark, d):
    empty = spark.createDataFrame([], SCHEMAS["job_discoveries"])
    return C.discover(
        _listing(spark, d), empty, settled(_known(spark, d)), "s1", W.AS_OF, datetime(2001, 8, 1), 1, IN_ROW, RATIO
    )


_SEARCHED = f"""
WITH p AS (SELECT page_id, url, {S.site_of('page_id')} AS source_site, 'k' || (page_id // 3 % 4) AS keyword,
    page_id // 12 + 1 AS page, regexp_extract_all(html, '{_LINK}([^"]*)"', 1) AS w FROM pages),
  every AS (SELECT * EXCLUDE (w), unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM p),
  l AS (SELECT *, CASE source_site WHEN 'irantalent' THEN '{V.SITE_BASE_URLS["irantalent"]}/en/job/'
      WHEN 'jobinja' THEN '{V.SITE_BASE_URLS["jobinja"]}/companies/' ELSE '{V.SITE_BASE_URLS["jobvision"].rstrip("/")}/jobs/' END || word AS job_url
    FROM every QUALIFY source_site <> 'jobvision' OR row_number() OVER (PARTITION BY page_id, word ORDER BY pos) = 1),
  known AS (SELECT DISTINCT job_url, source_site FROM l WHERE length(word) <= {KNOWN}),
  r AS (SELECT source_site, keyword, page,
      count(DISTINCT job_url) FILTER (length(word) <= {KNOWN}) / count(*)::DOUBLE >= {RATIO} AS ok FROM l GROUP BY 1, 2, 3),
  g AS (SELECT *, count(*) FILTER (NOT ok) OVER (PARTITION BY source_site, keyword ORDER BY page) AS island FROM r),
  s AS (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY source_site, keyword, island ORDER BY page) AS streak FROM g),
  stops AS (SELECT source_site, keyword, min(page) AS stop FROM s WHERE streak >= {IN_ROW} GROUP BY 1, 2),
  empties AS (SELECT source_site, keyword, min(page) FILTER (len(w) = 0) AS empty_page FROM p GROUP BY 1, 2),
  ends AS (SELECT source_site, keyword, empty_page, CASE WHEN empty_page IS NULL OR stop < empty_page THEN stop END AS stop_page
    FROM empties LEFT JOIN stops USING (source_site, keyword)),
  taken AS (SELECT l.* FROM l JOIN ends USING (source_site, keyword)
    WHERE coalesce(page <= stop_page, true) AND coalesce(page < empty_page, true)),
  found AS (SELECT * FROM taken QUALIFY row_number() OVER (PARTITION BY source_site, job_url ORDER BY page_id, pos) = 1)
"""


@query("collect_discovery", f"""{_SEARCHED}
SELECT row_number() OVER (ORDER BY page_id, pos) AS id, 's1' AS scrape_session_id, job_url, source_site,
  url AS found_on_page FROM found""")
def collect_discovery(spark, d):
    return _discovery(spark, d).log.select("id", "scrape_session_id", "job_url", "source_site", "found_on_page")


@query("collect_tracking", f"""{_SEARCHED}
SELECT coalesce(k.job_url, f.job_url) AS job_url, coalesce(k.source_site, f.source_site) AS source_site,
  CASE WHEN k.job_url IS NULL THEN 's1' ELSE 's0' END AS first_seen_session,
  CASE WHEN f.job_url IS NULL THEN 's0' ELSE 's1' END AS last_seen_session,
  f.job_url IS NOT NULL AS is_active, k.job_url IS NOT NULL AS detail_scraped
FROM known k FULL JOIN found f ON k.job_url = f.job_url""")
def collect_tracking(spark, d):
    return _discovery(spark, d).tracking.select(
        "job_url", "source_site", "first_seen_session", "last_seen_session", "is_active", "detail_scraped"
    )


@query("collect_searches", f"""{_SEARCHED}
SELECT source_site, keyword, empty_page, stop_page, count(*) FILTER (coalesce(page <= stop_page, true)
  AND coalesce(page <= empty_page, true)) AS pages FROM p JOIN ends USING (source_site, keyword) GROUP BY 1, 2, 3, 4""")
def collect_searches(spark, d):
    """Where each search ends, and how many of its pages are stored."""
    made = _discovery(spark, d)
    stored = made.pages.select(F.col("id"), W.site_of(F.col("id")).alias("source_site"),
                               F.concat(F.lit("k"), F.pmod(F.floor(F.col("id") / 3), F.lit(4)).cast("string")).alias("keyword"))
    counted = stored.groupBy("source_site", "keyword").agg(F.count("*").alias("pages"))
    return made.ends.join(counted, ["source_site", "keyword"])


def _details(spark, d):
    pages = _site_pages(spark, d)
    tracked = pages.select(
        *[
            {
                "job_url": F.col("source_url"), "source_site": F.col("source_site"), "first_seen_session": F.lit("s0"),
                "detail_scraped": F.lit(False), "detail_scrape_count": F.lit(1),
            }.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS["job_tracking"].fields
        ]
    )
    tables = {n: spark.createDataFrame([], SCHEMAS[n]) for n in ("job_postings", "company_tracking", "raw_scrapes")}
    fetched = pages.withColumn("scraped_at", F.lit(datetime(2001, 8, 1)).cast("timestamp_ntz"))
    return C.collect_details(fetched, tables | {"job_tracking": tracked}, "s1", W.AS_OF)


@query("collect_details", f"""
SELECT p.source_url AS job_url, p.source_site, e.external_id IS NOT NULL AS detail_scraped, 2 AS detail_scrape_count,
  e.raw_scrape_id AS id, e.external_id, e.title_persian, e.company_url, e.employment_type
FROM ({S.POSTINGS}) p LEFT JOIN ({EXTRACTED}) e ON e.raw_scrape_id = p.id""")
def collect_details(spark, d):
    """Postings numbered as stored, beside the marks that their URLs get."""
    made = _details(spark, d)
    postings = C.number_new_postings(made.postings, 1).select(
        F.col("raw_scrape_id").alias("id"), F.col("source_url").alias("job_url"), "external_id", "title_persian", "company_url", "employment_type"
    )
    return made.tracking.select("job_url", "source_site", "detail_scraped", "detail_scrape_count").join(postings, "job_url", "left")


@query("collect_companies", f"""
SELECT company_url, arg_min(source_site, raw_scrape_id) AS source_site, 's1' AS last_seen_session, false AS profile_scraped
FROM ({EXTRACTED}) WHERE company_url IS NOT NULL GROUP BY 1""")
def collect_companies(spark, d):
    return _details(spark, d).companies.select("company_url", "source_site", "last_seen_session", "profile_scraped")
