"""Rollups, the trigram index and exports, each built in two parts and then asked.

The tables are written to a fresh folder under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators import rollups as U
from hirelake.operators.trigrams import TrigramIndex, search_indexed
from hirelake.plans import reports as R
from hirelake.sources import values as V
from hirelake.sources.json_sink import export_documents, read_documents
from hirelake.sources.tables import shared_folder
from workload import sql as S
from workload import views as W
from workload.registry import ORACLES, query
from workload.report_queries import LISTED, P, SEARCH, dates_as_text

ALL = V.ALL_RANGE_DAYS


def _work(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/indexes/{name}-{uuid.uuid4().hex}"


def _rollups(spark: SparkSession, d: str) -> U.Rollups:
    """Rollups of the postings of even ids first, then refreshed by those of odd ids, which
    have days in common with them."""
    postings = W.postings(spark, d)
    even = F.col("id") % 2 == 0
    made = U.Rollups(spark, _work(spark, "rollups"), buckets=8)
    made.refresh(postings.where(even), postings.where(even))
    made.refresh(postings, postings.where(~even))
    return made


@query("rollup_market_stats", ORACLES["market_stats"])
def rollup_market_stats(spark, d):
    made = _rollups(spark, d)
    return U.market_stats(made.counts.read(), made.companies.read(), W.AS_OF)


@query("rollup_market_stats_site", ORACLES["market_stats_site"])
def rollup_market_stats_site(spark, d):
    made = _rollups(spark, d)
    return U.market_stats(made.counts.read(), made.companies.read(), W.AS_OF, "jobinja", ALL)


@query("rollup_snapshot", ORACLES["summary_snapshot"])
def rollup_snapshot(spark, d):
    made = _rollups(spark, d)
    return U.summary_snapshot(made.counts.read(), made.companies.read(), W.AS_OF)


@query("rollup_daily_by_site", ORACLES["daily_by_site"])
def rollup_daily_by_site(spark, d):
    return U.daily_by_site(_rollups(spark, d).counts.read(), W.AS_OF)


@query("rollup_breakdowns", ORACLES["breakdowns"])
def rollup_breakdowns(spark, d):
    return U.breakdowns(_rollups(spark, d).counts.read(), W.AS_OF, days=ALL)


def _index(spark: SparkSession, d: str) -> TrigramIndex:
    postings = W.postings(spark, d)
    even = F.col("id") % 2 == 0
    index = TrigramIndex(spark, _work(spark, "grams"), buckets=8)
    index.update(postings.where(even))
    index.update(postings.where(~even))
    return index


@query("posting_search_indexed", ORACLES["posting_search"])
def posting_search_indexed(spark, d):
    return dates_as_text(search_indexed(W.postings(spark, d), _index(spark, d), SEARCH, W.AS_OF))


#: Wildcards inside, capitals, all three text filters with trigrams of their own.
MIXED = R.Search(choice="all", text="ORDER 1%-HI_H", company="mer#000%1", location="tion_1", active_only=False)
MIXED_SQL = """company_name_raw ILIKE '%mer#000%1%' AND location_raw ILIKE '%tion_1%'
  AND (title_persian ILIKE '%ORDER 1%-HI_H%' OR title_english ILIKE '%ORDER 1%-HI_H%'
  OR description_persian ILIKE '%ORDER 1%-HI_H%' OR description_english ILIKE '%ORDER 1%-HI_H%')"""


@query("posting_search_wildcards", f"SELECT {LISTED} FROM {P} WHERE {MIXED_SQL}")
def posting_search_wildcards(spark, d):
    return dates_as_text(search_indexed(W.postings(spark, d), _index(spark, d), MIXED, W.AS_OF))


def _exported(spark: SparkSession, d: str) -> DataFrame:
    rows = W.discoveries(spark, d).select("job_url", "source_site", "keyword", "scrape_session_id", "seq")
    path = _work(spark, "export")
    export_documents(rows, path)
    return read_documents(spark, path, rows.schema)


@query("discoveries_exported", f"""
SELECT 'https://board.example/jobs/' || user_id AS job_url, {S.site_of("user_id")} AS source_site,
  event_type AS keyword, CAST(CAST(ts AS DATE) AS VARCHAR) AS scrape_session_id, event_id AS seq FROM events""")
def discoveries_exported(spark, d):
    return _exported(spark, d)
