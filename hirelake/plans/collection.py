"""Collection jobs over fetched pages: discovery and details."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.operators import extract as X
from hirelake.operators import pages as P
from hirelake.operators import tracking as K
from hirelake.operators.ids import assign_ids, next_id
from hirelake.operators.metrics import discovered_by_site
from hirelake.operators.streaks import early_stop
from hirelake.sources import values as V
from hirelake.sources.tables import TableStore, settled

#: A search is one keyword's result pages of a site, in the order of their numbers.
SEARCH = ["source_site", "keyword"]


@dataclass
class Discovery:
    log: DataFrame
    tracking: DataFrame
    totals: DataFrame
    pages: DataFrame
    ends: DataFrame


def search_ends(
    pages: DataFrame,
    links: DataFrame,
    tracking: DataFrame,
    pages_in_row: int = V.EARLY_STOP_PAGES,
    threshold: float = V.EARLY_STOP_RATIO,
) -> DataFrame:
    """Where each search ends: ``source_site, keyword, empty_page, stop_page``.

    ``pages`` has ``source_site, keyword, page, empty`` and ``links`` has
    ``source_site, keyword, page, job_url``.  A search ends at its first page that is
    empty or has no link, and with the page that completes ``pages_in_row`` pages in a
    row whose links are tracked to the share ``threshold``.  Either is null where it
    doesn't happen.  A group's streak is carried from block to block of its pages, so
    a search of any length isn't sorted in one task.
    """
    page = [*SEARCH, "page"]
    ratios = K.seen_ratio(links, tracking)
    linked = ratios.select(*page, F.lit(True).alias("_linked"))
    empty = (
        pages.groupBy(*page).agg(F.bool_or("empty").alias("_empty"))
        .join(linked, page, "left")
        .groupBy(*SEARCH)
        .agg(F.min(F.when(F.col("_empty") | F.col("_linked").isNull(), F.col("page"))).alias("empty_page"))
    )
    stops = early_stop(ratios, pages_in_row, threshold)
    before = F.col("empty_page").isNull() | (F.col("stop_page") < F.col("empty_page"))
    return empty.join(stops, SEARCH, "left").withColumn("stop_page", F.when(before, F.col("stop_page")))


def within_search(rows: DataFrame, ends: DataFrame, links: bool) -> DataFrame:
    """Rows (of ``source_site, keyword, page``) that a collector would have come to.

    The page that ends a search is fetched; of an empty one no link is taken.  There is
    one row of ``ends`` a search, narrow enough for Spark to broadcast under its own check.
    """
    page, empty, stop = F.col("page"), F.col("empty_page"), F.col("stop_page")
    reached = F.coalesce(page <= stop, F.lit(True)) & F.coalesce(page < empty if links else page <= empty, F.lit(True))
    return rows.join(ends, SEARCH).where(reached).drop("empty_page", "stop_page")


def discover(
    listing_pages: DataFrame,
    log: DataFrame,
    tracking: DataFrame,
    session: str,
    as_of: date,
    at: datetime | None = None,
    first_id: int = 1,
    pages_in_row: int = V.EARLY_STOP_PAGES,
    threshold: float = V.EARLY_STOP_RATIO,
) -> Discovery:
    """Links of listing pages -> discovery rows to append, tracking, totals per site.

    Where the pages say which search they belong to (``keyword`` and ``page``, its number),
    a search ends as ``search_ends`` has it, judged by the tracking before this session;
    what lies beyond is neither tracked nor among ``pages``, the pages to store.
    Without these columns every page counts.

    Only the session's own part of the log can hold its URLs, so only that
    partition is read.  New rows are numbered from ``first_id`` by page and position.
    The links are extracted once and kept, as several results are made of them.
    """
    log = log.where(F.col("scrape_session_id") == session)
    searched = {"keyword", "page"} <= set(listing_pages.columns)
    keyword = F.coalesce(F.col("keyword"), F.lit("")) if searched else F.lit("")
    number = F.col("page") if searched else F.lit(None)
    pages = listing_pages.select(
        F.col("id").alias("page_id"), "source_site", keyword.alias("keyword"), number.cast("long").alias("page"),
        F.col("source_url").alias("_found_on"),
        F.coalesce(X.has_no_results(F.col("source_site"), F.col("raw_html")), F.lit(False)).alias("empty"),
    )
    pages = settled(pages)
    links = X.listing_links(listing_pages).select(F.col("id").alias("page_id"), "position", "job_url")
    links = settled(pages.join(links, "page_id"))
    if searched:
        ends = settled(search_ends(pages, links, tracking, pages_in_row, threshold))
        links = within_search(links, ends, links=True)
        kept = listing_pages.join(within_search(pages, ends, links=False).select(F.col("page_id").alias("id")), "id", "left_semi")
    else:
        ends = pages.select(*SEARCH, F.lit(None).cast("long").alias("empty_page"), F.lit(None).cast("long").alias("stop_page")).limit(0)
        kept = listing_pages
    found = links.select(
        F.lit(session).alias("scrape_session_id"),
        "job_url",
        "source_site",
        F.lit(None).cast("string").alias("company_url"),
        F.col("_found_on").alias("found_on_page"),
        F.lit(at).cast("timestamp_ntz").alias("discovered_at"),
        F.col("page_id").alias("page"),
        "position",
    )
    order = ["page", "position"]
    unique = settled(K.first_occurrences(found, ["scrape_session_id", "source_site", "job_url"], order))
    sighted = unique.withColumns(
        {"session": F.lit(session), "day": F.lit(as_of).cast("date")}
    )
    return Discovery(
        log=assign_ids(K.new_discoveries(log, unique, order), "page", "position", first_id),
        tracking=K.track_urls(tracking, sighted, order, small_batch=True),
        totals=discovered_by_site(unique),
        pages=kept.select(*[c for c in listing_pages.columns if c not in ("keyword", "page")]),
        ends=ends,
    )


@dataclass
class Details:
    pages: DataFrame
    postings: DataFrame
    tracking: DataFrame
    companies: DataFrame
    attempts: DataFrame


def collect_details(
    detail_pages: DataFrame,
    tables: dict[str, DataFrame],
    session: str,
    as_of: date,
    headings: X.SiteHeadings = X.HEADINGS,
) -> Details:
    """Detail pages -> page store rows, posting upsert, tracking marks, company URLs."""
    readable = X.readable_pages(detail_pages)
    # Postings, companies and ids are made of it, so it is extracted once.
    found = settled(X.extract_postings(detail_pages, as_of, headings)).withColumn(
        "seq", F.col("raw_scrape_id")
    )
    attempts = X.attempts_of(detail_pages)
    companies = found.where(F.col("company_url").isNotNull()).select(
        "company_url",
        "source_site",
        F.lit(session).alias("session"),
        F.lit(as_of).cast("date").alias("day"),
        "seq",
    )
    return Details(
        pages=P.store_pages(readable, tables["raw_scrapes"]),
        postings=K.upsert_postings(tables["job_postings"], found, ["seq"], small_batch=True),
        tracking=K.mark_scraped(tables["job_tracking"], attempts, as_of),
        companies=K.track_companies(tables["company_tracking"], companies, ["seq"]),
        attempts=attempts,
    )


def run_collection(
    store: TableStore,
    listing_pages: DataFrame,
    detail_pages: DataFrame,
    session: str,
    as_of: date,
    at: datetime | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Both phases against the store; returns discovered URLs per site.

    Pages whose id is stored are done and left out, so a session may be run again.
    They are stored last: what a broken run did is done once more, by merges that
    find the rows it left.  A dry run writes nothing and returns the same totals.
    """
    known = store.read("raw_scrapes")
    done = known.select("id")
    listing_pages = listing_pages.join(done, "id", "left_anti")
    detail_pages = detail_pages.join(done, "id", "left_anti")
    log = store.read("job_discoveries")
    phase1 = discover(
        listing_pages, log, store.read("job_tracking"), session, as_of, at, next_id(log)
    )
    # Both are computed before anything that they are made from changes.
    totals = settled(phase1.totals)
    if dry_run:
        return totals
    listing_rows = settled(P.store_pages(phase1.pages, known))
    store.append("job_discoveries", phase1.log)
    store.replace("job_tracking", phase1.tracking)
    names = ["job_postings", "job_tracking", "company_tracking"]
    seen = known.unionByName(listing_rows.select(*[c for c in known.columns if c in listing_rows.columns]), allowMissingColumns=True)
    stored = {n: store.read(n) for n in names}
    phase2 = collect_details(detail_pages, stored | {"raw_scrapes": seen}, session, as_of)
    detail_rows = settled(phase2.pages)
    store.replace("job_postings", number_new_postings(phase2.postings, next_id(stored["job_postings"])))
    store.replace("job_tracking", phase2.tracking)
    store.replace("company_tracking", phase2.companies)
    for rows in (listing_rows, detail_rows):
        store.append("raw_scrapes", rows.withColumn("scrape_session_id", F.lit(session)))
    for name in names:
        store.vacuum(name)
    return totals


def number_new_postings(postings: DataFrame, first_id: int) -> DataFrame:
    """Give inserted postings (null id) ids from ``first_id``, by page and external id."""
    old = postings.where(F.col("id").isNotNull())
    new = postings.where(F.col("id").isNull()).drop("id")
    return old.unionByName(assign_ids(new, "raw_scrape_id", "external_id", first_id))
