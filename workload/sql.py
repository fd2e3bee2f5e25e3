"""SQL fragments shared by the comparison queries (DuckDB dialect)."""

from __future__ import annotations

from hirelake.sources import values as V
from workload import views as W

AS_OF = "DATE '2001-08-01'"
EVENT_DAY = "DATE '2024-01-31'"
SPACE = r"[\s\x1c-\x1f\x{85}\p{Z}]"


def text(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({listed(values)})[CAST(({index}) % {len(values)} AS INT) + 1]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def normalize(x: str) -> str:
    spaced = f"regexp_replace({strip(f'lower({x})')}, '{SPACE}+', ' ', 'g')"
    return strip(
        rf"regexp_replace({spaced}, '[^\p{{L}}\p{{N}}_\-\s\x1c-\x1f\x{{85}}\p{{Z}}]+', '', 'g')"
    )


def canonical(x: str) -> str:
    return f"nullif({strip(f'''replace({normalize(x)}, {text(V.COMPANY_WORD)}, '')''')}, '')"


def label(x: str, table: dict) -> str:
    """Ordered label lookup as a CASE over the same fixed table."""
    pairs = [(t, n) for n, ts in table.items() for t in ts]
    key = f"lower({strip(x)})"
    exact = " ".join(f"WHEN {key} = {text(t)} THEN {text(n)}" for t, n in pairs)
    inside = " ".join(f"WHEN contains({key}, {text(t)}) THEN {text(n)}" for t, n in pairs)
    return (
        f"CASE WHEN {x} IS NULL OR lower({x}) IN ('', 'unknown') THEN 'unknown' "
        f"{exact} {inside} ELSE 'unknown' END"
    )


_N = r"[\p{Nd},]"
_UNIT = "|".join(V.SALARY_UNITS)
RANGE = (
    rf"(?:{V.SALARY_FROM}{SPACE}*)?({_N}+){SPACE}*{V.SALARY_TO}{SPACE}*({_N}+){SPACE}*(?:{_UNIT})"
)
SINGLE = rf"({_N}{{5,}}){SPACE}*(?:{_UNIT})"


def amount(x: str) -> str:
    digits = f"translate(replace({x}, ',', ''), '۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩', '01234567890123456789')"
    return f"TRY_CAST({digits} AS DOUBLE)"


def salary(existing: str, x: str) -> tuple[str, str]:
    lo = amount(f"regexp_extract({x}, '{RANGE}', 1)")
    hi = amount(f"regexp_extract({x}, '{RANGE}', 2)")
    one = amount(f"regexp_extract({x}, '{SINGLE}', 1)")
    both = f"({lo} IS NOT NULL AND {hi} IS NOT NULL)"
    first = f"CASE WHEN {existing} IS NULL THEN CASE WHEN {both} THEN {lo} ELSE {one} END END"
    second = f"CASE WHEN {existing} IS NULL AND {both} THEN {hi} END"
    return first, second


def skills(x: str, table=None) -> str:
    """Sorted list of dictionary skills found in ``x``."""
    items = []
    for name, _, patterns in table or W.PROSE_SKILLS:
        hit = " OR ".join(f"contains(lower({x}), {text(p)})" for p in patterns)
        items.append(f"CASE WHEN {hit} THEN {text(name)} END")
    return f"list_sort(list_filter([{', '.join(items)}], lambda s: s IS NOT NULL))"


def site_of(n: str) -> str:
    return f"CASE ({n}) % 3 WHEN 0 THEN 'irantalent' WHEN 1 THEN 'jobvision' ELSE 'jobinja' END"


POSTINGS = f"""
SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS external_id,
  CASE o_orderstatus WHEN 'O' THEN 'irantalent' WHEN 'F' THEN 'jobinja' ELSE 'jobvision' END AS source_site,
  'https://board.example/jobs/' || o_orderkey AS source_url,
  'Order ' || o_orderkey || ' ' || o_orderpriority AS title_persian,
  CASE WHEN o_orderkey % 2 = 0 THEN 'EN Order ' || o_orderkey || ' ' || o_orderpriority END AS title_english,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'About Order ' || o_orderkey || ' ' || o_orderpriority END AS description_persian,
  CASE WHEN o_orderkey % 6 = 0 THEN 'details' END AS description_english,
  CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS company_id,
  'https://board.example/companies/' || o_custkey AS company_url,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'unknown' ELSE o_orderpriority END AS employment_type,
  CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) - 2 END AS posted_date,
  CAST(o_orderdate AS DATE) AS first_seen_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) AS last_seen_date,
  o_orderkey % 4 <> 0 AS is_active,
  CASE WHEN o_orderkey % 16 = 0 THEN {AS_OF} END AS deactivated_date,
  CASE o_orderkey % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'processed' ELSE 'skipped' END AS processing_status,
  c_name AS company_name_raw, c_mktsegment AS experience_level, n_name AS location_raw
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
"""

COMPANIES = f"""
SELECT c_custkey AS id, c_name AS display_name_persian,
  CAST(c_custkey % 5 AS INT) AS active_job_postings, c_custkey % 7 / 10.0::DOUBLE AS hiring_velocity_30d,
  {AS_OF} - CAST(c_custkey % 100 AS INT) AS last_activity_date
FROM customer
"""

DISCOVERIES = f"""
SELECT event_id AS seq, ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS scrape_session_id, CAST(ts AS DATE) AS day,
  'https://board.example/jobs/' || user_id AS job_url,
  CASE WHEN user_id % 4 <> 3 THEN 'https://board.example/c/' || (user_id % 40) END AS company_url,
  {site_of('user_id')} AS source_site, event_type AS keyword, event_type AS found_on_page
FROM events
"""

TRACKING = f"""
SELECT job_url, arg_min(source_site, seq) AS source_site,
  arg_min(scrape_session_id, seq) AS first_seen_session, arg_max(scrape_session_id, seq) AS last_seen_session,
  arg_min(day, seq) AS first_seen_date, arg_max(day, seq) AS last_seen_date,
  count(*) % 2 = 0 AS is_active, count(*) % 3 = 0 AS detail_scraped, CAST(count(*) % 3 AS INT) AS detail_scrape_count
FROM ({DISCOVERIES}) WHERE scrape_session_id < '{W.SESSION_CUT}' GROUP BY job_url
"""

ATTEMPTS = f"""
SELECT CAST(user_id % 6 AS INT) AS worker_id, {site_of('user_id')} AS source_site,
  'https://board.example/jobs/' || user_id AS job_url, event_type <> 'error' AS success, ts
FROM events
"""

LISTING = f"""
SELECT source_site, keyword, CAST(day(day) AS INT) AS page, job_url FROM ({DISCOVERIES})
"""

LABELS = f"""
SELECT o_orderkey AS id, {pick(W.EMPLOYMENT, 'o_orderkey')} AS employment_raw,
  {pick(W.EXPERIENCE, 'o_orderkey')} AS experience_raw, {pick(W.GENDER, 'o_orderkey')} AS gender_raw,
  {pick(W.TITLES, 'o_orderkey')} AS title, {pick(W.NOTES, 'o_orderkey // 3')} AS note,
  {pick(W.EDUCATION, 'o_orderkey')} AS education_raw
FROM orders
"""

DOC_POSTINGS = f"""
SELECT doc_id AS id,
  CASE WHEN doc_id % 50 = 49 THEN 'elsewhere' ELSE {site_of('doc_id')} END AS source_site,
  CASE WHEN doc_id % 9 = 0 THEN '' ELSE 'Role ' || source END AS title_persian,
  text || CASE WHEN doc_id % 4 = 0 THEN ' حقوق از ' || format('{{:,}}', 1000000 + doc_id) || ' تا '
      || format('{{:,}}', 2000000 + doc_id) || ' تومان'
    WHEN doc_id % 4 = 1 THEN ' ' || (50000 + doc_id) || ' ریال' ELSE '' END AS description_persian,
  CASE WHEN doc_id % 8 <> 0 THEN ' شرکت ' || source || ' & Co. ' END AS company_name_raw,
  CASE WHEN doc_id % 10 <> 0 THEN upper(lang) || '-City!' END AS location_raw,
  {pick(W.EMPLOYMENT, 'doc_id')} AS employment_type, {pick(W.EXPERIENCE, 'doc_id')} AS experience_level,
  CASE WHEN doc_id % 12 = 0 THEN 777.0::DOUBLE END AS salary_min_original,
  CASE WHEN doc_id % 3 = 0 THEN [lang, 'Thing'] END AS tags
FROM documents
"""
