"""Text, label, URL, page and extraction operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.functions import html as H
from hirelake.functions import labels as L
from hirelake.functions import people as G
from hirelake.functions import skills as K
from hirelake.functions import text as T
from hirelake.functions import urls as U
from hirelake.operators import extract as X
from hirelake.operators import pages as P
from hirelake.sources import values as V
from workload import sql as S
from workload import views as W
from workload.registry import query

ENTRIES = [K.SkillEntry(n, c, tuple(p)) for n, c, p in W.PROSE_SKILLS]
LINKS = 'href="([^"]+)"'


@query("normalize_text", f"""
SELECT doc_id, sha256({S.normalize('text')}) AS normalized_hash,
  length({S.normalize('text')}) AS normalized_chars FROM documents""")
def normalize_text(spark, d):
    clean = T.normalize(F.col("text"))
    return W.texts(spark, d, "documents").select("doc_id", clean.alias("n")).select(
        "doc_id", T.content_hash(F.col("n")).alias("normalized_hash"),
        F.length("n").cast("bigint").alias("normalized_chars"),
    )


@query("normalize_titles", f"""
SELECT page_id, nullif({S.normalize("regexp_extract(html, '<title>(.*?)</title>', 1)")}, '') AS title
FROM pages""")
def normalize_titles(spark, d):
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return W.texts(spark, d, "pages").select(
        "page_id", T.normalized_title(F.lit(None).cast("string"), title).alias("title")
    )


@query("salary_parse", f"""
SELECT id, {S.salary('salary_min_original', 'description_persian')[0]} AS salary_min,
  {S.salary('salary_min_original', 'description_persian')[1]} AS salary_max
FROM ({S.DOC_POSTINGS})""")
def salary_parse(spark, d):
    pay = T.salary(F.col("salary_min_original"), F.col("description_persian"))
    return W.document_postings(spark, d).select("id", pay.alias("p")).select(
        "id", F.col("p.min").alias("salary_min"), F.col("p.max").alias("salary_max")
    )


@query("employment_type", f"""
SELECT id, employment_raw, {S.label('employment_raw', V.EMPLOYMENT_LABELS)} AS employment_type
FROM ({S.LABELS})""")
def employment_type(spark, d):
    return W.raw_labels(spark, d).select(
        "id", "employment_raw", L.employment_type(F.col("employment_raw")).alias("employment_type")
    )


@query("experience_level", f"""
SELECT id, experience_raw, {S.label('experience_raw', V.EXPERIENCE_LABELS)} AS experience_level
FROM ({S.LABELS})""")
def experience_level(spark, d):
    return W.raw_labels(spark, d).select(
        "id", "experience_raw", L.experience_level(F.col("experience_raw")).alias("experience_level")
    )


@query("label_tokens", f"""
SELECT id, coalesce(replace(lower({S.strip('employment_raw')}), ' ', '_'), 'unknown') AS token,
  CASE WHEN education_raw = {S.text(V.NOT_IMPORTANT)} THEN 'none' ELSE coalesce(education_raw, 'unknown') END AS education
FROM ({S.LABELS})""")
def label_tokens(spark, d):
    return W.raw_labels(spark, d).select(
        "id", T.label_token(F.col("employment_raw")).alias("token"),
        G.education_level(F.col("education_raw")).alias("education"),
    )


@query("gender_rules", f"""
SELECT id,
  CASE WHEN contains(lower(coalesce(title, '')), '(female)') OR contains(coalesce(title, ''), 'خانم')
      OR contains(coalesce(note, ''), 'female') THEN 'female'
    WHEN contains(lower(coalesce(title, '')), '(male)') OR contains(coalesce(title, ''), 'آقا')
      OR contains(coalesce(note, ''), 'male') THEN 'male' ELSE 'unknown' END AS by_text,
  CASE WHEN gender_raw IN ('Woman', 'female', 'زن', 'خانم') THEN 'female'
    WHEN gender_raw IN ('Man', 'male', 'مرد', 'آقا') THEN 'male'
    WHEN gender_raw = {S.text(V.NOT_IMPORTANT)} THEN 'any' ELSE 'not_specified' END AS by_label,
  CASE WHEN gender_raw IN ('There is no difference.', 'تفاوت ندارد', 'مهم نیست') THEN 'any'
    WHEN regexp_matches(lower(gender_raw), 'woman|female|زن|خانم') THEN 'female'
    WHEN regexp_matches(lower(gender_raw), 'man|male|مرد|آقا') THEN 'male' ELSE 'not_specified' END AS by_phrase
FROM ({S.LABELS})""")
def gender_rules(spark, d):
    return W.raw_labels(spark, d).select(
        "id",
        G.gender_from_text(F.col("title"), F.col("note")).alias("by_text"),
        G.gender_from_label(F.col("gender_raw")).alias("by_label"),
        G.gender_from_phrase(F.col("gender_raw")).alias("by_phrase"),
    )


@query("skill_match", f"""
SELECT doc_id, array_to_string({S.skills('text')}, '|') AS skills FROM documents""")
def skill_match(spark, d):
    found = K.match_skills(F.col("text"), ENTRIES)
    return W.texts(spark, d, "documents").select("doc_id", F.array_join(found, "|").alias("skills"))


@query("skill_match_large", f"""
SELECT doc_id, array_to_string({S.skills('text')}, '|') AS skills FROM documents""")
def skill_match_large(spark, d):
    docs = W.texts(spark, d, "documents")
    found = K.match_large(docs, "doc_id", "text", K.dictionary_frame(spark, ENTRIES))
    return found.select("doc_id", F.array_join("skills", "|").alias("skills"))


TAGS_SQL = """CASE WHEN doc_id % 5 = 0 THEN '{oops' WHEN doc_id % 5 = 1 THEN NULL
  ELSE '[1,"' || source || '",null,"Thing",{"a":2},"' || lang || '"]' END"""


@query("skill_union", f"""
SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat({S.skills('text')},
  CASE WHEN doc_id % 5 > 1 THEN [source, 'Thing', lang] ELSE [] END))), '|') AS skills
FROM documents""")
def skill_union(spark, d):
    docs = W.texts(spark, d, "documents")
    tags = (
        F.when(F.col("doc_id") % 5 == 0, "{oops")
        .when(F.col("doc_id") % 5 == 1, F.lit(None).cast("string"))
        .otherwise(
            F.concat(F.lit('[1,"'), F.col("source"), F.lit('",null,"Thing",{"a":2},"'),
                     F.col("lang"), F.lit('"]'))
        )
    )
    joined = K.union_json_tags(K.match_skills(F.col("text"), ENTRIES), tags)
    return docs.select("doc_id", F.array_join(joined, "|").alias("skills"))


@query("topic_filter", f"""
SELECT doc_id FROM documents WHERE {" OR ".join(f"contains(lower(text), {S.text(k)})" for k in W.TOPIC)}""")
def topic_filter(spark, d):
    docs = W.texts(spark, d, "documents")
    return docs.where(T.on_topic(F.col("text"), W.TOPIC)).select("doc_id")


@query("keyword_list", f"""
SELECT id, array_to_string(list_filter(list_transform(string_split(k, ','), lambda x: trim(x)),
  lambda x: x <> ''), '|') AS keywords
FROM (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'default'
  ELSE ' ' || o_orderpriority || ' ,, ' || o_orderstatus || ',' END AS k FROM orders)""")
def keyword_list(spark, d):
    key = F.col("o_orderkey")
    raw = F.when(key % 4 == 0, "  ").otherwise(
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ,, "), F.col("o_orderstatus"), F.lit(","))
    )
    return W.table(spark, d, "orders").select(
        key.alias("id"), F.array_join(T.keyword_list(raw, ["default"]), "|").alias("keywords")
    )


# --- URLs ------------------------------------------------------------------


@query("external_id", """
SELECT page_id, regexp_extract(url, '[^/]*$') AS external_id FROM pages""")
def external_id(spark, d):
    return W.texts(spark, d, "pages").select("page_id", U.last_segment(F.col("url")).alias("external_id"))


@query("set_page_param", r"""
SELECT page_id, base || '?' || CASE WHEN q = '' THEN 'page=7'
    WHEN regexp_matches(q, '(^|&)page=') THEN regexp_replace(q, '(^|&)page=[^&]*', '\1page=7')
    ELSE q || '&page=7' END || frag AS url
FROM (SELECT page_id, regexp_extract(url, '^[^?#]*') AS base,
  regexp_extract(url, '\?([^#]*)', 1) AS q, regexp_extract(url, '#.+$') AS frag FROM pages)""")
def set_page_param(spark, d):
    return W.texts(spark, d, "pages").select("page_id", U.set_page(F.col("url"), F.lit(7)).alias("url"))


@query("absolute_links", f"""
SELECT page_id, href, CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://jobinja.ir' || href END AS prefixed,
  CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://jobvision.ir' || href END AS joined
FROM (SELECT page_id, unnest(regexp_extract_all(html, '{LINKS}', 1)) AS href FROM pages)""")
def absolute_links(spark, d):
    links = X.page_links(W.texts(spark, d, "pages"))
    return links.select(
        "page_id", "href",
        U.prefix(V.SITE_BASE_URLS["jobinja"], F.col("href")).alias("prefixed"),
        U.join_root(V.SITE_BASE_URLS["jobvision"], F.col("href")).alias("joined"),
    )


@query("search_urls", """
SELECT DISTINCT p_name, 'https://jobinja.ir/jobs?keyword=' || replace(p_name, ' ', '+') AS url,
  'https://www.irantalent.com/en/jobs/search?language=english&keyword=' || replace(p_name, ' ', '+') AS english_url
FROM part""")
def search_urls(spark, d):
    words = W.table(spark, d, "part").select("p_name").distinct()
    return words.select(
        "p_name",
        U.search_url(F.lit(V.SITE_SEARCH_URLS["jobinja"]), F.col("p_name")).alias("url"),
        U.search_url(F.lit(V.SITE_SEARCH_URLS["irantalent"]), F.col("p_name"), "english").alias("english_url"),
    )


# --- pages -----------------------------------------------------------------


@query("page_dedupe", f"""
SELECT doc_id AS id, sha256(text) AS content_hash, octet_length(encode(text)) AS html_size,
  row_number() OVER w > 1 AS is_duplicate,
  CASE WHEN row_number() OVER w = 1 THEN length(text) ELSE 0 END AS stored_chars
FROM documents WINDOW w AS (PARTITION BY sha256(text) ORDER BY 1000000 - doc_id % 7, doc_id)""")
def page_dedupe(spark, d):
    out = P.store_pages(W.raw_pages(spark, d))
    return out.select(
        "id", "content_hash", F.col("html_size").cast("bigint").alias("html_size"), "is_duplicate",
        F.length("raw_html").cast("bigint").alias("stored_chars"),
    )


@query("page_dedupe_stored", """
WITH p AS (SELECT doc_id, sha256(text) AS h, doc_id % 7 AS late FROM documents),
  known AS (SELECT DISTINCT h FROM p WHERE late >= 4)
SELECT doc_id AS id, h AS content_hash,
  row_number() OVER (PARTITION BY h ORDER BY 1000000 - late, doc_id) > 1
    OR h IN (SELECT h FROM known) AS is_duplicate
FROM p WHERE late < 4
UNION ALL SELECT doc_id, h, row_number() OVER (PARTITION BY h ORDER BY 1000000 - late, doc_id) > 1
FROM p WHERE late >= 4""")
def page_dedupe_stored(spark, d):
    pages = W.raw_pages(spark, d)
    store = P.store_pages(pages.where(F.col("id") % 7 >= 4))
    out = P.store_pages(pages.where(F.col("id") % 7 < 4), store)
    return store.unionByName(out).select("id", "content_hash", "is_duplicate")


@query("page_links", f"""
SELECT page_id, position - 1 AS position, href FROM (
  SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) AS position
  FROM (SELECT page_id, regexp_extract_all(html, '{LINKS}', 1) AS l FROM pages))""")
def page_links(spark, d):
    links = X.page_links(W.texts(spark, d, "pages"))
    return links.select("page_id", F.col("position").cast("bigint").alias("position"), "href")


@query("page_fields", r"""
SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
  trim(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&amp;', '&')) AS title,
  trim(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&amp;', '&')) AS heading,
  len(regexp_extract_all(html, '<p>')) AS paragraphs
FROM pages""")
def page_fields(spark, d):
    html = F.col("html")
    return W.texts(spark, d, "pages").select(
        "page_id",
        H.attribute_of(H.opening(html, "html"), "lang").alias("lang"),
        H.clean_all([H.element(html, "title"), H.element(html, "h1")]).alias("t"),
        F.size(H.sections(html, H.open_tag("p"))).cast("bigint").alias("paragraphs"),
    ).select("page_id", "lang", F.get("t", F.lit(0)).alias("title"), F.get("t", F.lit(1)).alias("heading"), "paragraphs")


@query("page_class", r"""
SELECT page_id, contains(html, 'track(') OR contains(html, 'spam') AS challenge,
  contains(html, '$$$') AS empty_a, contains(html, '###') AS empty_b,
  NOT regexp_matches(html, '<a[^>]*href="/jobs/') AS empty_c
FROM pages""")
def page_class(spark, d):
    texts = {"irantalent": "$$$", "jobinja": "###", "jobvision": "none"}
    html = F.col("html")

    def empty(site):
        return X.has_no_results(F.lit(site), html, texts)

    return W.texts(spark, d, "pages").select(
        "page_id",
        X.is_challenge(html, ["track(", "spam"]).alias("challenge"),
        empty("irantalent").alias("empty_a"),
        empty("jobinja").alias("empty_b"),
        empty("jobvision").alias("empty_c"),
    )


# --- site pages written from postings and read back ------------------------


def _site_pages(spark, d):
    """Detail pages in the layout of each site, from the postings view."""
    p = W.postings(spark, d, costly=True)

    def cat(*parts):
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    title, name, place = F.col("title_persian"), F.col("company_name_raw"), F.col("location_raw")
    kind, level = F.col("employment_type"), F.col("experience_level")
    body = cat("about <b>", title, "</b> at ", name)
    company = F.col("company_id").cast("string")
    page_a = cat(
        '<h1 class="margin-bottom-8 font-20 inline-middle font-weight-500">', title, " </h1>",
        '<a href="/en/company/', F.coalesce(company, F.lit("0")), '">', name, "</a>",
        '<span class="x color-gray">', place, "</span>",
        '<p class="description margin-top-12 margin-bottom-8 pre-wrap text-start">', body, "</p>",
        '<div class="margin-y-8"><ul>',
        F.coalesce(cat('<li class="description">', kind, "</li>"), F.lit("")), "</ul></div>",
        '<div class="margin-y-8"><p>Seniority</p><ul><li><a>', level, "</a></li></ul></div>",
    )
    def box(head, value):
        return F.coalesce(
            cat('<li class="c-infoBox__item"><h4>', head, '</h4><div class="tags">', value, "</div></li>"),
            F.lit(""),
        )
    def tag(value):
        return cat('<span class="black">', value, "</span>")
    page_b = cat(
        '<div class="c-jobView__titleText"><div></div><h1>', title, "</h1></div>",
        '<h2 class="c-companyHeader__name">', name, "</h2>",
        F.coalesce(cat('<a class="c-companyHeader__logoLink" href="https://b.example/', company, '">i</a>'), F.lit("")),
        "<ul>", box("Location", tag(place)), box("Type of cooperation", tag(kind)),
        box("Minimum work experience", tag(level)),
        box("Required skills", cat(tag(level), tag(place))), "</ul>",
        '<h4>Job description</h4><div class="o-box__text"><div>', body, "</div> end</div><div>x</div>",
    )
    page_c = cat(
        '<h1 class="text-black font-size-1 font-weight-bold py-2">', title, "</h1>",
        '<a class="text-primary font-size-2 font-weight-bold yn_brand" href="/companies/',
        F.coalesce(company, F.lit("0")), '">', name, "</a>",
        '<span class="text-muted font-size-6">', place, "</span>",
        "<h2>Job description and duties</h2><div><div>", body, "</div></div>",
        '<div class="requirement-value text-black bg-light">', level, "</div>",
    )
    site = F.col("source_site")
    html = F.when(site == "irantalent", page_a).when(site == "jobinja", page_b).otherwise(page_c)
    return p.select(
        "id", "source_site", "source_url", html.alias("raw_html"),
        F.when(F.col("id") % 17 == 0, 404).otherwise(200).alias("response_status"),
    )


_TOKEN = "coalesce(replace(lower({}), ' ', '_'), 'unknown')"
EXTRACTED = f"""
SELECT id AS raw_scrape_id, external_id, source_site, title_persian, company_name_raw, location_raw,
  'about ' || title_persian || ' at ' || company_name_raw
    || CASE WHEN source_site = 'jobinja' THEN ' end' ELSE '' END AS description_persian,
  CASE source_site WHEN 'irantalent' THEN 'https://irantalent.com/en/company/' || coalesce(company_id, 0)
    WHEN 'jobinja' THEN 'https://b.example/' || company_id
    ELSE 'https://jobvision.ir//companies/' || coalesce(company_id, 0) END AS company_url,
  CASE WHEN source_site = 'jobvision' THEN 'unknown' ELSE {_TOKEN.format('employment_type')} END AS employment_type,
  CASE WHEN source_site = 'jobvision' THEN 'unknown' ELSE {_TOKEN.format('experience_level')} END AS experience_level,
  CASE WHEN source_site = 'irantalent' THEN 'unknown' ELSE 'not_specified' END AS gender_requirement,
  CASE WHEN source_site = 'jobinja' THEN experience_level || '|' || location_raw END AS skills
FROM ({S.POSTINGS}) WHERE source_site = 'jobinja' OR id % 17 <> 0"""


@query("page_postings", EXTRACTED)
def page_postings(spark, d):
    out = X.extract_postings(_site_pages(spark, d), W.AS_OF)
    return out.select(
        "raw_scrape_id", "external_id", "source_site", "title_persian", "company_name_raw",
        "location_raw", "description_persian", "company_url", "employment_type",
        "experience_level", "gender_requirement",
        F.array_join("skills_required", "|").alias("skills"),
    )


@query("page_attempts", f"""
SELECT source_site, count(*) FILTER (source_site = 'jobinja' OR id % 17 <> 0) AS succeeded,
  count(*) FILTER (source_site <> 'jobinja' AND id % 17 = 0) AS failed
FROM ({S.POSTINGS}) GROUP BY 1""")
def page_attempts(spark, d):
    return X.attempts_of(_site_pages(spark, d)).groupBy("source_site").agg(
        F.count_if(F.col("success")).alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
    )


@query("company_urls", f"""
SELECT source_site, count(*) AS links, count(DISTINCT company_url) AS companies FROM ({EXTRACTED})
WHERE company_url IS NOT NULL GROUP BY 1""")
def company_urls(spark, d):
    found = X.company_urls(X.extract_postings(_site_pages(spark, d), W.AS_OF))
    return found.groupBy("source_site").agg(
        F.count("*").alias("links"), F.count_distinct("company_url").alias("companies")
    )


@query("listing_links", """
WITH l AS (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem),
  page AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS parts FROM l GROUP BY 1),
  links AS (SELECT l_orderkey AS id, l_orderkey % 3 AS s, CASE WHEN l_orderkey % 3 = 2
      THEN list_sort(list_distinct(parts)) ELSE list_sort(parts) END AS parts FROM page)
SELECT id, job_url, count(*) AS n FROM (
  SELECT id, CASE s WHEN 0 THEN 'https://irantalent.com/en/job/' || part
    WHEN 1 THEN 'https://jobinja.ir/companies/' || part
    ELSE 'https://jobvision.ir/jobs/' || part END AS job_url
  FROM (SELECT id, s, unnest(parts) AS part FROM links)) GROUP BY 1, 2""")
def listing_links(spark, d):
    lines = W.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").distinct()
    part = F.col("l_partkey").cast("string")
    kind = F.col("l_orderkey") % 3
    link = (
        F.when(kind == 0, F.concat(F.lit('<new-position-card><a href="/en/job/'), part,
                                   F.lit('">x</a><a href="/no">y</a></new-position-card>')))
        .when(kind == 1, F.concat(F.lit('<a class="c-jobListView__titleLink" href="/companies/'), part,
                                  F.lit('">x</a>')))
        .otherwise(F.concat(F.lit('<a href="/jobs/'), part, F.lit('">x</a>')))
    )
    site = F.when(kind == 0, "irantalent").when(kind == 1, "jobinja").otherwise("jobvision")
    pages = (
        lines.select("l_orderkey", site.alias("source_site"), link.alias("link"))
        .groupBy(F.col("l_orderkey").alias("id"), "source_site")
        .agg(F.array_join(F.collect_list("link"), " ").alias("raw_html"))
        .withColumn("source_url", F.lit("https://board.example/list"))
    )
    return X.listing_links(pages).groupBy("id", "job_url").agg(F.count("*").alias("n"))
