from datetime import date

from pyspark.sql import functions as F

from hirelake.operators import extract as X
from hirelake.functions import html as H
from workload import views as W
from workload.text_queries import _site_pages

A = """<h1 class="font-20 margin-bottom-8 inline-middle font-weight-500 x"> Data <b>Engineer</b> </h1>
<a class="c" href="/en/company/acme">Acme &amp; Co</a><span class="color-gray">Tehran</span>
<p class="description margin-top-12 margin-bottom-8 pre-wrap text-start">We need
a female engineer</p>
<div class="margin-y-8"><ul><li class="description"> Full Time </li></ul></div>
<div class="margin-y-8"><p>Seniority</p> <ul><li><a href="#">Mid Level</a></li></ul></div>"""

B = """<div class="c-jobView__titleText"><h1>مهندس</h1></div>
<h2 class="c-companyHeader__name"> شرکت آب </h2><a class="c-companyHeader__logoLink" href="https://b/c/1">l</a>
<ul><li class="c-infoBox__item"><h4>Location</h4><div class="tags"><span class="black">Tehran</span></div></li>
<li class="c-infoBox__item"><h4>Type of cooperation</h4><div class="tags"><span class="black">Full Time</span></div></li>
<li class="c-infoBox__item"><h4>Minimum work experience</h4><div class="tags"><span class="black">3 Years</span></div></li>
<li class="c-infoBox__item"><h4>Required skills</h4><div class="tags"><span class="black">SQL</span><span class="black"> Git </span></div></li>
<li class="c-infoBox__item"><h4>Gender</h4><div class="tags"><span class="black">خانم</span></div></li>
<li class="c-infoBox__item"><h4>Minimum educational qualification</h4><div class="tags"><span class="black">مهم‌ نیست</span></div></li></ul>
<span class="black">outside</span>
<h4>Other</h4><div class="o-box__text">no</div>
<h4><i>Job description</i></h4>  <div class="o-box__text s">one <div>two</div> three</div> four"""

C = """<h1 class="py-2 text-black font-size-1 font-weight-bold">Dev</h1>
<a class="text-primary font-size-2 font-weight-bold yn_brand" href="/companies/9">Co</a>
<span class="font-size-6 text-muted">Shiraz</span>
<h2>Job description and duties</h2><div>do <div>this <div>deep</div></div> well</div><div>not this</div>
<div class="requirement-value text-black bg-light">A woman is preferred</div>"""


def test_three_sites(spark):
    pages = spark.createDataFrame(
        [
            (1, "irantalent", "https://a/en/job/x/11", A, 200),
            (2, "jobinja", "https://b/companies/j/22", B, 500),
            (3, "jobvision", "https://c/jobs/33", C, 200),
            (4, "jobvision", "https://c/jobs/34", C, 404),
            (5, "jobinja", "https://b/5", "Checking your browser before accessing", 200),
            (6, "irantalent", "https://a/en/job/x/12", "<p>nothing</p>", 200),
        ],
        "id long, source_site string, source_url string, raw_html string, response_status int",
    )
    out = {r.raw_scrape_id: r for r in X.extract_postings(pages, date(2024, 1, 1)).collect()}
    assert sorted(out) == [1, 2, 3, 6]
    a, b, c, e = out[1], out[2], out[3], out[6]
    assert (a.title_persian, a.company_name_raw, a.location_raw) == ("Data Engineer", "Acme & Co", "Tehran")
    assert a.company_url == "https://irantalent.com/en/company/acme"
    assert (a.employment_type, a.experience_level) == ("full_time", "mid_level")
    assert (a.gender_requirement, a.external_id, a.skills_required) == ("female", "11", None)
    assert a.description_persian == "We need\na female engineer"
    assert (b.title_persian, b.company_name_raw, b.company_url) == ("مهندس", "شرکت آب", "https://b/c/1")
    assert (b.location_raw, b.employment_type, b.experience_level) == ("Tehran", "full_time", "3_years")
    assert (b.education_level, b.gender_requirement) == ("none", "female")
    assert b.skills_required == ["SQL", "Git"]
    assert b.description_persian == "one two three"
    assert (c.title_persian, c.company_name_raw, c.location_raw) == ("Dev", "Co", "Shiraz")
    assert c.company_url == "https://jobvision.ir//companies/9"
    assert c.description_persian == "do this deep well"
    assert (c.gender_requirement, c.employment_type) == ("female", "unknown")
    assert (e.title_persian, e.company_name_raw, e.employment_type, e.gender_requirement) == (
        "", None, "unknown", "unknown")
    tried = {r.job_url: r.success for r in X.attempts_of(pages).collect()}
    assert tried["https://c/jobs/34"] is False and tried["https://b/companies/j/22"] is True


def test_listing_links_and_page_classes(spark):
    a = '<a href="/en/job/0">out</a><new-position-card><a href="/en/job/1">x</a><a href="/en/x">y</a></new-position-card><new-position-card><div><a class="k" href="/en/job/2?a=1&amp;b=2">z</a></div></new-position-card>'
    b = '<a class="c-jobListView__titleLink z" href="/companies/1">x</a><a href="http://no">n</a><a href="https://b/2" class="c-jobListView__titleLink">y</a>'
    c = '<a href="/jobs/1">x</a><a href="/jobs/1">again</a><a href="/jobs/2">y</a>'
    empty = '<app-empty-state class="ng-star-inserted"><p>فرصت شغلی برای جستجوی شما پیدا نشد</p></app-empty-state>'
    pages = spark.createDataFrame(
        [
            (1, "irantalent", a), (2, "jobinja", b), (3, "jobvision", c), (4, "jobvision", empty),
            (5, "jobvision", "<p></p>"),
            (6, "irantalent", "Your filtered search does not match any jobs"),
        ],
        "id long, source_site string, raw_html string",
    ).withColumn("source_url", F.lit("u"))
    got = {}
    for r in X.listing_links(pages).orderBy("id", "position").collect():
        got.setdefault(r.id, []).append(r.job_url)
    assert got == {
        1: ["https://irantalent.com/en/job/1", "https://irantalent.com/en/job/2?a=1&b=2"],
        2: ["https://jobinja.ir/companies/1", "https://b/2"],
        3: ["https://jobvision.ir/jobs/1", "https://jobvision.ir/jobs/2"],
    }
    flags = pages.select("id", X.has_no_results(F.col("source_site"), F.col("raw_html")).alias("e"))
    assert {r.id: r.e for r in flags.collect()} == {
        1: False, 2: False, 3: False, 4: True, 5: True, 6: True}


def test_deep_nesting_and_unclosed(spark):
    deep = "<div class='t'>" + "<div>a" * 500 + "</div>" * 500 + "</div>tail"
    row = spark.createDataFrame([(deep, "<div class='t'>open <b>end")], "a string, b string").select(
        H.element(F.col("a"), "div", ["t"]).alias("a"),
        H.element(F.col("b"), "div", ["t"]).alias("b"),
        H.element(F.col("b"), "h1").alias("c"),
    ).first()
    assert row.a == "a" * 500 and row.b == "open end" and row.c is None


def test_character_references(spark):
    import html

    texts = ["a &amp; b", "&lt;p&gt;&nbsp;x", "&#1606;&#x646;&#128512;", "plain", "AT&T &zzz; & x",
             "می&zwnj;شود &raquo;", "&amp;lt;", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", H.unescape(F.col("t")).alias("u")).collect()
    for r in rows:
        assert r.u == (None if r.t is None else html.unescape(r.t)), r


def test_blocks_inside_blocks(spark):
    page = "<div class='k'>a<div class='k'>b</div>c</div>x<div class='k z'>d</div>y"
    row = spark.createDataFrame([(page,)], "p string").select(
        F.transform(H.blocks(F.col("p"), "div", ["k"]), H.markup_text).alias("b")).first()
    assert row.b == ["abc", "b", "d"]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_company_urls_read_links_only(spark):
    """No other text of a page is read for its links, and a link once only."""
    pages = spark.createDataFrame(
        [(1, "irantalent", "u/1", A, 200), (2, "jobinja", "u/2", B, 200), (3, "jobvision", "u/3", C, 200)],
        "id long, source_site string, source_url string, raw_html string, response_status int",
    )
    links = X.company_urls(X.extract_postings(pages, date(2024, 1, 1)))
    assert "<h1" not in _plan(links) and "o-box__text" not in _plan(links)
    assert _plan(links).count("companyHeader__logoLink") == 1
    assert len(links.collect()) == 3


def test_pages_are_dealt_by_their_number(spark, sf_dir, monkeypatch):
    """Tasks get no more pages on a larger table, whatever joins leave."""
    orders = W.table(spark, sf_dir, "orders").count()
    monkeypatch.setattr(W, "TEXT_ROWS", -(-orders // 50))
    assert _site_pages(spark, sf_dir).rdd.getNumPartitions() == 50
