"""Jobs over a table store, streams with restarts, exports, plan shapes."""

import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions.skills import SkillEntry
from hirelake.operators.merge import keyed_merge, take
from hirelake.operators.tracking import detail_worklist
from hirelake.plans import reports
from hirelake.plans.collection import discover, run_collection
from hirelake.plans.enrichment import run_enrichment
from hirelake.plans.refresh import run_refresh
from hirelake.sources import exports, schemas
from hirelake.sources.buckets import BucketTable
from hirelake.sources.tables import TableStore, jdbc_options, read_urls
from hirelake.streaming import incremental
from tests.test_extract import A, B, C

SKILLS = [SkillEntry(s, "tool", (p,)) for s, p in (("Git", "git"), ("Python", "python"), ("SQL", " sql "))]
DAY = date(2024, 3, 1)
AT = datetime(2024, 3, 1, 2)


def _pages(spark, rows):
    return spark.createDataFrame(
        [(i, s, u, t, h, 200, AT) for i, s, u, t, h in rows],
        "id long, source_site string, source_url string, page_type string, raw_html string, "
        "response_status int, scraped_at timestamp_ntz")


def test_collect_enrich_refresh(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    store.create_all()
    listing = _pages(spark, [
        (1, "jobvision", "https://jobvision.ir/jobs?page=1", "job_list", '<a href="/jobs/33">x</a><a href="/jobs/34">y</a>'),
        (2, "jobinja", "https://jobinja.ir/jobs?page=1", "job_list", '<a class="c-jobListView__titleLink" href="https://b/companies/j/22">x</a>'),
    ])
    detail = _pages(spark, [
        (3, "irantalent", "https://a/en/job/x/11", "job_detail", A),
        (4, "jobinja", "https://b/companies/j/22", "job_detail", B),
        (5, "jobvision", "https://jobvision.ir/jobs/33", "job_detail", C),
        (6, "jobvision", "https://jobvision.ir/jobs/34", "job_detail", C),
    ])
    totals = {r.site: r.discovered for r in run_collection(store, listing, detail, "s1", DAY).collect()}
    assert totals == {"jobvision": 2, "jobinja": 1, "all": 3}
    assert store.read("job_discoveries").count() == 3
    raw = store.read("raw_scrapes")
    assert raw.count() == 6 and raw.where("is_duplicate").count() == 1
    assert detail_worklist(store.read("job_tracking")).count() == 0
    postings = store.read("job_postings")
    assert [r.id for r in postings.orderBy("id").collect()] == [1, 2, 3, 4]
    assert store.read("company_tracking").count() == 3
    log = store.read("job_discoveries")
    assert sorted(r.id for r in log.collect()) == [1, 2, 3] and log.where("found_on_page is null").count() == 0
    # The same session once more changes nothing.
    before = {t: sorted(map(str, store.read(t).collect())) for t in ("raw_scrapes", "job_discoveries", "job_tracking", "job_postings", "company_tracking")}
    run_collection(store, listing, detail, "s1", DAY)
    assert before == {t: sorted(map(str, store.read(t).collect())) for t in before}

    dry = run_enrichment(store, SKILLS, DAY, AT, dry_run=True).first()
    assert dry.pending_jobs_found == 4
    counters = run_enrichment(store, SKILLS, DAY, AT).first()
    assert (counters.total, counters.processed, counters.failed) == (4, 4, 0)
    assert counters.companies_linked == 4 and counters.translated_title == 4
    done = {r.external_id: r for r in store.read("job_postings").collect()}
    assert done["22"].technologies_mentioned == ["Git", "SQL"]
    assert {r.canonical_name for r in store.read("companies").collect()} == {"acme  co", "آب", "co"}
    co = store.read("companies").where("canonical_name = 'co'").first()
    assert (co.total_job_postings, done["33"].company_id, done["34"].company_id) == (2, co.id, co.id)
    bridge = store.read("job_skills")
    assert bridge.count() == counters.skills_linked
    before = store.read("translation_cache").agg(F.sum("usage_count")).first()[0]
    again = run_enrichment(store, SKILLS, DAY, AT + timedelta(1)).first()
    assert again.total == 0 and store.read("translation_cache").agg(F.sum("usage_count")).first()[0] == before

    summary = run_refresh(store, DAY + timedelta(20), AT + timedelta(20)).first()
    assert (summary.total_jobs, summary.active_jobs, summary.deactivated_today) == (4, 0, 4)
    assert store.read("companies").agg(F.sum("active_job_postings")).first()[0] == 0
    log = store.read("processing_logs")
    assert log.where("process_type = 'analysis' and status = 'completed'").count() == 1
    details = json.loads(log.where("process_type = 'analysis' and details_json is not null").first().details_json)
    assert details["deactivated_jobs"] == 4 and details["summary"]["total_jobs"] == 4
    for child, column, parent, key in schemas.REFERENCES:
        assert schemas.orphans(store.read(child), column, store.read(parent), key).count() == 0

    assert store.vacuum("job_postings") > 0 and store.read("job_postings").count() == 4
    store.reset()
    assert all(store.read(t).count() == 0 for t in schemas.SCHEMAS)


def test_failed_rows_are_logged(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    bad = spark.createDataFrame(
        [(1, "elsewhere", "u", "t", DAY, DAY, "pending"), (2, "jobinja", "u", "python", DAY, DAY, "pending")],
        "id long, source_site string, source_url string, title_persian string, first_seen_date date, "
        "last_seen_date date, processing_status string")
    store.replace("job_postings", bad)
    row = run_enrichment(store, SKILLS, DAY, AT).first()
    assert (row.processed, row.failed, row.skills_linked) == (1, 1, 1)
    log = store.read("processing_logs").where("entity_id = 1").first()
    assert (log.status, log.error_details) == ("failed", "source_site_not_allowed")
    assert store.read("job_postings").where("processing_status = 'failed'").count() == 1


def test_stream_restart_and_replay(spark, tmp_path):
    schema = "seq int, job_url string, source_site string, session string, day date"
    source = tmp_path / "in"

    def put(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(source / name))

    def run():
        found = spark.readStream.schema(schema).json(str(source / "*"))
        q = incremental.track_stream(found, store, ["seq"]).option(
            "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        q.awaitTermination()

    store = TableStore(spark, str(tmp_path / "t"))
    put("a", [(1, "u1", "jobinja", "s1", DAY)])
    run()
    put("b", [(2, "u1", "jobinja", "s2", DAY + timedelta(1)), (3, "u2", "jobinja", "s2", DAY)])
    run()
    got = {r.job_url: (r.first_seen_session, r.last_seen_session) for r in store.read("job_tracking").collect()}
    assert got == {"u1": ("s1", "s2"), "u2": ("s2", "s2")}
    version = store.version("job_tracking")
    merge = incremental._merge_into(store, "job_tracking", "discoveries", lambda old, batch: batch, 2)
    merge(store.read("job_tracking").limit(0), store.applied("job_tracking")["discoveries"])
    assert store.version("job_tracking") == version


def test_streams_into_one_table_lose_nothing(spark, tmp_path):
    """Two streams, one of them restarted with a new checkpoint folder."""
    schema = "seq int, job_url string, source_site string, session string, day date"
    store = TableStore(spark, str(tmp_path / "t"))
    for stream, urls in (("a", ["u1"]), ("b", ["u2", "u3"]), ("a again", ["u4"])):
        spark.createDataFrame([(i, u, "jobinja", "s", DAY) for i, u in enumerate(urls)], schema).write.json(
            str(tmp_path / f"in-{stream}"))
        found = spark.readStream.schema(schema).json(str(tmp_path / f"in-{stream}"))
        incremental.track_stream(found, store, ["seq"], stream).option(
            "checkpointLocation", str(tmp_path / f"check-{stream}")).trigger(availableNow=True).start().awaitTermination()
    assert {r.job_url for r in store.read("job_tracking").collect()} == {"u1", "u2", "u3", "u4"}
    assert store.applied("job_tracking") == {"a": 0, "b": 0, "a again": 0}
    assert len(store._versions("job_tracking")) == 2


def test_writers_of_one_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    one = spark.createDataFrame([("u1",)], "job_url string")
    store.replace("job_tracking", one)
    store.replace("job_tracking", one.union(one), base=0)
    with pytest.raises(FileExistsError):
        store.replace("job_tracking", one, base=0)
    assert store.version("job_tracking") == 1 and store.read("job_tracking").count() == 2


def test_posting_stream_and_expiry(spark, tmp_path):
    schema = "seq int, source_site string, external_id string, source_url string, title_persian string, raw_scrape_id long, description_persian string, company_name_raw string, location_raw string, first_seen_date date, last_seen_date date"
    rows = [(1, "jobinja", "1", "u", "t", 1, None, None, None, DAY, DAY), (2, "jobinja", "1", "u", "t2", 2, "d", None, None, DAY, DAY)]
    spark.createDataFrame(rows, schema).write.json(str(tmp_path / "in"))
    store = TableStore(spark, str(tmp_path / "t"))
    found = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    incremental.posting_stream(found, store, ["seq"]).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    row = store.read("job_postings").first()
    assert (row.title_persian, row.description_persian, row.raw_scrape_id, row.is_active) == ("t", "d", 2, True)
    assert incremental.expire(store, DAY + timedelta(15)).first().is_active is False


def test_exports(spark, tmp_path):
    urls = spark.createDataFrame([("u1", "p"), ("u1", "p"), ("u2", "q")], "job_url string, found_on_page string")
    head = exports.discovered_url_summary(urls, "s", AT).first()
    assert (head.total_urls, head.unique_urls, head.timestamp) == (3, 2, "2024-03-01T02:00:00")
    tried = spark.createDataFrame([("u1", True), ("u2", False)], "job_url string, success boolean")
    assert [(r.url, r.reason) for r in exports.failures(tried).collect()] == [("u2", "no_data")]
    out = exports.session_summary(urls, tried, "s", "x", AT, AT + timedelta(seconds=5), limit_jobs=3).first()
    assert out.phase_2_detail_scraping.success_rate == 50.0 and out.duration_seconds == 5.0
    assert out.phase_1_discovery.unique_discovered == 2 and out.limits.limit_jobs == 3
    posts = spark.createDataFrame([("1", "a", "s"), (None, "b", "s"), ("", "c", "s")], "external_id string, source_url string, source_site string")
    exports.export_each(posts, str(tmp_path / "each"), "external_id")
    assert len([n for n in os.listdir(tmp_path / "each") if n.startswith("file=")]) == 3
    exports.export_json(posts, str(tmp_path / "all"), by="source_site")
    assert spark.read.json(str(tmp_path / "all")).count() == 3
    (tmp_path / "urls.txt").write_text("https://a\n\n https://b \n")
    assert [r.url for r in read_urls(spark, str(tmp_path / "urls.txt")).collect()] == ["https://a", "https://b"]
    assert jdbc_options("u", "t", "id", 0, 9, 4)["numPartitions"] == "4"


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 5000)
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shapes(spark, tmp_path):
    table = schemas.SCHEMAS["job_postings"]
    spark.createDataFrame([], table).write.parquet(str(tmp_path / "p"))
    p = spark.read.schema(table).parquet(str(tmp_path / "p"))
    top = plan(reports.top_companies(p, DAY, "jobinja"))
    assert "TakeOrderedAndProject" in top
    assert "EqualTo(source_site,jobinja)" in top and "GreaterThanOrEqual(first_seen_date,2024-01-31)" in top
    assert "ReadSchema: struct<source_site:string,first_seen_date:date>" in plan(reports.daily_by_site(p, DAY))
    stats = plan(reports.market_stats(p, DAY))
    assert "description_persian" not in stats
    page = plan(reports.posting_page(reports.search_postings(p, reports.Search(), DAY), 2))
    assert "TakeOrderedAndProject" in page


def test_large_dictionary_enriches_alike(spark, sf_dir):
    from hirelake.functions.skills import dictionary_frame
    from hirelake.plans.enrichment import Enriched, usable
    from workload.state_queries import ENTRIES, _enriched

    table = dictionary_frame(spark, ENTRIES)
    assert isinstance(usable(table), list)
    small = _enriched(spark, sf_dir)
    large = Enriched(small.pending, small.tables, table, small.as_of, small.at)
    rows = lambda job: {r.id: r.skills for r in job.derived.select("id", "skills").collect()}
    assert rows(small) == rows(large)
    names = lambda job: {(r.skill_name_english, r.skill_category) for r in job.skills.collect()}
    assert names(small) == names(large)


def test_searches_end_early(spark, tmp_path):
    """A search ends after pages of tracked links in a row, or at a page without a link."""
    def link(n):
        return f'<a href="/jobs/{n}">x</a>'

    pages = {"k": [[1, 2], [3, 9], [4], [5], [6]], "l": [[1], [8], [], [7]], "m": [[1, 2, 2], [], [2]]}
    rows, n = [], 0
    for keyword, search in pages.items():
        for number, numbers in enumerate(search, 1):
            n += 1
            rows.append((n, "jobvision", f"https://jobvision.ir/jobs?{keyword}={number}", "job_list", "".join(map(link, numbers)), 200, AT, keyword, number))
    listing = spark.createDataFrame(
        rows, "id long, source_site string, source_url string, page_type string, raw_html string, "
        "response_status int, scraped_at timestamp_ntz, keyword string, page int")
    store = TableStore(spark, str(tmp_path / "t"))
    store.create_all()
    known = [(f"https://jobvision.ir/jobs/{i}", "jobvision", "s0", True) for i in range(1, 7)]
    store.replace("job_tracking", spark.createDataFrame(known, "job_url string, source_site string, first_seen_session string, is_active boolean"))
    made = discover(listing, store.read("job_discoveries"), store.read("job_tracking"), "s1", DAY, AT, pages_in_row=2)
    ends = {r.keyword: (r.empty_page, r.stop_page) for r in made.ends.collect()}
    assert ends == {"k": (None, 4), "l": (3, None), "m": (2, None)}
    assert sorted(r.id for r in made.pages.collect()) == [1, 2, 3, 4, 6, 7, 8, 10, 11]
    assert sorted(int(r.job_url.rsplit("/")[-1]) for r in made.log.collect()) == [1, 2, 3, 4, 5, 8, 9]
    # 0 pages in a row: never early.
    assert {r.stop_page for r in discover(listing, made.log.limit(0), store.read("job_tracking"), "s1", DAY, pages_in_row=0).ends.collect()} == {None}
    # A dry run says what it would find, and writes nothing; five pages in a row are the default.
    before = store.version("job_tracking")
    nothing = listing.limit(0).drop("keyword", "page")
    assert {r.site: r.discovered for r in run_collection(store, listing, nothing, "s1", DAY, AT, dry_run=True).collect()} == {"jobvision": 8, "all": 8}
    assert store.version("job_tracking") == before and store.read("raw_scrapes").count() == 0
    run_collection(store, listing, nothing, "s1", DAY, AT)
    assert store.read("raw_scrapes").count() == 10 and store.read("job_discoveries").count() == 8


def test_merges_touch_their_buckets_only(spark, tmp_path):
    schema = T.StructType.fromDDL("k string, n long")
    table = BucketTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=16)
    assert table.read().count() == 0

    def add(rows):
        batch = spark.createDataFrame(rows, schema)
        return table.merge(batch, lambda old, new: keyed_merge(old, new, ["k"], {"n": take}))

    def files():
        return {(f.parent.name, f.name) for f in (tmp_path / "t").rglob("*.parquet")}

    add([(f"k{i}", i) for i in range(200)])
    before = files()
    assert len(before) == 16
    touched = add([("k3", 33), ("k3 again", 1)])
    gone = {b for b, _ in before - files()}
    assert 1 <= len(touched) <= 2 and gone == {f"_bucket={b}" for b in touched}
    assert len(before & files()) == 16 - len(touched)
    assert {r.k: r.n for r in table.read().collect()} == {f"k{i}": i for i in range(200)} | {"k3": 33, "k3 again": 1}
    assert add([]) == [] and table.read(touched).count() < 202
    # A crash between writing the new content and putting it in place.
    again = BucketTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=16)
    new = spark.createDataFrame([("k5", 55)], schema).withColumn("_bucket", again.bucket())
    bucket = new.first()["_bucket"]
    kept = again.read([bucket]).where("k <> 'k5'").withColumn("_bucket", F.lit(bucket))
    again._stage(kept.unionByName(new))
    reopened = BucketTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=16)
    assert reopened.read().where("k = 'k5'").first().n == 55 and reopened.read().count() == 201
    # An unfinished one is dropped.
    again._stage(reopened.read([bucket]).limit(1).withColumn("_bucket", F.lit(bucket)))
    (tmp_path / "t-pending" / "_SUCCESS").unlink()
    assert BucketTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=16).read().count() == 201
