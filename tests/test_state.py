"""Merges, ids, skew handling and streaks against small models."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hirelake.operators import metrics, pages, streaks, tracking
from hirelake.operators.ids import assign_ids
from hirelake.operators.merge import add, fill, fold, keyed_merge, take
from hirelake.operators.skew import heavy_keys, hot_keys, lookup
from hirelake.sources import schemas

D = date(2024, 1, 1)


def rows(df, *keys):
    return sorted((tuple(r[k] for k in keys) for r in df.collect()), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_merge_equals_row_by_row(spark, small):
    rnd = random.Random(5)
    stored = {k: [k, f"t{k}", rnd.choice([None, "old"]), 1, D] for k in range(0, 20, 2)}
    batch = [
        (rnd.randrange(20), f"new{i}", rnd.choice([None, f"d{i}"]), 1, D + timedelta(i), i)
        for i in range(60)
    ]
    schema = "k int, title string, descr string, n int, seen date"
    old = spark.createDataFrame([tuple(v) for v in stored.values()], schema)
    new = spark.createDataFrame(batch, schema + ", seq int")
    folded = fold(new, ["k"], ["seq"], last=["seen"], last_known=["descr"])
    counts = new.groupBy("k").agg(F.count("*").cast("int").alias("n"))
    folded = folded.drop("n", "seq").join(counts, "k")
    out = keyed_merge(old, folded, ["k"], {"descr": fill, "n": add, "seen": take}, small)
    for k, title, descr, n, seen, _ in batch:
        if k in stored:
            row = stored[k]
            row[2], row[3], row[4] = descr or row[2], row[3] + 1, seen
        else:
            stored[k] = [k, title, descr, n, seen]
    assert rows(out, "k", "title", "descr", "n", "seen") == sorted(
        (tuple(v) for v in stored.values()), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_null_keys_never_match(spark, small):
    old = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], "k int, v string")
    out = keyed_merge(old, new, ["k"], {"v": take}, small)
    assert rows(out, "k", "v") == sorted([(1, "x"), (None, "b"), (None, "y"), (None, "z")], key=repr)


def test_posting_upsert_rules(spark):
    names = "source_site string, external_id string, title_persian string, description_persian string, first_seen_date date, last_seen_date date, deactivated_date date"
    stored = spark.createDataFrame(
        [("jobinja", "1", "t1", "x", D, D, D), ("jobinja", None, "n", None, D, D, None)], names
    ).withColumn("is_active", F.lit(False)).withColumn("source_url", F.lit("u"))
    full = schemas.SCHEMAS["job_postings"]
    table = stored.select(*[
        (F.col(f.name) if f.name in stored.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in full.fields])
    later = D + timedelta(9)
    batch = spark.createDataFrame(
        [(1, "jobinja", "1", "t2", None, None, None, later, later), (2, "jobinja", "2", "a", "d1", None, None, D, D),
         (3, "jobinja", "2", "b", None, "c", None, later, later), (4, "jobinja", None, "n", None, None, None, D, D)],
        "seq int, source_site string, external_id string, title_persian string, description_persian string, "
        "company_name_raw string, location_raw string, first_seen_date date, last_seen_date date",
    ).withColumn("raw_scrape_id", F.col("seq").cast("bigint"))
    for small in (False, True):
        got = {(r.external_id, r.title_persian, r.last_seen_date): r for r in
               tracking.upsert_postings(table, batch, ["seq"], small).collect()}
        assert len(got) == 3  # the two null-id rows share title and date
        one = got[("1", "t1", later)]
        assert (one.is_active, one.description_persian, one.first_seen_date, one.deactivated_date) == (True, "x", D, D)
        two = got[("2", "a", later)]
        assert (two.description_persian, two.company_name_raw, two.first_seen_date, two.raw_scrape_id) == ("d1", "c", D, 3)
        assert (two.is_active, two.processing_status, two.salary_currency_original) == (True, "pending", "IRR")


def test_track_twice_is_once(spark):
    found = spark.createDataFrame(
        [("u1", "jobinja", "s1", D, 1), ("u1", "jobinja", "s1", D, 2), ("u2", "jobvision", "s1", D, 3)],
        "job_url string, source_site string, session string, day date, seq int")
    empty = spark.createDataFrame([], schemas.SCHEMAS["job_tracking"])
    once = tracking.track_urls(empty, found, ["seq"])
    twice = tracking.track_urls(once, found, ["seq"])
    assert sorted(once.collect(), key=repr) == sorted(twice.collect(), key=repr) and once.count() == 2
    tried = spark.createDataFrame([("u1", False), ("u1", True), ("zz", True)], "job_url string, success boolean")
    got = {r.job_url: (r.detail_scraped, r.detail_scrape_count, r.last_detail_scrape_date)
           for r in tracking.mark_scraped(once, tried, D).collect()}
    assert got == {"u1": (True, 2, D), "u2": (False, 0, None)}


def test_ids_in_slices(spark):
    rnd = random.Random(3)
    numbers = rnd.sample(range(10**9), 500)
    df = spark.createDataFrame([(n, f"k{n % 7}") for n in numbers], "first long, key string")
    for per_slice in (10**6, 40):
        got = {r.first: r.id for r in assign_ids(df, "first", "key", 11, rows_per_slice=per_slice).collect()}
        assert got == {n: i + 11 for i, n in enumerate(sorted(numbers))}
    assert assign_ids(df.limit(0), "first", "key", 1).count() == 0


def test_lookup_finds_hot_keys(spark):
    """A third of the rows with one key, a third with none: no task gets much more than its share."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") + 100)
    facts = spark.range(90_000).select("id", key.alias("key"))
    found = heavy_keys(facts, "key")
    assert list(found) == [7] and abs(found[7] - 0.5) < 0.001
    assert heavy_keys(facts.limit(0), "key") == {} and heavy_keys(facts.where("key is null"), "key") == {}
    dim = facts.select("key").distinct().where("key is null or key % 2 = 1").withColumn("n", F.col("key") * 2)
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(before, ("-1", "false"), strict=True):
            spark.conf.set(c, v)
        joined = lookup(facts, dim, "key", "id")
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 90_000 and max(sizes) < 2.5 * 90_000 / 8
        plain = facts.join(dim, "key", "left").select("id", "key", "n")
        assert joined.select("id", "key", "n").exceptAll(plain).count() == 0 and joined.count() == plain.count()
        inner = lookup(facts, dim, "key", "id", how="inner")
        assert inner.count() == facts.join(dim, "key").count()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_hot_keys_and_lookup(spark):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 200).cast("string"))).alias("key"))
    assert hot_keys(facts, "key", share=0.2) == ["hot"]
    assert hot_keys(facts.limit(0), "key") == []
    dim = facts.where("key is not null").select("key").distinct().withColumn("n", F.length("key"))
    plain = facts.join(dim, "key", "left").select("id", "n")
    salted = lookup(facts, dim, "key", "id", ["hot"]).select("id", "n")
    assert rows(plain, "id", "n") == rows(salted, "id", "n")


def test_page_store(spark):
    at = datetime(2024, 1, 1)
    batch = spark.createDataFrame(
        [(1, "a", at), (2, "a", at - timedelta(1)), (3, "é", at), (4, "old", at), (5, None, at)],
        "id long, raw_html string, scraped_at timestamp_ntz")
    store = pages.store_pages(spark.createDataFrame([(9, "old", at)], batch.schema))
    got = {r.id: (r.is_duplicate, r.raw_html, r.html_size) for r in pages.store_pages(batch, store).collect()}
    assert got[1] == (True, "", 1) and got[2] == (False, "a", 1) and got[3] == (False, "é", 2)
    assert got[4] == (True, "", 3)


def test_early_stop_model(spark):
    rnd = random.Random(8)
    data, expected = [], {}
    for k in range(12):
        ratios = [rnd.choice([1.0, 1.0, 0.5]) for _ in range(30)]
        data += [("s", f"k{k}", p + 1, r, 5) for p, r in enumerate(ratios)]
        streak = 0
        for p, r in enumerate(ratios):
            streak = streak + 1 if r >= 1.0 else 0
            if streak == 3:
                expected[f"k{k}"] = p + 1
                break
    data += [("s", "v", p + 1, r, 5) for p, r in enumerate([1, 1, 0.5, 1, 1, 1])]
    expected["v"] = 6
    df = spark.createDataFrame(
        [(a, b, c, float(d), e) for a, b, c, d, e in data],
        "source_site string, keyword string, page int, seen_ratio double, total_count long")
    for block in (4, 7, 1000):
        got = {r.keyword: r.stop_page for r in streaks.early_stop(df, 3, 1.0, block).collect()}
        assert got == expected
    assert streaks.early_stop(df, 0).count() == 0


def test_rate_audit_window_edges(spark):
    at = datetime(2024, 1, 1, 0, 0, 30)
    times = [at, at, at + timedelta(seconds=59, microseconds=999999), at + timedelta(seconds=60), at + timedelta(seconds=150)]
    df = spark.createDataFrame([("s", t) for t in times], "source_site string, ts timestamp")
    out = [(r.requests, r.requests_in_window, r.remaining, r.utilization_percent)
           for r in streaks.rate_audit(df, {"s": 4}, 1).orderBy("ts").collect()]
    assert out == [(2, 2, 2, 50.0), (1, 3, 1, 75.0), (1, 2, 2, 50.0), (1, 1, 3, 25.0)]


def test_lifecycle_edges(spark):
    as_of = date(2024, 1, 31)
    df = spark.createDataFrame(
        [(1, date(2024, 1, 16), True), (2, date(2024, 1, 17), True), (3, D, False), (4, D, None)],
        "id int, last_seen_date date, is_active boolean").withColumn("deactivated_date", F.lit(None).cast("date"))
    once = metrics.deactivate_stale(df, as_of)
    assert rows(once, "id", "is_active", "deactivated_date") == sorted(
        [(1, False, as_of), (2, True, None), (3, False, None), (4, None, None)], key=repr)
    again = metrics.deactivate_stale(once, as_of + timedelta(1))
    assert rows(again.where("id <> 2"), "id", "deactivated_date") == rows(once.where("id <> 2"), "id", "deactivated_date")
    v = spark.createDataFrame([(7,), (0,)], "n long").select(metrics.velocity(F.col("n")).alias("v"))
    assert [r.v for r in v.collect()] == [0.2333, 0.0]


def test_validation(spark):
    df = spark.createDataFrame([("jobinja", "u", None), ("x", None, "bad")], "source_site string, source_url string, page_type string").withColumn("processing_status", F.lit("pending"))
    good, bad = schemas.split_valid(df, schemas.rules("raw_scrapes"))
    assert good.count() == 1
    assert sorted(bad.first().violations) == ["page_type_not_allowed", "source_site_not_allowed", "source_url_missing"]
    for table in schemas.SCHEMAS:
        schemas.rules(table)
