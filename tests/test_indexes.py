"""Rollups and the trigram index against the plain reports, exports with failing tasks."""

import json
import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.operators import metrics, rollups
from hirelake.operators.trigrams import TrigramIndex, candidates, pattern_grams, search_indexed
from hirelake.plans import reports
from hirelake.sources.buckets import BucketTable
from hirelake.sources.json_sink import MANIFEST, export_documents, read_documents

DAY = date(2024, 3, 1)
SCHEMA = (
    "id long, source_site string, source_url string, title_persian string, title_english string, description_persian string, "
    "description_english string, company_name_raw string, company_url string, location_raw string, employment_type string, "
    "experience_level string, posted_date date, first_seen_date date, last_seen_date date, is_active boolean, "
    "processing_status string, deactivated_date date, company_id long"
)


def _postings(spark, rng, n, text=lambda rng: None):
    def one(i):
        day = None if rng.random() < 0.1 else DAY - timedelta(rng.randint(0, 60))
        return (
            i, rng.choice(["a", "b", "jobinja", None]), f"u{i}", text(rng), text(rng), text(rng), text(rng), text(rng), None,
            text(rng), rng.choice([None, "unknown", "full", ""]), rng.choice([None, "senior"]), None, day, DAY,
            rng.choice([True, False, None]), rng.choice(["pending", "processed", "failed", None]),
            rng.choice([None, DAY, DAY - timedelta(1)]), rng.choice([None, -5, 0, 1, 2, 32768, 32769, 10**9]),
        )

    return spark.createDataFrame([one(i) for i in range(n)], SCHEMA)


def _same_reports(made, postings):
    counts, companies = made.counts.read(), made.companies.read()
    pairs = [(rollups.summary_snapshot(counts, companies, DAY), metrics.summary_snapshot(postings, DAY))]
    for site, choice in (("all", 30), ("jobinja", "all"), ("nowhere", 7)):
        days = reports.range_days(choice)
        pairs += [
            (rollups.market_stats(counts, companies, DAY, site, days), reports.market_stats(postings, DAY, site, choice)),
            (rollups.breakdowns(counts, DAY, site, days), reports.breakdowns(postings, DAY, site, choice)),
        ]
    pairs.append((rollups.daily_by_site(counts, DAY), reports.daily_by_site(postings, DAY, choice="all")))
    for mine, plain in pairs:
        assert mine.columns == plain.columns
        assert sorted(mine.collect(), key=str) == sorted(plain.collect(), key=str)


def test_rollups_follow_changes(spark, tmp_path):
    made = rollups.Rollups(spark, str(tmp_path / "r"), buckets=4)
    none = _postings(spark, random.Random(0), 1).where("id < 0")
    _same_reports(made, none)
    rows = _postings(spark, random.Random(1), 300).unionByName(_postings(spark, random.Random(1), 40))
    made.refresh(rows, rows)
    _same_reports(made, rows)
    # Some postings close, change company or come anew; only their days are counted again.
    some = F.col("id") % 37 == 0
    after = rows.withColumns({"is_active": F.when(some, False).otherwise(F.col("is_active")),
                              "company_id": F.when(some, 77).otherwise(F.col("company_id"))})
    for _ in range(2):
        made.refresh(after, after.where(some))
        _same_reports(made, after)


LETTERS = ["a", "b", "A", "B", "ab", " ", "İ", "Σ", "σ", "é", "😀", "%", "_", "\\", "شغل"]


def test_search_by_trigrams(spark, tmp_path):
    rng = random.Random(3)

    def text(rng):
        return None if rng.random() < 0.2 else "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 14)))

    rows = _postings(spark, rng, 250, text).persist()
    index = TrigramIndex(spark, str(tmp_path / "g"), buckets=4)
    index.update(rows)

    def compare(postings, search):
        mine = search_indexed(postings, index, search, DAY)
        plain = reports.search_postings(postings, search, DAY)
        found = sorted(r.source_url for r in plain.collect())
        assert sorted(r.source_url for r in mine.collect()) == found, search
        return len(found)

    def search(**given):
        return reports.Search(choice="all", active_only=False, **given)

    seen = [
        compare(rows, search(text=t))
        for t in ("aba", "AB%ba", "ab_ab", "ab", "σΣa", "😀ab", "شغل", "İab", "a\\\\b", "zzzz", "%", "b a\\%")
    ]
    assert sum(n > 0 for n in seen) >= 8 and seen[9] == 0
    compare(rows, search(text="aba", company="bab", location="ab"))
    # Changed texts answer as they are now; rows without an id are compared without the index.
    changed = rows.withColumn("title_english", F.when(F.col("id") % 3 == 0, "now zzzz").otherwise(F.col("title_english")))
    index.update(changed.where("id % 3 = 0"))
    unnamed = changed.where("id = 3").withColumns({"id": F.lit(None).cast("long"), "source_url": F.lit("none")})
    assert compare(changed.unionByName(unnamed), search(text="W ZZ")) == 85
    compare(changed, search(text="aba"))
    entries = index.table.read()
    assert entries.count() == entries.distinct().count()


def test_pattern_grams(spark):
    assert pattern_grams(spark, "AbCd") == ["abc", "bcd"]
    assert pattern_grams(spark, "ab%cd_efg") == ["efg"]
    assert pattern_grams(spark, r"a\%b") == ["a%b"]
    assert pattern_grams(spark, "") == pattern_grams(spark, "__%") == []


def _left(folder):
    return sorted(os.listdir(folder))


def test_json_export(spark, tmp_path):
    path = str(tmp_path / "out" / "x")
    rows = spark.range(0, 50, 1, 4).select(
        "id", F.when(F.col("id") % 5 != 0, F.lit('"ü\n')).alias("text"), F.to_date(F.lit("2024-01-02")).alias("day"),
        F.array(F.struct(F.lit(1).alias("k"), F.lit(None).cast("string").alias("v"))).alias("items"),
    )
    with pytest.raises(FileNotFoundError):
        read_documents(spark, path, rows.schema)
    export_documents(rows, path)
    assert sorted(read_documents(spark, path, rows.schema).collect()) == sorted(rows.collect())
    files = [f for f in _left(path) if f.startswith("part-")]
    assert len(files) == 4 and sum(len(json.load(open(f"{path}/{f}"))) for f in files) == 50
    export_documents(rows.limit(1), path, overwrite=False)
    assert json.load(open(f"{path}/{MANIFEST}"))["rows"] == 51 and read_documents(spark, path, rows.schema).count() == 51

    # A task fails after it and others have written: what was there stays, and nothing else.
    before = _left(path)
    broken = rows.withColumn("text", F.when(F.col("id") == 49, F.raise_error(F.lit("no"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="no"):
        export_documents(broken, path)
    assert _left(path) == before and _left(tmp_path / "out") == ["x"]
    fresh = str(tmp_path / "new" / "y")
    with pytest.raises(Exception, match="no"):
        export_documents(broken, fresh)
    assert _left(tmp_path / "new") == []

    export_documents(rows.where("id < 0"), path)
    assert read_documents(spark, path, rows.schema).count() == 0 and _left(path) == [MANIFEST]


def test_companies_are_shuffled_as_ids(spark):
    """No bitmaps of parts of a day are shuffled or sorted, 4 KB each."""
    rows = spark.createDataFrame([], "first_seen_date date, source_site string, is_active boolean, company_id long")
    plan = rollups.company_rollup(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") < plan.index("Exchange")
    assert plan.count("Exchange") == 1


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    table = BucketTable(spark, f"{tmp_path}/t", T.StructType().add("id", "long").add("text", "string"), ["id"], 1, sort=["text"])
    rows = spark.range(0, 40_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    spark.conf.set(name, "200k")
    try:
        table.merge(rows, lambda old, new: old.unionByName(new))
    finally:
        spark.conf.set(name, before)
    assert len(list((tmp_path / "t" / "_bucket=0").glob("*.parquet"))) > 1
    assert table.read().count() == 40_000 and table.read().distinct().count() == 40_000


def test_a_repeated_id_is_found_once(spark, tmp_path):
    one = "id long, title_persian string, title_english string, description_persian string, description_english string, company_name_raw string, location_raw string"
    index = TrigramIndex(spark, f"{tmp_path}/grams", 2)
    index.update(spark.createDataFrame([(1, "abcdef", *[None] * 5)] * 2 + [(2, "abcxyz", *[None] * 5)], one))
    assert [r["id"] for r in candidates(index, "abcd", ["title_persian"]).collect()] == [1]


def test_wide_rows_are_written_unsorted_in_small_files(spark, tmp_path):
    """A task that writes or reads a bucket holds few of its rows, however well they compress."""
    from hirelake.sources import buckets

    table = BucketTable(spark, f"{tmp_path}/t", T.StructType().add("id", "long"), ["id"], 2, file_rows=50)
    asked, write = [], table._sorted
    table._sorted = lambda rows: asked.append(spark.conf.get(buckets.WRITERS)) or write(rows)
    before = spark.conf.get(buckets.WRITERS)
    table.merge(spark.range(0, 1000, 1, 4), lambda old, new: old.unionByName(new))
    assert asked == ["2", "2"] and spark.conf.get(buckets.WRITERS) == before
    files = list((tmp_path / "t").glob("_bucket=*/*.parquet"))
    assert len(files) >= 20 and max(spark.read.parquet(str(f)).count() for f in files[:5]) <= 50
    assert sorted(r.id for r in table.read().collect()) == list(range(1000))
    # A sorted table is sorted by what it says, by one writer after another.
    ordered = BucketTable(spark, f"{tmp_path}/s", T.StructType().add("id", "long"), ["id"], 2, sort=["id"])
    ordered.merge(spark.range(0, 100), lambda old, new: new)
    assert ordered.read().count() == 100 and spark.conf.get(buckets.WRITERS) == before
    made = rollups.Rollups(spark, str(tmp_path / "r"), buckets=2)
    assert made.companies.file_rows == rollups.FILE_BITMAPS


def _named(spark, ids, name="company"):
    none = {f: F.lit(None).cast("string") for f in ("title_english", "description_persian", "description_english", "location_raw")}
    return spark.createDataFrame([(i,) for i in ids], "id long").withColumns(
        {"title_persian": F.concat(F.lit("posting "), F.col("id").cast("string")), "company_name_raw": F.lit(name), **none}
    )


def _files(folder):
    return {f.relative_to(folder) for f in folder.rglob("*.parquet")}


def test_new_postings_leave_what_is_indexed(spark, tmp_path, monkeypatch):
    """Their texts are shuffled, trigrams are sorted where they are made, and no stored entry is rewritten."""
    plans, add = [], BucketTable.add
    monkeypatch.setattr(BucketTable, "add", lambda self, rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or add(self, rows))
    index = TrigramIndex(spark, str(tmp_path / "g"), buckets=2)
    index.update(_named(spark, [*range(0, 40_000, 10), None]))
    before = _files(tmp_path / "g")
    index.update(_named(spark, [*range(5, 40_000, 10), 2**62, -(2**62)]))
    assert before and before < _files(tmp_path / "g") and len(plans) == 2
    for plan in plans:
        assert plan.rindex("Generate") < plan.index("Exchange") and plan.count("Exchange") == 1
    entries = index.table.read()
    assert entries.count() == entries.distinct().count() and entries.select("id").distinct().count() == 8002
    assert {r.id for r in candidates(index, "ing 1234", ["title_persian", "company_name_raw"]).collect()} >= {12340, 12345}
    assert sorted(r.id for r in candidates(index, "461", ["title_persian", "company_name_raw"]).where("id > 40000 or id < 0").collect()) == [-(2**62), 2**62]
    # A known one among the new ones: its entries are replaced, in its bucket.
    index.update(_named(spark, [10, 11], "others"))
    assert sorted(r.id for r in candidates(index, "others", ["company_name_raw"]).collect()) == [10, 11]
    assert 10 not in {r.id for r in candidates(index, "company", ["company_name_raw"]).collect()}
    entries = index.table.read()
    assert entries.count() == entries.distinct().count() and entries.select("id").distinct().count() == 8003


def test_an_interrupted_addition_is_finished(spark, tmp_path):
    def table():
        return BucketTable(spark, str(tmp_path / "t"), T.StructType().add("id", "long"), ["id"], 4)

    table().add(spark.range(100).repartition(3))
    mine = table()
    moved, mine.recover = mine.recover, lambda: None
    mine.add(spark.range(100, 200).repartition(3))
    assert mine.read().count() == 100
    # Some files have been moved, one has been copied and is still there.
    files = sorted((tmp_path / "t-added").rglob("*.parquet"))
    files[0].rename(tmp_path / "t" / files[0].relative_to(tmp_path / "t-added"))
    (tmp_path / "t" / files[1].relative_to(tmp_path / "t-added")).write_bytes(files[1].read_bytes()[:50])
    assert sorted(r.id for r in table().read().collect()) == list(range(200)) and not (tmp_path / "t-added").exists()
    # An unfinished one is dropped.
    mine.add(spark.range(200, 300))
    (tmp_path / "t-added" / "_SUCCESS").unlink()
    moved()
    assert table().read().count() == 200 and not (tmp_path / "t-added").exists()


def test_found_entries_are_shuffled_once_for_each_posting(spark, tmp_path):
    index = TrigramIndex(spark, str(tmp_path / "g"), buckets=2)
    index.update(_named(spark, range(50)))
    found = candidates(index, "posting 1", ["title_persian", "company_name_raw"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == plan.count("Exchange") == 1
    assert sorted(r.id for r in found.collect()) == [1, *range(10, 20)]
