"""Driver tables in the shapes the operators expect.

Each view is a projection (plus, for names, two joins) over the given tables;
``workload.sql`` states the same views as SQL.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.sources.tables import spread

#: Partitions that tables of long texts are dealt over here at least, as they come in one
#: file, and rows that a partition gets at most, so that no task grows with its table.
TEXT_PARTITIONS, TEXT_ROWS = 32, 20_000

AS_OF = date(2001, 8, 1)
RUN_AT = datetime(2001, 8, 1, 2, 0, 0)
EVENT_DAY = date(2024, 1, 31)
SESSION_CUT = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows take much CPU each."""
    rows = table(spark, sf_dir, name)
    return spread(rows, text_partitions(rows))


def text_partitions(rows: DataFrame) -> int:
    """Partitions for as many rows as the scan ``rows`` has; Parquet knows their number."""
    return max(TEXT_PARTITIONS, -(-rows.count() // TEXT_ROWS))


def site_of(n: Column) -> Column:
    """One of the three sites by number."""
    return (
        F.when(F.pmod(n, F.lit(3)) == 0, "irantalent")
        .when(F.pmod(n, F.lit(3)) == 1, "jobvision")
        .otherwise("jobinja")
    )


def postings(
    spark: SparkSession, sf_dir: str, names: bool = True, costly: bool = False
) -> DataFrame:
    """Orders as postings; ``names`` joins company, segment and nation.

    ``costly`` deals them over tasks, after the joins, which would leave few of these.
    """
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.to_date("o_orderdate")
    status = F.col("o_orderstatus")
    text = F.concat(F.lit("Order "), key.cast("string"), F.lit(" "), F.col("o_orderpriority"))
    employment = (
        F.when(key % 7 == 0, F.lit(None).cast("string"))
        .when(key % 11 == 0, "unknown")
        .otherwise(F.col("o_orderpriority"))
    )
    base = o.select(
        key.alias("id"),
        key.cast("string").alias("external_id"),
        F.when(status == "O", "irantalent").when(status == "F", "jobinja").otherwise("jobvision")
        .alias("source_site"),
        F.concat(F.lit("https://board.example/jobs/"), key.cast("string")).alias("source_url"),
        text.alias("title_persian"),
        F.when(key % 2 == 0, F.concat(F.lit("EN "), text)).alias("title_english"),
        F.when(key % 5 != 0, F.concat(F.lit("About "), text)).alias("description_persian"),
        F.when(key % 6 == 0, F.lit("details")).alias("description_english"),
        F.when(cust % 10 != 0, cust).alias("company_id"),
        F.concat(F.lit("https://board.example/companies/"), cust.cast("string")).alias("company_url"),
        employment.alias("employment_type"),
        F.when(key % 5 == 0, F.date_sub(day, 2)).alias("posted_date"),
        day.alias("first_seen_date"),
        F.date_add(day, F.pmod(key, F.lit(60)).cast("int")).alias("last_seen_date"),
        (key % 4 != 0).alias("is_active"),
        F.when(key % 16 == 0, F.lit(AS_OF)).alias("deactivated_date"),
        F.when(key % 3 == 0, "pending").when(key % 3 == 1, "processed").otherwise("skipped")
        .alias("processing_status"),
        cust.alias("custkey"),
    )
    dealt = (lambda rows: rows.repartition(text_partitions(o), "id")) if costly else (lambda rows: rows)
    if not names:
        return dealt(base.drop("custkey"))
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("company_name_raw"),
        F.col("c_mktsegment").alias("experience_level"),
        F.col("c_nationkey").alias("n_nationkey"),
    )
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("location_raw"))
    return dealt(base.join(c, "custkey").join(n, "n_nationkey").drop("custkey", "n_nationkey"))


def company_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.col("c_name").alias("display_name_persian"),
        (key % 5).cast("int").alias("active_job_postings"),
        (key % 7 / 10.0).alias("hiring_velocity_30d"),
        F.date_sub(F.lit(AS_OF), (key % 100).cast("int")).alias("last_activity_date"),
    )


def skill_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("skill_name_english")
    )


def posting_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("job_posting_id"), F.col("l_partkey").alias("skill_id"))
        .distinct()
    )


def discoveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sightings of one URL per user."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        "ts",
        F.to_date("ts").cast("string").alias("scrape_session_id"),
        F.to_date("ts").alias("day"),
        F.concat(F.lit("https://board.example/jobs/"), user.cast("string")).alias("job_url"),
        F.when(user % 4 != 3, F.concat(F.lit("https://board.example/c/"), (user % 40).cast("string")))
        .alias("company_url"),
        site_of(user).alias("source_site"),
        F.col("event_type").alias("keyword"),
        F.col("event_type").alias("found_on_page"),
    )


def early(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("scrape_session_id") < SESSION_CUT)


def late(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("scrape_session_id") >= SESSION_CUT)


def url_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking state after the earlier sessions."""
    seen = early(discoveries(spark, sf_dir))
    first = seen.groupBy("job_url").agg(
        F.min_by("source_site", "seq").alias("source_site"),
        F.min_by("scrape_session_id", "seq").alias("first_seen_session"),
        F.max_by("scrape_session_id", "seq").alias("last_seen_session"),
        F.min_by("day", "seq").alias("first_seen_date"),
        F.max_by("day", "seq").alias("last_seen_date"),
        F.count("*").alias("_n"),
    )
    return first.select(
        "job_url", "source_site", "first_seen_session", "last_seen_session",
        "first_seen_date", "last_seen_date",
        (F.col("_n") % 2 == 0).alias("is_active"),
        F.lit(None).cast("date").alias("disappeared_date"),
        F.lit(None).cast("string").alias("disappeared_session"),
        (F.col("_n") % 3 == 0).alias("detail_scraped"),
        F.lit(None).cast("date").alias("last_detail_scrape_date"),
        (F.col("_n") % 3).cast("int").alias("detail_scrape_count"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        (user % 6).cast("int").alias("worker_id"),
        site_of(user).alias("source_site"),
        F.concat(F.lit("https://board.example/jobs/"), user.cast("string")).alias("job_url"),
        (F.col("event_type") != "error").alias("success"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links seen on listing pages: one page per day of the month."""
    return discoveries(spark, sf_dir).select(
        "source_site", "keyword", F.dayofmonth("day").alias("page"), "job_url"
    )


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as fetched pages."""
    d = F.col("doc_id")
    return texts(spark, sf_dir, "documents").select(
        d.alias("id"),
        site_of(d).alias("source_site"),
        F.concat(F.lit("https://board.example/p/"), d.cast("string")).alias("source_url"),
        F.col("text").alias("raw_html"),
        F.lit(200).alias("response_status"),
        F.timestamp_seconds(F.lit(1_000_000) - d % 7).cast("timestamp_ntz").alias("scraped_at"),
    )


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employment, experience, gender and education labels spread over the orders."""
    key = F.col("o_orderkey")

    def pick(options: list[str | None], every: int = 1) -> Column:
        at = (F.floor(key / every) % len(options)).cast("int")
        return F.get(F.array(*[F.lit(x) for x in options]), at)

    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        pick(EMPLOYMENT).alias("employment_raw"),
        pick(EXPERIENCE).alias("experience_raw"),
        pick(GENDER).alias("gender_raw"),
        pick(TITLES).alias("title"),
        pick(NOTES, 3).alias("note"),
        pick(EDUCATION).alias("education_raw"),
    )


# Values the label views rotate through.
EMPLOYMENT = [
    "Full-Time", "full_time", "تمام وقت", "تمام_وقت", None, "", "Unknown", "volunteer",
    "Hybrid work, part time", "Contract position", "internship program", " Remote ",
]
EXPERIENCE = [
    "Senior Level", "کارشناس ارشد", "less_than_1_year", "3-5 years", "Tech Lead", None, "",
    "Head of sales", "junior", "unknown", "Staff engineer",
]
GENDER = [
    "Woman", "Man", "زن", "آقا", "مهم‌ نیست", "مهم نیست", "There is no difference.", None,
    "A male is preferred", "any woman", "other",
]
TITLES = ["Nurse (female)", "Driver (MALE)", "خانم منشی", "Clerk", None]
NOTES = ["female team", "for male staff", "no preference", None]
EDUCATION = ["مهم‌ نیست", "Bachelor", None]

# A dictionary for the invented prose of the documents.
PROSE_SKILLS = [
    ("Ander", "language", ["ander", "anander"]),
    ("Bleed", "framework", ["bleed", " ble "]),
    ("Cion", "database", ["ción", "sión"]),
    ("Ening", "tool", ["ening"]),
    ("Irgend", "soft", ["irgend", "schön"]),
    ("Leau", "language", ["leau", "eaux"]),
    ("Never", "cloud", ["zzzz-not-there"]),
    ("Thing", "tool", ["thing", "hingth"]),
    ("Unge", "methodology", ["unge", "ungen"]),
    ("Éç", "certification", ["éç"]),
]
TOPIC = ["leau", "water", "ción"]


def document_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pending postings with companies, places, labels and pay."""
    d = F.col("doc_id")
    pay = F.when(
        d % 4 == 0,
        F.concat(
            F.lit(" حقوق از "), F.format_string("%,d", F.lit(1_000_000) + d),
            F.lit(" تا "), F.format_string("%,d", F.lit(2_000_000) + d), F.lit(" تومان"),
        ),
    ).when(d % 4 == 1, F.concat(F.lit(" "), (F.lit(50_000) + d).cast("string"), F.lit(" ریال"))).otherwise("")
    tags = F.when(d % 3 == 0, F.array(F.col("lang"), F.lit("Thing"), F.lit(None)))
    employment = F.get(F.array(*[F.lit(x) for x in EMPLOYMENT]), (d % len(EMPLOYMENT)).cast("int"))
    experience = F.get(F.array(*[F.lit(x) for x in EXPERIENCE]), (d % len(EXPERIENCE)).cast("int"))
    return texts(spark, sf_dir, "documents").select(
        d.alias("id"),
        F.when(d % 50 == 49, F.lit("elsewhere")).otherwise(site_of(d)).alias("source_site"),
        F.concat(F.lit("https://board.example/jobs/"), d.cast("string")).alias("source_url"),
        F.when(d % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("Role "), F.col("source"))).alias("title_persian"),
        F.concat(F.col("text"), pay).alias("description_persian"),
        F.when(d % 8 != 0, F.concat(F.lit(" شرکت "), F.col("source"), F.lit(" & Co. "))).alias("company_name_raw"),
        F.when(d % 10 != 0, F.concat(F.upper("lang"), F.lit("-City!"))).alias("location_raw"),
        employment.alias("employment_type"),
        experience.alias("experience_level"),
        F.when(d % 12 == 0, F.lit(777.0)).alias("salary_min_original"),
        F.lit(None).cast("double").alias("salary_max_original"),
        tags.alias("skills_required"),
        F.lit("pending").alias("processing_status"),
        F.lit(AS_OF).alias("first_seen_date"),
        F.lit(AS_OF).alias("last_seen_date"),
    )
