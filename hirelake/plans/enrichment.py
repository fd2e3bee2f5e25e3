"""Enrichment of pending postings.

One declarative plan: translation memory, text normalisation, labels, salary,
dimension resolution and skill matching.  Wide rows are projected once; only
narrow (id, key) columns travel to the dimension joins, and their results come
back in one join on the posting id.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions.labels import employment_type, experience_level, known_or_kept
from hirelake.functions.skills import (
    SkillEntry,
    cleaned,
    load_dictionary,
    match_joined,
    match_skills,
    matcher,
    searchable,
    skill_category,
    union_skills,
)
from hirelake.functions.text import normalized_title, salary, strip
from hirelake.operators import dimensions as D
from hirelake.operators.metrics import enrichment_counters
from hirelake.operators.skew import computed_once, hot_keys
from hirelake.plans.reports import pending_batch
from hirelake.sources.exports import failure_log, log_event
from hirelake.sources.schemas import rules, with_violations
from hirelake.sources.tables import TableStore


@dataclass(frozen=True)
class Hot:
    """Keys holding a large share of the batch, per join; None: the join finds them itself."""

    companies: Sequence | None = None
    locations: Sequence | None = None
    skills: Sequence | None = None
    texts: Sequence | None = None


def translate(postings: DataFrame, memory: DataFrame, hot: Hot = Hot()) -> DataFrame:
    """Add English title and description: stored translation, else the text itself."""
    columns = {"title_persian": "title_english", "description_persian": "description_english"}
    uses = D.text_uses(postings, list(columns))
    hits = D.known_translations(memory, uses, hot.texts)
    return D.translated(postings.drop(*columns.values()), hits, columns)


Dictionary = list[SkillEntry] | DataFrame


def usable(dictionary: Iterable[SkillEntry] | DataFrame) -> Dictionary:
    """A dictionary table as entries where it is small enough for the plan."""
    if not isinstance(dictionary, DataFrame):
        return cleaned(dictionary)
    loaded = load_dictionary(dictionary)
    return dictionary if loaded is None else loaded


def derive(translated: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Title, labels, salary and skills of each posting.

    Row-local, without a shuffle, unless the dictionary is too large to broadcast.
    """
    pay = salary(F.col("salary_min_original"), strip(F.col("description_persian")))
    text = searchable(
        strip(F.col("title_persian")),
        strip(F.col("description_persian")),
        F.col("title_english"),
        F.col("description_english"),
    )
    skills_of = matcher(dictionary) if isinstance(dictionary, DataFrame) else None
    if skills_of is not None:
        found = skills_of(text)
    elif isinstance(dictionary, DataFrame):
        docs = translated.select("id", text.alias("_text"))
        hits = match_joined(docs, "id", "_text", dictionary)
        translated = translated.join(hits.withColumnRenamed("skills", "_found"), "id", "left")
        found = F.col("_found")
    else:
        found = match_skills(text, dictionary)
    labelled = translated.withColumns(
        {
            "title_normalized": normalized_title(
                F.col("title_english"), strip(F.coalesce("title_persian", F.lit("")))
            ),
            "employment_type": known_or_kept(
                employment_type(strip(F.col("employment_type"))), F.col("employment_type")
            ),
            "experience_level": known_or_kept(
                experience_level(strip(F.col("experience_level"))), F.col("experience_level")
            ),
        }
    )
    costly = computed_once(
        labelled, skills=union_skills(found, F.col("skills_required")), _pay=pay
    )
    return costly.withColumns(
        {
            "salary_min_original": F.coalesce("_pay.min", "salary_min_original"),
            "salary_max_original": F.coalesce("_pay.max", "salary_max_original"),
            "technologies_mentioned": F.when(F.size("skills") > 0, F.col("skills")),
        }
    ).drop("_pay", "_found")


def link(
    derived: DataFrame,
    source: DataFrame,
    companies: DataFrame,
    locations: DataFrame,
    hot: Hot = Hot(),
) -> DataFrame:
    """Attach dimension ids and the final status.

    Both id columns are resolved on narrow rows of ``source`` (the postings before
    enrichment, so that nothing costly is computed for them) and joined back
    together.
    """
    company = D.resolve(
        D.company_keys(source), companies, "company_key", "canonical_name", "company_id",
        hot.companies,
    )
    location = D.resolve(
        D.location_keys(source), locations, "location_key", "location_normalized",
        "location_id", hot.locations,
    )
    ids = company.join(location, "id", "full_outer")
    return derived.drop("company_id", "location_id").join(ids, "id", "left").withColumn(
        "processing_status", F.lit("processed")
    )


@dataclass
class Enriched:
    """Results of enriching ``pending`` against the current dimension tables.

    ``tables``: companies, locations, skills, job_skills, translation_cache.  Each
    result is planned when first asked for, so asking for one does not number the
    rows of another.  Rows that break a posting rule fail and touch nothing else.
    """

    pending: DataFrame
    tables: dict[str, DataFrame]
    dictionary: Dictionary
    as_of: date
    at: datetime
    hot: Hot = field(default_factory=Hot)

    @cached_property
    def checked(self) -> DataFrame:
        return with_violations(self.pending, rules("job_postings"))

    @cached_property
    def good(self) -> DataFrame:
        return self.checked.where(F.size("violations") == 0).drop("violations")

    @cached_property
    def failed(self) -> DataFrame:
        """Rejected rows with status and ``error``."""
        return (
            self.checked.where(F.size("violations") > 0)
            .select(*self.pending.columns, F.array_join("violations", ", ").alias("error"))
            .withColumn("processing_status", F.lit("failed"))
        )

    @cached_property
    def derived(self) -> DataFrame:
        return derive(translate(self.good, self.tables["translation_cache"], self.hot), self.dictionary)

    @cached_property
    def mentions(self) -> DataFrame:
        return self.derived.select("id", F.explode("skills").alias("skill"))

    @cached_property
    def companies(self) -> DataFrame:
        return D.upsert_companies(self.tables["companies"], D.company_keys(self.good), self.as_of)

    @cached_property
    def locations(self) -> DataFrame:
        return D.upsert_locations(self.tables["locations"], D.location_keys(self.good))

    @cached_property
    def skills(self) -> DataFrame:
        if isinstance(self.dictionary, DataFrame):
            category = self.dictionary.select("skill", "category")
        else:
            category = skill_category(F.col("skill"), self.dictionary)
        return D.upsert_skills(self.tables["skills"], self.mentions, category, self.as_of)

    @cached_property
    def bridge(self) -> DataFrame:
        rows = D.bridge_rows(self.mentions, self.skills, self.hot.skills)
        return D.upsert_bridge(self.tables["job_skills"], rows)

    @cached_property
    def memory(self) -> DataFrame:
        uses = D.text_uses(self.good, ["title_persian", "description_persian"])
        return D.remember_translations(self.tables["translation_cache"], uses, self.at)

    @cached_property
    def postings(self) -> DataFrame:
        return link(self.derived, self.good, self.companies, self.locations, self.hot)

    @cached_property
    def counters(self) -> DataFrame:
        failed = self.failed.drop("error")
        return enrichment_counters(self.postings.unionByName(failed, allowMissingColumns=True))


def find_hot(batch: DataFrame) -> Hot:
    """Hot companies, locations and texts of a batch; only keys in bounded number come back."""
    keyed = D.company_keys(batch)
    places = D.location_keys(batch)
    texts = D.text_uses(batch, ["title_persian", "description_persian"])
    return Hot(
        companies=hot_keys(keyed, "company_key"),
        locations=hot_keys(places, "location_key"),
        texts=hot_keys(texts, "source_text_hash"),
    )


def run_enrichment(
    store: TableStore,
    dictionary: Iterable[SkillEntry] | DataFrame,
    as_of: date,
    at: datetime,
    batch_size: int | None = None,
    dry_run: bool = False,
    process_id: str = "processor",
) -> DataFrame:
    """Enrich the store's pending postings and write every table's next version.

    Stages are written to the store and read back instead of being recomputed:
    the checked rows, the row-local result, then each dimension before the rows
    that refer to it.  A dry run counts the pending rows and writes nothing.
    """
    pending = pending_batch(store.read("job_postings"), batch_size)
    if dry_run:
        return pending.agg(F.count("*").alias("pending_jobs_found"))
    names = ["companies", "locations", "skills", "job_skills", "translation_cache"]
    staging = f"{store.root}/_stage/enrich-{at:%Y%m%dT%H%M%S%f}"

    def staged(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{staging}/{name}")
        return store.spark.read.schema(df.schema).parquet(f"{staging}/{name}")

    def log(status: str, message: str, **more) -> None:
        row = log_event(store.spark, "processing", process_id, status, message, at, **more)
        store.append("processing_logs", row)

    job = Enriched(pending, {n: store.read(n) for n in names}, usable(dictionary), as_of, at)
    job.checked = staged(job.checked, "checked")
    log("started", f"Starting processor batch of {job.checked.count()} jobs")
    job.hot = find_hot(job.good)
    job.derived = staged(job.derived, "derived")
    job.hot = replace(job.hot, skills=hot_keys(job.mentions, "skill"))
    job.companies = store.replace("companies", job.companies)
    job.locations = store.replace("locations", job.locations)
    job.skills = store.replace("skills", job.skills)
    store.replace("job_skills", job.bridge)
    store.replace("translation_cache", job.memory)
    job.postings = staged(job.postings, "postings")

    postings = store.read("job_postings")
    rest = postings.join(job.checked.select("id"), "id", "left_anti")
    store.replace(
        "job_postings",
        rest.unionByName(job.postings.select(*postings.columns)).unionByName(
            job.failed.select(*postings.columns)
        ),
    )
    store.append("processing_logs", failure_log(job.failed.select("id", "error"), process_id, at))
    counters = staged(job.counters, "counters")
    row = counters.first()
    clean = row["failed"] == 0
    log(
        "completed" if clean else "warning",
        f"Processor batch finished with status={'completed' if clean else 'completed_with_errors'}",
        processed=row["processed"],
        failed=row["failed"],
        details=counters.toJSON().first(),
    )
    return counters
