"""Company, location and skill dimensions, the posting-skill bridge, translations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import canonical_company, location_key, strip, translation_key
from hirelake.operators.ids import assign_ids, next_id
from hirelake.operators.merge import add, insert_absent, keep, keyed_merge, larger, take
from hirelake.operators.skew import computed_once, lookup
from hirelake.sources import values as V
from hirelake.sources.tables import settled


def company_keys(postings: DataFrame) -> DataFrame:
    """``(id, company_key, raw)`` of postings that name a company."""
    named = postings.select("id", strip(F.col("company_name_raw")).alias("raw"))
    keyed = computed_once(named, company_key=canonical_company(F.col("raw")))
    return keyed.where(F.col("company_key").isNotNull())


def location_keys(postings: DataFrame) -> DataFrame:
    """``(id, location_key, raw)`` of postings that name a place."""
    named = postings.select("id", strip(F.col("location_raw")).alias("raw"))
    keyed = computed_once(named, location_key=location_key(F.col("raw")))
    return keyed.where(F.col("location_key").isNotNull())


def upsert_companies(companies: DataFrame, keys: DataFrame, as_of: date) -> DataFrame:
    """Company dimension after processing the postings behind ``keys``.

    A new company is named by its first posting; counters grow by its postings.
    """
    day = F.lit(as_of).cast("date")
    batch = keys.groupBy(F.col("company_key").alias("canonical_name")).agg(
        F.min(F.struct("id", "raw")).alias("first"),
        F.count("*").cast("int").alias("total_job_postings"),
    )
    batch = batch.select(
        "canonical_name",
        F.col("first.id").alias("_first_id"),
        F.col("first.raw").alias("display_name_persian"),
        "total_job_postings",
        F.col("total_job_postings").alias("active_job_postings"),
        day.alias("first_seen_date"),
        day.alias("last_activity_date"),
        F.lit(True).alias("is_active"),
    )
    rules = {
        "last_activity_date": take,
        "total_job_postings": add,
        "active_job_postings": add,
    }
    return _merge_dimension(companies, batch, "canonical_name", rules)


def upsert_locations(locations: DataFrame, keys: DataFrame) -> DataFrame:
    batch = (
        keys.groupBy(F.col("location_key").alias("location_normalized"))
        .agg(F.min(F.struct("id", "raw")).alias("first"))
        .select(
            "location_normalized",
            F.col("first.id").alias("_first_id"),
            F.col("first.raw").alias("city_persian"),
            F.lit("city").alias("location_type"),
        )
    )
    return _merge_dimension(locations, batch, "location_normalized", {})


def upsert_skills(
    skills: DataFrame, mentions: DataFrame, categories: DataFrame | Column, as_of: date
) -> DataFrame:
    """Skill dimension from ``mentions(id, skill)``.

    ``categories`` is a Column over ``skill`` or a dictionary DataFrame
    ``(skill, category)``; an unlisted skill is domain knowledge.
    """
    day = F.lit(as_of).cast("date")
    names = mentions.groupBy("skill").agg(F.min("id").alias("_first_id"))
    if isinstance(categories, DataFrame):
        table = categories.groupBy("skill").agg(F.min("category").alias("_category"))
        category = F.coalesce("_category", F.lit(V.DEFAULT_SKILL_CATEGORY))
        names = names.join(table, "skill", "left")
    else:
        category = categories
    batch = names.select(
        F.col("skill").alias("skill_name_english"),
        "_first_id",
        category.alias("skill_category"),
        day.alias("first_seen_date"),
        day.alias("last_seen_date"),
        F.lit(True).alias("is_active"),
    )
    return _merge_dimension(
        skills, batch, "skill_name_english", {"last_seen_date": take, "is_active": take}
    )


def _merge_dimension(table: DataFrame, batch: DataFrame, key: str, rules: dict) -> DataFrame:
    """Merge known keys, number the new ones by first posting, append them.

    The batch is one narrow row per key; it is computed once for both halves.
    """
    batch = settled(batch)
    plain = batch.drop("_first_id")
    updated = table
    if rules:
        known = plain.join(table.select(key), key, "left_semi")
        updated = keyed_merge(table, known, [key], {"id": keep, **rules})
    fresh = assign_ids(insert_absent(table, batch, [key]), "_first_id", key, next_id(table))
    given = set(fresh.columns)
    return updated.unionByName(
        fresh.select(
            *[
                (F.col(c) if c in given else F.lit(None)).cast(table.schema[c].dataType).alias(c)
                for c in table.columns
            ]
        )
    )


def resolve(
    keys: DataFrame, table: DataFrame, key: str, table_key: str, out: str, hot: Sequence | None = None
) -> DataFrame:
    """``(id, <out>)``: the dimension id behind each posting's key."""
    dim = table.select(F.col(table_key).alias(key), F.col("id").alias(out))
    return lookup(keys.select("id", key), dim, key, "id", hot, how="inner").select("id", out)


def bridge_rows(mentions: DataFrame, skills: DataFrame, hot: Sequence | None = None) -> DataFrame:
    """Posting-skill rows of ``mentions(id, skill)``, distinct per posting already."""
    dim = skills.select(
        F.col("skill_name_english").alias("skill"), F.col("id").alias("skill_id")
    )
    return lookup(mentions, dim, "skill", "id", hot, how="inner").select(
        F.col("id").alias("job_posting_id"),
        "skill_id",
        F.lit(V.BRIDGE_REQUIREMENT).alias("requirement_type"),
        F.lit(V.BRIDGE_PROFICIENCY).alias("proficiency_level"),
        F.lit(V.BRIDGE_CONFIDENCE).alias("confidence_score"),
        F.lit(V.BRIDGE_METHOD).alias("extraction_method"),
    )


def upsert_bridge(bridge: DataFrame, rows: DataFrame) -> DataFrame:
    return keyed_merge(bridge, rows, ["job_posting_id", "skill_id"], {"confidence_score": larger})


def text_uses(postings: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(id, field, source_text_hash, source_text)`` of non-blank texts."""
    fields = F.array(
        *[
            F.struct(F.lit(c).alias("field"), strip(F.col(c)).alias("source_text"))
            for c in columns
        ]
    )
    uses = postings.select("id", F.explode(fields).alias("u")).select("id", "u.*")
    filled = uses.where(F.col("source_text") != "")
    return computed_once(filled, source_text_hash=translation_key(F.col("source_text")))


def remember_translations(memory: DataFrame, uses: DataFrame, as_of: datetime) -> DataFrame:
    """Translation memory after looking up every use.

    A text the memory lacks is stored as its own translation (the service is not
    called); a known one keeps its translation.  Uses are counted per hash, without
    their texts, with map-side combine; a text is fetched only where it is new, from
    the first posting that uses it.
    """
    counts = uses.groupBy("source_text_hash").agg(
        F.count("*").cast("int").alias("_uses"), F.min(F.struct("id", "field")).alias("_first")
    )
    stamp = F.lit(as_of).cast("timestamp_ntz")
    used = F.col("_uses").isNotNull()
    changed = {
        # Only a null translation is replaced, by the text; an empty one stays stored.
        "translated_text": F.when(used, F.coalesce("translated_text", "source_text")).otherwise(F.col("translated_text")),
        "last_used_at": F.when(used, stamp).otherwise(F.col("last_used_at")),
        "usage_count": F.when(used, F.coalesce("usage_count", F.lit(0)) + F.col("_uses")).otherwise(F.col("usage_count")),
    }
    kinds = {f.name: f.dataType for f in memory.schema.fields}
    known = memory.join(counts.drop("_first"), "source_text_hash", "left").select(
        *[changed.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in memory.columns]
    )
    new = counts.join(memory.select("source_text_hash"), "source_text_hash", "left_anti")
    texts = uses.join(
        new.select("source_text_hash", "_uses", "_first.id", "_first.field"), ["source_text_hash", "id", "field"]
    )
    given = {
        "source_text_hash": F.col("source_text_hash"),
        "source_text": F.col("source_text"),
        "source_language": F.lit("fa"),
        "target_language": F.lit("en"),
        "translated_text": F.col("source_text"),
        "translation_service": F.lit(V.TRANSLATION_SERVICE),
        "translation_confidence": F.lit(V.TRANSLATION_CONFIDENCE),
        "last_used_at": stamp,
        "usage_count": F.col("_uses"),
    }
    fresh = texts.select(*[given.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in memory.columns])
    return known.unionByName(fresh)


def known_translations(memory: DataFrame, uses: DataFrame, hot: Sequence | None = None) -> DataFrame:
    """``(id, field, translated_text)`` for uses the memory can answer.

    Only keys travel to the join; the texts stay where they are.
    """
    answers = memory.where(F.coalesce("translated_text", F.lit("")) != "").select(
        "source_text_hash", "translated_text"
    )
    keys = uses.select("id", "field", "source_text_hash")
    return lookup(keys, answers, "source_text_hash", "id", hot, how="inner").select(
        "id", "field", "translated_text"
    )


def translated(postings: DataFrame, hits: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add translated columns (``columns``: source -> target), source text on a miss."""
    wide = hits.groupBy("id").agg(
        *[
            F.max(F.when(F.col("field") == src, F.col("translated_text"))).alias(f"_{src}")
            for src in columns
        ]
    )
    joined = postings.join(wide, "id", "left")
    for src, target in columns.items():
        own = F.nullif(strip(F.col(src)), F.lit(""))
        joined = joined.withColumn(target, F.coalesce(f"_{src}", own))
    return joined.drop(*[f"_{src}" for src in columns])
