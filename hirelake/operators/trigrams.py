"""Trigram index for text searches with ``ilike``.

The index has a row ``(field, gram, id)`` for each distinct three characters of a lower-cased
text.  Whatever matches a pattern holds every trigram of the pattern's literal parts, so
postings with all of them are candidates and only these are compared.  Patterns whose
literal parts have less than three characters can't be looked up: they scan.

The table is bucketed by the posting's id, so no bucket grows with a frequent trigram and
a change of postings rewrites their buckets only; in a file entries are ordered by trigram, field
and id, so a lookup reads the few pages of a file that hold its trigrams.  Ids are stored
as differences, and those of a block of ``1 << BLOCK_BITS`` ids share a bucket, so differences
are short where ids are given one after another; other ids are blocks of their own.

What is shuffled are texts, not their trigrams: tasks get the texts of some postings of a
bucket, so many that the trigrams are sorted in memory, and write a file each.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.plans.reports import TEXT_COLUMNS, Search, search_postings
from hirelake.sources.buckets import BucketTable
from hirelake.sources.tables import settled

INDEX = T.StructType().add("field", "string").add("gram", "string").add("id", "long")
FIELDS = [*TEXT_COLUMNS, "company_name_raw", "location_raw"]
#: Of a pattern's trigrams, so many of the rarest are looked up.
LOOKED_UP = 3


BLOCK_BITS = 12
#: Characters of texts that a task cuts into trigrams and sorts, some 100 bytes for each.
TASK_CHARS = 2_500_000
#: Differences of neighbouring ids are short, while dictionaries of ids and plain ids aren't.
STORED = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#id": "false", "compression": "zstd"}


def _numbered(postings: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``index_rows`` with a field's number in ``fields`` for its name."""
    # Joining characters takes linear time, cutting substrings out of UTF-8 wouldn't.
    chars = F.filter(F.split(F.lower(F.col("text")), ""), lambda c: c != "")
    last = F.size("chars") - 2
    grams = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.concat(F.get("chars", i - 1), F.get("chars", i), F.get("chars", i + 1)),
    )
    texts = F.array(*[F.struct(F.lit(i).alias("field"), F.col(c).cast("string").alias("text")) for i, c in enumerate(fields)])
    return (
        postings.select("id", F.explode(texts).alias("t"))
        .select("id", "t.*")
        .where(F.length("text") >= 3)
        .select("id", "field", chars.alias("chars"))
        .where(F.size("chars") >= 3)
        .where(F.col("id").isNotNull())
        .select("field", F.explode(F.array_distinct(grams)).alias("gram"), F.col("id").cast("long").alias("id"))
    )


def _named(entries: DataFrame, fields: Sequence[str]) -> DataFrame:
    return entries.select(F.get(F.array(*map(F.lit, fields)), "field").alias("field"), "gram", "id")


def index_rows(postings: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """``(field, gram, id)`` of each text; null and shorter texts and rows without an id have none.

    Row-local, each once for a text.
    """
    return _named(_numbered(postings, fields), fields)


class TrigramIndex:
    """The index as a bucketed table under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.block = F.shiftright("id", BLOCK_BITS)
        self.table = BucketTable(spark, path, INDEX, [self.block], buckets, sort=["gram", "field", "id"], options=STORED)

    def update(self, postings: DataFrame) -> None:
        """Put the entries of new or changed postings in place of those they had."""
        ids = postings.select(F.col("id").cast("long").alias("id")).where("id is not null").distinct()
        # Ids of the index, so mostly one row for each posting after tasks have combined their entries.
        known = settled(self.table.read().select("id").distinct().join(ids.hint("shuffle_hash"), "id", "left_semi"))
        if known.isEmpty():
            self.table.add(self._sorted(postings))
        else:
            # A text's trigrams are distinct; lookups count those of repeated ids once.
            fresh = index_rows(postings)
            self.table.merge(ids, lambda old, _: old.join(known, "id", "left_anti").unionByName(fresh))

    def _sorted(self, postings: DataFrame) -> DataFrame:
        """The entries, dealt by parts of the table's buckets and sorted in each."""
        texts = postings.select(F.col("id").cast("long").alias("id"), *FIELDS).where("id is not null")
        chars = texts.agg(F.sum(reduce(lambda a, b: a + b, [F.coalesce(F.length(c), F.lit(0)) for c in FIELDS]))).first()[0] or 0
        # A multiple of the buckets, so each part lies in one of them.
        parts = self.table.buckets * -(-max(1, chars) // (TASK_CHARS * self.table.buckets))
        dealt = texts.repartitionById(parts, F.pmod(F.xxhash64(self.block), F.lit(parts)).cast("int"))
        return _named(_numbered(dealt, FIELDS).sortWithinPartitions("gram", "field", "id"), FIELDS)

    def read(self, grams: Sequence[str], fields: Sequence[str]) -> DataFrame:
        """The entries of some trigrams in some fields."""
        return self.table.read().where(F.col("gram").isin(list(grams)) & F.col("field").isin(list(fields)))


def pattern_grams(spark: SparkSession, text: str) -> list[str]:
    """Distinct trigrams of the literal parts of ``%text%``; a backslash quotes what follows.

    The pattern is lower-cased by Spark and as a whole, as ``ilike`` does it.
    """
    pattern = spark.range(1).select(F.lower(F.lit(f"%{text}%"))).first()[0]
    parts, quoted = [""], False
    for ch in pattern:
        if quoted or ch not in "%_\\":
            parts[-1] += ch
            quoted = False
        elif ch == "\\":
            quoted = True
        else:
            parts.append("")
    return sorted({p[i : i + 3] for p in parts for i in range(len(p) - 2)})


def candidates(index: TrigramIndex, text: str, fields: Sequence[str]) -> DataFrame | None:
    """``(id)``, distinct: postings one of whose ``fields`` may match; None if it takes a scan.

    The rarest of the pattern's grams are looked up, ``LOOKED_UP`` of them; how often
    each occurs is counted first, and one number for each gram comes to the driver.
    """
    grams = pattern_grams(index.table.spark, text)
    if not grams:
        return None
    counted = index.read(grams, fields).groupBy("gram").count().collect()
    seen = {r["gram"]: r["count"] for r in counted}
    rarest = sorted(grams, key=lambda g: (seen.get(g, 0), g))[:LOOKED_UP]
    # A bit for each field and gram; a posting's entries lie in one file, so tasks combine them
    # and one row for each posting is shuffled.
    bit = F.lit(0)
    for i, (field, gram) in enumerate(product(fields, rarest)):
        bit = F.when((F.col("field") == field) & (F.col("gram") == gram), 1 << i).otherwise(bit)
    whole = (1 << len(rarest)) - 1
    matched = [F.col("bits").bitwiseAND(F.lit(whole << (len(rarest) * i))) == F.lit(whole << (len(rarest) * i)) for i in range(len(fields))]
    return (
        index.read(rarest, fields)
        .groupBy("id")
        .agg(F.bit_or(bit).alias("bits"))
        .where(reduce(lambda a, b: a | b, matched))
        .select("id")
    )


def search_indexed(postings: DataFrame, index: TrigramIndex, search: Search, as_of: date) -> DataFrame:
    """``reports.search_postings`` over the candidates of all text filters.

    The result is the same as long as the index holds the postings' own trigrams; postings
    without an id aren't in it, so they are compared in any case.
    """
    asked = [(search.text, TEXT_COLUMNS), (search.company, ["company_name_raw"]), (search.location, ["location_raw"])]
    found = [candidates(index, text, fields) for text, fields in asked if text.strip()]
    narrow = [ids for ids in found if ids is not None]
    if narrow:
        ids = reduce(lambda a, b: a.join(b, "id", "left_semi"), narrow)
        unnamed = postings.where("id is null")
        postings = postings.join(ids, "id", "left_semi").select(*postings.columns).unionByName(unnamed)
    return search_postings(postings, search, as_of)
