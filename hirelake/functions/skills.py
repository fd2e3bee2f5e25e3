"""Dictionary matching: which skills does a text mention?

A pattern matches as a raw substring of the lower-cased text.  The dictionary is
data (``skill, category, pattern`` rows).  Up to ``LITERAL_PATTERNS`` patterns it
travels inside the plan as an array literal, so matching is a projection with no
shuffle.  A larger one becomes an Aho-Corasick automaton that reads each text once,
whatever the number of patterns, in Arrow batches: no shuffle either.  It is broadcast,
so its size is checked: a dictionary beyond ``AUTOMATON_PATTERNS`` or
``AUTOMATON_CHARS`` meets the texts in an equi-join on the patterns' leading characters.
All forms give the same answer.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.text import let, string_items
from hirelake.sources import values as V

LITERAL_PATTERNS = 2_000
#: Bounds of a dictionary that is broadcast: rows and characters in all.
AUTOMATON_PATTERNS = 200_000
AUTOMATON_CHARS = 8_000_000
_GRAM = 3


@dataclass(frozen=True)
class SkillEntry:
    skill: str
    category: str | None
    patterns: tuple[str, ...]


def cleaned(entries: Iterable[SkillEntry]) -> list[SkillEntry]:
    """Entries as both forms of matching take them: one per skill, sorted.

    Patterns are lower-cased and distinct, null and empty ones say nothing; of several
    categories of a skill the smallest holds; a null skill is none.
    """
    patterns: dict[str, set[str]] = {}
    categories: dict[str, set[str]] = {}
    for e in entries:
        if e.skill is not None:
            patterns.setdefault(e.skill, set()).update(p.lower() for p in e.patterns if p)
            categories.setdefault(e.skill, set()).update([e.category] if e.category is not None else [])
    return [SkillEntry(s, min(categories[s], default=None), tuple(sorted(p))) for s, p in sorted(patterns.items())]


def dictionary_frame(spark: SparkSession, entries: Iterable[SkillEntry]) -> DataFrame:
    rows = [(e.skill, e.category, p) for e in entries for p in e.patterns]
    return spark.createDataFrame(rows, "skill string, category string, pattern string")


def load_dictionary(df: DataFrame, limit: int = LITERAL_PATTERNS) -> list[SkillEntry] | None:
    """Dictionary rows as entries, or None when there are more than ``limit``.

    At most ``limit + 1`` rows reach the driver.
    """
    rows = df.select("skill", "category", "pattern").take(limit + 1)
    if len(rows) > limit:
        return None
    return cleaned(SkillEntry(r.skill, r.category, (r.pattern,)) for r in rows)


def searchable(*texts: Column) -> Column:
    """Texts joined by a space, nulls as empty."""
    return F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts])


def _tail(items: Column, start: int) -> Column:
    return F.slice(items, F.lit(start), F.size(items))


def _inside(text: Column, pattern: Column, whole_words: bool) -> Column:
    if not whole_words:
        return text.contains(pattern)
    quoted = F.concat(F.lit(r"(?<![\p{L}\p{N}_])\Q"), pattern, F.lit(r"\E(?![\p{L}\p{N}_])"))
    return F.regexp_like(text, quoted)


def match_skills(
    text: Column, entries: Iterable[SkillEntry], whole_words: bool = False
) -> Column:
    """Sorted distinct skills whose patterns occur in ``text``.

    ``whole_words`` requires a non-word character (or the text's edge) on both
    sides of a hit; the default is plain substring.
    """
    entries = [e for e in cleaned(entries) if e.patterns]
    if not entries:
        return F.array().cast("array<string>")
    table = F.from_json(
        F.lit(json.dumps([[e.skill, *e.patterns] for e in entries])),
        "array<array<string>>",
    )

    def hits(t: Column) -> Column:
        kept = F.filter(
            table,
            lambda e: F.exists(_tail(e, 2), lambda p: _inside(t, p, whole_words)),
        )
        return F.array_sort(F.array_distinct(F.transform(kept, lambda e: F.get(e, F.lit(0)))))

    return F.coalesce(let(F.lower(text), hits), F.array().cast("array<string>"))


def union_skills(matched: Column, tags: Column) -> Column:
    """Matched skills plus pre-extracted tags, sorted and distinct.

    ``tags`` is an array of strings; null adds nothing, null items are dropped.
    """
    extra = F.coalesce(F.array_compact(tags), F.array().cast("array<string>"))
    return F.array_sort(F.array_union(matched, extra))


def union_json_tags(matched: Column, tags_json: Column) -> Column:
    return union_skills(matched, string_items(tags_json))


def skill_category(skill: Column, entries: Iterable[SkillEntry]) -> Column:
    pairs = [F.lit(x) for e in cleaned(entries) if e.category is not None for x in (e.skill, e.category)]
    if not pairs:
        return F.lit(V.DEFAULT_SKILL_CATEGORY)
    return F.coalesce(
        F.try_element_at(F.create_map(*pairs), skill), F.lit(V.DEFAULT_SKILL_CATEGORY)
    )


_BITS = 1 << 18


def _gram_bitmap(patterns: DataFrame) -> Column:
    """Bitmap over the hashes of the patterns' grams: 4096 words at most."""
    slot = F.pmod(F.xxhash64("gram"), F.lit(_BITS))
    words = (
        patterns.select(F.floor(slot / 64).alias("word"), (slot % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .collect()
    )
    filled = [0] * (_BITS // 64)
    for w in words:
        filled[w["word"]] = w["bits"]
    return F.from_json(F.lit(json.dumps(filled)), "array<bigint>")


def large_patterns(dictionary: DataFrame) -> DataFrame:
    """Distinct (skill, pattern) rows as the forms for large dictionaries take them."""
    return (
        dictionary.select("skill", F.lower("pattern").alias("pattern"))
        .where((F.col("pattern") != "") & F.col("skill").isNotNull())
        .distinct()
    )


def _word(char: str) -> bool:
    return char == "_" or unicodedata.category(char)[0] in "LN"


def _occurring(automaton, text: str, whole_words: bool) -> list[str]:
    """The sorted distinct skills of the patterns that occur in a text."""
    found: set[str] = set()
    for end, (length, skills) in automaton.iter(text):
        if whole_words:
            begin = end - length + 1
            if (begin and _word(text[begin - 1])) or (end + 1 < len(text) and _word(text[end + 1])):
                continue
        found.update(skills)
    # Spark sorts strings by their bytes, which is the order of code points.
    return sorted(found)


def matcher(
    dictionary: DataFrame, whole_words: bool = False, max_patterns: int = AUTOMATON_PATTERNS, max_chars: int = AUTOMATON_CHARS
) -> Callable[[Column], Column] | None:
    """The skills of a text column by an automaton over ``dictionary``, or None when the
    dictionary is beyond the bounds.

    All patterns are found in one pass over a text, overlapping ones too; a null text
    has no skills.  At most the bounds reach the driver and each executor.
    """
    rows = large_patterns(dictionary)
    size = rows.agg(F.count("*").alias("n"), F.sum(F.char_length("pattern") + F.char_length("skill")).alias("chars")).first()
    if size.n > max_patterns or (size.chars or 0) > max_chars:
        return None
    listed: dict[str, list[str]] = {}
    for r in rows.toLocalIterator():
        listed.setdefault(r.pattern, []).append(r.skill)
    shared = dictionary.sparkSession.sparkContext.broadcast(sorted(listed.items()))

    def match(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from ahocorasick import Automaton

        automaton = Automaton()
        for pattern, skills in shared.value:
            automaton.add_word(pattern, (len(pattern), skills))
        if shared.value:
            automaton.make_automaton()
        for part in texts:
            yield pd.Series([_occurring(automaton, t, whole_words) if t and shared.value else [] for t in part], dtype=object)

    # Annotations kept as text are not resolved for functions within functions.
    match.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(match, "array<string>")
    return lambda text: udf(F.lower(text))


def match_large(
    docs: DataFrame, key: str, text: str, dictionary: DataFrame, whole_words: bool = False, max_patterns: int = AUTOMATON_PATTERNS
) -> DataFrame:
    """``(key, skills)`` of each row for dictionaries too large for the plan.

    The result is that of ``match_skills`` with the same rows.
    """
    skills_of = matcher(dictionary, whole_words, max_patterns)
    if skills_of is None:
        return match_joined(docs, key, text, dictionary, whole_words)
    return docs.select(key, skills_of(F.col(text)).alias("skills"))


def match_joined(
    docs: DataFrame, key: str, text: str, dictionary: DataFrame, whole_words: bool = False
) -> DataFrame:
    """``(key, skills)`` for dictionaries too large to broadcast; ``key`` is unique.

    Each pattern is filed under its first characters (up to three).  A document
    contributes its distinct character grams once each, candidates meet in an
    equi-join, and only candidate patterns are tested against the text.  A bitmap
    of fixed size drops grams no pattern starts with before anything is shuffled;
    it may let others pass but loses none.  No pattern or document is dropped; the
    result is that of ``match_skills`` with the same rows.
    """
    patterns = large_patterns(dictionary).withColumn("gram", F.left("pattern", F.lit(_GRAM)))
    bitmap = _gram_bitmap(patterns)
    lengths = {
        r[0] for r in patterns.select(F.char_length("gram")).distinct().collect()
    }
    lowered = docs.select(F.col(key).alias("_key"), F.lower(text).alias("_text"))

    def listed(gram: Column) -> Column:
        slot = F.pmod(F.xxhash64(gram), F.lit(_BITS))
        return F.getbit(F.get(bitmap, F.floor(slot / 64).cast("int")), slot % 64) == 1

    if not lengths:
        empty = F.array().cast("array<string>")
        return docs.select(key, empty.alias("skills"))
    # The look-ahead yields the overlapping grams of every position in one pass.
    grams = [
        F.regexp_extract_all("_text", F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
        for n in sorted(lengths)
    ]
    found = F.filter(F.array_distinct(F.concat(*grams)), listed)
    exploded = lowered.select("_key", F.explode(found).alias("gram"))
    candidates = exploded.join(patterns, "gram").select("_key", "skill", "pattern")
    hits = (
        candidates.join(lowered, "_key")
        .where(_inside(F.col("_text"), F.col("pattern"), whole_words))
        .groupBy("_key")
        .agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    )
    empty = F.array().cast("array<string>")
    return (
        lowered.select("_key")
        .join(hits, "_key", "left")
        .select(F.col("_key").alias(key), F.coalesce("skills", empty).alias("skills"))
    )
