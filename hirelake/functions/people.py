"""Gender and education rules of the three sites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.sources import values as V


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def gender_from_text(title: Column, description: Column) -> Column:
    """Site A: words in the title or description, female tested before male."""
    t = F.coalesce(title, F.lit(""))
    d = F.lower(F.coalesce(description, F.lit("")))
    female = F.lower(t).contains("(female)") | t.contains(V.FEMALE_WORDS[1]) | d.contains("female")
    male = F.lower(t).contains("(male)") | t.contains(V.MALE_WORDS[1]) | d.contains("male")
    return F.when(female, "female").when(male, "male").otherwise(V.UNKNOWN)


def gender_from_label(label: Column) -> Column:
    """Site B: the label must equal a known word."""
    return (
        F.when(label.isin("Woman", "female", *V.FEMALE_WORDS), "female")
        .when(label.isin("Man", "male", *V.MALE_WORDS), "male")
        .when(label == V.NOT_IMPORTANT, "any")
        .otherwise(V.NOT_SPECIFIED)
    )


def gender_from_phrase(label: Column) -> Column:
    """Site C: no-difference labels first, then words inside the phrase."""
    low = F.lower(label)
    female = _any([low.contains(w) for w in ("woman", "female", *V.FEMALE_WORDS)])
    male = _any([low.contains(w) for w in ("man", "male", *V.MALE_WORDS)])
    return (
        F.when(label.isin(*V.NO_DIFFERENCE), "any")
        .when(female, "female")
        .when(male, "male")
        .otherwise(V.NOT_SPECIFIED)
    )


def education_level(label: Column) -> Column:
    return F.when(label == V.NOT_IMPORTANT, "none").otherwise(
        F.coalesce(label, F.lit(V.UNKNOWN))
    )
