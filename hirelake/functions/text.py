"""Text, number and label normalisation as codegen-friendly Column expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.sources import values as V

# Unicode whitespace; Java's \s alone is ASCII only.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_NOT_WORD = r"[^\p{L}\p{N}_\-\s\x1c-\x1f\x85\p{Z}]+"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a bound variable.

    Without the binding the optimiser may inline an expensive expression at each
    of its uses, and inside a lambda that means once per array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# The same characters one by one, for trimming without a regex.
_SPACE_CHARS = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE_CHARS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize(c: Column) -> Column:
    """Lower, strip, collapse whitespace, delete punctuation, strip.

    Deletion comes after collapsing, so ``a & b`` keeps two spaces.
    """
    collapsed = F.regexp_replace(strip(F.lower(c)), f"{SPACE}+", " ")
    return strip(F.regexp_replace(collapsed, _NOT_WORD, ""))


def canonical_company(c: Column) -> Column:
    """Normalised name without the company word; null when nothing is left."""
    return blank_to_null(strip(F.replace(normalize(c), F.lit(V.COMPANY_WORD), F.lit(""))))


def location_key(c: Column) -> Column:
    return blank_to_null(normalize(c))


def normalized_title(translated: Column, original: Column) -> Column:
    return blank_to_null(normalize(F.coalesce(blank_to_null(translated), original)))


def _decimal_digits() -> tuple[str, str]:
    """All non-ASCII decimal digits and their ASCII values, by Unicode category."""
    digits = [
        chr(i)
        for i in range(128, sys.maxunicode + 1)
        if unicodedata.category(chr(i)) == "Nd"
    ]
    return "".join(digits), "".join(str(unicodedata.digit(d)) for d in digits)


_DIGITS, _ASCII_DIGITS = _decimal_digits()


def ascii_digits(c: Column) -> Column:
    return F.translate(c, _DIGITS, _ASCII_DIGITS)


_UNITS = "|".join(V.SALARY_UNITS)
_AMOUNT = r"[\p{Nd},]"
SALARY_RANGE = (
    f"(?:{V.SALARY_FROM}{SPACE}*)?({_AMOUNT}+){SPACE}*{V.SALARY_TO}{SPACE}*"
    f"({_AMOUNT}+){SPACE}*(?:{_UNITS})"
)
SALARY_SINGLE = f"({_AMOUNT}{{5,}}){SPACE}*(?:{_UNITS})"


def _amount(c: Column) -> Column:
    return ascii_digits(F.replace(c, F.lit(","), F.lit(""))).try_cast("double")


def salary(existing_min: Column, text: Column) -> Column:
    """``struct(min, max)`` of the first salary phrase, nulls when there is none.

    Only texts naming a currency reach the regexes, and digits are converted on
    the matched number instead of the whole text.
    """
    low = _amount(F.regexp_extract(text, SALARY_RANGE, 1))
    high = _amount(F.regexp_extract(text, SALARY_RANGE, 2))
    single = _amount(F.regexp_extract(text, SALARY_SINGLE, 1))
    names_unit = text.contains(V.SALARY_UNITS[0]) | text.contains(V.SALARY_UNITS[1])
    is_range = low.isNotNull() & high.isNotNull()
    parsed = F.when(is_range, F.struct(low.alias("min"), high.alias("max"))).otherwise(
        F.struct(single.alias("min"), F.lit(None).cast("double").alias("max"))
    )
    nothing = F.struct(
        F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max")
    )
    return F.when(existing_min.isNull() & names_unit, parsed).otherwise(nothing)


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def byte_size(c: Column) -> Column:
    return F.coalesce(F.octet_length(c), F.lit(0))


def translation_key(c: Column) -> Column:
    return F.sha2(F.concat(F.lit(V.TRANSLATION_PREFIX), strip(c)), 256)


def label_token(c: Column) -> Column:
    """Scraped label to token form; null becomes ``unknown``."""
    token = F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_"))
    return F.coalesce(token, F.lit(V.UNKNOWN))


def keyword_list(c: Column, default: list[str]) -> Column:
    """Comma list to trimmed non-empty items; blank input gives ``default``."""
    fallback = F.array(*[F.lit(k) for k in default]).cast("array<string>")
    items = F.filter(F.transform(F.split(c, ","), strip), lambda k: k != "")
    return F.when(strip(F.coalesce(c, F.lit(""))) == "", fallback).otherwise(items)


def on_topic(text: Column, keywords: list[str]) -> Column:
    words = F.array(*[F.lit(k.lower()) for k in keywords])
    return let(F.lower(text), lambda t: F.exists(words, lambda k: t.contains(k)))


def json_list(c: Column) -> Column:
    """List to JSON text; an empty list is stored as null."""
    return F.when(F.size(c) > 0, F.to_json(c))


def string_items(c: Column) -> Column:
    """JSON list text to its string items.

    Other item types are dropped; malformed or non-list text gives null.
    """
    items = F.from_json(c, "array<variant>", {"mode": "PERMISSIVE"})
    texts = F.filter(items, lambda v: F.schema_of_variant(v) == "STRING")
    return F.transform(texts, lambda v: F.variant_get(v, "$", "string"))


def first_filled(*cs: Column, default: str) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cs], F.lit(default))


def display_date(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "MMM dd, yyyy"), F.lit(V.EMPTY_LABEL))


def error_text(c: Column) -> Column:
    return F.left(c, F.lit(V.ERROR_TEXT_LIMIT))
