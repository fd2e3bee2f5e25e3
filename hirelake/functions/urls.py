"""URL handling as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import blank_to_null, let


def last_segment(url: Column) -> Column:
    """Text after the last slash (query string kept); null without a slash."""
    return F.when(url.contains("/"), F.substring_index(url, "/", -1))


def encode(c: Column) -> Column:
    """Form encoding: ``~`` stays, ``*`` is escaped, space becomes ``+``."""
    plain = F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A"))
    return F.replace(plain, F.lit("%7E"), F.lit("~"))


def decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def set_page(url: Column, page: Column) -> Column:
    """Set the ``page`` query parameter; path and fragment are kept.

    A repeated parameter keeps its first position and its last value.
    """
    head = F.substring_index(url, "#", 1)
    fragment = F.regexp_extract(url, r"(?s)#(.*)$", 1)
    base = F.substring_index(head, "?", 1)
    query = F.regexp_extract(head, r"(?s)\?(.*)$", 1)
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            decode(F.substring_index(p, "=", 1)).alias("k"),
            decode(F.regexp_extract(p, r"(?s)=(.*)$", 1)).alias("v"),
        ),
    )

    def rebuild(ps: Column) -> Column:
        keys = F.array_distinct(
            F.concat(F.transform(ps, lambda p: p["k"]), F.array(F.lit("page")))
        )

        def render(k: Column) -> Column:
            last = F.element_at(F.filter(ps, lambda p: p["k"] == k), -1)["v"]
            value = F.when(k == "page", page.cast("string")).otherwise(last)
            return F.concat(encode(k), F.lit("="), encode(value))

        return F.array_join(F.transform(keys, render), "&")

    tail = F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise("")
    return F.concat(base, F.lit("?"), let(pairs, rebuild), tail)


def prefix(base: str, href: Column) -> Column:
    """``http...`` links stay; others get the base in front, as is."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def join_root(base: str, href: Column) -> Column:
    """Resolve a root-relative or absolute link against the base's origin."""
    scheme, rest = base.split("://", 1)
    origin = f"{scheme}://{rest.split('/', 1)[0]}"
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(f"{scheme}:"), href))
        .when(href.startswith("/"), F.concat(F.lit(origin), href))
        .otherwise(F.concat(F.lit(f"{origin}/"), href))
    )


def search_url(base: Column, keyword: Column, language: str | None = None) -> Column:
    """Search page of a keyword; without a keyword only the language is set."""
    lang = f"language={language}" if language else ""
    word = blank_to_null(keyword)
    with_word = F.concat(F.lit(f"{lang}&" if lang else ""), F.lit("keyword="), encode(word))
    query = F.coalesce(with_word, F.lit(lang))
    return F.when(query == "", base).otherwise(F.concat(base, F.lit("?"), query))
