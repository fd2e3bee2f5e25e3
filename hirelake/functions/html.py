"""Reading elements out of HTML text with Column expressions.

Enough of a selector language for fixed page layouts: an opening tag with
classes or an attribute prefix, an element's text (nested elements of the same
tag included), elements after a heading, and list items under a heading.
Attribute values must be quoted.

Callers keep each intermediate result in its own projection: an expression that
is referenced twice in one projection may be evaluated twice.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import blank_to_null, let, strip

# Elements that cannot contain themselves: they end at their first closing tag.
_FLAT = {"a", "h1", "h2", "h3", "h4", "p", "title"}


def open_tag(
    tag: str, classes: Sequence[str] = (), attribute: tuple[str, str] | None = None
) -> str:
    """Regex of an opening tag carrying all ``classes`` and an attribute prefix."""
    wanted = "".join(
        rf"""(?=[^>]*\sclass\s*=\s*["'](?:[^"']*\s)?{re.escape(c)}(?:\s[^"']*)?["'])"""
        for c in classes
    )
    if attribute:
        name, start = attribute
        wanted += rf"""(?=[^>]*\s{re.escape(name)}\s*=\s*["']{re.escape(start)}[^"']*["'])"""
    return rf"<{tag}\b{wanted}[^>]*>"


def after(html: Column, opening: str) -> Column:
    """The first match of ``opening`` and all text behind it; null without a match."""
    return blank_to_null(F.regexp_extract(html, rf"(?is){opening}.*\z", 0))


def inner_html(found: Column, tag: str) -> Column:
    """The element whose opening tag starts ``found``, up to its closing tag.

    Counts opening and closing tags so that nested elements of the same tag stay
    inside.  An element that is never closed runs to the end of the text.
    """
    if tag in _FLAT:
        return F.regexp_extract(found, rf"(?is)^.*?(?=</{tag}\b|\z)", 0)
    pieces = F.split(found, rf"(?i)(?=</?{re.escape(tag)}\b)")

    def depth_after(state: Column, piece: Column) -> Column:
        closing = F.when(piece.startswith("</"), -1)
        step = closing.when(F.regexp_like(piece, F.lit(rf"(?i)^<{tag}\b")), 1).otherwise(0)
        return F.when(
            state["open"],
            F.struct(
                (state["depth"] + step).alias("depth"),
                (state["n"] + F.when(state["depth"] + step > 0, 1).otherwise(0)).alias("n"),
                (state["depth"] + step > 0).alias("open"),
            ),
        ).otherwise(state)

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def cut(ps: Column) -> Column:
        return F.array_join(F.slice(ps, F.lit(1), F.aggregate(ps, start, depth_after)["n"]), "")

    return let(pieces, cut)


def markup_text(inner: Column) -> Column:
    """Text with comments and tags removed; entities are left alone."""
    return F.regexp_replace(inner, r"(?s)<!--.*?-->|<[^>]*>", "")


#: Code points that a number from 128 to 159 stands for in HTML (fixed values).
_C1 = {
    0x80: 0x20AC, 0x82: 0x201A, 0x83: 0x0192, 0x84: 0x201E, 0x85: 0x2026, 0x86: 0x2020, 0x87: 0x2021,
    0x88: 0x02C6, 0x89: 0x2030, 0x8A: 0x0160, 0x8B: 0x2039, 0x8C: 0x0152, 0x8E: 0x017D, 0x91: 0x2018,
    0x92: 0x2019, 0x93: 0x201C, 0x94: 0x201D, 0x95: 0x2022, 0x96: 0x2013, 0x97: 0x2014, 0x98: 0x02DC,
    0x99: 0x2122, 0x9A: 0x0161, 0x9B: 0x203A, 0x9C: 0x0153, 0x9E: 0x017E, 0x9F: 0x0178,
}


def _character(digits: Column, base: int) -> Column:
    """The character of a reference's digits, of any count; what is none is U+FFFD.

    It is put together from UTF-8 bytes by arithmetic, so no number can fail.
    """
    most = 7 if base == 10 else 6
    bare = F.regexp_replace(digits, "^0+(?=.)", "")
    number = F.when(F.length(bare) > most, 0x110000).otherwise(
        (F.conv(F.left(bare, F.lit(most)), base, 10)).cast("bigint")
    )

    def encoded(given: Column) -> Column:
        known = F.try_element_at(F.create_map(*[F.lit(x).cast("bigint") for kv in _C1.items() for x in kv]), given)
        bad = (given == 0) | (given > 0x10FFFF) | given.between(0xD800, 0xDFFF)
        n = F.when(bad, F.lit(0xFFFD)).otherwise(F.coalesce(known, given)).cast("bigint")

        def utf8(n: Column) -> Column:
            def byte(mark: int, shift: int, mask: int) -> Column:
                return F.lpad(F.hex(F.lit(mark) + F.shiftright(n, shift).bitwiseAND(F.lit(mask).cast("bigint"))), 2, "0")

            tail = [byte(0x80, s, 0x3F) for s in (12, 6, 0)]
            text = (
                F.when(n < 0x80, byte(0, 0, 0x7F))
                .when(n < 0x800, F.concat(byte(0xC0, 6, 0x1F), tail[2]))
                .when(n < 0x10000, F.concat(byte(0xE0, 12, 0x0F), *tail[1:]))
                .otherwise(F.concat(byte(0xF0, 18, 0x07), *tail))
            )
            return F.unhex(text).cast("string")

        return let(n, utf8)

    return let(number, encoded)


def unescape(c: Column) -> Column:
    """Decode named and numeric character references, with or without their semicolon.

    Numbers beyond Unicode, zero and surrogates become U+FFFD; names without a
    semicolon are decoded where HTML knows them so, the longest first.
    """
    named = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    bare = "|".join(sorted((k for k in html5 if not k.endswith(";")), key=len, reverse=True))

    def reference(piece: Column) -> Column:
        # ``piece`` starts behind an ampersand.
        whole = F.regexp_extract(piece, r"^([a-zA-Z][a-zA-Z0-9]*;)", 1)
        name = F.when(F.try_element_at(named, whole).isNotNull(), whole).otherwise(F.regexp_extract(piece, f"^({bare})", 1))
        decimal = F.regexp_extract(piece, r"^#([0-9]+)", 1)
        hexadecimal = F.regexp_extract(piece, r"^#[xX]([0-9a-fA-F]+)", 1)
        rest = F.regexp_replace(piece, r"^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", "")
        return (
            F.when(decimal != "", F.concat(_character(decimal, 10), rest))
            .when(hexadecimal != "", F.concat(_character(hexadecimal, 16), rest))
            .when(name != "", F.concat(F.try_element_at(named, name), F.substr(piece, F.length(name) + 1)))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    def decode(pieces: Column) -> Column:
        later = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), reference)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(later, ""))

    return F.when(c.contains("&"), let(F.split(c, "&"), decode)).otherwise(c)


def clean(text: Column) -> Column:
    """The decoded and stripped text, null where the input is null."""
    return let(text, lambda t: strip(unescape(t)))


def clean_all(texts: Sequence[Column]) -> Column:
    """Decoded and stripped texts as an array, null where the input is null."""
    return F.transform(F.array(*texts), lambda t: strip(unescape(t)))


def element(html: Column, tag: str, classes: Sequence[str] = (),
            attribute: tuple[str, str] | None = None) -> Column:
    """Tagless text of the first matching element; null when there is none."""
    return markup_text(inner_html(after(html, open_tag(tag, classes, attribute)), tag))


def opening(html: Column, tag: str, classes: Sequence[str] = (),
            attribute: tuple[str, str] | None = None) -> Column:
    """The first matching opening tag itself."""
    return F.regexp_extract(html, f"(?is){open_tag(tag, classes, attribute)}", 0)


def attribute_of(tag_text: Column, name: str) -> Column:
    return blank_to_null(
        F.regexp_extract(tag_text, rf"""(?is)\s{re.escape(name)}\s*=\s*["']([^"']*)["']""", 1)
    )


def all_attributes(html: Column, name: str, tag: str, classes: Sequence[str] = (),
                   attribute: tuple[str, str] | None = None) -> Column:
    """Decoded attribute values of every matching tag, in page order."""
    tags = F.regexp_extract_all(
        html, F.lit(f"((?is){open_tag(tag, classes, attribute)})"), F.lit(1)
    )
    values = F.array_compact(F.transform(tags, lambda t: attribute_of(t, name)))
    return F.transform(values, unescape)


def sections(html: Column, start: str) -> Column:
    """The page cut in front of every match; what precedes the first is dropped."""
    parts = F.split(html, f"(?is)(?={start})")
    return F.filter(parts, lambda p: F.regexp_like(p, F.lit(f"(?is)^{start}")))


def blocks(html: Column, tag: str, classes: Sequence[str] = ()) -> Column:
    """Every matching element, in page order.

    A section ends where the next match starts; an element still open there
    contains that match, and is read from the rest of the page instead.
    """
    def whole(parts: Column) -> Column:
        def block(part: Column, i: Column) -> Column:
            left_open = F.regexp_count(part, F.lit(rf"(?i)<{tag}\b")) > F.regexp_count(
                part, F.lit(rf"(?i)</{tag}\b")
            )
            tail = F.array_join(F.slice(parts, i + 1, F.size(parts)), "")
            return inner_html(F.when(left_open, tail).otherwise(part), tag)

        return F.transform(parts, block)

    return let(sections(html, open_tag(tag, classes)), whole)


def headed(html: Column, tag: str) -> Column:
    """Every heading with what follows it: ``array<struct<head, rest>>``.

    ``rest`` ends in front of the next heading of the same tag.
    """
    end = rf"</{tag}\s*>"

    def split_head(part: Column) -> Column:
        return F.struct(
            markup_text(F.regexp_extract(part, rf"(?is)^.*?(?={end}|\z)", 0)).alias("head"),
            F.regexp_extract(part, rf"(?is){end}(.*)\z", 1).alias("rest"),
        )

    return F.transform(sections(html, rf"<{tag}\b[^>]*>"), split_head)


def under(heads: Column, heading: str) -> Column:
    """What follows the first heading whose text contains ``heading``."""
    return F.get(F.filter(heads, lambda h: h["head"].contains(heading)), F.lit(0))["rest"]


def sibling(rest: Column, tag: str, classes: Sequence[str] = ()) -> Column:
    """The element directly behind; null when another element follows."""
    lead = r"^(?:[^<]|<!--.*?-->)*+"
    found = F.regexp_extract(rest, rf"(?is){lead}({open_tag(tag, classes)}.*)\z", 1)
    return inner_html(blank_to_null(found), tag)
