"""Ordered label lookup: exact key, else the first listed token inside the key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import let, strip
from hirelake.sources import values as V


def match_label(raw: Column, table: Mapping[str, Sequence[str]]) -> Column:
    """Canonical value of ``raw`` under ``table`` (canonical -> tokens, in order)."""
    pairs = [(token, name) for name, tokens in table.items() for token in tokens]
    exact = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    ordered = F.array(
        *[F.struct(F.lit(t).alias("token"), F.lit(n).alias("name")) for t, n in pairs]
    )

    def lookup(key: Column) -> Column:
        inside = F.filter(ordered, lambda e: key.contains(e["token"]))
        return F.coalesce(
            F.try_element_at(exact, key), F.get(inside, F.lit(0))["name"], F.lit(V.UNKNOWN)
        )

    skip = raw.isNull() | F.lower(raw).isin("", V.UNKNOWN)
    return F.when(skip, F.lit(V.UNKNOWN)).otherwise(let(F.lower(strip(raw)), lookup))


def employment_type(raw: Column) -> Column:
    return match_label(raw, V.EMPLOYMENT_LABELS)


def experience_level(raw: Column) -> Column:
    return match_label(raw, V.EXPERIENCE_LABELS)


def known_or_kept(canonical: Column, raw: Column) -> Column:
    """The canonical value, or the stored raw one when nothing matched."""
    return F.when(canonical != V.UNKNOWN, canonical).otherwise(raw)


def site_label(site: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for kv in V.SITE_LABELS.items() for x in kv])
    return F.coalesce(F.try_element_at(labels, site), site)
