"""Pages to links and postings, by a rule set per site.

Everything is a projection over the page table: no shuffle, no Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import html as H
from hirelake.functions.people import (
    education_level,
    gender_from_label,
    gender_from_phrase,
    gender_from_text,
)
from hirelake.functions.text import label_token, let, strip
from hirelake.functions.urls import join_root, last_segment, prefix
from hirelake.operators.skew import computed_once
from hirelake.sources import values as V


@dataclass(frozen=True)
class SiteHeadings:
    """Heading texts the rules look for, in the language the pages are kept in."""

    location: str = "Location"
    cooperation: str = "Type of cooperation"
    experience: str = "Minimum work experience"
    education: str = "Minimum educational qualification"
    skills: str = "Required skills"
    gender: str = "Gender"
    description_b: str = "Job description"
    description_c: str = "Job description and duties"
    seniority: str = "Seniority"


HEADINGS = SiteHeadings()


def is_challenge(html: Column, markers: Sequence[str] = V.CHALLENGE_MARKERS) -> Column:
    return reduce(lambda a, b: a | b, [html.contains(m) for m in markers])


def has_no_results(site: Column, html: Column, texts: Mapping[str, str] = V.NO_RESULT_TEXT) -> Column:
    """Site rules for an empty result page.

    Sites A and B show a sentence.  Site C shows it inside an empty-state block;
    without that block a page is empty when it has no posting link.
    """
    link = F.lit(f"(?is){H.open_tag('a', attribute=('href', '/jobs/'))}")
    site_c = let(
        H.element(html, "app-empty-state", ["ng-star-inserted"]),
        lambda state: F.when(state.isNotNull(), state.contains(texts["jobvision"])).otherwise(
            ~F.regexp_like(html, link)
        ),
    )
    return (
        F.when(site == "irantalent", html.contains(texts["irantalent"]))
        .when(site == "jobinja", html.contains(texts["jobinja"]))
        .when(site == "jobvision", site_c)
        .otherwise(False)
    )


def _links_a(html: Column) -> Column:
    hrefs = F.flatten(
        F.transform(
            H.blocks(html, "new-position-card"),
            lambda c: H.all_attributes(c, "href", "a", attribute=("href", "/en/job/")),
        )
    )
    return F.transform(hrefs, lambda h: F.concat(F.lit(V.SITE_BASE_URLS["irantalent"]), h))


def _links_b(html: Column) -> Column:
    hrefs = H.all_attributes(html, "href", "a", ["c-jobListView__titleLink"])
    return F.transform(hrefs, lambda h: prefix(V.SITE_BASE_URLS["jobinja"], h))


def _links_c(html: Column) -> Column:
    hrefs = H.all_attributes(html, "href", "a", attribute=("href", "/jobs/"))
    return F.array_distinct(
        F.transform(hrefs, lambda h: join_root(V.SITE_BASE_URLS["jobvision"], h))
    )


def listing_links(pages: DataFrame) -> DataFrame:
    """``(id, source_site, source_url, position, job_url)`` of listing pages."""
    site, html = F.col("source_site"), F.col("raw_html")
    links = (
        F.when(site == "irantalent", _links_a(html))
        .when(site == "jobinja", _links_b(html))
        .when(site == "jobvision", _links_c(html))
    )
    return pages.select(
        "id", "source_site", "source_url", F.posexplode(links).alias("position", "job_url")
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Every quoted link target of any page, in page order."""
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    return pages.select("page_id", F.posexplode(hrefs).alias("position", "href"))


@dataclass(frozen=True)
class SiteRules:
    """How one site's detail page becomes a posting, in three projections.

    ``parts`` cuts the page into reusable pieces, ``texts`` reads one text per
    field from page and pieces, ``fields`` derives posting columns from the
    cleaned texts.  Each step sees the columns of the one before.
    """

    parts: Callable[[SiteHeadings], dict[str, Column]]
    texts: Callable[[SiteHeadings], dict[str, Column]]
    fields: Callable[[], dict[str, Column]]


def _first(found: Column) -> Column:
    return F.get(F.array_compact(found), F.lit(0))


def _a_parts(heads: SiteHeadings) -> dict[str, Column]:
    html = F.col("raw_html")
    return {
        "p_blocks": H.blocks(html, "div", ["margin-y-8"]),
        "p_company": H.opening(html, "a", attribute=("href", "/en/company/")),
    }


def _a_texts(heads: SiteHeadings) -> dict[str, Column]:
    html, parts = F.col("raw_html"), F.col("p_blocks")

    def lists(block: Column) -> Column:
        return H.inner_html(H.after(block, r"<ul\b[^>]*>"), "ul")

    def level(block: Column) -> Column:
        rest = H.under(H.headed(block, "p"), heads.seniority)
        return H.element(H.sibling(rest, "ul"), "a")

    return {
        "title": H.element(
            html, "h1", ["margin-bottom-8", "font-20", "inline-middle", "font-weight-500"]
        ),
        "company": H.element(html, "a", attribute=("href", "/en/company/")),
        "company_url": H.attribute_of(F.col("p_company"), "href"),
        "location": H.element(html, "span", ["color-gray"]),
        "description": H.element(
            html, "p",
            ["description", "margin-top-12", "margin-bottom-8", "pre-wrap", "text-start"],
        ),
        "employment": _first(
            F.transform(parts, lambda b: H.element(lists(b), "li", ["description"]))
        ),
        "experience": _first(F.transform(parts, level)),
    }


def _a_fields() -> dict[str, Column]:
    return {
        "company_url": F.concat(F.lit(V.SITE_BASE_URLS["irantalent"]), F.col("company_url")),
        "employment_type": label_token(F.col("employment")),
        "experience_level": label_token(F.col("experience")),
        "gender_requirement": gender_from_text(F.col("title"), F.col("description")),
    }


_ANY_TAGS = r"""<\w+\b(?=[^>]*\sclass\s*=\s*["'](?:[^"']*\s)?tags(?:\s[^"']*)?["'])[^>]*>"""


def _b_parts(heads: SiteHeadings) -> dict[str, Column]:
    html = F.col("raw_html")

    def box(item: Column) -> Column:
        """Headings of a list item and the texts of its tags."""
        return F.struct(
            F.transform(H.headed(item, "h4"), lambda h: h["head"]).alias("heads"),
            F.transform(
                H.blocks(H.after(item, _ANY_TAGS), "span", ["black"]), H.markup_text
            ).alias("tags"),
        )

    return {
        "p_boxes": F.transform(H.blocks(html, "li", ["c-infoBox__item"]), box),
        "p_title": H.inner_html(H.after(html, H.open_tag("div", ["c-jobView__titleText"])), "div"),
        "p_logo": H.opening(html, "a", ["c-companyHeader__logoLink"]),
        "p_heads": H.headed(html, "h4"),
    }


def _b_tags(heading: str) -> Column:
    named = F.filter(
        "p_boxes", lambda b: F.exists(b["heads"], lambda h: h.contains(heading))
    )
    return F.get(named, F.lit(0))["tags"]


def _b_texts(heads: SiteHeadings) -> dict[str, Column]:
    html = F.col("raw_html")

    def first(heading: str) -> Column:
        return F.get(_b_tags(heading), F.lit(0))

    return {
        "title": H.element(F.col("p_title"), "h1"),
        "company": H.element(html, "h2", ["c-companyHeader__name"]),
        "company_url": H.attribute_of(F.col("p_logo"), "href"),
        "location": first(heads.location),
        "description": H.markup_text(
            H.sibling(H.under(F.col("p_heads"), heads.description_b), "div", ["o-box__text"])
        ),
        "employment": first(heads.cooperation),
        "experience": first(heads.experience),
        "education": first(heads.education),
        "gender": first(heads.gender),
    }


def _b_fields() -> dict[str, Column]:
    return {
        "employment_type": label_token(F.col("employment")),
        "experience_level": label_token(F.col("experience")),
        "education_level": education_level(F.col("education")),
        "gender_requirement": gender_from_label(F.col("gender")),
    }


_COMPANY_C = ("text-primary", "font-size-2", "font-weight-bold", "yn_brand")


def _c_parts(heads: SiteHeadings) -> dict[str, Column]:
    html = F.col("raw_html")
    return {
        "p_company": H.opening(html, "a", _COMPANY_C),
        "p_heads": H.headed(html, "h2"),
    }


def _c_texts(heads: SiteHeadings) -> dict[str, Column]:
    html = F.col("raw_html")
    return {
        "title": H.element(html, "h1", ["text-black", "font-size-1", "font-weight-bold", "py-2"]),
        "company": H.element(html, "a", _COMPANY_C),
        "company_url": H.attribute_of(F.col("p_company"), "href"),
        "location": H.element(html, "span", ["text-muted", "font-size-6"]),
        "description": H.markup_text(
            H.sibling(H.under(F.col("p_heads"), heads.description_c), "div")
        ),
        "gender": H.element(html, "div", ["requirement-value", "text-black", "bg-light"]),
    }


def _c_fields() -> dict[str, Column]:
    href = F.col("company_url")
    base = F.lit(V.SITE_BASE_URLS["jobvision"])
    return {
        "company_url": F.when(href.startswith("/"), F.concat(base, href)).otherwise(href),
        "gender_requirement": gender_from_phrase(F.col("gender")),
    }


RULES = {
    "irantalent": SiteRules(_a_parts, _a_texts, _a_fields),
    "jobinja": SiteRules(_b_parts, _b_texts, _b_fields),
    "jobvision": SiteRules(_c_parts, _c_texts, _c_fields),
}


def readable() -> Column:
    """Whether a detail page is worth reading: served correctly and not a challenge page.

    Site B is judged by its text alone, the others by the response status.
    """
    served = F.when(F.col("source_site") == "jobinja", ~is_challenge(F.col("raw_html"))).otherwise(
        F.col("response_status") == 200
    )
    return F.coalesce(served, F.lit(False))


def readable_pages(pages: DataFrame) -> DataFrame:
    return pages.where(readable())


def extract_site(
    pages: DataFrame, site: str, as_of: date, headings: SiteHeadings = HEADINGS
) -> DataFrame:
    """Posting rows of one site's detail pages."""
    rule = RULES[site]
    texts = rule.texts(headings)
    keep = ["id", "source_site", "source_url"]
    skills = _b_tags(headings.skills) if site == "jobinja" else F.lit(None).cast("array<string>")
    cut = pages.where(F.col("source_site") == site).withColumns(rule.parts(headings))
    # The link stands by itself, so a query of links only doesn't read the other texts.
    link = texts.pop("company_url")
    read = cut.select(*keep, H.clean_all(list(texts.values())).alias("t"), H.clean(link).alias("company_url"), skills.alias("s"))
    named = read.select(
        *keep,
        "company_url",
        *[F.get("t", F.lit(i)).alias(name) for i, name in enumerate(texts)],
        F.transform("s", lambda t: strip(H.unescape(t))).alias("skills"),
    )
    derived = rule.fields()
    day = F.lit(as_of).cast("date")
    unknown = F.lit(V.UNKNOWN)
    return named.select(
        F.col("id").alias("raw_scrape_id"),
        last_segment(F.col("source_url")).alias("external_id"),
        "source_site",
        "source_url",
        F.coalesce("title", F.lit("")).alias("title_persian"),
        F.col("description").alias("description_persian"),
        F.col("company").alias("company_name_raw"),
        derived.get("company_url", F.col("company_url")).alias("company_url"),
        F.col("location").alias("location_raw"),
        derived.get("employment_type", unknown).alias("employment_type"),
        derived.get("experience_level", unknown).alias("experience_level"),
        derived["gender_requirement"].alias("gender_requirement"),
        derived.get("education_level", unknown).alias("education_level"),
        F.when(F.size("skills") > 0, F.col("skills")).alias("skills_required"),
        F.lit("pending").alias("processing_status"),
        day.alias("first_seen_date"),
        day.alias("last_seen_date"),
    )


def extract_postings(
    pages: DataFrame, as_of: date, headings: SiteHeadings = HEADINGS
) -> DataFrame:
    """Posting rows of the readable detail pages of all sites that have rules."""
    good = readable_pages(pages)
    return reduce(
        DataFrame.unionByName, [extract_site(good, site, as_of, headings) for site in RULES]
    )


def attempts_of(pages: DataFrame, rules: Mapping[str, SiteRules] = RULES) -> DataFrame:
    """``(job_url, source_site, success)`` per fetched detail page.

    A page of a site without ``rules`` can't be read and fails.
    """
    return pages.select(
        F.col("source_url").alias("job_url"),
        "source_site",
        (readable() & F.coalesce(F.col("source_site").isin(*rules), F.lit(False))).alias("success"),
    )


def company_urls(postings: DataFrame) -> DataFrame:
    found = computed_once(postings.select("source_site", "company_url"), company_url=F.col("company_url"))
    return found.where(F.col("company_url").isNotNull()).select("company_url", "source_site")
