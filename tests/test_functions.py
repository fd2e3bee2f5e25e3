"""Column functions against stated vectors and the standard library."""

import re
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelake.functions import labels, people, skills, text, urls
from hirelake.plans import reports
from hirelake.sources import values as V


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


SAMPLES = [
    "  A & B  Co., Ltd.  ", "شرکت آب‌فا تهران", "Tehran (Iran)", "٣٤۱۲_ok-go", "!!!", "",
    "\x1cA\x85B　c‌d", "Ünïcödé — dash – x", "a\tb\n\nc", "کاملاً", "x²½ ①", "-_-", "é é",
]


def test_normalize_matches_python(spark):
    def model(t):
        t = re.sub(r"\s+", " ", t.lower().strip())
        return re.sub(r"[^\w\s\-]+", "", t).strip()

    assert column(spark, SAMPLES, text.normalize) == [model(s) for s in SAMPLES]


def test_keys(spark):
    assert column(spark, ["شرکت آب‌فا تهران", "!!!", "a شرکت b", None], text.canonical_company) == [
        "آبفا تهران", None, "a b", None]
    assert column(spark, [" Tehran (Iran)", "?"], text.location_key) == ["tehran iran", None]
    assert column(spark, ["x", " x "], text.translation_key) == [
        "e343605a83dc75e4d4bc9dc3ec5b7630a620b9bacab19524776d12991cc53a82"] * 2


@pytest.mark.parametrize("value,expected", [
    ("حقوق از ۱,۰۰۰,۰۰۰ تا ۲,۰۰۰,۰۰۰ تومان", (1000000.0, 2000000.0)),
    ("۱,۵۰۰,۰۰۰ تومان ماهیانه", (1500000.0, None)),
    ("توافقی", (None, None)), ("۱۲۳۴ تومان", (None, None)), ("10 تا 20 دلار", (None, None)),
    (", تا ۵ تومان ۹۹۹۹۹ ریال", (99999.0, None)), ("٣٤٥٦٧ ریال", (34567.0, None)),
    ("१२३४५ ریال", (12345.0, None)), (None, (None, None)),
])
def test_salary(spark, value, expected):
    none = F.lit(None).cast("double")
    got = column(spark, [value], lambda c: text.salary(none, c))[0]
    assert (got["min"], got["max"]) == expected
    got = column(spark, [value], lambda c: text.salary(F.lit(1.0), c))[0]
    assert (got["min"], got["max"]) == (None, None)


def test_labels(spark):
    raw = ["Full-Time", "full_time", "تمام وقت", "تمام_وقت", None, "", "Unknown", "volunteer"]
    assert column(spark, raw, labels.employment_type) == ["full_time"] * 3 + ["unknown"] * 5
    raw = ["Senior Level", "کارشناس ارشد", "less_than_1_year", " Tech Lead "]
    assert column(spark, raw, labels.experience_level) == ["senior", "mid_level", "unknown", "lead"]
    assert sum(map(len, V.EMPLOYMENT_LABELS.values())) == 33
    assert sum(map(len, V.EXPERIENCE_LABELS.values())) == 38


def test_skills(spark):
    entries = [skills.SkillEntry(s, "tool", (p,)) for s, p in
               (("Git", "git"), ("Python", "PYTHON"), ("TypeScript", "ts"), ("C", " c "))]
    texts = ["Python requirements digital", None, "x c y", "", "plain"]
    expected = [["Git", "Python", "TypeScript"], [], ["C"], [], []]
    assert column(spark, texts, lambda c: skills.match_skills(c, entries)) == expected
    assert column(spark, texts[:1], lambda c: skills.match_skills(c, entries, whole_words=True)) == [["Python"]]
    tags = ['[1,"a",null,"Git"]', "{bad", '{"a":1}', None, "[]"]
    git = F.array(F.lit("Git"))
    assert column(spark, tags, lambda c: skills.union_json_tags(git, c)) == [
        ["Git", "a"], ["Git"], ["Git"], ["Git"], ["Git"]]


def test_large_dictionary_equals_literal_one(spark):
    words = [f"w{i:04d}" for i in range(0, 3000, 7)] + ["a", "zz", "😀b"]
    entries = [skills.SkillEntry(w.upper(), "tool", (w,)) for w in words]
    docs = spark.createDataFrame(
        [(i, f"text w{i:04d} and w{(i * 3) % 3000:04d} {'zz' if i % 5 else '😀B'}") for i in range(60)]
        + [(99, None), (98, "")],
        "id long, body string",
    )
    assert skills.load_dictionary(skills.dictionary_frame(spark, entries), limit=100) is None
    loaded = skills.load_dictionary(skills.dictionary_frame(spark, entries))
    small = {r.id: r.s for r in docs.select("id", skills.match_skills(F.col("body"), loaded).alias("s")).collect()}
    large = {r.id: r.skills for r in skills.match_large(
        docs, "id", "body", skills.dictionary_frame(spark, entries)).collect()}
    joined = {r.id: r.skills for r in skills.match_joined(
        docs, "id", "body", skills.dictionary_frame(spark, entries)).collect()}
    assert small == large == joined and any(small.values())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["S1", "s2", "S3", None]), st.sampled_from(["a", "b", None]),
                          st.sampled_from(["ab", "AB", "b c", "x", "", None, "abcd", "😀"])), max_size=8),
       st.booleans())
def test_both_forms_of_a_dictionary_agree(spark, listed, whole_words):
    """Empty, null and repeated patterns, and several categories, at either size."""
    frame = spark.createDataFrame(listed, "skill string, category string, pattern string")
    docs = spark.createDataFrame(list(enumerate(["Ab c", "xabcdx", "", None, "b C 😀", "x"])), "id int, body string")
    loaded = skills.load_dictionary(frame)
    small = docs.select("id", skills.match_skills(F.col("body"), loaded, whole_words).alias("s"))
    want = {r.id: r.s for r in small.collect()}
    for bound in (skills.AUTOMATON_PATTERNS, -1):
        large = skills.match_large(docs, "id", "body", frame, whole_words, bound)
        assert want == {r.id: r.skills for r in large.collect()}
    assert all(e.category == min((c for s, c, _ in listed if s == e.skill and c), default=None) for e in loaded)


def test_automaton_reads_texts_once(spark):
    """No join and no shuffle; overlapping patterns, repeated keys and edges of words."""
    listed = [("he", "he"), ("she", "she"), ("hers", "HERS"), ("usher", "usher"), ("é", "é"), ("c++", "c++"), ("x", "x_y")]
    frame = spark.createDataFrame([(s, None, p) for s, p in listed], "skill string, category string, pattern string")
    docs = spark.createDataFrame(
        [(1, "uSHErs"), (1, "he\u0301 é"), (None, "C++, x_y"), (3, "éé he_ 3he he3 (he)"), (4, None), (5, ""), (6, "he " * 200_000)],
        "id int, body string")
    entries = [skills.SkillEntry(s, None, (p,)) for s, p in listed]
    for whole in (False, True):
        found = skills.match_large(docs, "id", "body", frame, whole)
        small = docs.select("id", skills.match_skills(F.col("body"), entries, whole).alias("skills"))
        key = lambda r: (r.id or 0, r.skills)
        assert sorted(found.collect(), key=key) == sorted(small.collect(), key=key)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
    assert skills.matcher(frame, max_chars=10) is None


def test_set_page_matches_urllib(spark):
    def model(u):
        p = urlsplit(u)
        q = dict(parse_qsl(p.query, keep_blank_values=True))
        q["page"] = "7"
        return urlunsplit((p.scheme, p.netloc, p.path, urlencode(q), p.fragment))

    cases = ["https://s/a", "https://s/a?page=2&ref=x", "http://x/y?ref=x&a=%20b+c&a=~*#top",
             "https://x/y?q=&flag&page=1&page=3", "https://x/?k=%D8%A2%D8%A8", "https://x/y#f?g"]
    assert column(spark, cases, lambda c: urls.set_page(c, F.lit(7))) == [model(u) for u in cases]


def test_urls(spark):
    cases = ["https://s/a/b/123", "https://s/a/", "https://s/a?x=1/2", "none"]
    assert column(spark, cases, urls.last_segment) == ["123", "", "2", None]
    assert column(spark, ["/jobs/1", "http://o/2", "//cdn/x"], lambda c: urls.join_root("https://j.ir/", c)) == [
        "https://j.ir/jobs/1", "http://o/2", "https://cdn/x"]
    word = lambda c: urls.search_url(F.lit("https://b"), c, "english")
    assert column(spark, ["a b", "", None], word) == [
        "https://b?language=english&keyword=a+b", "https://b?language=english", "https://b?language=english"]


def test_people_and_lists(spark):
    assert column(spark, ["Woman", "مرد", "مهم‌ نیست", "x", None], people.gender_from_label) == [
        "female", "male", "any", "not_specified", "not_specified"]
    assert column(spark, ["مهم نیست", "a woman", "Males", None], people.gender_from_phrase) == [
        "any", "female", "male", "not_specified"]
    assert column(spark, [" a, ,b ", "  ", None], lambda c: text.keyword_list(c, ["d"])) == [["a", "b"], ["d"], ["d"]]
    assert column(spark, ["e" * 3000], text.error_text) == ["e" * 2000]
    assert column(spark, ["x" * 5, "é", None], text.byte_size) == [5, 2, 0]
    assert column(spark, ["Full Time ", None], text.label_token) == ["full_time", "unknown"]


def test_parameters():
    assert [reports.positive_int(v, 9) for v in ("3", "12abc", "-4", "0", None, "x", 5)] == [3, 12, 9, 9, 9, 9, 5]
    assert reports.range_days("all") == 36500 and reports.range_days("all", None) is None
    assert reports.range_days("7") == 7
    assert reports.page_numbers(45, 3, 20) == {"total_pages": 3, "shown_from": 41, "shown_to": 45}
    assert reports.page_numbers(0)["total_pages"] == 1
