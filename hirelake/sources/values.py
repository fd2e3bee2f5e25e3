"""Fixed values of the data model.

Everything below is data, not logic: enumerations, display labels, base URLs and
word lists that stored tables already contain or that decide a result.
"""

from __future__ import annotations

# --- fixed values: enumerations -------------------------------------------
SITES = ("irantalent", "jobvision", "jobinja")
PAGE_TYPES = ("job_list", "job_detail", "company_profile")
PROCESSING_STATUSES = ("pending", "processed", "failed", "skipped")
LOCATION_TYPES = (
    "country", "province", "city", "district", "industrial_zone", "free_trade_zone",
)
SKILL_CATEGORIES = (
    "language", "framework", "database", "cloud", "tool", "methodology", "soft",
    "certification", "domain_knowledge",
)
REQUIREMENT_TYPES = ("required", "preferred", "nice_to_have", "mentioned")
PROFICIENCY_LEVELS = ("basic", "intermediate", "advanced", "expert", "unknown")
EXTRACTION_METHODS = ("keyword_match", "nlp_extraction", "manual_review")
PROCESS_TYPES = (
    "scraping", "processing", "translation", "entity_resolution", "analysis",
)
ENTITY_TYPES = ("scrape_session", "job_posting", "company", "raw_scrape", "batch")
LOG_STATUSES = ("started", "completed", "failed", "warning", "skipped")

# --- fixed values: defaults ------------------------------------------------
UNKNOWN = "unknown"
NOT_SPECIFIED = "not_specified"
DEFAULT_SKILL_CATEGORY = "domain_knowledge"
DEFAULT_CURRENCY = "IRR"
BRIDGE_REQUIREMENT = "mentioned"
BRIDGE_PROFICIENCY = "unknown"
BRIDGE_CONFIDENCE = 0.7
BRIDGE_METHOD = "keyword_match"
TRANSLATION_SERVICE = "google"
TRANSLATION_CONFIDENCE = 0.8
TRANSLATION_PREFIX = "fa|en|"
STALE_DAYS = 14
VELOCITY_DAYS = 30
NEW_DAYS = 7
ENRICH_BATCH = 200
DETAIL_BATCH = 100
PROFILE_BATCH = 50
TOP_K = 15
EARLY_STOP_PAGES = 5
EARLY_STOP_RATIO = 1.0
ALL_RANGE_DAYS = 36500
ALL_RANGE_DAYS_SERIES = 365
ERROR_TEXT_LIMIT = 2000
EMPTY_LABEL = "—"

# --- fixed values: sites ---------------------------------------------------
SITE_LABELS = {
    "irantalent": "IranTalent",
    "jobinja": "Jobinja",
    "jobvision": "JobVision",
}
SITE_BASE_URLS = {
    "irantalent": "https://irantalent.com",
    "jobinja": "https://jobinja.ir",
    "jobvision": "https://jobvision.ir/",
}
SITE_SEARCH_URLS = {
    "irantalent": "https://www.irantalent.com/en/jobs/search",
    "jobinja": "https://jobinja.ir/jobs",
    "jobvision": "https://jobvision.ir/jobs",
}
SITE_REQUESTS_PER_MINUTE = {"irantalent": 20, "jobinja": 15, "jobvision": 20}

# --- fixed values: label tables (order decides substring matches) ------------
EMPLOYMENT_LABELS = {
    "full_time": [
        "full_time", "full-time", "full time", "تمام وقت", "تمام‌وقت", "فول تایم",
        "تمام‌ وقت",
    ],
    "part_time": [
        "part_time", "part-time", "part time", "نیمه وقت", "نیمه‌وقت", "پاره وقت",
    ],
    "remote": ["remote", "دورکاری", "remote work", "کاملاً دورکار"],
    "hybrid": ["hybrid", "هیبریدی", "hybrid work"],
    "contract": ["contract", "قراردادی", "پروژه‌ای", "پروژه ای", "project_based"],
    "freelance": ["freelance", "فریلنسر", "freelancer"],
    "internship": ["internship", "کارآموزی", "کارآموز", "intern", "trainee"],
}
EXPERIENCE_LABELS = {
    "entry_level": [
        "entry_level", "entry level", "junior", "entry", "تازه‌کار", "بدون سابقه",
        "کم‌تجربه", "جونیور", "less than 1 year", "زیر یک سال",
    ],
    "mid_level": [
        "mid_level", "mid level", "mid", "intermediate", "با تجربه", "کارشناس",
        "1-3 years", "2-4 years", "3-5 years",
    ],
    "senior": [
        "senior", "ارشد", "سینیور", "senior level", "5+ years", "بیش از ۵ سال",
    ],
    "lead": ["lead", "تیم‌لید", "team lead", "tech lead"],
    "manager": ["manager", "مدیر", "director", "head of", "مدیریت"],
    "expert": ["expert", "خبره", "principal", "staff"],
}

# --- fixed values: words in pages and texts ----------------------------------
COMPANY_WORD = "شرکت "
SALARY_UNITS = ("تومان", "ریال")
SALARY_FROM = "از"
SALARY_TO = "تا"
FEMALE_WORDS = ("زن", "خانم")
MALE_WORDS = ("مرد", "آقا")
NOT_IMPORTANT = "مهم‌ نیست"
NOT_IMPORTANT_C = "مهم نیست"
NO_DIFFERENCE = ("There is no difference.", "تفاوت ندارد", NOT_IMPORTANT_C)
CHALLENGE_MARKERS = (
    "error-section__subtitle--waiting",
    "Checking your browser before accessing",
    "در حال بررسی مرورگر پیش از اتصال به سایت",
)
NO_RESULT_TEXT = {
    "irantalent": "Your filtered search does not match any jobs",
    "jobinja": "متاسفانه‌ برای فیلتر‌های اعمال شده نتیجه‌ای یافت نشد",
    "jobvision": "فرصت شغلی برای جستجوی شما پیدا نشد",
}
