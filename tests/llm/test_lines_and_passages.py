"""Line dedup of long documents and any ids; substring dedup leaves what doesn't repeat."""

import random
import time

from pyspark.sql import functions as F

from hirelake.llm import line_dedup, substring_dedup


def brute_lines(rows, min_chars, min_docs):
    """What each row keeps; ``rows`` are (id, text)."""
    key = lambda line: line_dedup.line_key(line)
    long = lambda line: len(line.strip(" \t\n\v\f\r")) >= min_chars
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if long(line):
                holders.setdefault(key(line), set()).add(i)
    last = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    return [(i, "\n".join(x for x in (t or "").split("\n") if not (long(x) and key(x) in last and last[key(x)] != i))) for i, t in rows]


def test_ids_as_text_and_clashing_names(spark):
    rng = random.Random(41)
    lines = ["".join(rng.choice("abcdeé") for _ in range(12)) for _ in range(30)]
    rows = [(rng.choice([None, f"d{i:03}"]) if i % 9 == 0 else f"d{i:03}", "\n".join(rng.choice(lines) + rng.choice(["", " "]) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [rows[1], ("d900", None), ("d901", "\n\n")]
    clash = ["__gone", "__key", "__of", "__row", "doc", "row", "Kept_Text"]
    docs = spark.createDataFrame(rows, "name string, text string")
    for c in clash:
        docs = docs.withColumn(c, F.lit("mine"))
    made = line_dedup.line_dedup(docs.repartition(3), "name", "text", min_chars=10, min_docs=4).collect()
    order = lambda x: (x[0] or "", x[1])
    assert sorted([(r["name"], r["kept_text"]) for r in made], key=order) == sorted(brute_lines(rows, 10, 4), key=order)
    assert all(r[c] == "mine" for r in made for c in clash[:-1])
    assert "Kept_Text" not in made[0].asDict()


def test_many_shared_lines_take_linear_time(spark):
    text = "\n".join(f"line {i} " + "x" * 40 for i in range(32_000))
    docs = spark.createDataFrame([(i, text) for i in range(6)], "doc_id long, text string")
    line_dedup.line_dedup(docs.limit(1)).collect()
    start = time.time()
    made = line_dedup.line_dedup(docs).collect()
    assert time.time() - start < 15
    assert sorted((r.doc_id, r.n_dropped, len(r.kept_text)) for r in made) == [*((i, 32_000, 0) for i in range(5)), (5, 0, len(text))]


def words(rng, vocabulary, n):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def test_prose_of_few_words_stays(spark):
    """Every chunk of it is found somewhere, no passage is."""
    rng = random.Random(91)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(40)]
    rows = [(i, words(rng, vocabulary, 150)) for i in range(3_000)]
    made = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert made.where("n_repeated > 0").count() == 0
    assert made.agg(F.sum("removed_bytes")).first()[0] == 0


def test_what_is_marked_stands_elsewhere(spark):
    """Against brute force: each marked document shares a string with another, each that
    shares a long one is marked, and what is removed is kept by some other document."""
    rng = random.Random(92)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    shared = [words(rng, vocabulary, rng.randint(5, 70)) for _ in range(12)]
    rows = []
    for i in range(80):
        parts = [words(rng, vocabulary, rng.randint(0, 60)) for _ in range(3)]
        rows.append((i, " ".join([parts[0], rng.choice(shared), parts[1], *([rng.choice(shared)] if i % 2 else []), parts[2]])))
    raw = {i: t.encode() for i, t in rows}
    made = {r.doc: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}

    def longest(i):
        """The longest string of a document, in bytes, that another holds."""
        others, best, a = b"\xff".join(x for j, x in raw.items() if j != i), 0, 0
        for b in range(1, len(raw[i]) + 1):
            while raw[i][a:b] not in others:
                a += 1
            best = max(best, b - a)
        return best

    for i, r in made.items():
        n = longest(i)
        assert n >= substring_dedup.MIN_RUN or r.n_repeated == 0, i
        assert n < 300 or r.n_repeated > 0, i
    kept = [r.kept_text for r in made.values()]
    for p in shared:
        # The middle of a passage stays in one document at least.
        if sum(p in t for _, t in rows) and len(p) > 300:
            assert any(p[120:-120] in t for t in kept)
