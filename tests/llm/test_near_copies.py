"""The pipeline's near-duplicate stage against all pairs' exact similarities."""

import random

import numpy as np

import corpus_pipeline
from hirelake.llm import near_copies
from hirelake.llm.simhash import fingerprint


def brute_shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_groups(texts, similarity=0.8):
    sets, label = [brute_shingles(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if len(a & b) >= similarity * len(a | b) and label[i] != label[j]:
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    return label


def edited(words, edits, rng):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_edited_copies_go(spark):
    rng = random.Random(3)
    texts = ["", None, "  ", "one two", "one two"]
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        texts += [" ".join(edited(base, k, rng)) for k in (0, 0, 2, 3, 4, 9, 20)]
    # A chain: neighbours are alike, its ends aren't.
    chain = [f"c{rng.randrange(5000)}" for _ in range(150)]
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = edited(chain, 1, rng)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == set(brute_groups(texts))
    assert {r.doc: r.component for r in near_copies.near_copies(docs).collect()} == dict(enumerate(brute_groups(texts)))
    assert near_copies.near_copies(docs.limit(0)).count() == 0


def test_clashing_columns_repeated_rows_and_missing_ids(spark):
    long = " ".join(f"word{i % 9000}" for i in range(120_000))
    rows = [(1, long), (2, long + " end"), (3, "a few words that nobody else has in this order"), (3, "a few words that nobody else has in this order")]
    rows += [(None, long), (None, "nobody"), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id long, text string, own_doc string, own_row string, component string")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.where("text is not null").collect()) == sorted([(0, "nobody"), *((i or 0, t) for i, t in rows[:1] + rows[2:4])])
    assert [r.doc_id for r in got.where("text is null").collect()] == [4]


def test_stage_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect())
    assert kept == [rows[i].doc_id for i in sorted(set(brute_groups([r.text for r in rows])))]


def test_fingerprints_find_candidates_without_bands(spark, monkeypatch):
    """Texts within three bits meet by their fingerprints alone, and are confirmed exactly."""
    rng = random.Random(5)
    texts = ["one two", "one two"]
    for _ in range(30):
        base = [f"w{rng.randrange(5000)}" for _ in range(400)]
        texts += [" ".join(edited(base, k, rng)) for k in (0, 1, 1)]
    # The same fingerprint, as one passage makes up most shingles, but sets that are not alike.
    loop = " ".join("a b c d e f g".split() * 60)
    texts += [f"{loop} {' '.join(f'{x}{i}' for i in range(20))}" for x in "pq"]
    fps = [fingerprint(t, 5) for t in texts]
    close = {(i, j) for i in range(len(texts)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3}
    exact = brute_groups(texts)
    meant = {i for i, j in close if exact[i] == exact[j]}
    assert len(meant) > 20 and (len(texts) - 1, len(texts) - 2) in close and exact[-1] != exact[-2]
    monkeypatch.setattr(near_copies, "bands", lambda hashes: np.zeros(0, np.uint64))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc: r.component for r in near_copies.near_copies(docs, block=7, chunk=2).collect()}
    assert meant <= {i for i, c in got.items() if c != i}
    assert all(c == i or exact[i] == exact[c] for i, c in got.items())
