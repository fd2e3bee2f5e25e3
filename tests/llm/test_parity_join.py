"""The parity-sketch join against all pairs' exact similarities."""

import random

import numpy as np
import pytest

from hirelake.llm import jaccard, parity_join
from hirelake.llm.jaccard import shingles


def brute_set(text, shingle=4):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))) if words else frozenset()


def brute_groups(rows, percent=85, shingle=4):
    """{place: component} for (id, text) rows; the lists of each shingle give the pairs."""
    sets, label = [brute_set(t, shingle) for _, t in rows], list(range(len(rows)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        seen = {}
        for x in s:
            for j in holders.get(x, ()):
                seen[j] = seen.get(j, 0) + 1
            holders.setdefault(x, []).append(i)
        for j, both in seen.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                label[root(i)] = root(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            names[root(i)] = min(doc, names.get(root(i), doc))
    return [(doc, len(sets[i]), names.get(root(i))) for i, (doc, _) in enumerate(rows)]


def edited(words, edits, rng):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def mixed_rows(rng):
    texts = ["", None, " \t\n", "one two", "One TWO", "one two three", "a b c d", "a b c d e"]
    for size in (9, 20, 60, 200, 900):
        for _ in range(4):
            base = [f"w{rng.randrange(5000)}" for _ in range(size)]
            texts += [" ".join(edited(base, k, rng)) for k in (0, 0, 1, size // 60, size // 50, size // 40, size // 20)]
            texts += [" ".join(base[: size - size // 9]), " ".join(base[: size - size // 6])]
    # A chain whose ends are not alike, and a template that many fill in.
    chain = [f"c{rng.randrange(5000)}" for _ in range(150)]
    for _ in range(15):
        texts.append(" ".join(chain))
        chain = edited(chain, 1, rng)
    template = [f"t{rng.randrange(5000)}" for _ in range(120)]
    for _ in range(40):
        texts.append(" ".join(template + [f"o{rng.randrange(10**6)}" for _ in range(rng.choice([3, 10, 25]))]))
    texts.append(" ".join(f"long{rng.randrange(9000)}" for _ in range(60000)))
    texts.append(" ".join(edited(texts[-1].split(), 900, rng)))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    rows = [(10 * i, t) for i, (_, t) in enumerate(rows)]
    return rows + [(rows[3][0], rows[3][1]), (rows[4][0], rows[5][1]), (None, rows[6][1]), (None, "nobody else has this text here")]


@pytest.mark.parametrize("block,chunk", [(500_000, 1024), (50, 3)])
def test_groups(spark, block, chunk):
    rng = random.Random(block)
    rows = mixed_rows(rng)
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, node int, id int, component int")
    got = parity_join.jaccard_groups(docs.repartition(5), block=block, chunk=chunk).drop("row").collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute_groups(rows), key=key)


@pytest.mark.parametrize("percent,shingle", [(60, 2), (100, 4)])
def test_other_limits(spark, percent, shingle):
    rows = mixed_rows(random.Random(5))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = parity_join.jaccard_groups(docs, shingle=shingle, percent=percent).drop("row").collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute_groups(rows, percent, shingle), key=key)


def test_text_ids_and_no_rows(spark):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "X y Z"), ("c", None)], "doc_id string, text string")
    assert sorted(map(tuple, parity_join.jaccard_groups(docs).drop("row").collect())) == [("a", 1, "a"), ("b", 1, "a"), ("c", 0, "c")]
    assert parity_join.jaccard_groups(docs.limit(0)).count() == 0


def test_linked_sets_share_a_piece():
    """The pigeonhole, for sets just at the limit, of equal and of unequal sizes."""
    rng = np.random.default_rng(2)
    for n in [7, 8, 13, 40, 41, 100, 333, 1000, 5000]:
        for _ in range(40):
            whole = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
            most = jaccard.most_apart(2 * n, 85)
            gone = int(rng.integers(0, most // 2 + 1))
            added = int(rng.integers(0, most // 2 + 1))
            other = np.unique(np.r_[rng.permutation(whole)[gone:], rng.integers(0, 1 << 64, added, np.uint64)])
            both = len(whole) - gone
            if 100 * both < 85 * (len(whole) + len(other) - both) or (not gone and not added):
                continue
            keys = [{int(k) for b in parity_join.places(len(s), 85) for k in parity_join.pieces_of(s, b, 85)} for s in (whole, other)]
            assert keys[0] & keys[1], (n, gone, added)
            distance = np.bitwise_count(np.frombuffer(jaccard.short_sketch(whole), np.uint8) ^ np.frombuffer(jaccard.short_sketch(other), np.uint8)).sum()
            assert distance <= gone + added


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = parity_join.op13_parity_join(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups([tuple(r) for r in docs]))


def test_shingles_fold_case_of_ascii_only():
    assert len(shingles("A b c d É", 4)) == 2 and (shingles("É b c d", 4) != shingles("é b c d", 4)).all()
