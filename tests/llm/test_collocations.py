"""Phrase mining against plain counting, with samples that miss much."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

from hirelake.llm import collocations
from tests.llm.test_operators import documents


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, min_count, top, longest=4, covered=80):
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, own in counts.items():
        frequent = {p: f for p, f in own.items() if f >= min_count and len(p) > 1}
        found = []
        for p, a in frequent.items():
            if any(q != p and 100 * f >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, f in frequent.items() if len(q) > len(p)):
                continue
            cuts = [(2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return out


def corpus(rng):
    rows = []
    vocabulary = ["x", "y", "É", "é", "new", "york", "city", "hall", "of", "The", "the", "\x1c", "a b", "漢字"]
    for i in range(220):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 60]))]
        if rng.random() < 0.5:
            words += ["new", "york", "city", "hall"][: rng.choice([2, 3, 4, 4])]
        rows.append((rng.choice(["en", "fr", None]), "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]) for w in words)))
    # Phrases of one document only, which a sample often doesn't have.
    rows.append(("de", "rare words do stay " * 40))
    rows += [("en", None), ("en", ""), (None, " ., \n"), ("xx", "one"), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("sample,bits,block,top", [(0.25, 20, 2_000_000, 2000), (0.0, 20, 300, 7), (0.05, 3, 300, 2000)])
def test_against_counting(spark, sample, bits, block, top):
    rows = corpus(random.Random(4))
    docs = spark.createDataFrame([(*r, 1, "p", 2) for r in rows], "lang string, text string, f int, phrase string, n int").repartition(4)
    got = collocations.collocations(docs, min_count=6, top=top, sample=sample, bits=bits, block=block)
    assert {tuple(r) for r in got.collect()} == brute(rows, 6, top)


def test_no_rows(spark):
    docs = documents(spark, [(1, "no phrase here"), (2, None)])
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(docs.limit(0)).count() == 0


def _bits(bits, *phrases):
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for phrase in phrases:
        words = [np.array([xxh64_intdigest(w)], np.uint64) for w in phrase.encode().split(b" ")]
        at = int(collocations._hashed("en", words)[0]) >> (64 - bits)
        bitmap[at >> 3] |= 1 << (at & 7)
    return bitmap


def _counted(text, *how):
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], ["lang", "text"])
    return {r["phrase"]: r["f"] for b in collocations._Counter(*how).run(iter([batch]), 100) for r in b.to_pylist()}


def test_a_shared_bit_hides_no_phrase():
    """The bit of `b c` was set in the first pass by another phrase; `c` was not proposed, so
    `b c` and what extends it were not counted then."""
    before = _bits(16, "a", "b", "a b", "b c")
    known = before | _bits(16, "c")
    assert _counted("a b c", range(2, 5), known, before, 16) == {"b c": 1, "a b c": 1}


def test_one_further_pass_is_enough():
    """Only words are known; all that they make is counted, but nothing that was found rare."""
    assert _counted("a b c", range(2, 5), _bits(16, "a", "b", "c"), _bits(16), 16) == {"a b": 1, "b c": 1, "a b c": 1}
    # `a b` was counted in the first pass and is not among the frequent ones.
    assert _counted("a b c", range(2, 5), _bits(16, "a", "b", "c"), _bits(16, "a", "b"), 16) == {"b c": 1}


@pytest.mark.parametrize("bits", [8, 10])
def test_few_bits(spark, bits):
    rows = corpus(random.Random(6))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = collocations.collocations(docs, min_count=6, sample=0.02, bits=bits, block=300)
    assert {tuple(r) for r in got.collect()} == brute(rows, 6, 2000)


def test_blocks_add_up():
    """With every phrase proposed and a block for each text."""
    counter = collocations._Counter(range(1, 3), np.full(1 << 10, 255, np.uint8), None, 13)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array(["a b a b", "b a", None])], ["lang", "text"])
    got = Counter()
    for b in counter.run(iter([batch]), 1):
        for r in b.to_pylist():
            got[r["phrase"]] += r["f"]
    assert got == {"": 6, "a": 3, "b": 3, "a b": 2, "b a": 2}
