"""Substring dedup on passages just over 50 words."""

import random

from hirelake.llm import substring_dedup


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_passages_over_50_words(spark):
    rng = random.Random(21)
    rows, lengths = [], {}
    for i in range(150):
        passage = prose(rng, rng.randint(51, 60))
        for d in (2 * i, 2 * i + 1):
            rows.append((d, f"{prose(rng, rng.randint(0, 80))} {passage} {prose(rng, rng.randint(0, 80))}"))
            lengths[d] = len(passage)
    # A passage that only repeats a word stands at another place in each document.
    for d in (1000, 1001):
        rows.append((d, f"{prose(rng, 30)} {'spamspam ' * 55}{prose(rng, 20)}"))
        lengths[d] = 55 * 9
    made = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = [r.repeated_bytes / lengths[r.doc] for r in made]
    assert min(found) > 0.3 and sum(found) / len(found) > 0.8
    assert all((r.removed_bytes > 0) == (r.doc % 2 == 1) for r in made)
