"""N-gram Jaccard join by parity sketches.

A document's set of shingles is xor-hashed into a sketch: each shingle flips one bit, so
a shingle that two sets don't share changes one bit at most, and the sketches' Hamming
distance never exceeds the sets' symmetric difference.

Sets are joined by size bands.  A band knows how many shingles k two linked sets in it can
differ by at most; its sketch has ``PIECE_BITS`` bits in each of k + 1 + spare pieces, so
linked sets agree on at least spare + 1 whole pieces (pigeonhole).  Pieces without a
bit say little: a set with no more than ``spare`` of them need not be found by one.  A
piece is kept as the xor of its set bits' hashes, which is 0 for no bits and alike for alike bits.

How sets that share a piece are verified and grouped is in ``jaccard``.
"""

from __future__ import annotations

from functools import lru_cache
from math import exp, sqrt

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import table
from hirelake.llm.jaccard import BLOCK, CHUNK, alike_groups, most_apart

SHINGLE, PERCENT, PIECE_BITS = 4, 85, 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=64)
def bands(percent: int) -> list[tuple[int, int, int, int]]:
    """(least size, largest size, pieces, spare) of each band, up to 2^40 shingles.

    A band's sizes span the square of the limit's inverse, so linked sets are in the same
    band or in neighbouring ones.
    """
    made, low = [], 1
    while low < 1 << 40:
        high = low * 10_000 // percent**2
        apart = most_apart(2 * high, percent)
        none = (apart + 1) * exp(-low * percent / 100 / (apart + 1))  # expected pieces without bits in the least set
        spare = int(none + 2 * sqrt(none)) + 1
        made.append((low, high, apart + 1 + spare, spare))
        low = high + 1
    return made


def places(n: int, percent: int) -> list[int]:
    """The bands in which a set of n shingles meets all sets it can be linked with.

    Its own, and the next one where that has sizes that it can be linked with.  Bands
    whose linked sets can't differ are left out, as equal sets count as one.
    """
    if percent == 100:
        return []
    known = bands(percent)
    own = next(i for i, b in enumerate(known) if n <= b[1])
    found = [own] + [own + 1] * (100 * n >= percent * (known[own][1] + 1))
    return [i for i in found if most_apart(2 * known[i][1], percent)]


def pieces_of(hashes: np.ndarray, band: int, percent: int) -> np.ndarray:
    """The keys of the sketch's pieces by which a set (ascending hashes) is looked up in a band."""
    _, _, count, spare = bands(percent)[band]
    piece = ((hashes >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    bit = _mixed(piece * np.uint64(PIECE_BITS) + (hashes & np.uint64(PIECE_BITS - 1)) + np.uint64(1))
    starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    words = np.zeros(count, np.uint64)
    words[piece[starts].astype(np.int64)] = np.bitwise_xor.reduceat(bit, starts)
    asked = np.arange(count) if (words == 0).sum() > spare else np.flatnonzero(words)
    return _mixed(words[asked] ^ _mixed((np.uint64(band) << np.uint64(48)) + asked.astype(np.uint64) * _STEP))


def sketch_keys(hashes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The keys of all pieces by which a set is looked up."""
    found = [pieces_of(hashes, band, percent) for band in places(len(hashes), percent)]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def jaccard_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per row of ``docs``: doc, row, n and component, as ``alike_groups`` has them.

    No link is lost.  Texts without a word are linked with nothing, not with each other either.
    """
    if not 50 <= percent <= 100:
        raise ValueError("the limit must be 50 to 100 percent")
    return alike_groups(docs, lambda h: sketch_keys(h, percent), shingle, percent, doc_id, text, block=block, chunk=chunk)


def op13_parity_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )
