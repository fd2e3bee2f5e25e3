"""Near copies: documents alike in at least 0.8 of their five-word shingles.

Candidates come from SimHash as in ``simhash``, on five-word shingles: fingerprints that hang
together within three bits are found on bit planes and make a bucket.  As documents at 0.8
differ in ten bits or so, MinHash adds candidates: each document has ``BANDS`` bands of
``ROWS`` minima over its shingles, and whoever shares one of them is a candidate; two documents
at 0.8 share one in 99.9 of 100 cases.  All candidates are confirmed by the exact similarity
of their shingle sets.

How candidates are verified and grouped is in ``jaccard``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from hirelake.llm.common import unused
from hirelake.llm.jaccard import alike_groups
from hirelake.llm.simhash import row_hash

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 24, 6
_MIX = np.array([[xxh64_intdigest(str(i), seed) | 1 for i in range(BANDS * ROWS)] for seed in (1, 2)], np.uint64)


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key for each band, of the hashes of a set that isn't empty."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for start in range(0, len(hashes), 2048):  # very long texts in pieces
        part = hashes[start : start + 2048]
        least = np.minimum(least, ((part[None, :] ^ _MIX[0][:, None]) * _MIX[1][:, None]).min(1))
    raw, width = least.tobytes(), 8 * ROWS
    return np.array([xxh64_intdigest(raw[width * b : width * (b + 1)], b) for b in range(BANDS)], np.uint64)


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, **how) -> DataFrame:
    """One row per row of ``docs``: doc, row, n and component, as ``alike_groups`` has them.

    Null and empty texts and texts of white space are alike.
    """
    return alike_groups(docs, bands, SHINGLE, round(100 * similarity), doc_id, text, empty_alike=True, fingerprints=True, **how)


def near_copy_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without those that aren't the first of their group.

    The document whose id is the smallest of the group stays; rows that repeat it (id
    and text) stay with it, and rows without an id go where their group has an id.
    All columns pass through.
    """
    doc, row = unused(docs, "own_doc"), unused(docs, "own_row")
    gone = near_copies(docs, doc_id, text, **how).where(
        F.col("component").isNotNull() & ~F.col("doc").eqNullSafe(F.col("component"))
    ).select(F.col("doc").alias(doc), F.col("row").alias(row))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(doc)) & (row_hash(F.col(f"`{text}`")) == F.col(row))
    return docs.join(gone, same, "left_anti")
