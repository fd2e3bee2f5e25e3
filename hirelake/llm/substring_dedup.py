"""Substring dedup: content-defined chunks, deduplicated by digest.

A gear rolling hash over the bytes decides where chunks end, so a passage is cut alike
wherever it stands and whatever was inserted before it: after the first boundary in it
its chunks are the same.  What is compared across all documents are passages: from
each chunk on, as many whole chunks as make ``PASSAGE`` bytes, by a 64-bit digest.  So
a repeat is text that stands in one other document as it stands here, not chunks found
here and there; and it has two passages or more that begin one chunk apart, so a chance
hit of a digest makes none.  All but the document with the smallest id lose it.

(digest, document) rows are counted with map-side sums.  On the way back the digests that
very many documents hold, of which there can be only so many, are broadcast, and just the
others are joined by a shuffle: a passage that a third of the documents hold is nobody's
hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from struct import iter_unpack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_digest, xxh32_intdigest

from hirelake.llm.common import Stages, table

#: A chunk's bytes: at least, at most; it ends where so many bits of the hash are 0, which
#: tell of the last WINDOW bytes.  So a passage of 50 words holds several whole chunks.
LEAST, MOST, BITS, WINDOW = 8, 48, 4, 8
#: Bytes that a passage has at least, some ten words.
PASSAGE = 60
#: Bytes that a run of repeated passages must have to be a repeat.
MIN_RUN = 80
#: Of the rows of shared digests, a digest with more than this share is broadcast; so at
#: most one by this many are.
HOT_SHARE = 1 / 100_000
#: Rows that a digest has at least to be broadcast.
HOT_ROWS = 1000

#: The gear table, one number for each byte, from a hash of the byte.
GEAR = np.array([xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)


def rolling(raw: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: sum of GEAR[byte k before] << k, over 32 bytes.

    Sums over 1, 2, 4 ... 32 bytes are made from each other.
    """
    h = GEAR[raw]
    for width in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
    return h


def ends(raw: bytes, least: int = LEAST, most: int = MOST, bits: int = BITS, window: int = WINDOW) -> list[int]:
    """Where the chunks of a UTF-8 text end; never inside a character.

    Without an end for ``most`` bytes, the least hash says where to cut, so text that
    repeats itself is cut alike wherever it stands, too.
    """
    if not raw:
        return []
    data = np.frombuffer(raw, np.uint8)
    # Bit b of the hash tells of the last b + 1 bytes.
    own = rolling(data) << np.uint32(32 - window)
    whole = np.append((data[1:] & 0xC0) != 0x80, True)
    ends_here = (own >> np.uint32(32 - bits) == 0) & whole
    own = np.where(whole, own, np.uint32(0xFFFFFFFF))
    out, last = [], 0
    for end in [*(np.flatnonzero(ends_here) + 1).tolist(), len(raw)]:
        while end - last > most:
            begin = last + least - 1
            cut = begin + int(own[begin : last + most].argmin()) + 1
            out.append(cut)
            last = cut
        if end - last >= least:
            out.append(end)
            last = end
    if last < len(raw):
        out.append(len(raw))
    return out


def passages(raw: bytes) -> tuple[list[int], list[int], bytes]:
    """The chunks' ends; for each chunk that a passage begins with, the chunk after its
    last; and the passages' digests of 8 bytes, joined."""
    stops = ends(raw)
    starts = [0, *stops]
    after, digests, j = [], [], 0
    for a in starts[:-1]:
        while j < len(stops) and starts[j] - a < PASSAGE:
            j += 1
        if starts[j] - a < PASSAGE:
            break
        after.append(j)
        digests.append(xxh3_64_digest(raw[a : starts[j]]))
    return stops, after, b"".join(digests)


def _held(batches: Iterator[pa.RecordBatch]):
    """(doc, h1) for each distinct passage of a row."""
    for batch in batches:
        for start in range(0, batch.num_rows, 128):
            part = batch.slice(start, 128)
            ids, h1 = [], []
            for i, text in enumerate(part.column(1).to_pylist()):
                *_, digests = passages(text.encode("utf-8", "surrogatepass"))
                own = {h for (h,) in iter_unpack("<q", digests)}
                ids.extend([i] * len(own))
                h1.extend(own)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(ids, pa.int64())), pa.array(h1, pa.int64())], ["doc", "h1"])


_FOUND = {"n_chunks": T.LongType(), "n_repeated": T.LongType(), "repeated_bytes": T.LongType(), "removed_bytes": T.LongType(), "kept_text": T.StringType()}


def judged(text: str, shared: list[int], first: list[bool], min_run: int = MIN_RUN) -> dict:
    """A row's repeats, given the digests it shares and whether this document is the
    first to hold each."""
    raw = text.encode("utf-8", "surrogatepass")
    if not shared:
        return {"n_chunks": len(ends(raw)), "n_repeated": 0, "repeated_bytes": 0, "removed_bytes": 0, "kept_text": text}
    stops, after, digests = passages(raw)
    known = dict(zip(shared, first, strict=True))
    marks = [known.get(h1) for (h1,) in iter_unpack("<q", digests)]
    n = repeated = removed = 0
    kept, done = [], 0
    starts = [0, *stops]
    i = 0
    while i < len(marks):
        j = i
        while j < len(marks) and marks[j] is not None:
            j += 1
        # Passages i to j - 1 repeat: chunks i to last - 1.
        if j > i + 1 and starts[after[j - 1]] - starts[i] >= min_run:
            last = after[j - 1]
            n += last - i
            repeated += starts[last] - starts[i]
            upto = i
            for k in range(i, j):
                if not marks[k] and after[k] > upto:
                    a, b = starts[max(k, upto)], starts[after[k]]
                    kept.append(raw[done:a])
                    done = b
                    removed += b - a
                    upto = after[k]
        i = max(j, i + 1)
    kept.append(raw[done:])
    return {"n_chunks": len(stops), "n_repeated": n, "repeated_bytes": repeated, "removed_bytes": removed, "kept_text": b"".join(kept).decode("utf-8", "surrogatepass")}


def substring_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_run: int = MIN_RUN, hot_share: float = HOT_SHARE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(doc, n_chunks, n_repeated, repeated_bytes, removed_bytes, kept_text) of each row.

    ``repeated`` are the chunks in runs of at least ``min_run`` bytes of two or more
    passages that other documents hold; of each passage the document with the smallest
    id keeps its own, in the others it is removed.  What one document repeats by itself stays.  Null and
    empty texts have no chunks and an empty kept_text.  Rows of one id are one
    document; rows without an id are one document too, which never comes first unless
    no other holds the passage.  Extra columns are not read; no rows give no rows.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = docs.schema[doc_id].dataType
    held = rows.mapInArrow(_held, T.StructType([T.StructField("doc", kind), T.StructField("h1", T.LongType())]))
    stages = Stages(docs.sparkSession)
    shared = stages.add(
        held.groupBy("h1")
        .agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.max(F.col("doc").isNull()).alias("none"), F.count("*").alias("rows"))
        .where((F.col("least") < F.col("most")) | (F.col("none") & F.col("least").isNotNull()))
        .select("h1", "least", "rows"),
        "shared",
        release=True,
    )
    limit = max(hot_rows, int(hot_share * (shared.agg(F.sum("rows")).first()[0] or 0)))
    # At most 1 / hot_share digests have so many of the rows.
    hot = F.broadcast(shared.where(F.col("rows") > limit).select("h1", F.col("least").alias("hot")))
    cold = shared.where(F.col("rows") <= limit).select(F.col("h1").alias("k1"), "least")
    # Rows that the broadcast has answered are spread; what they meet there isn't theirs.
    known = F.col("hot").isNotNull()
    k1 = F.when(known, F.xxhash64("doc", "h1")).otherwise(F.col("h1"))
    found = (
        held.join(hot, "h1", "left")
        .withColumn("p1", k1)
        .join(cold, (F.col("p1") == F.col("k1")) & F.col("hot").isNull(), "left")
        .withColumn("least", F.coalesce("hot", "least"))
        .where("least is not null")
        .groupBy("doc")
        .agg(F.collect_set(F.struct("h1", F.col("doc").eqNullSafe(F.col("least")).alias("first"))).alias("shared"))
        .withColumnRenamed("doc", "__doc")
    )
    joined = rows.join(found, F.col("doc").eqNullSafe(F.col("__doc")), "left").select(
        "doc", "text", F.col("shared.h1").alias("shared"), F.col("shared.first").alias("first")
    )

    def judge(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                made = [
                    judged(t, s or [], f or [], min_run)
                    for t, s, f in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
                ]
                kinds = {"kept_text": pa.string()}
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([m[n] for m in made], kinds.get(n, pa.int64())) for n in _FOUND)], ["doc", *_FOUND]
                )

    return joined.mapInArrow(judge, T.StructType([T.StructField("doc", kind), *[T.StructField(n, t) for n, t in _FOUND.items()]]))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        F.col("doc").alias("doc_id"), "n_chunks", "n_repeated", "repeated_bytes", "removed_bytes",
        (F.col("n_repeated") > 0).alias("repeats"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )
