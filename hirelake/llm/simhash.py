"""SimHash near-duplicates, compared on vertical bit planes.

Distinct fingerprints are dealt to buckets: the 64 bits are cut into pieces and any
two fingerprints within the radius agree on all but ``radius`` pieces, so each choice
of that many pieces is a table of buckets, and every link shows in some bucket.

In a bucket the fingerprints stand in blocks of 64 lanes, stored as 64 planes: word b
of a block holds bit b of its 64 members.  A member is compared with a whole block by
xor with the planes; carry-save counters, one bit per lane, add up the differing
bits.  Once all lanes of a block exceed the radius, the comparison is abandoned.

A bucket gives links that keep its members together (a star for each of its parts),
not all pairs.  Buckets over ``CHUNK`` members are cut into chunks and every pair of
chunks is a task's row group of its own, so no bucket is capped or lands in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_digest

from hirelake.llm.common import LOWER, Stages, staged, table
from hirelake.llm.components import components, stars

RADIUS, SHINGLE, PIECES, CHUNK = 3, 3, 5, 4096
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit b is 1 if it is set in over half the hashes of the word shingles; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if n > 1 or len(words) >= shingle else [b" ".join(words)]
    hashes = np.frombuffer(b"".join([xxh64_digest(p, 42) for p in parts]), np.uint8)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 8 * 65536):  # very long texts in pieces
        counts += np.unpackbits(hashes[start : start + 8 * 65536]).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def row_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc, row, fp) of every row: ``row`` is a hash of its text, fp the fingerprint as a
    signed long."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                own = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own.view(np.int64))], ["doc", "row", "fp"])

    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc", kind), T.StructField("row", T.LongType()), T.StructField("fp", T.LongType())])
    return docs.select(F.col(f"`{doc_id}`").alias("doc"), row_hash(F.col(f"`{text}`")).alias("row"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def _tables(pieces: int, radius: int) -> list[int]:
    """Masks of the bits that a table's buckets share."""
    if not radius < pieces <= 64:
        raise ValueError("there must be more pieces than bits of the radius, 64 at most")
    edges = [64 * i // pieces for i in range(pieces + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(x) for x in combinations(masks, pieces - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def planes(members: np.ndarray) -> np.ndarray:
    """(blocks, 64) words from (64 * blocks) fingerprints: word b has bit b of each lane."""
    bits = np.unpackbits(members.view(np.uint8), bitorder="little").reshape(-1, 64, 64)
    packed = np.packbits(np.ascontiguousarray(bits.transpose(0, 2, 1)), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)[:, :, 0]


def within(members: np.ndarray, block: np.ndarray, blocks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and their lanes within the radius: member[i] against planes blocks[block[i]].

    Lane j of the result word is 1 if the distance to lane j is at most ``radius``.
    Counters start so that they overflow just beyond the radius.  Rows all of whose
    lanes have overflowed are abandoned.
    """
    levels = max(1, radius.bit_length())
    begin = (1 << levels) - 1 - radius
    row = np.arange(len(members))
    counter = [np.full(len(members), _ONES if begin >> k & 1 else 0, np.uint64) for k in range(levels)]
    over = np.zeros(len(members), np.uint64)
    for b in range(0, 64, 2):
        # Two planes at a time: a carry-save adder gives their sum with the lowest counter.
        first, second = (
            blocks[block, b + k] ^ np.where(members >> np.uint64(b + k) & np.uint64(1), _ONES, np.uint64(0)) for k in (0, 1)
        )
        half = counter[0] ^ first
        carry = (counter[0] & first) | (half & second)
        counter[0] = half ^ second
        for k in range(1, levels):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        if b % 8 == 6:
            alive = over != _ONES
            if not alive.all():
                row, members, block, over = row[alive], members[alive], block[alive], over[alive]
                counter = [c[alive] for c in counter]
                if not len(row):
                    break
    return row, ~over


def links_of(groups: np.ndarray, side: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within row groups (``groups`` ascending): side 0 and 2 are compared with 1
    and 2; so chunk pairs use 0 and 1, whole buckets 2."""
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    group = np.cumsum(np.r_[False, groups[1:] != groups[:-1]])
    lanes_at = np.flatnonzero(side >= 1)
    # Lanes of a group fill blocks of their own.
    per = np.bincount(group[lanes_at], minlength=len(starts))
    n_blocks = -(-per // 64)
    first_block = np.r_[0, np.cumsum(n_blocks)][:-1]
    rank = np.arange(len(lanes_at)) - np.r_[0, np.cumsum(per)][:-1][group[lanes_at]]
    slot = 64 * first_block[group[lanes_at]] + rank
    total = int(n_blocks.sum())
    filled, who = np.zeros(64 * total, np.uint64), np.full(64 * total, -1)
    filled[slot], who[slot] = fps[lanes_at], lanes_at
    vertical = planes(filled)
    asks = np.flatnonzero(side != 1)
    times = n_blocks[group[asks]]
    found_a, found_b = [], []
    ends = np.cumsum(times)
    begin = 0
    while begin < len(asks):  # so many comparisons at once that they fit in memory
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + 65536, "right")))
        own, t = asks[begin:stop], times[begin:stop]
        ask = np.repeat(own, t)
        offset = np.arange(len(ask)) - np.repeat(np.cumsum(t) - t, t)
        block = first_block[group[ask]] + offset
        row, near = within(fps[ask], block, vertical, radius)
        for start in range(0, len(row), 16384):
            r = row[start : start + 16384]
            bits = np.unpackbits(near[start : start + 16384].view(np.uint8), bitorder="little").reshape(-1, 64)
            i, lane = np.nonzero(bits)
            x, y = ask[r[i]], who[64 * block[r[i]] + lane]
            real = (y >= 0) & (x != y)
            found_a.append(x[real])
            found_b.append(y[real])
        begin = stop
    a, b = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_a, found_b))
    label = stars(len(fps), a, b)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return moved, label[moved]


def links(distinct: DataFrame, radius: int = RADIUS, pieces: int = PIECES, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) that join just what pairs of fingerprints within the radius join.

    ``distinct`` is a table (fp long) of distinct fingerprints without null.
    """
    masks = _tables(pieces, radius)

    def entries(df: DataFrame) -> DataFrame:
        made = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)]))
        return df.select("fp", made.alias("e")).select("e.t", "e.k", "fp")

    placed = entries(distinct)
    crowded = placed.groupBy("t", "k").count().where(F.col("count") > chunk).select(
        "t", "k", F.ceil(F.col("count") / chunk).cast("int").alias("n")
    )
    chunked = placed.join(staged(crowded, "crowded"), ["t", "k"], "left").withColumn(
        "c", F.pmod(F.xxhash64("fp"), F.coalesce("n", F.lit(1))).cast("int")
    )
    # Chunk c meets every chunk: as the lower one of a pair it asks (0), as the upper one it has the lanes (1).
    other = F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("n") - 1)))
    groups = chunked.select("t", "k", "fp", "c", other.alias("o")).select(
        "t", "k", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"),
        F.when(F.col("c") == F.col("o"), 2).when(F.col("c") < F.col("o"), 0).otherwise(1).alias("side"), "fp",
    )
    dealt = groups.repartition("t", "k", "x", "y").sortWithinPartitions("t", "k", "x", "y")

    def compare(parts: Iterator[pd.DataFrame]):
        for u, v in _compared(parts, radius):
            yield pd.DataFrame({"u": u, "v": v})

    return dealt.mapInPandas(compare, "u long, v long").distinct()


def _compared(parts: Iterator[pd.DataFrame], radius: int):
    """Links of sorted rows, which arrive in batches that may cut a group."""
    held = None
    for part in parts:
        part = part if held is None else pd.concat([held, part], ignore_index=True)
        key = part[["t", "k", "x", "y"]]
        new = (key != key.shift()).any(axis=1).to_numpy()
        cut = int(np.flatnonzero(new)[-1])
        held, part, new = part.iloc[cut:], part.iloc[:cut], new[:cut]
        yield from _group_links(part, new, radius)
    if held is not None:
        key = held[["t", "k", "x", "y"]]
        yield from _group_links(held, (key != key.shift()).any(axis=1).to_numpy(), radius)


def _group_links(part: pd.DataFrame, new: np.ndarray, radius: int):
    if len(part):
        fps = part["fp"].to_numpy(np.int64)
        a, b = links_of(np.cumsum(new), part["side"].to_numpy(), fps.view(np.uint64), radius)
        if len(a):
            yield fps[a], fps[b]


def simhash_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    pieces: int = PIECES,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per row of ``docs``: doc, row, fp (signed long) and component (smallest doc).

    Documents are linked when their fingerprints differ in ``radius`` bits or fewer;
    a component is all that links reach.  Null and empty texts, and texts of white
    space, have the fingerprint 0 and are linked like any other; fewer words than a
    shingle are one shingle.  Rows without an id take part but never name a component
    (one of such rows only has none).  Repeated rows come out repeated.  Extra columns
    are not read.  An empty table gives no rows.
    """
    rows = staged(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    stages = Stages(docs.sparkSession)
    least = stages.add(rows.groupBy("fp").agg(F.min("doc").alias("doc")), "distinct")
    roots = stages.add(components(links(least.select("fp"), radius, pieces, chunk)), "roots")
    joined = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "doc", F.coalesce("root", "fp").alias("root")
    )
    joined = stages.add(joined, "rooted")
    named = joined.groupBy("root").agg(F.min("doc").alias("component"))
    final = staged(joined.select("fp", "root").join(named, "root").select("fp", "component"), "components")
    stages.clear()
    return rows.join(final, "fp").select("doc", "row", "fp", "component")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without those that aren't the first of their group.

    The document whose id is the smallest of the group stays; rows that repeat it (id
    and text) stay with it, and rows without an id go where their group has an id.
    All columns pass through.
    """
    gone = simhash_groups(docs, doc_id, text, **how).where(
        F.col("component").isNotNull() & ~F.col("doc").eqNullSafe(F.col("component"))
    ).select(F.col("doc").alias("__doc"), F.col("row").alias("__row"))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__doc")) & (row_hash(F.col(f"`{text}`")) == F.col("__row"))
    return docs.join(gone, same, "left_anti")


def hex_of(fp: Column) -> Column:
    """A signed long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select(
        F.col("doc").alias("doc_id"), hex_of(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )
