"""Connected components of a table of links: each task joins what its own links join, then
large-star and small-star rounds join what is left.

Up to ``WHOLE`` links are one task's, so no rounds follow; each would be half a dozen
jobs, whose plans and compiled code the driver holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import SMALL, Stages, portions

#: Links that a task joins at once; it holds some 150 bytes for each.
WHOLE = 1_000_000


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of each node's part, for links a-b among n nodes."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        # Labels move besides the nodes that have them, so long chains take few steps.
        for ends in (a, b, label[a], label[b]):
            np.minimum.at(new, ends, least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def _joined(batches: Iterator[pa.RecordBatch], whole: int) -> Iterator[pa.RecordBatch]:
    """Links of each node to the least node that the links (u, v) of its block join it to."""
    for held in portions((b for b in batches if b.num_rows), lambda b: b.num_rows, whole):
        u, v = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
        nodes, at = np.unique(np.r_[u, v], return_inverse=True)
        root = stars(len(nodes), at[: len(u)], at[len(u) :])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["u", "v"])


def _star(links: DataFrame, large: bool, stages: Stages) -> DataFrame:
    """Each node's neighbours on one side are linked to its least neighbour.

    The least neighbours are written first, so that both sides of the join are plain
    exchanges, whose large partitions (the hub of a star) Spark splits.
    """
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = stages.add(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least", release=True)
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def _settled(now: DataFrame, rounds: int, stages: Stages) -> DataFrame:
    """The stars that ``now`` (u > v), the last of ``stages``, comes down to."""
    print_of = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = print_of(now)
    for _ in range(rounds):
        # The first star is written too, as the second reads it twice.
        wide = stages.add(_star(now, True, stages).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "star", release=True)
        now = stages.add(_star(wide, False, stages), "links", release=True)
        stages.clear(keep=1)
        after = print_of(now)
        if after == before:
            return now
        before = after
    raise RuntimeError(f"{rounds} rounds did not settle the components")


def components(links: DataFrame, rounds: int = 50, whole: int = WHOLE) -> DataFrame:
    """(node, root) of every node in ``links`` (u long, v long) that isn't its own root.

    The root is the smallest node of the component.  Each round is written to the
    shared folder and read again, so lineage stays short and a lost executor costs one
    round; what earlier rounds wrote is deleted.  Links with a null end or of a node with itself say nothing; no links give
    no rows.  Raises if ``rounds`` don't settle the graph, rather than return parts.
    """
    down = lambda df: df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stages = Stages(links.sparkSession, SMALL)
    now = stages.add(down(links.where("u <> v")).distinct(), "links", release=True)
    n = now.count()
    # Few enough links are one task's block, whose stars are the components.
    dealt = now.coalesce(1) if n <= whole else now
    now = stages.add(dealt.mapInArrow(lambda batches: _joined(batches, whole), "u long, v long"), "links")
    stages.clear(keep=1)
    if n > whole:
        now = _settled(now, rounds, stages)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
