"""Embedding whitening by shifted CholeskyQR.

Entries are rounded to whole numbers x, so sums are exact.  The centred rows A of the fit
list are made orthogonal in passes: a pass adds up the Gram matrix G of Q = A / R by
partitions, the driver factors G (plus a shift in the first pass, and wherever G is not
positive definite) as L L^T, and R becomes L^T R.  Once Q's columns are orthonormal,
A = Q R, and the singular vectors and values of the small matrix R are those of A: no
covariance matrix is decomposed, so small components keep their digits.

A pass keeps one Gram matrix a task; these are added up in two shuffles, so the driver
gets one matrix of dimension^2 numbers, whatever the number of rows.  The
dimension is bounded by ``MAX_DIMENSION``.  Every pass reads the table again and writes
nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import table

SCALE, OFFSET, COMPONENTS = 1024, 100000, 8
#: The driver and each task hold a few matrices of this many rows and columns (128 MB each).
MAX_DIMENSION = 4096
#: Entries from here on count as non-finite: sums of any number of rows keep within two words.
MAX_ENTRY = 2.0**40
#: A pass ends the work once no entry of Q's Gram matrix is farther from the identity.
ORTHOGONAL, MAX_PASSES = 1e-10, 12
#: Singular values below this part of the largest are rounding errors, not components.
RANK = 1e-12
#: Rows multiplied at once, tasks that add up partial sums, entries of a piece of these.
_BLOCK, _PARTS, _PIECE = 4096, 8, 1024
_LOW = np.int64((1 << 32) - 1)


def _rows(batch: pa.RecordBatch, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers x of the batch's fit rows, and their places in the batch."""
    column = batch.column(batch.num_columns - 1)
    lengths = np.diff(column.offsets.to_numpy())
    if column.null_count:
        lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), -1, lengths)
    at = np.flatnonzero(lengths == dimension)
    if not len(at):
        return np.zeros((0, dimension), np.int64), at
    values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dimension)
    with np.errstate(invalid="ignore"):
        fit = (np.abs(values) < MAX_ENTRY).all(1)  # null entries arrive as NaN
    return np.floor(SCALE * values[fit]).astype(np.int64) + OFFSET, at[fit]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit whole numbers where they suffice, else Python's."""
    if n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums)) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int):
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(start, _BLOCK)
            x, at = _rows(part, dimension)
            if len(x):
                yield part, x, at


def _total(vectors: DataFrame, part: Callable, kind: type) -> np.ndarray | None:
    """The arrays of ``kind`` that ``part`` makes of each partition's batches, added up entry by entry.

    None where no task has one.  Arrays travel in short pieces, so an Arrow batch stays
    small; they are added in ``_PARTS`` tasks first, then piece by piece.
    """
    schema = "piece int, entries binary"

    def sent(totals: dict[int, np.ndarray]):
        for i, entries in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([entries.tobytes()], pa.binary())], ["piece", "entries"])

    def first(batches):
        made = part(batches)
        if made is not None:
            flat = made.ravel()
            yield from sent({i: flat[at : at + _PIECE] for i, at in enumerate(range(0, len(flat), _PIECE))})

    def added(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, entries in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(entries, kind)
                totals[i] = totals[i] + own if i in totals else own
        yield from sent(totals)

    parts = vectors.mapInArrow(first, schema).repartition(_PARTS).mapInArrow(added, schema)
    # dimension^2 numbers, whatever the number of rows
    rows = sorted(parts.repartition(_PARTS, "piece").mapInArrow(added, schema).collect())
    return np.concatenate([np.frombuffer(bytes(r["entries"]), kind) for r in rows]) if rows else None


def _joined(total: np.ndarray) -> list[int]:
    """Sums from (count, high words, low words)."""
    d = (len(total) - 1) // 2
    return [(int(h) << 32) + int(lo) for h, lo in zip(total[1 : 1 + d], total[1 + d :], strict=True)]


def fit_sums(vectors: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """The number of fit rows and the exact sum of each dimension."""

    def part(batches):
        total = None
        for _, x, _ in _blocks(batches, dimension):
            own = np.concatenate([[len(x)], (x >> np.int64(32)).sum(0), (x & _LOW).sum(0)]).astype(np.int64)
            total = own if total is None else total + own
        if total is not None:  # low words below 2^32 again
            total[1 : 1 + dimension] += total[1 + dimension :] >> np.int64(32)
            total[1 + dimension :] &= _LOW
        return total

    total = _total(vectors, part, np.int64)
    return (0, [0] * dimension) if total is None else (int(total[0]), _joined(total))


def gram(vectors: DataFrame, n: int, sums: list[int], into: np.ndarray) -> np.ndarray:
    """Sum of q^T q over the centred fit rows a, where q = a @ ``into``."""
    dimension, width = into.shape

    def part(batches):
        total = None
        for _, x, _ in _blocks(batches, dimension):
            q = (_centred(x, n, sums) / n).astype(np.float64) @ into
            total = q.T @ q if total is None else total + q.T @ q
        return total

    total = _total(vectors, part, np.float64)
    return np.zeros((width, width)) if total is None else total.reshape(width, width)


def _factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular R with R^T R = g + shift * I; a larger shift where that fails."""
    unit = 11 * len(g) * (len(g) + 1) * np.finfo(np.float64).eps * max(np.trace(g), np.finfo(np.float64).tiny)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(unit, 100 * shift)


def orthogonal(vectors: DataFrame, n: int, sums: list[int]) -> tuple[np.ndarray, float]:
    """(M, trace): M has the singular values and right singular vectors of the centred rows."""
    dimension = len(sums)
    identity = np.eye(dimension)
    g = gram(vectors, n, sums, identity)
    trace = float(np.trace(g))
    if trace == 0:
        return np.zeros((dimension, dimension)), 0.0
    r = _factor(g, 11 * dimension * (dimension + 1) * np.finfo(np.float64).eps * trace)
    for done in range(MAX_PASSES):
        g = gram(vectors, n, sums, np.linalg.solve(r, identity))
        if np.abs(g - identity).max() <= ORTHOGONAL:
            break
        # After two shifted passes only directions without any spread are still short.
        values, turn = np.linalg.eigh(g)
        if done > 1 and ((np.abs(values - 1) <= ORTHOGONAL) | (values <= 1e-3)).all():
            return turn * np.sqrt(np.where(values > 0.5, values, 0)) @ turn.T @ r, trace
        r = _factor(g, 0.0) @ r
    return r, trace


def whiten(
    embeddings: DataFrame,
    row_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """(row_id, component, n, deviation, whitened, explained, identity_error) per fit row and component.

    Rows whose vector is null or holds a null or non-finite entry (or one of 2^40 or more) are
    dropped.  Vectors of another length than the most frequent one (of two, the longer)
    have no covariance with the others and are dropped too; so are empty ones.  Rows
    without an id and repeated rows count and come out as often as they stand.  There are
    as many components as the rank has, ``components`` at most: equal rows, one row and no
    rows have none and give no rows.  ``deviation`` is a decimal(38,0); it grows with
    n^2.  Other columns are not read.  A length over ``MAX_DIMENSION`` is an error.
    """
    kind = embeddings.schema[row_id].dataType
    vectors = embeddings.select(F.col(f"`{row_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    schema = T.StructType(
        [
            T.StructField(row_id, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
            T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
        ]
    )
    none = embeddings.sparkSession.createDataFrame([], schema)
    usable = (F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(F.abs(c) < MAX_ENTRY, F.lit(False)))
    lengths = vectors.where(usable).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return none
    dimension = lengths["d"]
    if dimension > MAX_DIMENSION:
        raise ValueError(f"vectors of {dimension} entries; {MAX_DIMENSION} at most")
    n, sums = fit_sums(vectors, dimension)
    m, trace = orthogonal(vectors, n, sums)
    _, sigma, turned = np.linalg.svd(m)
    found = min(components, int((sigma > RANK * sigma[0]).sum())) if trace else 0
    if not found:
        return none
    axes, spread = turned[:found].T, sigma[:found] / np.sqrt(n)
    into = axes / spread
    error = float(np.abs(gram(vectors, n, sums, into) / n - np.eye(found)).max())
    explained = spread**2 * n / trace

    def run(batches: Iterator[pa.RecordBatch]):
        for part, x, at in _blocks(batches, dimension):
            y = _centred(x, n, sums)
            small = y.dtype != object and dimension * int(np.abs(y).max(initial=0)) ** 2 < 1 << 62
            squares = (y * y if small else y.astype(object) ** 2).sum(1)
            out = (y / n).astype(np.float64) @ into
            own = np.repeat(np.arange(len(x)), found)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(at[own])),
                    pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(own), n, np.int64)),
                    pa.array([int(s) for s in squares], pa.decimal128(38, 0)).take(pa.array(own)),
                    pa.array(out.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(own), error)),
                ],
                [f.name for f in schema],
            )

    return vectors.mapInArrow(run, schema)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """A deviation beyond 64 bits is an error here; ``whiten`` has it in full."""
    made = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return made.withColumn("deviation", F.col("deviation").cast("long"))
