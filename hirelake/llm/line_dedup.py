"""Line dedup: lines that many documents share are dropped from all but one.

Lines are exploded with their position and the hash of their normalised form; the
distinct documents of each hash are counted; lines of hashes over the threshold
are dropped and what is left is put together by position.

A hash that a third of all documents hold never meets in one task: its documents
are made distinct under (hash, document), counted with map-side sums, and the few
frequent hashes are repeated over salts for the way back.
"""

from __future__ import annotations

from collections.abc import Iterator
from struct import unpack

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from hirelake.llm.common import LOWER, SPACES, table, unused

MIN_CHARS = 40
MIN_DOCS = 5
SALTS = 32
LINES = "row long, h1 long, h2 long, at array<int>"


def line_key(line: str) -> bytes:
    """The line without ASCII white space at its ends, A-Z lower-cased, in UTF-8."""
    return line.strip(SPACES).encode("utf-8", "surrogatepass").translate(LOWER)


def exploded(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Per document and key of at least ``min_chars``: the key's hash and where its lines are."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            of, h1, h2, at = [], [], [], []
            for i, text in enumerate(part.column(2).to_pylist()):
                keys: dict[bytes, list[int]] = {}
                for n, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(line.strip(SPACES)) >= min_chars:
                        keys.setdefault(line_key(line), []).append(n)
                for key, lines in keys.items():
                    a, b = unpack("<qq", xxh3_128_digest(key))
                    of.append(i)
                    h1.append(a)
                    h2.append(b)
                    at.append(lines)
            own = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(own), part.column(1).take(own), pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()), pa.array(at, pa.list_(pa.int32())),
                ],
                ["doc", "row", "h1", "h2", "at"],
            )


def without(text: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without the lines at the positions in ``gone``; null where there is no text."""

    def one(lines: str | None, at) -> str | None:
        if lines is None:
            return None
        out = set(at.tolist())
        return "\n".join([line for i, line in enumerate(lines.split("\n")) if i not in out])

    return pd.Series([one(t, g) for t, g in zip(text, gone, strict=True)], dtype=object)


def line_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    salts: int = SALTS,
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``; all rows stay.

    Lines are split at newline; a null or empty text is one empty line and its
    ``kept_text`` is empty.  Keys of at least ``min_chars`` code points held by at
    least ``min_docs`` distinct documents lose all their lines except in the largest
    document id that holds them.  Rows of one id count as one document, and so do
    all rows without an id, which rank below any id.  Repeated rows are each
    treated alike.  Ids may be of any type that Spark sorts; they compare as it sorts
    them.  A table without rows gives no rows.  Other columns pass through, whatever
    their names; own ones called kept_text, n_lines or n_dropped are replaced.
    """
    rest = [c for c in docs.columns if c.lower() not in ("kept_text", "n_lines", "n_dropped")]
    gone, key, of, row = (unused(docs, c) for c in ("__gone", "__key", "__of", "__row"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # A row is known by its id and the hash of its text: rows alike in both are treated alike.
    schema = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), *T.StructType.fromDDL(LINES).fields])
    lines = docs.select(
        F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(body).alias("row"), body.alias("text")
    ).mapInArrow(lambda batches: exploded(batches, min_chars), schema)
    held = lines.select("h1", "h2", "doc").distinct()
    frequent = (
        held.groupBy("h1", "h2")
        .agg(F.count("*").alias("docs"), F.max("doc").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .select("h1", "h2", "keeper", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    )
    dropped = (
        lines.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int"))
        .join(frequent, ["h1", "h2", "salt"])
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc").alias(of), F.col("row").alias(row))
        .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias(gone))
    )
    joined = docs.select(*[F.col(f"`{c}`") for c in rest], F.xxhash64(body).alias(key)).join(
        dropped, F.col(f"`{doc_id}`").eqNullSafe(F.col(of)) & (F.col(key) == F.col(row)), "left"
    )
    # Only texts that lose lines go to Python.
    kept = F.pandas_udf(without, "string")(F.when(F.col(gone).isNotNull(), body), F.col(gone))
    return joined.select(
        *[F.col(f"`{c}`") for c in rest],
        F.when(F.col(gone).isNull(), body).otherwise(kept).alias("kept_text"),
        F.size(F.split(body, "\n", -1)).cast("long").alias("n_lines"),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"),
    )


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, i AS pos, x[i] AS line,
         translate(trim(x[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))
), f AS (
  SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT l.doc_id, l.pos, l.line, f.k IS NOT NULL AND l.doc_id <> f.keeper AS gone
  FROM l LEFT JOIN f ON l.k = f.k
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
