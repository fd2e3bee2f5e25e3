"""Sharding by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in the order of a permutation of
its own.  Shards take turns; each claims the first slot of its order that is free,
until the table is full.  So shards have equally many slots, give or take one, and when
a shard leaves, few slots but its own change hands.  A key's hash names a slot, and the
table, whose size is fixed, is broadcast: placement is one lookup.

The table is filled on the driver, as its size doesn't depend on the data; all that is
done to rows are SQL functions and a broadcast join.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import table

#: Slots; a prime, and a hundred times the shards or more.
SIZE = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(256))


def _is_prime(n: int) -> bool:
    return n > 2 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(shards: tuple[str, ...] | list[str], size: int = SIZE) -> list[int]:
    """The number of the shard that has each slot."""
    names = list(shards)
    if not names or len(set(names)) < len(names) or not _is_prime(size) or size < len(names):
        raise ValueError("the shards must be distinct, and the table's size a prime, no less than their number")
    steps = []
    for name in names:
        h = md5(name.encode()).digest()
        steps.append((int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:], "big") % (size - 1) + 1))
    at = [0] * len(names)
    slots = [-1] * size
    left = size
    while True:
        for i, (offset, skip) in enumerate(steps):
            slot = (offset + at[i] * skip) % size
            while slots[slot] >= 0:
                at[i] += 1
                slot = (offset + at[i] * skip) % size
            slots[slot] = i
            at[i] += 1
            left -= 1
            if not left:
                return slots


def lookup(spark: SparkSession, shards: tuple[str, ...] | list[str], size: int = SIZE) -> DataFrame:
    """(slot, shard) for each slot, as a table of one row of text taken apart."""
    slots = ",".join(map(str, fill(shards, size)))
    names = F.array(*[F.lit(s) for s in shards])
    return spark.range(1).select(F.posexplode(F.split(F.lit(slots), ",")).alias("slot", "number")).select(
        F.col("slot").cast("long").alias("slot"), F.element_at(names, F.col("number").cast("int") + 1).alias("shard")
    )


def slot_of(key: Column, size: int = SIZE) -> Column:
    """The slot of a key's text: 60 bits of its MD5; a null key is the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % size


def place(df: DataFrame, key: str, shards: tuple[str, ...] | list[str] = SHARDS, size: int = SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard``, by the column ``key``.

    Rows of equal keys, repeated rows among them, go to the same shard; null keys go
    where the empty text goes.  Texts aren't looked at.  Other columns pass through;
    ones called slot or shard, in any case, are replaced (the key itself can't be).
    No rows give no rows.
    """
    if key.lower() in ("slot", "shard"):
        raise ValueError("the key can't be called slot or shard")
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    placed = df.select(*rest, slot_of(F.col(f"`{key}`"), size).alias("slot"))
    # ``size`` rows, whatever the data.
    return placed.join(F.broadcast(lookup(df.sparkSession, shards, size)), "slot", "left").select(*rest, "slot", "shard")


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "slot", "shard")


def op5_sql() -> str:
    """The lookup with the filled table as text; how it is filled is tested by itself."""
    slots = ",".join(map(str, fill(SHARDS)))
    return f"""
WITH t AS (SELECT string_split('{slots}', ',') AS s),
k AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SIZE} AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(s[slot + 1], 3, '0') AS shard FROM k, t
"""
