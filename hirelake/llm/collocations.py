"""Phrase collocations by Toivonen's mining.

A sample of the documents proposes phrases: those frequent in it at a lowered limit.  One
pass over all documents then counts exactly the proposed phrases and their negative
border, that is every occurring phrase whose parts (without its first and without its
last word) are proposed.  Where a phrase of the border turns out frequent, phrases that
extend it have not been counted: it is added to the proposals, and one further pass counts
every phrase not counted so far whose parts are proposed or not counted so far either.
Then all frequent phrases are counted, whatever the sample was, as the parts of a
frequent phrase are frequent.

Proposals go to the tasks as a bitmap of fixed size with a bit for each phrase's hash: a
shared bit lets a phrase too many be counted, and counts are of the phrases themselves.
So nothing that grows with the data is broadcast.  Tasks count blocks of words with
numpy and send each block's distinct phrases with their counts into the shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from hirelake.llm.common import LOWER, Stages, table

MIN_COUNT, LONGEST, TOP = 30, 4, 2000
COVERED = 80  # percent of its occurrences within a longer phrase that make a phrase go
SCORE_UNIT = 2_000_000
#: The sample's part of the documents, and the part of the expected count that is asked there.
SAMPLE, LOWERED = 0.25, 0.8
#: Bits of the proposals' bitmap (2^27: 16 MB), and words that a task counts at once.
BITS, BLOCK = 27, 1_000_000
_BREAK, _NONE = 0, 1  # codes of a piece's end and of the nothing between two spaces
_TABLE = LOWER.translate(bytes(32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256)))
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Vocabulary(dict):
    """Codes of words, given in the order of their first use."""

    def __init__(self):
        super().__init__({b"\n": _BREAK, b"": _NONE})

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def pieces(text: str | None) -> list[bytes]:
    """Words in lower case, with a newline where a piece ends and empty strings that say nothing."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).replace(b"\n", b" \n ").split(b" ")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def _hashed(lang: str, parts: list[np.ndarray]) -> np.ndarray:
    """A hash of each phrase, from the hashes of its words (one array a place)."""
    h = np.full(len(parts[0]), xxh64_intdigest(lang), np.uint64)
    for words in parts:
        h = _mixed(h * _STEP + words)
    return h


def _held(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    at = hashes >> np.uint64(64 - bits)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _distinct(key: np.ndarray):
    """Of each key its number in order of first use; of each number its first place and its count."""
    own, distinct = pd.factorize(key)
    first = np.empty(len(distinct), np.int64)
    first[own[::-1]] = np.arange(len(key))[::-1]
    return own, first, np.bincount(own, minlength=len(distinct))


class _Counter:
    """Counts the phrases of one language's words that a pass asks for.

    ``known`` has the proposals; ``before``, in a further pass, those of the first pass, which
    tell what that pass counted.
    """

    def __init__(self, lengths: range, known: np.ndarray | None, before: np.ndarray | None, bits: int):
        self.lengths, self.known, self.before, self.bits = lengths, known, before, bits

    def counts(self, lang: str, codes: np.ndarray, words: pa.Array, hashes: np.ndarray):
        """(phrases, counts) of each length; the empty phrase stands for all words."""
        codes = codes[codes != _NONE]
        size, n = len(words), len(codes)
        places = np.flatnonzero(codes > _NONE)
        if 1 in self.lengths:
            yield pa.array([b""], pa.binary()), np.array([len(places)])
        of_word = hashes[codes]
        made = np.full(n, xxh64_intdigest(lang), np.uint64)  # hash of the phrase that starts at a place
        number = codes  # of that phrase, among those of its length; kept in a first pass only
        for k in range(1, self.lengths.stop):
            asked, counted = places, None
            if k > 1:
                # Both parts may be frequent; and, in a further pass, were not both proposed before.
                both = known[:-1] & known[1:]
                both[-(k - 1) :] = False
                places = asked = np.flatnonzero(both)
                if self.before is not None:
                    counted = before[places] & before[places + 1]
                    asked = places[~counted]
            if not len(places):
                return
            if self.before is None:
                key = number[places] if k == 1 else number[places] * size + codes[places + k - 1]
                own, first, count = _distinct(key)
                number = np.zeros(n, np.int64)
                number[places] = own
            elif k in self.lengths and len(asked):
                # Little is asked in a further pass, so only that is numbered, from its first word on.
                key = codes[asked]
                for i in range(1, k):
                    key = pd.factorize(key)[0] * size + codes[asked + i]
                _, first, count = _distinct(key)
            if k in self.lengths and len(asked):
                parts = [words.take(pa.array(codes[asked[first] + i])) for i in range(k)]
                yield parts[0] if k == 1 else pc.binary_join_element_wise(*parts, b" "), count
            if k + 1 == self.lengths.stop:
                return
            made[places] = _mixed(made[places] * _STEP + of_word[places + k - 1])
            known, before = self._flags(made[places], places, counted, n)

    def _flags(self, made: np.ndarray, places: np.ndarray, counted: np.ndarray | None, n: int):
        """By place: whether its phrase may be frequent, and whether the first pass counted and
        proposed it.  A bit may be shared, so a bit alone doesn't tell that it was counted."""
        known, before = np.zeros(n, bool), np.zeros(n, bool)
        proposed = _held(self.known, made, self.bits)
        if self.before is not None:
            old = proposed if counted is None else proposed & counted
            before[places] = old
            before[places[old]] = _held(self.before, made[old], self.bits)
        known[places] = proposed if counted is None else proposed | ~counted
        return known, before

    def run(self, batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
        held, words, total = {}, _Vocabulary(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for lang, text in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                    parts = pieces(text)
                    parts.append(b"\n")
                    codes = np.fromiter(map(words.__getitem__, parts), np.int64, len(parts))
                    held.setdefault(lang, []).append(codes)
                    total += len(codes)
                    if total >= block:
                        yield from self._sent(held, words)
                        held, words, total = {}, _Vocabulary(), 0
        yield from self._sent(held, words)
        # The worker stays for later tasks; its unused memory goes back.
        del held, words
        pa.default_memory_pool().release_unused()

    def _sent(self, held: dict[str, list[np.ndarray]], words: _Vocabulary) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        hashes = np.array([xxh64_intdigest(w) for w in words], np.uint64)
        names = pa.array(list(words), pa.binary())
        for lang in sorted(held):
            for phrases, counts in self.counts(lang, np.concatenate(held.pop(lang)), names, hashes):
                for start in range(0, len(phrases), 65536):
                    part = phrases.slice(start, 65536)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), part.cast(pa.string()), pa.array(counts[start : start + 65536].astype(np.int64))],
                        ["lang", "phrase", "f"],
                    )


def bitmap_of(phrases: DataFrame, bits: int = BITS) -> np.ndarray:
    """2^bits bits, those set that the hashes of ``phrases`` (lang, phrase) name."""

    def places(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for lang, phrase in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = [np.array([xxh64_intdigest(w)], np.uint64) for w in phrase.encode().split(b" ")]
                out.append(int(_hashed(lang, parts)[0]) >> (64 - bits))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["at"])

    # Spark numbers bits from 1; a bucket has 32,768.
    made = phrases.select("lang", "phrase").mapInArrow(places, "at long").select((F.col("at") + 1).alias("at"))
    buckets = made.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )
    whole = np.zeros(max(4096, 1 << (bits - 3)), np.uint8)
    for row in buckets.collect():  # 2^bits bits at most
        whole[4096 * (row["bucket"] - 1) : 4096 * row["bucket"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return whole


@contextmanager
def _counting(texts: DataFrame, known: np.ndarray, before: np.ndarray | None, bits: int, block: int):
    """Gives a function of lengths that gives (lang, phrase, f): all phrases of those lengths
    that the pass counts, f over all of ``texts``.  What it gives is good within the context."""
    context = texts.sparkSession.sparkContext
    sent = [None if b is None else context.broadcast(zlib.compress(b.tobytes(), 1)) for b in (known, before)]

    def counted(lengths: range) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]):
            bitmaps = [None if b is None else np.frombuffer(zlib.decompress(b.value), np.uint8) for b in sent]
            yield from _Counter(lengths, *bitmaps, bits).run(batches, block)

        # A block's phrases are distinct already, so they are dealt first and added up then.
        parts = texts.mapInArrow(run, "lang string, phrase string, f long").repartition("lang", "phrase")
        return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))

    try:
        yield counted
    finally:
        for b in sent:
            if b is not None:
                b.destroy()


def _length() -> F.Column:
    """Words of the phrase; the empty phrase has none."""
    return F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))


def frequent_phrases(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    sample: float = SAMPLE,
    bits: int = BITS,
    block: int = BLOCK,
    stages: Stages | None = None,
) -> DataFrame:
    """(lang, phrase, f, k) of all phrases of 1 to ``longest`` words found ``min_count`` times
    or more in a language, and of each language's empty phrase (k = 0), f being its words.

    The sample decides only how much is counted, and whether a second pass is taken.
    """
    stages = stages or Stages(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text")
    )
    drawn = texts.where(F.rand(11) < sample)
    asked = max(1, int(min_count * sample * LOWERED))
    known = np.zeros(max(4096, 1 << (bits - 3)), np.uint8)
    for k in range(1, longest):
        with _counting(drawn, known, None, bits, block) as counted:
            found = counted(range(k, k + 1)).where((F.col("f") >= asked) & (F.col("phrase") != ""))
            known = known | bitmap_of(found, bits)

    def counted_table(known: np.ndarray, before: np.ndarray | None) -> DataFrame:
        with _counting(texts, known, before, bits, block) as counted:
            lengths = range(1 if before is None else 2, longest + 1)
            kept = counted(lengths).where((F.col("f") >= min_count) | (F.col("phrase") == ""))
            return stages.add(kept.withColumn("k", _length()), "phrases")

    first = counted_table(known, None)
    found = bitmap_of(first.where((F.col("k") > 0) & (F.col("k") < longest)), bits)
    if not (found & ~known).any():  # the border has held
        return first
    return first.unionByName(counted_table(known | found, known))


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    longest: int = LONGEST,
    covered: int = COVERED,
    sample: float = SAMPLE,
    bits: int = BITS,
    block: int = BLOCK,
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Words are what spaces and tabs part within pieces, which end at ``. , ; : ! ?`` and line
    breaks; A-Z are lower-cased.  A phrase has 2 to ``longest`` words of one piece and
    occurs a >= ``min_count`` times; its score is that of its worst cut into a first part
    found l times and a rest found r times, floor(2000000 a / (l + r)).  Phrases found to
    ``covered`` percent or more within one longer such phrase are dropped.  Ties go to
    the more frequent, then to the lesser phrase by its bytes.

    Rows without a language count as ``und``; null and empty texts have no words; repeated
    rows count as often as they stand; other columns are not read.  Languages without a
    phrase, and an empty table, give no rows.
    """
    stages = Stages(docs.sparkSession)
    frequent = stages.add(
        frequent_phrases(docs, lang, text, min_count, longest, sample, bits, block, stages), "frequent"
    )
    stages.clear(keep=1)
    words = frequent.where("k = 0").select("lang", F.col("f").alias("n"))
    counts = frequent.where("k > 0").select("lang", "phrase", "f")
    candidates = frequent.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), "k", F.split("phrase", " ").alias("w"))

    cuts = candidates.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut",
        F.concat_ws(" ", F.slice("w", F.lit(1), F.col("cut"))).alias("first"),
        F.concat_ws(" ", F.expr("slice(w, cut + 1, size(w))")).alias("rest"),
    )
    part = lambda own, f: counts.select("lang", F.col("phrase").alias(own), F.col("f").alias(f))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = (
        cuts.join(part("first", "l"), ["lang", "first"])
        .join(part("rest", "r"), ["lang", "rest"])
        .withColumn("unit", wide("a") * F.lit(SCORE_UNIT).cast("decimal(7,0)"))
        .withColumn("parts", wide("l") + wide("r"))
        .withColumn("score", F.expr("unit div parts"))
    )
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))

    inner = candidates.where("k > 2").select(
        "lang", "a", "k", "w", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("length")
    )
    inner = inner.select("lang", "a", "w", "length", F.explode(F.sequence(F.lit(1), F.expr("k - length + 1"))).alias("at"))
    longer = inner.groupBy("lang", F.expr("concat_ws(' ', slice(w, at, length))").alias("phrase")).agg(F.max("a").alias("within"))
    own = (
        worst.join(longer, ["lang", "phrase"], "left")
        .where(F.col("within").isNull() | (wide("within") * 100 < wide("a") * covered))
        .select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
    )
    # The best of each of 64 parts of a language first, so no task ranks a whole language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    spread = own.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE i + k - 1 <= len(w)
), total AS (
  SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), f AS (
  SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY lang, phrase, k HAVING count(*) >= 30
), c AS (
  SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w FROM f WHERE k >= 2
), cuts AS (
  SELECT lang, phrase, a, w, unnest(range(1, k)) AS cut FROM c
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cut, x.f AS l, y.f AS r,
         CAST((CAST(2000000 AS HUGEINT) * cuts.a) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts
  JOIN f AS x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1 : cut], ' ')
  JOIN f AS y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[cut + 1 : len(w)], ' ')
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), sizes AS (
  SELECT lang, a, k, w, unnest(range(2, k)) AS s FROM c WHERE k > 2
), inner_at AS (
  SELECT lang, a, w, s, unnest(range(1, k - s + 2)) AS i FROM sizes
), longer AS (
  SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS within FROM inner_at GROUP BY 1, 2
), ranked AS (
  SELECT worst.*, row_number() OVER (PARTITION BY worst.lang ORDER BY score DESC, a DESC, encode(worst.phrase)) AS rank
  FROM worst LEFT JOIN longer ON longer.lang = worst.lang AND longer.phrase = worst.phrase
  WHERE within IS NULL OR CAST(100 AS HUGEINT) * within < CAST(80 AS HUGEINT) * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
