"""Benchmark decontamination by a generalised suffix automaton.

The normalised words of all test items form one automaton.  Training words stream
through it; at each word it knows the longest run of words, ending there, that some
item contains.  A window (so many consecutive item words, or a whole shorter item)
occurs where that length reaches the window's, and the words it covers are hit.
Spans of hit words over a length limit are cut out of the text; documents over a
coverage limit go altogether.

An automaton is broadcast, so its size is bounded: items are dealt over shards of
about ``SHARD_WORDS`` words, built on the executors.  With one shard (most test
suites) documents are read once and nothing is shuffled; each further shard reads
them again and returns only the documents it hits.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hirelake.llm.common import LOWER, table

WINDOW = 10
#: Words of the items in one broadcast automaton (about 100 bytes each, twice as many states).
SHARD_WORDS = 200_000
#: Spans of more hit words than this are cut out; documents with a larger share of hit words go.
MAX_SPAN, MAX_COVERAGE = 5, 0.5

#: Bytes with A-Z lower-cased and all that is in no word as a blank.
_WORDS = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in LOWER
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ADDED = {
    "n_words": T.LongType(), "n_hit": T.LongType(), "longest": T.LongType(), "spans": _SPAN,
    "items": T.ArrayType(T.StringType()), "dropped": T.BooleanType(), "clean_text": T.StringType(),
}


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Automaton:
    """Suffix automaton of many word lists, with the windows each state ends."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        lists = []
        for item, own in items:
            if own:
                ids = [self.vocab.setdefault(w, len(self.vocab)) for w in own]
                lists.append((item, ids))
                last = 0
                for w in ids:
                    last = self._extend(last, w)
        #: By state: (length, items) of the windows whose text ends such a state.
        found: dict[int, dict[int, set[str]]] = {}
        self.shortest = window
        for item, ids in lists:
            size = min(window, len(ids))
            self.shortest = min(self.shortest, size)
            state = 0
            for i, w in enumerate(ids):
                state = self.next[state][w]
                if i + 1 >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    found.setdefault(at, {}).setdefault(size, set()).add(item)
        self.windows = {s: [(n, tuple(x)) for n, x in by.items()] for s, by in found.items()}
        #: The nearest state with windows, on the way from a state to the root; 0: none.
        self.nearest = [0] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.nearest[s] = s if s in self.windows else self.nearest[self.link[s]]

    def _state(self, length: int, follows: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(follows)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of the longest text that ends in p and then w; q holds longer ones too."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:  # another item has this text
            return self._split(last, w, self.next[last][w])
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.next[p][w])
        return new

    def scan(self, own: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit spans (first word, word after), items with windows here, longest match.

        A word no item has sends the automaton back to its root; runs of known words
        shorter than the shortest window can't complete one and are passed over.
        """
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        longest = 0
        if len(own) < self.shortest:
            return spans, items, 0
        known = bytes(map(self.vocab.__contains__, own))
        for run in re.finditer(b"\x01{%d,}" % self.shortest, known):
            state = n = 0
            for i in range(*run.span()):
                w = self.vocab[own[i]]
                while state and w not in self.next[state]:
                    state = self.link[state]
                    n = self.length[state]
                if w in self.next[state]:
                    state, n = self.next[state][w], n + 1
                longest = max(longest, n)
                at = self.nearest[state]
                while at:
                    for size, of in self.windows[at]:
                        if size <= n:
                            items.update(of)
                            start = i + 1 - size
                            while spans and spans[-1][1] >= start:
                                start = min(start, spans.pop()[0])
                            spans.append((start, i + 1))
                    at = self.nearest[self.link[at]]
        return spans, items, longest


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw)]
    out, done = [], 0
    for start, end in spans:
        out.append(raw[done : places[start][0]])
        done = places[end - 1][1]
    return b"".join([*out, raw[done:]]).decode("utf-8", "surrogatepass")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_LOADED: dict[str, Automaton] = {}


def _loaded(name: str, shard) -> Automaton:
    """The automaton of a broadcast, unpickled once in a Python worker, which keeps one."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = pickle.loads(shard.value)
    return _LOADED[name]


def _shards(items: DataFrame, item_id: str, text: str, window: int, shard_words: int) -> list:
    """Named broadcasts of pickled automata, each of about ``shard_words`` item words."""
    spark = items.sparkSession
    own = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text")).where(
        F.col("text").isNotNull()
    )
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // (6 * shard_words)))

    def build(pdf):
        import pandas as pd

        made = Automaton(((str(i), words(t)) for i, t in zip(pdf["item"], pdf["text"], strict=True)), window)
        return pd.DataFrame({"automaton": [pickle.dumps(made, protocol=5)]})

    built = (
        own.withColumn("item", F.coalesce("item", F.lit("")))
        .groupBy(F.pmod(F.hash("item", "text"), F.lit(n)).alias("shard"))
        .applyInPandas(build, "automaton binary")
    )
    return [
        (uuid4().hex, spark.sparkContext.broadcast(bytes(row["automaton"]))) for row in built.toLocalIterator()
    ]


def _scanned(batches: Iterator[pa.RecordBatch], shard, text: str, only_hits: bool, max_span: int, max_coverage: float):
    added = to_arrow_schema(T.StructType([T.StructField(n, t) for n, t in _ADDED.items()]))
    automaton = _loaded(*shard) if shard is not None else None
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            new: dict[str, list] = {name: [] for name in _ADDED}
            for body in batch.column(batch.schema.names.index(text)).to_pylist():
                own = words(body)
                spans, items, longest = automaton.scan(own) if automaton else ([], set(), 0)
                values = _verdict(body, own, spans, max_span, max_coverage)
                for name, v in (("n_words", len(own)), ("longest", longest), ("items", sorted(items)), *values.items()):
                    new[name].append(v)
            out = pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(new[f.name], f.type) for f in added)],
                schema=pa.schema([*batch.schema, *added]),
            )
            yield out.filter(pa.array([n > 0 for n in new["n_hit"]])) if only_hits else out


def _verdict(body: str | None, own: list, spans: list[tuple[int, int]], max_span: int, max_coverage: float) -> dict:
    hit = sum(end - start for start, end in spans)
    cut = [x for x in spans if x[1] - x[0] > max_span]
    return {
        "n_hit": hit, "spans": [{"start": a, "end": b} for a, b in spans], "dropped": hit > max_coverage * len(own),
        "clean_text": without(body, cut) if cut else body,
    }


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_span: int = MAX_SPAN,
    max_coverage: float = MAX_COVERAGE,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with n_words, n_hit, longest, spans, items, dropped and clean_text.

    ``spans`` are the merged runs of hit words, ``items`` the sorted ids (as strings)
    of items with an occurring window, ``longest`` the longest match in runs that
    could hold a window.  ``clean_text`` lacks the spans of over ``max_span`` words;
    ``dropped`` says that over ``max_coverage`` of the words are hit.

    A null or empty text has no words, is clean and stays as it is; items without
    words have no window; items without an id count under the id "".  Repeated rows
    and items are each treated alike.  No items or no documents: nothing is hit or
    returned.  Other columns pass through; ones named like an added column are
    replaced.
    """
    kept = [c for c in docs.columns if c not in _ADDED or c == text]
    if text in _ADDED:
        raise ValueError(f"the text column can't be called {text}")
    base = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*base.schema.fields, *[T.StructField(n, t) for n, t in _ADDED.items()]])
    shards = _shards(items, item_id, item_text, window, shard_words)

    def scan(df: DataFrame, shard, only_hits: bool) -> DataFrame:
        return df.mapInArrow(lambda b: _scanned(b, shard, text, only_hits, max_span, max_coverage), schema)

    first = scan(base, shards[0] if shards else None, False)
    if len(shards) < 2:
        return first
    return _joined(base, first, [scan(base, s, True) for s in shards[1:]], text, max_span, max_coverage, schema)


def _joined(base, first, others, text, max_span, max_coverage, schema) -> DataFrame:
    """The findings of all shards; the further ones are joined by a hash of the text,
    which decides them, as rows with equal texts have equal findings."""
    key = F.xxhash64(F.col(f"`{text}`"), F.length(F.col(f"`{text}`")))
    more = None
    for df in others:
        part = df.select(key.alias("__key"), F.col("spans").alias("__s"), F.col("items").alias("__i"), F.col("longest").alias("__l"))
        more = part if more is None else more.unionByName(part)
    merged = more.dropDuplicates().groupBy("__key").agg(
        F.array_distinct(F.flatten(F.collect_list("__s"))).alias("__s"),
        F.array_distinct(F.flatten(F.collect_list("__i"))).alias("__i"),
        F.max("__l").alias("__l"),
    )
    both = first.withColumn("__key", key).join(merged, "__key", "left").drop("__key")

    def fold(batches):
        added = to_arrow_schema(T.StructType([T.StructField(n, t) for n, t in _ADDED.items()]))
        for batch in batches:
            rows = batch.select([text, *_ADDED, "__s", "__i", "__l"]).to_pylist()
            for r in rows:
                spans = _merged([(s["start"], s["end"]) for s in [*r["spans"], *(r["__s"] or [])]])
                r["items"] = sorted({*r["items"], *(r["__i"] or [])})
                r["longest"] = max(r["longest"], r["__l"] or 0)
                r |= _verdict(r[text], range(r["n_words"]), spans, max_span, max_coverage)
            own = [n for n in batch.schema.names if n not in _ADDED and n not in ("__s", "__i", "__l")]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(own).columns, *(pa.array([r[f.name] for r in rows], f.type) for f in added)],
                schema=pa.schema([*(batch.schema.field(n) for n in own), *added]),
            )

    return both.mapInArrow(fold, schema)


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0))
), dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (
  SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN its USING (doc_id)
"""
