"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

A character n-gram model per language is trained on trusted text.  Its counts are a
table keyed by (language, n-gram); the highest order counts occurrences, lower ones
the distinct characters before.  Probabilities of the n-grams that the documents ask
for come from joins with these tables, order by order.

Documents aren't exploded into n-grams: they stand in blocks, as Arrow batches, and a
block asks once for each distinct n-gram in it.  The answers go back to the blocks,
and each block adds up its documents' log-probabilities.  What is shuffled is each
block's distinct n-grams, there and back, and the compressed documents once.

A document is rejected if its perplexity is over the quantile of its language, taken
over trusted documents that the model was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import Stages, portions, table

ORDER = 4
#: Quantile of the trusted perplexities over which a document is rejected.
QUANTILE = 0.995
#: The limit is so many times as far from the median as the quantile, in logarithms, as a
#: quantile of a few hundred documents, most of them good, is a narrow one.
SLACK = 1.5
#: Characters at the usual perplexity that are added to each text.
PRIOR = 100
#: Trusted ids in one broadcast; there are as many broadcasts as it takes for all of them.
SHARD_TRUSTED = 1_000_000
#: Of the trusted documents, one in so many sets the thresholds instead of training.
HOLD_OUT = 5
#: Characters of a block and of a portion that is worked on at once.
BLOCK, PORTION = 32_000_000, 2_000_000
#: N-grams of a block that a task holds before it hands them on.
HELD = 500_000
_START = "\x02"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                     0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def normalised(text: str | None) -> str:
    """White space runs are one blank, none at the ends."""
    return " ".join((text or "").split())


class Grams:
    """The n-grams of some texts: of each character with those before it in its text."""

    def __init__(self, texts: list[str], order: int):
        pad = _START * (order - 1)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        joined = "".join(x for t in texts for x in (pad, t))
        self.chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(self.lengths + order - 1) - self.lengths
        #: For each character of the texts, where its n-gram begins.
        self.at = np.repeat(starts - (np.cumsum(self.lengths) - self.lengths), self.lengths) + np.arange(self.lengths.sum()) - (order - 1)
        keys = np.zeros(max(0, len(self.chars) - order + 1), np.uint64)
        for k in range(order):
            keys += self.chars[k : k + len(keys)].astype(np.uint64) * _FACTORS[k]
        #: Each character's n-gram, numbered in order of first occurrence.
        self.ids, distinct = pd.factorize(keys[self.at])
        first = np.empty(len(distinct), np.int64)
        first[self.ids[::-1]] = self.at[::-1]
        window = np.ascontiguousarray(self.chars[first[:, None] + np.arange(order)])
        # A fixed-width numpy string would lose NULs at its end: decode all at once and cut.
        text = window.tobytes().decode("utf-32-le", "surrogatepass")
        self.names = pa.array([text[i : i + order] for i in range(0, len(text), order)], pa.string())

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Per text, the sum of its n-grams' values."""
        out = np.zeros(len(self.lengths))
        some = self.lengths > 0
        if some.any():
            out[some] = np.add.reduceat(value[self.ids], (np.cumsum(self.lengths) - self.lengths)[some])
        return out


def _blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Portions of a partition's rows with the number of their block.

    It follows from the partition's rows alone, so every run over the same table deals
    the same blocks.
    """
    from pyspark import TaskContext

    partition = TaskContext.get().partitionId()

    def rows():
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy()
            at = 0
            while at < len(sizes):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at : at + 4096]), PORTION // 8, "right")))
                yield batch.slice(at, n), int(sizes[at : at + n].sum())
                at += n

    done = 0
    for held in portions(rows(), lambda x: x[1], PORTION):
        yield (partition << 32) + done // BLOCK, [x[0] for x in held]
        done += sum(x[1] for x in held)


def _by_language(part: list[pa.RecordBatch], text: str, lang: str):
    """(language, row numbers, normalised texts); a null language is ""."""
    rows = pa.Table.from_batches(part)
    texts, langs = rows[text].to_pylist(), pc.fill_null(rows[lang], "").to_pylist()
    by: dict[str, list[int]] = {}
    for i, x in enumerate(langs):
        by.setdefault(x, []).append(i)
    for x, at in sorted(by.items()):
        yield x, at, [normalised(texts[i]) for i in at]


def _asked(batches, text: str, lang: str, order: int):
    """Of each block: its n-grams, with their occurrences in training text.

    An n-gram comes once, or a few times where a block has more than ``HELD`` of them.
    """
    held: dict[tuple[str, str], int] = {}
    at_block = None

    def rows():
        langs, grams = zip(*held, strict=True) if held else ((), ())
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(held), at_block or 0)), pa.array(langs, pa.string()), pa.array(grams, pa.string()), pa.array(held.values(), pa.int64())],
            ["block", "lang", "gram", "n"],
        )
        held.clear()
        return out

    for block, part in _blocks(batches, text):
        if block != at_block or len(held) > HELD:
            yield rows()
            at_block = block
        train = pc.fill_null(pa.Table.from_batches(part)["__train"], False).to_numpy()
        for language, at, texts in _by_language(part, text, lang):
            grams = Grams(texts, order)
            if len(grams.names):
                weight = np.repeat(train[at], grams.lengths)
                n = np.bincount(grams.ids[weight], minlength=len(grams.names))
                for gram, k in zip(grams.names.to_pylist(), n.tolist(), strict=True):
                    key = language, gram
                    held[key] = held.get(key, 0) + k
    yield rows()


def _packed(batches, text: str):
    """Each portion's rows as a compressed Arrow stream."""
    for block, part in _blocks(batches, text):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))) as out:
            out.write_table(pa.Table.from_batches(part).combine_chunks())
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def _scored(packed: pa.Table, answers: pa.Table, text: str, lang: str, order: int, returns: list[str]) -> Iterator[pa.Table]:
    """The rows of a block with ``n_scored`` and ``log_prob``."""
    known = {}
    for language in pc.unique(answers["lang"]).to_pylist():
        own = answers.filter(pc.equal(answers["lang"], language))
        known[language] = own["gram"].combine_chunks(), own["log_p"].to_numpy()
    for blob in packed["rows"]:
        rows = pa.ipc.open_stream(blob.as_buffer()).read_all()
        n, total = np.zeros(len(rows), np.int64), np.zeros(len(rows))
        for language, at, texts in _by_language(rows.to_batches(), text, lang):
            grams = Grams(texts, order)
            if len(grams.names):
                names, log_p = known[language]
                found = pc.index_in(grams.names, value_set=names)
                if found.null_count:
                    raise RuntimeError("a block met n-grams that it had not asked for: its table changed between two reads")
                n[at], total[at] = grams.lengths, grams.sums(log_p[found.to_numpy()])
        yield rows.select(returns).append_column("n_scored", pa.array(n)).append_column("log_prob", pa.array(total))


def model_tables(counts: DataFrame, order: int) -> list[tuple[DataFrame, DataFrame]]:
    """From (lang, gram, n): for each order from 1, its counts and its contexts.

    Counts: (lang, gram, n, disc), disc being what is taken off n.  Contexts: (lang,
    context, total, back), back being the share left to the order below.
    """
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        levels[k] = levels[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n"))
    out = []
    for k in range(1, order + 1):
        n = [F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]
        y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

        def off(i: int, y=y):
            """The discount of counts of i; half of i where there are too few counts to tell."""
            d = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
            return F.when(d.isNotNull() & (d > 0) & (d < i), d).otherwise(F.lit(i / 2)).alias(f"d{i}")

        # One row for each language: it may be broadcast.
        discounts = levels[k].groupBy(F.col("lang").alias("__lang")).agg(*n).select("__lang", off(1), off(2), off(3))
        table_ = levels[k].join(F.broadcast(discounts), F.col("lang") == F.col("__lang")).select(
            "lang", "gram", "n",
            F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")).alias("disc"),
        )
        contexts = table_.groupBy("lang", F.substring("gram", 1, k - 1).alias("context")).agg(
            F.sum("n").alias("total"), (F.sum("disc") / F.sum("n")).alias("back"), F.count("*").alias("kinds")
        )
        out.append((table_, contexts))
    return out


def log_probabilities(asked: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """(lang, gram, log_p) for each of ``asked`` (lang, gram), distinct.

    p(w | context) is (n - discount) / total, plus the context's share for the order
    below times the probability there; an unseen context gives all to the order below.
    Below the first order all characters seen and one unseen are alike.  A language
    without training text has p = 1 / 2.
    """
    lower = None
    for k, (own, contexts) in enumerate(model_tables(counts, order), 1):
        wanted = asked.select("lang", F.substring("gram", order - k + 1, k).alias("gram")).distinct()
        joined = wanted.join(own, ["lang", "gram"], "left").withColumn("context", F.substring("gram", 1, k - 1))
        if k == 1:
            joined = joined.join(F.broadcast(contexts.drop("context")), "lang", "left").withColumn(
                "below", F.lit(1.0) / (F.coalesce("kinds", F.lit(1)) + 1)
            )
        else:
            joined = joined.join(contexts, ["lang", "context"], "left").join(
                lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")),
                (joined["lang"] == lower["lang"]) & (F.substring(joined["gram"], 2, k - 1) == F.col("suffix")),
            ).drop(lower["lang"])
        p = F.coalesce((F.col("n") - F.col("disc")) / F.col("total"), F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("below")
        lower = joined.select("lang", "gram", p.alias("p"))
    return lower.select("lang", "gram", F.log("p").alias("log_p"))


def perplexities(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    order: int = ORDER,
    shard_trusted: int = SHARD_TRUSTED,
    hold_out: int = HOLD_OUT,
    returns: list[str] | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """``docs`` with n_scored (characters), perplexity and calibrates (boolean); of the
    columns of ``docs`` only ``returns``, if given.

    ``trusted`` is a table of trusted ids, in a column called like ``doc_id``; all of them
    serve, in broadcasts of about ``shard_trusted`` ids, so that documents stay where they
    are read.  The documents must be a table that reads alike each time, as Parquet does;
    they are read twice.
    """
    if not 2 <= order <= len(_FACTORS):
        raise ValueError(f"the order must be 2 to {len(_FACTORS)}")
    added = ("n_scored", "perplexity", "calibrates", "log_prob", "__train", "__id", "__own")
    ids = trusted.select(F.col(f"`{doc_id}`").alias("__id")).where("__id is not null").distinct()
    stages = stages or Stages(docs.sparkSession)
    shards = max(1, -(-ids.count() // shard_trusted))
    role = F.pmod(F.xxhash64("__id", F.lit("fold")), F.lit(hold_out)) == 0
    shard = F.pmod(F.xxhash64("__id", F.lit("shard")), F.lit(shards))
    dealt = stages.add(ids.select("__id", (~role).alias("__own"), shard.alias("__shard")), "trusted")
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).withColumn("__train", F.lit(None).cast("boolean"))
    for i in range(shards):
        part = dealt.where(F.col("__shard") == i).select("__id", "__own")
        base = base.join(F.broadcast(part), F.col(f"`{doc_id}`") == F.col("__id"), "left").withColumn(
            "__train", F.coalesce("__train", "__own")
        ).drop("__id", "__own")
    asked = stages.add(
        base.mapInArrow(lambda b: _asked(b, text, lang, order), "block long, lang string, gram string, n long"), "asked"
    )
    totals = stages.add(asked.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "counts")
    model = stages.add(log_probabilities(totals, totals.where("n > 0"), order), "model")
    answers = asked.select("block", "lang", "gram").join(model, ["lang", "gram"])
    packed = base.mapInArrow(lambda b: _packed(b, text), "block long, rows binary")
    names = [c for c in base.columns if c == "__train" or returns is None or c in returns]
    out = T.StructType([*[base.schema[c] for c in names], T.StructField("n_scored", T.LongType()), T.StructField("log_prob", T.DoubleType())])

    def score(rows: pa.Table, found: pa.Table) -> pa.Table:
        made = pa.concat_tables(_scored(rows, found, text, lang, order, names))
        pa.default_memory_pool().release_unused()
        return made

    # Each block has rows; answers without rows can't be, as blocks ask for what is in them.
    scored = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, out)
    return scored.select(
        *[c for c in names if c != "__train"], "n_scored",
        F.when(F.col("n_scored") > 0, F.exp(-F.col("log_prob") / F.col("n_scored"))).alias("perplexity"),
        F.coalesce(~F.col("__train"), F.lit(False)).alias("calibrates"),
    )


def classify(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    order: int = ORDER,
    quantile: float = QUANTILE,
    slack: float = SLACK,
    prior: int = PRIOR,
    shard_trusted: int = SHARD_TRUSTED,
    hold_out: int = HOLD_OUT,
    returns: list[str] | None = None,
) -> DataFrame:
    """``docs`` with n_scored, perplexity, steadied, limit and kept.

    ``steadied`` is the perplexity as if the text went on for ``prior`` characters at
    the usual perplexity of its language, so that a few words can't stand out by
    chance.  A document goes (``kept`` false) when it is over ``limit``: ``slack`` times
    the ``quantile``'s distance from the median, both of its language and of the trusted
    documents that set thresholds.
    Null and empty texts and texts of white space have no perplexity and stay, as do
    documents of a language for which no trusted document sets a limit; a null
    language is a language of its own.  Repeated rows are scored alike; trusted ids
    count once, and ids without a document or null ones say nothing.  No documents
    give no rows; without trusted ids all stay.  Other columns pass through (or only
    ``returns``, which has to name ``lang``); ones named like an added column are
    replaced.
    """
    clean = docs.drop("steadied", "limit", "kept", "__lang", "__usual")
    stages = Stages(docs.sparkSession)
    scored = stages.add(
        perplexities(clean, trusted, doc_id, text, lang, order, shard_trusted, hold_out, returns, stages), "scored"
    )
    stages.clear(keep=1)
    language = F.coalesce(F.col(f"`{lang}`"), F.lit(""))
    tells = F.col("calibrates") & F.col("perplexity").isNotNull()
    # One row for each language, here and below.
    usual = scored.where(tells).groupBy(language.alias("__lang")).agg(
        F.percentile_approx(F.log("perplexity"), 0.5, 100_000).alias("__usual")
    )
    n = F.col("n_scored")
    steadied = scored.join(F.broadcast(usual), language == F.col("__lang"), "left").drop("__lang").withColumn(
        "steadied", F.exp((n * F.log("perplexity") + prior * F.col("__usual")) / (n + prior))
    )
    limits = steadied.where(tells).groupBy(language.alias("__lang")).agg(
        F.percentile_approx(F.log("steadied"), quantile, 100_000).alias("__high"), F.first("__usual").alias("__usual")
    ).select("__lang", F.exp(F.col("__usual") + slack * F.greatest(F.col("__high") - F.col("__usual"), F.lit(0.0))).alias("limit"))
    return steadied.join(F.broadcast(limits), language == F.col("__lang"), "left").select(
        *[F.col(f"`{c}`") for c in scored.columns if c != "calibrates"], "steadied", "limit",
        F.coalesce(F.col("steadied") <= F.col("limit"), F.lit(True)).alias("kept"),
    )


def trusted_ids(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return classify(docs, trusted_ids(spark, sf_dir), returns=["doc_id", "lang"]).select(
        "doc_id", "lang", F.col("n_scored").alias("n_chars"), "perplexity", "steadied", "limit", "kept"
    )
