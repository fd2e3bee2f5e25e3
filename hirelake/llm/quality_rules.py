"""Quality rules: a learned decision list over document statistics.

Sequential covering: a rule is a conjunction of thresholds.  It is grown on two thirds
of the labelled rows, condition by condition, by the information it gains, pruned on
the rest by what it gets right there, and the rows it covers leave.  The rules, in
order, are Spark conditional expressions over the statistics' columns, so applying
them is a projection.

The statistics are made once for every document and written to the shared folder.
Labelled rows are fitted up to a bound (``MAX_ROWS``), chosen by hash; that is a few
numbers per row, and all that the driver sees.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import SPACES, staged, table

WINDOW, MIN_WORDS, MAX_REPEAT_PCT = 8, 20, 30
#: Labelled rows that rules are learned from, at most.
MAX_ROWS = 50_000
MAX_RULES, MAX_CONDITIONS, CANDIDATES = 12, 4, 64

_WORD = re.compile(f"[^{re.escape(SPACES)}]+")
_SYMBOLS = frozenset("#*$%&|<>")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_upper", "n_digits", "n_distinct_words", "n_lines", "n_chars", "n_ended")


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more, first ones included."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    # Ranks of windows of doubling width are exact names: equal names, equal windows.
    names, width = ids, 1
    while width < window:
        step = min(width, window - width)
        own = names[: len(ids) - width - step + 1].astype(np.int64)
        names = np.unique(own * (len(ids) + 1) + names[step : step + len(own)], return_inverse=True)[1]
        width += step
    twice = np.bincount(names)[names] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += twice
    edge[window : window + n] -= twice
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: str | None) -> dict[str, int]:
    """The base counts of a text and those that rules may use besides."""
    text = text or ""
    words = _WORD.findall(text)
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    seen: set[str] = set()
    dup = 0
    lines = text.split("\n")
    for line in lines:
        if line in seen:
            dup += _WORD.search(line) is not None
        else:
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in _SYMBOLS),
        "n_dup_lines": dup,
        "n_repeat_words": repeated_words(ids),
        "n_upper": len(_UPPER.findall(text)),
        "n_digits": len(_DIGIT.findall(text)),
        "n_distinct_words": len(number),
        "n_lines": len(lines),
        "n_chars": len(text),
        "n_ended": len(_ENDED.findall(text)),
    }


_UPPER, _DIGIT, _ENDED = re.compile("[A-Z]"), re.compile("[0-9]"), re.compile(r"[.!?][" + re.escape(SPACES) + "]")


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, counts...) of each row; a null text has no words and one empty line."""
    names = [*COUNTS, *_MORE]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                made = [statistics(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([m[n] for m in made], pa.int64()) for n in names)], ["doc", *names]
                )

    schema = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), *[T.StructField(n, T.LongType()) for n in names]])
    return docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def features() -> dict[str, Column]:
    """What rules compare with thresholds: shares and means, of no words 0."""
    n, chars, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_chars", F.lit(1)), F.col("n_lines")
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / n,
        "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars,
        "distinct_share": F.col("n_distinct_words") / F.sqrt(n),
        "words_per_line": F.col("n_words") / lines,
        "ended_per_word": F.col("n_ended") / n,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"

    def holds(self, column: np.ndarray) -> np.ndarray:
        return column > self.threshold if self.above else column <= self.threshold

    def expression(self, column: Column) -> Column:
        return column > self.threshold if self.above else column <= self.threshold


def _covered(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x[c.feature])
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """Conditions added while one gains: the gain is positives kept times bits of purity won."""
    rule: list[Condition] = []
    now = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (p := bad[now].sum()) and p < now.sum():
        before = math.log2(p / now.sum())
        best = (1e-9, None)
        for name, column in x.items():
            own, label = column[now], bad[now]
            order = np.argsort(own, kind="stable")
            own, hits = own[order], np.cumsum(label[order])
            ends = np.flatnonzero(np.r_[own[1:] != own[:-1], False])
            if len(ends) > CANDIDATES:
                # Besides evenly spread thresholds, those where the class changes most.
                turn = np.flatnonzero(label[order][ends] != label[order][ends + 1])
                ends = np.unique(np.r_[ends[np.linspace(0, len(ends) - 1, CANDIDATES).astype(int)], ends[turn]])
            if not len(ends):
                continue
            size, pos = ends + 1, hits[ends]
            for above, k, q in ((False, size, pos), (True, len(own) - size, p - pos)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(q > 0, q * (np.log2(q / k) - before), 0.0)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], Condition(name, above, float((own[ends[i]] + own[ends[i] + 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        now &= best[1].holds(x[best[1].feature])
    return rule


def _prune(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[list[Condition], float]:
    """The conditions, last ones dropped, that get most of the rest right; and their precision."""
    best, worth, precision = rule, -2.0, 0.0
    for k in range(len(rule), 0, -1):
        on = _covered(rule[:k], x, len(bad))
        p, n = int(bad[on].sum()), int(on.sum())
        value = (p - (n - p)) / n if n else -1.0
        if value >= worth:
            best, worth, precision = rule[:k], value, p / n if n else 0.0
    return best, precision


def learn(x: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray, min_precision: float) -> list[list[Condition]]:
    """An ordered list of rules for ``bad`` rows; ``fold`` marks the rows that prune."""
    rules: list[list[Condition]] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES and bad[left & ~fold].any():
        grow, prune = left & ~fold, left & fold
        rule = _grow({n: c[grow] for n, c in x.items()}, bad[grow])
        if not rule:
            break
        rule, precision = _prune(rule, {n: c[prune] for n, c in x.items()}, bad[prune])
        on = _covered(rule, x, len(bad)) & left
        if precision < min_precision or not on.any():
            break
        rules.append(rule)
        left &= ~on
    return rules


def expression(rules: list[list[Condition]]) -> Column:
    """The list as one conditional expression: the number of the first rule that holds, or 0."""
    columns = features()
    out = None
    for i, rule in enumerate(rules, 1):
        all_of = F.lit(True)
        for c in rule:
            all_of = all_of & c.expression(columns[c.feature])
        out = F.when(all_of, i) if out is None else out.when(all_of, i)
    return F.lit(0) if out is None else out.otherwise(0)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    max_rows: int = MAX_ROWS,
    min_precision: float = 0.9,
) -> tuple[DataFrame, list[list[Condition]]]:
    """Per row of ``docs``: doc, the counts, base_failed, rule, kept; and the rules.

    ``labels`` has ids like ``docs`` and ``quality`` (1 good, 0 not; others and nulls
    say nothing; of several labels of an id the lowest holds).  ``kept`` is false if
    base_failed or a rule holds.  A null or empty text has no words and fails.
    Repeated rows come out repeated, rows without an id are judged like others; extra
    columns are not read.  Without labels there are no rules, without documents no rows.
    """
    stats = staged(document_statistics(docs, doc_id, text), "statistics")
    known = labels.where(F.col(f"`{quality}`").isin(0, 1)).groupBy(F.col(f"`{doc_id}`").alias("doc")).agg(
        F.min(f"`{quality}`").alias("label")
    )
    columns = features()
    rows = stats.where(~_base_failed()).join(known, "doc").select(
        F.xxhash64("doc").alias("h"), (F.col("label") == 0).alias("bad"), *[c.alias(n) for n, c in columns.items()]
    )
    # In place of a sort: a hash below a limit, for about as many rows as are asked for.
    total = rows.count()
    limit = 1 << 20 if total <= max_rows else int((1 << 20) * max_rows / total)
    sample = rows.where(F.pmod("h", F.lit(1 << 20)) < limit).orderBy("h", *columns).toPandas()
    x = {n: sample[n].to_numpy(float) for n in columns}
    fold = (sample["h"].to_numpy(np.int64) >> 20) % 3 == 0
    rules = learn(x, sample["bad"].to_numpy(bool), fold, min_precision) if len(sample) else []
    judged = stats.select("doc", *COUNTS, _base_failed().alias("base_failed"), expression(rules).alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)), rules


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(F.col("doc").alias("doc_id"), *COUNTS, "base_failed", "kept", "rule")
