"""BPE encoding and decoding by tree concatenation.

A text is cut at white space, where the tokenizer's pre-tokens always end, and runs
without white space are encoded (each distinct run once; a bounded cache keeps them).
What stays unsplit for long is encoded as a tree:

* a long pre-token is halved until its leaves are short; the leaves are encoded on
  their own, and each join re-encodes a window of tokens around it that doubles until
  its outermost tokens are those that both sides have there.  BPE is decided by pairs
  of neighbouring tokens, so the sequence is then the encoding of the whole, exactly;
* a text over ``SPREAD`` characters is halved at any character into slices that go to
  different tasks; each join re-encodes the run that the cut may have gone through,
  a window that grows until both its ends rest on white space.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import portions, staged, table

#: Byte symbols of a leaf; pre-tokens no longer are encoded as they are.
LEAF = 64
#: Characters of a text that one task encodes.
SPREAD = 32_768
#: Runs in each of the two generations that a task keeps.
CACHE = 150_000
#: A run's text that is kept at most, so that the cache's size is bounded.
CACHED_CHARS = 256

#: White space that all parts of the tokenizer treat as such.
_BLANK = re.compile("[ \t\n\x0b\x0c\r]+")
_NONE = (0, "", "")


def named_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """The JSON of a tokenizer that the public_tokenizers package holds."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


class Encoder:
    """Encodes as the tokenizers library does with this file, without special tokens added."""

    def __init__(self, spec: str, leaf: int = LEAF):
        import json

        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.whole = Tokenizer.from_str(spec)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.leaf = leaf
        model = json.loads(spec)["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: Of symbols inside a word, and of those at its end.
        self.inner = Tokenizer(BPE(vocab=model["vocab"], merges=merges))
        self.final = Tokenizer(BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix))
        added = self.whole.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        size = 1 + max(*model["vocab"].values(), *self.added.values(), 0)
        #: Of each id, its text and its token.
        self.names = [(str(i), self.whole.id_to_token(i)) for i in range(size)]
        self.joined_tokens = json.loads(spec)["decoder"] is None  # else the library decodes
        #: Runs met lately, and those met before the last time it was full.
        self.cache: dict[str, tuple[int, str, str]] = {"": _NONE}
        self.older: dict[str, tuple[int, str, str]] = {}
        self.joins = 0
        self._learn_plain()

    def forget(self) -> None:
        """Give back what a task kept: the worker may live on, idle."""
        self.cache, self.older = {"": _NONE}, {}
        pa.default_memory_pool().release_unused()

    def _learn_plain(self) -> None:
        """Ask the tokenizer for letters that it takes one by one, and for marks that it
        sets apart from them: words of such letters need only the model.

        Letters qualify if each is normalised and pre-tokenised by itself to what it is
        among all others, and if all in a row are still one pre-token.
        """

        def pieces(text: str) -> list[str]:
            normal = self.whole.normalizer.normalize_str(text) if self.whole.normalizer else text
            return [p for p, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal)]

        letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))]
        alone = {c: p[0] for c in letters if len(p := pieces(c)) == 1}
        whole = [pieces("".join(row)) for row in (alone, [*alone][::-1])]
        if whole != [["".join(alone.values())], ["".join([*alone.values()][::-1])]]:
            alone = {}
        marks = [m for m in ".,;:!?" if alone and pieces(f"{next(iter(alone))}{m}") == [next(iter(alone.values())), m]]
        self.symbols = str.maketrans(alone)
        self.plain = re.compile(f"([{''.join(alone)}]+)([{re.escape(''.join(marks))}]?)" if marks else "(?!)")

    def _word(self, symbols: str) -> tuple[int, str, str]:
        """One pre-token, given as byte symbols; kept under a name that no run has."""
        key = "\n" + symbols
        got = self.cache.get(key) or self.older.get(key)
        if got is None:
            got = self._named(self.pretoken(symbols) if len(symbols) > self.leaf else self.final.encode(symbols, add_special_tokens=False).ids)
        self._keep(key, got)
        return got

    def _named(self, ids: list[int]) -> tuple[int, str, str]:
        if not ids:
            return _NONE
        names = [self.names[i] for i in ids]
        tokens = " ".join([n[1] for n in names]) if self.joined_tokens else self.decode(ids)
        return len(ids), " ".join([n[0] for n in names]), tokens

    def _keep(self, key: str, got: tuple[int, str, str]) -> None:
        if len(key) <= CACHED_CHARS:
            if len(self.cache) >= CACHE:
                self.older, self.cache = self.cache, {"": _NONE}
            self.cache[key] = got

    def run(self, run: str) -> tuple[int, str, str]:
        """Count, ids and tokens (both joined by blanks) of a text without white space."""
        got = self.cache.get(run)
        if got is None:
            got = self.older.get(run)
            if got is None:
                if len(run) > self.leaf:
                    got = self._named(self._long(run))
                elif plain := self.plain.fullmatch(run):
                    got = self._word(plain[1].translate(self.symbols))
                    if plain[2]:
                        mark = self.cache.get(plain[2]) or self.run(plain[2])
                        got = got[0] + mark[0], f"{got[1]} {mark[1]}", f"{got[2]} {mark[2]}"
                else:
                    got = self._named(self.whole.encode(run, add_special_tokens=False).ids)
            self._keep(run, got)
        return got

    def decode(self, ids: list[int]) -> str:
        return self.whole.decode(ids, skip_special_tokens=False)

    def _long(self, run: str) -> list[int]:
        """A long run: its pre-tokens, the long ones as trees."""
        out: list[int] = []
        at = 0
        for m in [*self.special.finditer(run), None]:
            text = run[at : m.start() if m else len(run)]
            if text:
                normal = self.whole.normalizer.normalize_str(text) if self.whole.normalizer else text
                for piece, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal):
                    out += self.pretoken(piece)
            if m:
                out.append(self.added[m[0]])
                at = m.end()
        return out

    def pretoken(self, symbols: str) -> list[int]:
        """The ids of one pre-token, given as byte symbols."""
        return [i for i, _ in self._tree(symbols, True)]

    def _symbols(self, symbols: str, last: bool) -> list[tuple[int, str]]:
        made = (self.final if last else self.inner).encode(symbols, add_special_tokens=False)
        out = list(zip(made.ids, made.tokens, strict=True))
        if last and self.suffix:
            out[-1] = (out[-1][0], out[-1][1].removesuffix(self.suffix))
        return out

    def _tree(self, symbols: str, last: bool) -> list[tuple[int, str]]:
        if len(symbols) <= self.leaf:
            return self._symbols(symbols, last)
        middle = len(symbols) // 2
        return self._join(self._tree(symbols[:middle], False), self._tree(symbols[middle:], last), last)

    def _join(self, left: list, right: list, last: bool) -> list:
        """Both sides with a window around the join encoded anew, until both agree with it."""
        size = 1
        while True:
            self.joins += 1
            a, b = max(0, len(left) - size), min(len(right), size)
            again = self._symbols("".join(s for _, s in left[a:] + right[:b]), last and b == len(right))
            if (a == 0 or again[0] == left[a]) and (b == len(right) or again[-1] == right[b - 1]):
                return left[:a] + again + right[b:]
            size *= 2

    def text(self, text: str) -> tuple[int, str, str]:
        """Count, ids and tokens of a whole text."""
        for blank in "\t\n\x0b\x0c\r":
            text = text.replace(blank, " ")
        known = self.cache.get
        return self.joined([known(run) or self.run(run) for run in text.split(" ")])

    @staticmethod
    def joined(parts: list[tuple[int, str, str]]) -> tuple[int, str, str]:
        counts, ids, tokens = zip(*parts, strict=True)
        if 0 in counts:  # of nothing, as between two blanks
            ids, tokens = filter(None, ids), filter(None, tokens)
        return sum(counts), " ".join(ids), " ".join(tokens)


@lru_cache(1)
def _encoder(spec: str, leaf: int) -> Encoder:
    return Encoder(spec, leaf)


def cuts(length: int, most: int) -> list[int]:
    """Where halving a text again and again, until no part is over ``most``, cuts it."""
    if length <= most:
        return []
    middle = length // 2
    return [*cuts(middle, most), middle, *(middle + c for c in cuts(length - middle, most))]


def _encoded_slice(encoder: Encoder, text: str) -> dict:
    """A slice's inner runs encoded; its first and last run, which a cut may have parted, as text.

    ``solid``: the slice is one run or a part of one; then ``head`` holds it.
    """
    first = _BLANK.search(text)
    if first is None:
        return {"solid": True, "head": text, "tail": "", "n": 0, "ids": "", "tokens": ""}
    end = len(text)
    while text[end - 1] not in " \t\n\x0b\x0c\r":
        end -= 1
    n, ids, tokens = encoder.text(text[first.start() : end])
    return {"solid": False, "head": text[: first.start()], "tail": text[end:], "n": n, "ids": ids, "tokens": tokens}


def _combined(encoder: Encoder, slices: list[dict]) -> tuple[int, str, str]:
    """The slices of a text in order: the runs around each cut grow together until both
    sides show white space, and are encoded whole."""
    parts, window = [], []
    for s in slices:
        window.append(s["head"])
        if not s["solid"]:
            parts.append(encoder.run("".join(window)))
            parts.append((s["n"], s["ids"], s["tokens"]))
            window = [s["tail"]]
    parts.append(encoder.run("".join(window)))
    return encoder.joined(parts)


_SLICE = "at int, solid boolean, head string, tail string, n long, ids string, tokens string"


def encode(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    leaf: int = LEAF,
    spread: int = SPREAD,
    digests: bool = False,
) -> DataFrame:
    """(doc, n_tokens, ids array<int>, decoded) of every row of ``docs``.

    ``tokenizer`` is the JSON of a BPE tokenizer whose pre-tokens end at white space
    and whose decoder joins tokens by blanks.  ``digests`` gives ids_sha256 and
    decoded_sha256 in place of ids and decoded.  A null text is empty; an empty text
    or one of white space has no tokens.  Strings of special tokens in a text become
    those tokens, as the library has it.  Rows without an id and repeated rows each
    come out.  Extra columns are not read; no rows give no rows.
    """
    spec = tokenizer or named_tokenizer()
    kind = docs.schema[doc_id].dataType
    out = T.StructType([
        T.StructField("doc", kind), T.StructField("n_tokens", T.LongType()),
        *([T.StructField(n, T.StringType()) for n in ("ids_sha256", "decoded_sha256")] if digests
          else [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]),
    ])
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), body.alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def batch_of(docs_column, made: list[tuple[int, str, str]]) -> pa.RecordBatch:
        counts = pa.array([m[0] for m in made], pa.int64())
        if digests:
            more = [pa.array([hashlib.sha256(m[k].encode()).hexdigest() for m in made], pa.string()) for k in (1, 2)]
        else:
            more = [pa.array([list(map(int, m[1].split())) for m in made], pa.list_(pa.int32())), pa.array([m[2] for m in made], pa.string())]
        return pa.RecordBatch.from_arrays([docs_column, counts, *more], names=out.names)

    def short(batches: Iterator[pa.RecordBatch]):
        encoder = _encoder(shared.value, leaf)
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                yield batch_of(part.column(0), [encoder.text(t) for t in part.column(1).to_pylist()])
        encoder.forget()

    def slices(batches: Iterator[pa.RecordBatch]):
        encoder = _encoder(shared.value, leaf)
        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in ("row", "at", "part")), strict=True)
            for held in portions(rows, lambda r: len(r[2]), 1 << 20):
                yield pa.RecordBatch.from_pylist(
                    [{"row": row, "at": at} | _encoded_slice(encoder, part) for row, at, part in held],
                    schema=pa.schema([("row", pa.int64()), ("at", pa.int32()), ("solid", pa.bool_()), *((n, pa.string()) for n in ("head", "tail")), ("n", pa.int64()), ("ids", pa.string()), ("tokens", pa.string())]),
                )
        encoder.forget()

    def combine(batches: Iterator[pa.RecordBatch]):
        encoder = _encoder(shared.value, leaf)
        row, held = None, []

        def done():
            return {"row": row} | dict(zip(("n_tokens", "ids", "decoded"), _combined(encoder, held), strict=True))

        for batch in batches:
            for r in batch.to_pylist():
                if held and r["row"] != row:
                    yield from made([done()])
                    held.clear()
                row = r["row"]
                held.append(r)
        if held:
            yield from made([done()])
        encoder.forget()

    def made(rows: list[dict]):
        part = batch_of(pa.array([r["row"] for r in rows], pa.int64()), [(r["n_tokens"], r["ids"], r["decoded"]) for r in rows])
        yield part.rename_columns(["row", *out.names[1:]])

    direct = rows.where(F.length("text") <= spread).mapInArrow(short, out)
    # A long text is known by its hash: equal texts are encoded once, and each row finds its own.
    key = F.xxhash64("text", F.length("text"))
    long = rows.where(F.length("text") > spread).withColumn("row", key)

    def halves(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = [0, *cuts(len(text), spread), len(text)]
                parts = [text[a:b] for a, b in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_pydict(
                    {"row": pa.array([row] * len(parts), pa.int64()), "at": pa.array(range(len(parts)), pa.int32()), "part": pa.array(parts, pa.string())}
                )

    cut = long.select("row", "text").mapInArrow(halves, "row long, at int, part string").dropDuplicates(["row", "at"])
    encoded = cut.mapInArrow(slices, f"row long, {_SLICE}")
    again = T.StructType([T.StructField("row", T.LongType()), *out.fields[1:]])
    whole = encoded.repartition("row").sortWithinPartitions("row", "at").mapInArrow(combine, again)
    return direct.unionByName(long.select("doc", "row").join(whole, "row").select(*out.names))


def decode(encoded: DataFrame, ids: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: the ids as text, special tokens included; null ids: null."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer or named_tokenizer())
    base = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = _encoder(shared.value, LEAF)
        for batch in batches:
            made = [None if x is None else encoder.decode(x) for x in batch.column(ids).to_pylist()]
            yield batch.append_column("decoded", pa.array(made, pa.string()))

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("decoded", T.StringType())]))


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), digests=True).withColumnRenamed("doc", "doc_id")
