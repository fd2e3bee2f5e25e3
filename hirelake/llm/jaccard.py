"""Groups of documents whose shingle sets are alike, from keys that linked sets share.

A method gives each set some keys, so that two linked sets have one in common (surely, or
nearly so); sets that share a key are a bucket.  Its members are compared with its least
member first; where members are still in different components after that, pairs across
components are compared, in chunks, until none is left that could join two.  A comparison
is by a short parity sketch first, whose Hamming distance never exceeds the sets' symmetric
difference, and then exact by the shingles.

Sets that repeat count once everywhere.  Buckets are never capped: tasks combine a
bucket's members in blocks before the shuffle, so a bucket of a third of all rows has a
row a block there.  Only narrow rows are kept for all documents; texts are fetched for
pairs that the sketches allow, from those of all candidates, which are taken out once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest, xxh64_digest

from hirelake.llm.common import LOWER, SMALL, Stages, portions
from hirelake.llm.components import components
from hirelake.llm.simhash import fingerprint, links, row_hash

SHORT_BITS = 2048
#: Members of a bucket compared in one group, members of a centre compared in one task.
CHUNK, FOLLOWERS = 1024, 2048
#: Tasks over which a component is spread at least where its name is looked up.
SALTS = 32
#: Entries that a task combines before it sends them.
BLOCK = 500_000

#: The keys of a set, given the ascending hashes of its shingles; 64 bits each.
Keys = Callable[[np.ndarray], np.ndarray]


def shingles(text: str | None, shingle: int) -> np.ndarray:
    """The distinct hashes of the word shingles, ascending; fewer words are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    return np.unique(np.frombuffer(b"".join([xxh64_digest(p) for p in parts]), np.uint64))


def most_apart(sizes: int, percent: int) -> int:
    """The largest symmetric difference of linked sets whose sizes add up to ``sizes``."""
    return (100 - percent) * sizes // (100 + percent)


def short_sketch(hashes: np.ndarray) -> bytes:
    """``SHORT_BITS`` parities, from bits of the hashes that pieces don't use."""
    at = ((hashes >> np.uint64(17)) & np.uint64(SHORT_BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=SHORT_BITS) & 1).astype(np.uint8)).tobytes()


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    raw = xxh3_128_digest(hashes.tobytes())
    return tuple(np.frombuffer(raw, np.int64).tolist())


def _marked(batches: Iterator[pa.RecordBatch], shingle: int, fingerprints: bool) -> Iterator[pa.RecordBatch]:
    """(doc, row, h1, h2, n, sketch, fp)."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = part.column(2).to_pylist()
            sets = [shingles(t, shingle) for t in texts]
            fps = np.array([fingerprint(t, shingle) for t in texts] if fingerprints else [0] * len(texts), np.uint64)
            h1, h2 = zip(*map(_digest, sets), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([short_sketch(s) for s in sets], pa.binary()),
                    pa.array(fps.view(np.int64)),
                ],
                ["doc", "row", "h1", "h2", "n", "sketch", "fp"],
            )


def _combined(piece: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    """Entries of a block: the least node of each piece (its least is null), and whoever
    shares the piece with it."""
    order = np.lexsort((node, piece))
    piece, node = piece[order], node[order]
    new = np.r_[True, (piece[1:] != piece[:-1]) | (node[1:] != node[:-1])]
    piece, node = piece[new], node[new]
    first = np.r_[True, piece[1:] != piece[:-1]]
    least = node[np.flatnonzero(first)][np.cumsum(first) - 1]
    return pa.RecordBatch.from_arrays([pa.array(piece), pa.array(node), pa.array(least, mask=first)], ["piece", "node", "least"])


def _entries(batches: Iterator[pa.RecordBatch], shingle: int, keys: Keys, block: int) -> Iterator[pa.RecordBatch]:
    held, nodes, total = [], [], 0
    for batch in batches:
        for text in (t for start in range(0, batch.num_rows, 256) for t in batch.column(0).slice(start, 256).to_pylist()):
            hashes = shingles(text, shingle)
            if not len(hashes):
                continue
            held.append(keys(hashes))
            nodes.append(np.full(len(held[-1]), _digest(hashes)[0], np.int64))
            total += len(held[-1])
            if total >= block:
                yield _combined(np.concatenate(held).view(np.int64), np.concatenate(nodes))
                held, nodes, total = [], [], 0
    if total:
        yield _combined(np.concatenate(held).view(np.int64), np.concatenate(nodes))


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Entries of blocks of (piece, node)."""
    for held in portions((b for b in batches if b.num_rows), lambda b: b.num_rows, block):
        piece, node = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
        yield _combined(piece, node)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(piece, node, least) of members of buckets with two or more, from sorted entries.

    A bucket's first entry is its least member; a bucket of one isn't sent.  Only that
    one entry is held between batches.
    """
    last = lead = None
    for batch in batches:
        piece, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        followers = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(followers)) for c in batch.columns], ["piece", "node", "least"])
        piece, node = piece[~followers], node[~followers]
        if not len(piece):
            continue
        if last is not None:
            piece, node = np.r_[last, piece], np.r_[lead, node]
        first = np.r_[True, piece[1:] != piece[:-1]]
        least = node[np.flatnonzero(first)][np.cumsum(first) - 1]
        # The entry held before has been seen already, whoever came with it has been sent.
        sent = (node != least) if last is None else np.r_[False, (node != least)[1:]]
        yield pa.RecordBatch.from_arrays([pa.array(c[sent]) for c in (piece, node, least)], ["piece", "node", "least"])
        last, lead = piece[-1], least[-1]


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _words(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint64).reshape(len(sketches), SHORT_BITS // 64)


def _near(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Those of (u, v, nu, nv, su, sv) whose short sketches allow a link."""
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            nu, nv = (part.column(i).to_numpy() for i in (2, 3))
            near = _distance(_words(part.column(4)), _words(part.column(5))) <= most_apart(nu + nv, percent)
            keep = pa.array(near & (100 * np.minimum(nu, nv) >= percent * np.maximum(nu, nv)))
            yield pa.RecordBatch.from_arrays([part.column(i).filter(keep) for i in (0, 1)], ["u", "v"])


def _verified(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links (u, v) from rows (u, salt, v, text) in which a centre (v null) comes before its followers."""
    centre, own = None, None
    for batch in batches:
        out: list[list[int]] = [[], []]
        for u, v, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            if v is None:
                if centre != u:
                    centre, own = u, shingles(text, shingle)
                continue
            other = shingles(text, shingle)
            both = len(np.intersect1d(own, other, assume_unique=True))
            if 100 * both >= percent * (len(own) + len(other) - both):
                out[0].append(u)
                out[1].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["u", "v"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that agree on piece, x and y, from sorted rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            if held and any(held[-1].column(i)[0] != part.column(i)[0] for i in range(3)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _across(batches: Iterator[pa.RecordBatch], percent: int, each: int) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) of different components that short sketches allow, from groups of
    (piece, x, y, side, id, n, root, sketch, apart): side 0 meets 1, side 2 meets itself.

    ``apart`` has ids known not to be linked.  With ``each`` 0, components that a sent
    pair may join count as one from there on, so a group sends fewer pairs than it has
    components; else a member's ``each`` nearest of any component are sent.
    """
    for group in _groups(b for b in batches if b.num_rows):
        side, ids, n, label = (group.column(i).to_numpy() for i in (3, 4, 5, 6))
        words, apart = _words(group.column(7).combine_chunks()), group.column(8).to_pylist()
        label, sent = label.copy(), [[], []]
        right = np.flatnonzero(side != 0)
        whole = side[0] == 2
        for i in np.flatnonzero(side != 1):
            other = right[label[right] != label[i]]
            if whole:
                other = other[other > i]
            other = other[100 * np.minimum(n[other], n[i]) >= percent * np.maximum(n[other], n[i])]
            if apart[i]:
                other = other[~np.isin(ids[other], apart[i])]
            distance = _distance(words[other], words[i])
            near = distance <= most_apart(n[other] + n[i], percent)
            other = other[near][np.argsort(distance[near], kind="stable")]
            if not len(other):
                continue
            if each:
                by = np.argsort(label[other], kind="stable")  # nearest first within a component
                starts = np.flatnonzero(np.r_[True, label[other][by][1:] != label[other][by][:-1]])
                rank = np.arange(len(by)) - np.repeat(starts, np.diff(np.r_[starts, len(by)]))
                chosen = other[by[rank < each]]
            else:
                chosen = other[np.unique(label[other], return_index=True)[1]]
                label[np.isin(label, label[other])] = label[i]
            sent[0].append(np.minimum(ids[chosen], ids[i]))
            sent[1].append(np.maximum(ids[chosen], ids[i]))
        if sent[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in sent], ["u", "v"])


def _links(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (u, v) whose shingle sets are linked; ``texts`` (id, text) has their texts.

    A centre u with many followers is repeated, so no task gets more than about
    ``FOLLOWERS`` of one centre.
    """
    many = pairs.groupBy("u").agg(F.ceil(F.count("*") / FOLLOWERS).cast("int").alias("salts"))
    followers = pairs.join(many, "u").join(texts.withColumnRenamed("id", "v"), "v").select(
        "u", F.pmod(F.xxhash64("v"), F.col("salts")).cast("int").alias("salt"), "v", "text"
    )
    centres = many.join(texts.withColumnRenamed("id", "u"), "u").select(
        "u", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("v"), "text"
    )
    dealt = followers.unionByName(centres).repartition("u", "salt").sortWithinPartitions("u", "salt", F.asc_nulls_first("v"))
    return dealt.mapInArrow(lambda batches: _verified(batches, shingle, percent), "u long, v long")


def _residual(
    buckets: DataFrame, classes: DataFrame, roots: DataFrame, apart: DataFrame, percent: int, chunk: int, each: int, stages: Stages
) -> DataFrame:
    """Pairs of different components that share a bucket of three or more and may be linked.

    Where there are such pairs that are not ``apart`` (u, v), some are found; how many of a
    bucket, ``each`` says.
    """
    part = buckets.join(classes.select("node", "id"), "node").join(roots, F.col("id") == F.col("node_id"), "left").select(
        "piece", "id", F.coalesce("root", "id").alias("root")
    )
    placed = stages.add(part, "placed", release=True)
    crowds = placed.groupBy("piece").agg(
        F.count("*").alias("many"), F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.bit_xor(F.xxhash64("id")).alias("s1"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("s2"),
    ).where("many > 2 and lo < hi")
    # Buckets of the same members count once; s1 and s2 are 128 bits that stand for them.
    once = crowds.groupBy("many", "s1", "s2").agg(F.min("piece").alias("piece")).select(
        "piece", F.ceil(F.col("many") / chunk).cast("int").alias("chunks")
    )
    both = apart.unionByName(apart.select(F.col("u").alias("v"), F.col("v").alias("u")))
    tested = both.groupBy(F.col("u").alias("id")).agg(F.collect_list("v").alias("apart"))
    known = classes.select("id", "n", "sketch").join(tested, "id", "left")
    members = placed.join(once, "piece").join(known, "id").withColumn(
        "c", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    )
    # Chunk c meets every chunk of its bucket, itself included.
    dealt = members.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "piece", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"),
        F.when(F.col("c") == F.col("o"), 2).when(F.col("c") < F.col("o"), 0).otherwise(1).alias("side"),
        "id", "n", "root", "sketch", "apart",
    ).repartition("piece", "x", "y").sortWithinPartitions("piece", "x", "y")
    return dealt.mapInArrow(lambda batches: _across(batches, percent, each), "u long, v long").distinct()


def alike_groups(
    docs: DataFrame,
    keys: Keys,
    shingle: int,
    percent: int,
    doc_id: str = "doc_id",
    text: str = "text",
    empty_alike: bool = False,
    block: int = BLOCK,
    chunk: int = CHUNK,
    fingerprints: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc, row (a hash of the text), n (size of its set) and
    component (smallest doc).

    The set has the distinct shingles of ``shingle`` words; fewer words are one shingle.
    Sets are linked at ``percent`` of their union in common, where they share one of
    ``keys``; a component is all that links reach.  With ``fingerprints``, sets whose SimHash
    fingerprints (of the same shingles) hang together within three bits share a key too.  Null and empty texts and texts of
    white space have no shingle: they are linked with each other (``empty_alike``) or
    with nothing.  Rows without an id take part but never name a component (one of such
    rows only has none).  Repeated rows come out repeated.  Extra columns are not read.
    An empty table gives no rows.
    """
    stages = Stages(docs.sparkSession, SMALL)
    kind = docs.schema[doc_id].dataType
    read = docs.select(F.col(f"`{doc_id}`").alias("doc"), row_hash(F.col(f"`{text}`")).alias("row"), F.col(f"`{text}`").alias("text"))
    marks = T.StructType([T.StructField("doc", kind), *(T.StructField(c, T.LongType()) for c in ("row", "h1", "h2", "n")), T.StructField("sketch", T.BinaryType()), T.StructField("fp", T.LongType())])
    rows = stages.add(read.mapInArrow(lambda b: _marked(b, shingle, fingerprints), marks), "rows")

    entry = "piece long, node long, least long"
    entries = read.select("text").mapInArrow(lambda b: _entries(b, shingle, keys, block), entry)
    if fingerprints:
        marked = rows.where("n > 0").select("fp", "h1").distinct()
        near_fps = stages.add(components(links(stages.add(marked.select("fp").distinct(), "fps", release=True))), "fp-roots")
        hung = marked.join(near_fps, F.col("fp") == F.col("node"), "left").select(
            F.xxhash64(F.coalesce("root", "fp"), F.lit("fingerprint")).alias("piece"), F.col("h1").alias("node")
        )
        entries = entries.unionByName(hung.mapInArrow(lambda b: _blocks(b, block), entry))
    # Least members meet by piece; the others know their centre and go anywhere.
    where = F.when(F.col("least").isNull(), F.col("piece")).otherwise(F.xxhash64("piece", "node"))
    dealt = entries.repartition(where).sortWithinPartitions("piece", "least", "node")
    members = stages.add(dealt.mapInArrow(_buckets, entry), "members", release=True)

    # A set is known by 128 bits; h1 alone (node) only finds candidates.  id is its number.
    wanted = members.select("node").union(members.select("least")).distinct()
    known = rows.where("n > 0").drop("fp").join(wanted, F.col("h1") == F.col("node"), "left_semi").dropDuplicates(["h1", "h2"])
    classes = stages.add(known.withColumnRenamed("h1", "node").withColumn("id", F.monotonically_increasing_id()), "classes", release=True)
    pairs = members.select(F.col("least").alias("u"), F.col("node").alias("v")).distinct()
    side = lambda c: classes.select(F.col("node").alias(c), F.col("id").alias(f"i{c}"), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    asked = pairs.join(side("u"), "u").join(side("v"), "v").select("iu", "iv", "nu", "nv", "su", "sv")
    near = stages.add(asked.mapInArrow(lambda b: _near(b, percent), "u long, v long"), "near", release=True)

    # All texts are shuffled once here; the rounds read those of the candidates only.
    one = classes.select("id", F.col("doc").alias("own_doc"), F.col("row").alias("own_row"))
    same = F.col("doc").eqNullSafe(F.col("own_doc")) & (F.col("row") == F.col("own_row"))
    known_texts = stages.add(read.join(one, same).select("id", "text"), "known-texts", release=True)

    def verified(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
        texts = known_texts.join(ids, "id", "left_semi")
        return stages.add(_links(pairs, texts, shingle, percent), "links", release=True)

    confirmed = verified(near)
    found = stages.add(components(confirmed), "roots")
    buckets = members.select("piece", "node").union(members.select("piece", F.col("least").alias("node"))).distinct()
    # First pairs that hold the buckets together, then what is left around those that failed,
    # ever more at once: each round tries pairs that none has tried, until there are none.
    apart, each = near.limit(0), 0
    while True:
        roots = found.withColumnRenamed("node", "node_id")
        more = stages.add(_residual(buckets, classes, roots, apart, percent, chunk, each, stages), "residual", release=True)
        if more.isEmpty():
            break
        confirmed = verified(more)
        apart = apart.unionByName(stages.add(more.join(confirmed, ["u", "v"], "left_anti"), "apart", release=True))
        joined = found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(confirmed)
        found = stages.add(components(joined), "roots")
        each = 16 * max(each, 1)

    # Each set's least document, then each component's.
    named_rows = rows if empty_alike else rows.where("n > 0")
    sets = named_rows.groupBy("h1", "h2").agg(F.min("doc").alias("doc"))
    linked = classes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("node").alias("h1"), "h2", F.coalesce("root", "id").alias("root")
    )
    joined = stages.add(sets.join(linked, ["h1", "h2"], "left"), "sets", release=True)
    alone = joined.where("root is null").select("h1", "h2", F.col("doc").alias("component"))
    # One component may hold most sets: its name is repeated, so they stay spread.  Spark sizes the names
    # as they are before that and would broadcast ``SALTS`` times its limit, so it is told not to.
    firsts = joined.where("root is not null").groupBy("root").agg(F.min("doc").alias("component")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    salted = joined.where("root is not null").withColumn("salt", F.pmod(F.col("h2"), F.lit(SALTS)).cast("int"))
    named = alone.unionByName(salted.join(firsts.hint("merge"), ["root", "salt"]).select("h1", "h2", "component"))
    out = named_rows.select("doc", "row", "n", "h1", "h2").join(named, ["h1", "h2"]).select("doc", "row", "n", "component")
    empty = rows.where("n = 0").select("doc", "row", "n", F.col("doc").alias("component"))
    final = stages.add(out if empty_alike else out.unionByName(empty), "alike", release=True)
    stages.clear(keep=1)
    return final
