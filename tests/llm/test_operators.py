"""Each text operator on small tables with nulls, ties, copies and clashing columns,
against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from hirelake.llm import bpe, decontaminate, kn_quality, line_dedup, quality_rules, sharding, simhash, substring_dedup, toxicity, warc
from hirelake.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra=""):
    """Rows (id, text) as documents, with columns whose names the operators use."""
    rows = [(i, t, "en", "s", 0) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    for c in extra.split():
        df = df.withColumn(c, F.lit("mine"))
    return df.repartition(3)


def sentence(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4))) for _ in range(n))


# --- 1: BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(bpe.named_tokenizer())


def awkward(rng):
    al = "abcdeéñçthein'ʼSßİΣσς!$%#漢字かな한글ȩ́а б  ‍ 0123٣ \n\t\x1c.,"
    size = rng.choice([0, 3, 10, 80, 300, 1500])
    text = "".join(rng.choice(sub) for sub in [rng.sample(al, rng.choice([1, 2, 3, 5, 12]))] for _ in range(size))
    return text[: size // 2] + rng.choice(["", "", "<|endoftext|>", "<|startoftext|>"]) + text[size // 2 :]


def test_trees_and_slices_agree_with_the_library(library):
    encoder, rng = bpe.Encoder(bpe.named_tokenizer(), leaf=8), random.Random(5)
    texts = [awkward(rng) for _ in range(800)]
    texts += ["".join(rng.choice(["the", "ing", "er", "a", "n"]) for _ in range(300)) for _ in range(50)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        want = len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        assert encoder.text(t) == want, t
        for most in (5, 40):
            at = [0, *bpe.cuts(len(t), most), len(t)]
            parts = [bpe._encoded_slice(encoder, t[a:b]) for a, b in zip(at, at[1:], strict=False)]
            assert bpe._combined(encoder, parts) == want, (t, most)
    assert encoder.joins > 1000


def test_encode_and_decode(spark, library):
    rng = random.Random(1)
    texts = [(i, awkward(rng)) for i in range(60)] + [(7, awkward(rng)), (None, "it's"), (90, None), (91, ""), (92, " \n"), (93, "a" * 5000), (93, "a" * 5000)]
    docs = documents(spark, texts, "ids doc n_tokens row")
    for spread in (20, 10**9):
        got = bpe.encode(docs, spread=spread)
        rows = Counter((r.doc, r.n_tokens, tuple(r.ids), r.decoded) for r in got.collect())
        want = Counter()
        for i, t in texts:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want[i, len(ids), tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
        assert rows == want
        back = bpe.decode(got)
        assert Counter(r.decoded for r in back.collect()) == Counter(k[3] for k in rows.elements())
    assert bpe.encode(docs.limit(0)).count() == 0


# --- 2: decontamination


def brute_hits(text, items, window):
    words = [w.lower() for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
    hit, found, longest = set(), set(), 0
    for item, body in items:
        own = [w.lower() for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", body or "")]
        n = min(window, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def test_decontamination(spark):
    rng = random.Random(2)
    items = [(i, sentence(rng, rng.randint(1, 12), "ab")) for i in range(12)] + [(12, None), (13, ""), (3, "A-b, aa b"), (None, "ba ab ba")]
    texts = [(i, sentence(rng, rng.randint(0, 120), "ab")) for i in range(60)] + [(5, "A aB"), (61, None), (62, ""), (None, "ba AB ba")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, texts, "spans items dropped clean_text")
    want = Counter((i, *brute_hits(t, items, 4)[:2], tuple(brute_hits(t, items, 4)[2])) for i, t in texts)
    for shard_words in (200_000, 5):
        made = decontaminate.decontaminate(docs, bench, window=4, shard_words=shard_words)
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in made.collect()) == want
    assert made.columns[:5] == docs.columns[:5] and len(set(made.columns)) == len(made.columns)
    assert decontaminate.decontaminate(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0


def test_spans_are_cut_and_covered_documents_dropped(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    texts = [(1, "Say: One, two three four. five six seven! " + "then more words of my own follow here now ok"), (2, "one two three four five six seven"), (3, "clean")]
    made = {r.doc_id: r for r in decontaminate.decontaminate(documents(spark, texts), bench).collect()}
    assert made[1].clean_text == "Say: ! then more words of my own follow here now ok" and not made[1].dropped
    assert made[2].dropped and made[3].clean_text == "clean" and made[1].longest == 7


# --- 3: language model


def test_kneser_ney_probabilities(spark):
    rng = random.Random(3)
    train = [sentence(rng, 30, "abc") for _ in range(40)]
    order = 3
    counts = Counter()
    for t in train:
        padded = "\x02\x02" + t
        counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    levels = {3: counts}
    for k in (2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    # The share that all known characters and one unknown have below the first order.
    base = 1 / (len(levels[1]) + 1)

    def p(g):
        k = len(g)
        if k == 0:
            return base
        n = Counter(levels[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        def off(c):
            i = min(c, 3)
            d = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else None
            return d if d is not None and 0 < d < i else i / 2
        own = {x: c for x, c in levels[k].items() if x[:-1] == g[:-1]}
        if not own:
            return p(g[1:])
        total = sum(own.values())
        return (own[g] - off(own[g]) if g in own else 0) / total + sum(map(off, own.values())) / total * p(g[1:])

    asked = [*counts][:60] + ["zzz", "abz", "zab", "\x02\x02z"]
    frame = spark.createDataFrame([("en", g) for g in asked], "lang string, gram string").distinct()
    model = spark.createDataFrame([("en", g, c) for g, c in counts.items()], "lang string, gram string, n long")
    got = {r.gram: r.log_p for r in kn_quality.log_probabilities(frame, model, order).collect()}
    for g in asked:
        assert got[g] == pytest.approx(np.log(p(g)), rel=1e-9), g
    for context in ("ab", "zz"):
        everything = sum(p(context + c) for c in [*levels[1], "?"])
        assert everything == pytest.approx(1.0)


def test_classifier(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, 40), "en", "s", 0) for i in range(200)]
    rows += [(1000 + i, sentence(rng, 40, "#$%&!"), "en", "s", 0) for i in range(20)]
    rows += [(2000, None, "en", "s", 0), (2001, "", None, "s", 0), (2002, "x y z", "xx", "s", 0), (3, rows[3][1], "en", "s", 0), (None, rows[4][1], "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("mine"))
    docs.write.mode("overwrite").parquet(path := _folder(spark, "kn"))
    docs = spark.read.parquet(path)
    trusted = spark.createDataFrame([(i,) for i in range(200)] + [(5,), (None,), (99999,)], "doc_id long")
    made = kn_quality.classify(docs, trusted).collect()
    assert len(made) == len(rows)
    by = Counter((r.doc_id is not None and 1000 <= r.doc_id < 1020, r.kept) for r in made)
    assert by[True, True] == 0 and by[True, False] == 20 and by[False, False] <= 2
    one = {r.doc_id: r for r in made}
    assert one[2000].perplexity is None and one[2000].kept and one[2001].kept and one[2002].kept
    assert one[2002].limit is None and len({r.perplexity for r in made if r.doc_id == 3}) == 1
    assert all(r.kept for r in kn_quality.classify(docs, trusted.limit(0)).collect())
    assert kn_quality.classify(docs.limit(0), trusted).count() == 0


def test_grams_are_those_of_the_text():
    texts = ["", "a", "añ漢\x00b", "ab" * 9]
    grams = kn_quality.Grams(texts, 3)
    names = grams.names.to_pylist()
    got = [names[i] for i in grams.ids]
    want = [("\x02\x02" + t)[i : i + 3] for t in texts for i in range(len(t))]
    assert got == want and len(set(names)) == len(names)
    assert grams.sums(np.ones(len(names))).tolist() == [0, 1, 5, 18]


def _folder(spark, name):
    from uuid import uuid4

    from hirelake.llm.common import shared_folder

    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


# --- 4: lines


def test_line_dedup(spark):
    long = "This line is long enough to be looked at, surely so"
    texts = [(i, f"own {i}\n \t{long.upper() if i % 2 else long}\r\nshort\n{long}") for i in range(6)]
    texts += [(100, None), (101, ""), (102, "a\n\nb\n"), (3, texts[3][1]), (None, long), (103, "é" * 40), (104, "x" * 39)]
    made = line_dedup.line_dedup(documents(spark, texts, "kept_text n_lines h1 pos salt keeper"))
    rows = made.collect()
    assert len(rows) == len(texts)
    for r in rows:
        if r.doc_id in range(5):
            assert (r.kept_text, r.n_lines, r.n_dropped) == (f"own {r.doc_id}\nshort", 4, 2)
    one = {r.doc_id: r for r in rows}
    assert one[5].n_dropped == 0 and one[None].kept_text == "" and one[None].n_dropped == 1
    assert (one[100].kept_text, one[100].n_lines) == ("", 1) and one[102].kept_text == "a\n\nb\n"
    assert line_dedup.line_dedup(documents(spark, texts).limit(0)).count() == 0


# --- 5: sharding


def test_table_is_filled_in_turns():
    names, size = ["a", "b", "c"], 13
    slots = sharding.fill(names, size)
    orders = []
    for n in names:
        h = hashlib.md5(n.encode()).digest()
        offset, skip = int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:], "big") % (size - 1) + 1
        orders.append([(offset + j * skip) % size for j in range(size)])
    want, turn = {}, 0
    while len(want) < size:
        want[next(s for s in orders[turn % 3] if s not in want)] = turn % 3
        turn += 1
    assert slots == [want[s] for s in range(size)]
    for bad in ([], ["a", "a"], ["a"] * 20):
        with pytest.raises(ValueError):
            sharding.fill(bad, size)
    with pytest.raises(ValueError):
        sharding.fill(names, 12)


def test_placement(spark):
    texts = [(i, "t") for i in range(2000)] + [(5, "u"), (None, None), (None, "")]
    docs = documents(spark, texts).withColumn("Slot", F.lit("mine")).withColumn("number", F.lit(1))
    placed = sharding.place(docs, "doc_id")
    rows = placed.collect()
    slots = sharding.fill(sharding.SHARDS)
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SIZE
        assert r.shard == sharding.SHARDS[slots[r.slot]]
    assert len(rows) == len(texts) and placed.columns[-2:] == ["slot", "shard"]
    assert max(Counter(slots).values()) - min(Counter(slots).values()) <= 1
    fewer = sharding.fill(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(slots, fewer, strict=True) if a != 255)
    assert moved < 0.05 * sharding.SIZE
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan
    assert sharding.place(docs.limit(0), "doc_id").count() == 0


# --- 6: WARC


def test_warc_round_trip(spark):
    rng = random.Random(6)
    noise = ["".join(chr(rng.randint(32, 0x4FF)) for _ in range(20_000)) for _ in range(120)]
    pages = [(i, f"http://h/{i}", t) for i, t in enumerate(noise)]
    pages += [(500, "u\r\nX: y", "same"), (400, None, "same"), (401, "v", None), (402, "w", ""), (None, "n", "same"), (None, "n", "alone"), (400, "z", "same")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("mine"))
    warc.write_archives(frame.repartition(3), folder := _folder(spark, "warc"))
    files = [r.content for r in spark.read.format("binaryFile").load(folder).collect()]
    # Any gzip reader takes the archives, and magic turns up inside members.
    import gzip

    assert b"".join(map(gzip.decompress, files)).count(b"WARC/1.1") == len(pages)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "40000", "7001"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            rows = warc.read_archives(spark, folder).collect()
            got = Counter((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, r.payload and bytes(r.payload)) for r in rows)
            want = Counter()
            for i, _, html in pages:
                data = (html or "").encode()
                first = {"same": 400, "": 401}.get(html or "")
                revisit = first is not None and i != first
                want[i, "revisit" if revisit else "response", len(data), warc.payload_digest(data), first if revisit else None, b"" if not data and not revisit else None if revisit else data] += 1
            assert got == want, size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.url for r in rows if r.page_id == 500} == {"u%0D%0AX: y"}


def test_members_with_magic_inside_are_put_together():
    data = [b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 0\r\n\r\n" + bytes([i]) * 5 for i in range(4)]
    stored = []
    for i, d in enumerate(data):
        import zlib

        c = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored, so the magic shows
        stored.append(c.compress(d + (warc.MAGIC + b"no" if i % 2 else b"")) + c.flush())
    pieces = [warc.MAGIC + p for p in b"".join(stored).split(warc.MAGIC)[1:]]
    assert len(pieces) == 6
    assert [k for k, _ in warc._members(pieces)] == ["data"] * 4
    # A range that begins between the two parts of a member hands on the second.
    assert [k for k, _ in warc._members(pieces[2:])] == ["piece", "data", "data"]
    with pytest.raises(ValueError):
        list(warc._members([pieces[1], pieces[0]]))


# --- 7: SimHash


def brute_fingerprint(text, k):
    words = (text or "").encode().translate(simhash.LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    h = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint():
    rng = random.Random(7)
    for t in [None, "", " \t", "A", "a b", "a b c", "É é x y z", *[sentence(rng, rng.randint(1, 60)) for _ in range(40)]]:
        assert simhash.fingerprint(t) == brute_fingerprint(t, 3), t


def least_of(values, radius):
    """The least index that each value reaches."""
    n = len(values)
    label = list(range(n))
    links = [(i, j) for i in range(n) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= radius]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            m = min(label[i], label[j])
            if label[i] != m or label[j] != m:
                label[i] = label[j] = m
                changed = True
    return label


@pytest.mark.parametrize("radius,pieces,chunk", [(3, 5, 4096), (3, 4, 8), (2, 3, 16), (5, 8, 4), (0, 1, 4096), (1, 2, 2)])
def test_links_join_what_brute_force_joins(spark, radius, pieces, chunk):
    rng = random.Random(radius)
    values = []
    for _ in range(12):
        x = rng.getrandbits(64)
        values.append(x)
        for _ in range(rng.randint(0, 25)):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 2)))
            values.append(x)
    values = sorted({*values, 0, (1 << 64) - 1})
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(frame, radius, pieces, chunk)).collect()}
    got = [roots.get(simhash._signed(v), simhash._signed(v)) for v in values]
    want = least_of(values, radius)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_planes_count_as_bits_do():
    rng = np.random.default_rng(8)
    members = rng.integers(0, 1 << 63, 192).astype(np.uint64)
    members[1::3] = members[::3] ^ np.uint64(0b101)
    for radius in (0, 1, 2, 3, 4, 6, 7, 30):
        ask, block = np.repeat(np.arange(192), 3), np.tile(np.arange(3), 192)
        row, near = simhash.within(members[ask], block, simhash.planes(members), radius)
        got = {(ask[r], 64 * block[r] + k) for r, w in zip(row, near, strict=True) for k in range(64) if int(w) >> k & 1}
        d = np.bitwise_count(members[:, None] ^ members[None, :])
        assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(d <= radius)), strict=True)), radius


def test_near_dedup(spark):
    rng = random.Random(9)
    base = sentence(rng, 400)
    texts = [(10, base), (11, base + " x"), (9, base.upper()), (12, sentence(rng, 50)), (13, None), (14, ""), (15, " \n"), (10, base), (None, base), (None, None), (16, "one"), (17, "ONE")]
    docs = documents(spark, texts, "doc row fp component node root")
    rows = simhash.simhash_groups(docs).collect()
    assert len(rows) == len(texts)
    fps = [brute_fingerprint(t, 3) for _, t in texts]
    label = least_of(fps, 3)
    want = Counter()
    for (i, _), fp, own in zip(texts, fps, label, strict=True):
        ids = [j for (j, _), x in zip(texts, label, strict=True) if x == own and j is not None]
        want[i, simhash._signed(fp), min(ids, default=None)] += 1
    assert Counter((r.doc, r.fp, r.component) for r in rows) == want
    kept = Counter(r.doc_id for r in simhash.near_dedup(docs).collect())
    assert kept[9] == 1 and not kept[10] + kept[11] + kept[None] + kept[14] + kept[15] + kept[17] and kept[12] == kept[13] == kept[16] == 1
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(10)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(4000, 4100)] + [(None, 1), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    least = {x: x for e in links for x in e if x is not None}
    for _ in range(100):
        for u, v in links:
            if u is not None and v is not None:
                least[u] = least[v] = min(least[u], least[v])
    assert {x: got.get(x, x) for x in least} == least


# --- 8: toxicity


def test_toxicity(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = sentence(rng, 60).split()
        for _ in range(4 * bad):
            words[rng.randrange(60)] = rng.choice(["Nasty", "vile", "horrid"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(700, None), (701, ""), (None, "nasty vile horrid"), (5, rows[5][1])]
    docs = documents(spark, rows, "doc score label key")
    frame = spark.createDataFrame(labels + [(5, None), (6, 7), (None, 1), (9999, 1)], "doc_id long, toxic int")
    made = toxicity.toxicity(docs, frame).collect()
    truth = dict(labels)
    held = [r for r in made if r.held_out and r.doc in truth]
    import zlib

    assert all(r.held_out == (r.doc is None or zlib.crc32(str(r.doc).encode()) % 5 == 0) for r in made)
    assert len(held) > 80 and sum(r.predicted == truth[r.doc] for r in held) >= 0.97 * len(held)
    assert len(made) == len(rows) and all(0 <= r.score <= 1 for r in made)
    one = {r.doc: r for r in made}
    assert one[700].score == one[701].score < 0.5 and one[None].predicted == 1
    assert {r.score for r in toxicity.toxicity(docs, frame.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(docs.limit(0), frame).count() == 0


# --- 9: substrings


def test_chunks():
    rng = random.Random(12)
    for _ in range(200):
        raw = "".join(rng.choice("abc éß漢 d\n") for _ in range(rng.choice([0, 1, 15, 40, 500, 3000]))).encode()
        stops = substring_dedup.ends(raw)
        assert (stops[-1] if stops else 0) == len(raw)
        for a, b in zip([0, *stops], stops, strict=False):
            raw[a:b].decode()
            assert 0 < b - a <= substring_dedup.MOST
        if raw:
            h, x, i = substring_dedup.rolling(np.frombuffer(raw, np.uint8)), 0, rng.randrange(len(raw))
            for b in raw[max(0, i - 31) : i + 1]:
                x = (x << 1) + int(substring_dedup.GEAR[b]) & 0xFFFFFFFF
            assert h[i] == x


def test_substring_dedup(spark):
    rng = random.Random(13)
    al = "abcdefghijklmnop"
    passage = sentence(rng, 120, al)
    texts = [(i, sentence(rng, rng.randint(20, 90), al) + " " + passage + " " + sentence(rng, 30, al)) for i in range(6)]
    texts += [(100 + i, sentence(rng, 100, al)) for i in range(10)]
    texts += [(200, None), (201, ""), (202, sentence(rng, 40, al) + passage), (3, texts[3][1]), (None, passage)]
    docs = documents(spark, texts, "shared first h1 least salt")
    made = substring_dedup.substring_dedup(docs).collect()
    # With digests of three rows and more broadcast, all is the same.
    assert Counter(made) == Counter(substring_dedup.substring_dedup(docs, hot_rows=2).collect())
    body = dict(texts)
    assert len(made) == len(texts)
    for r in made:
        if r.doc in (200, 201) or (r.doc or 0) in range(100, 110):
            assert (r.n_repeated, r.removed_bytes, r.kept_text) == (0, 0, body[r.doc] or "")
        else:
            assert r.repeated_bytes >= 0.6 * len(passage)
            # 202 is the first to end as the passage does, so that last chunk is its own.
            assert r.removed_bytes == (0 if r.doc == 0 else r.repeated_bytes) or r.doc == 202
            assert len(r.kept_text) == len(body[r.doc]) - r.removed_bytes
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0


# --- 10: rules


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_quality_rules(spark):
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        text = sentence(rng, rng.randint(15, 80), "ab" if i % 7 == 0 else "abcdefgh")
        if bad:
            text = text.replace(" ", " # ") if i % 2 else text.upper()
        rows.append((i, text))
        labels.append((i, int(not bad)))
    rows += [(900, None), (901, ""), (902, "a b\na b\n \n \n" * 30), (None, "x " * 50), (3, rows[3][1])]
    docs = documents(spark, rows, "doc rule kept n_words label")
    frame = spark.createDataFrame(labels + [(5, None), (6, 3), (None, 0)], "doc_id long, quality int")
    judged, rules = quality_rules.quality_rules(docs, frame)
    made = judged.collect()
    assert 1 <= len(rules) <= quality_rules.MAX_RULES and len(made) == len(rows)
    want = Counter((i, *brute_counts(t)) for i, t in rows)
    assert Counter((r.doc, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in made) == want
    for r in made:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule == 0)
    truth = dict(labels)
    told = [r for r in made if r.doc in truth and not r.base_failed]
    assert sum(r.kept == bool(truth[r.doc]) for r in told) >= 0.97 * len(told)
    none, no_rules = quality_rules.quality_rules(docs, frame.limit(0))
    assert no_rules == [] and none.where("rule <> 0").count() == 0
    assert quality_rules.quality_rules(docs.limit(0), frame)[0].count() == 0
