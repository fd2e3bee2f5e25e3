"""The pipeline's stages against brute force on the smallest tables, and its registration."""

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from hirelake.llm import bpe
from hirelake.llm.queries import ORACLES, QUERIES
from tests.llm.test_near_copies import brute_groups
from tests.llm.test_operators import brute_hits
from workload.compare import compare, duck


def test_registration():
    names = entry.queries()
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    ok, note = compare(spark, duck(sf_dir), name, QUERIES[name], ORACLES[name], sf_dir)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op12_whitening"}))
def test_every_document_has_a_row(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sorted(r.doc_id for r in QUERIES[name](spark, sf_dir).collect()) == sorted(r.doc_id for r in docs.collect())


def test_stages(spark, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(bpe.named_tokenizer())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    from hirelake.llm.common import staged

    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, columns = docs.collect(), docs.columns
        docs = staged(stage(spark, docs, sf_dir), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count()
        if name != "tokens":
            assert docs.columns == columns and all(r.n_chars == len(r.text) for r in after.values() if name != "quality")
        if name == "quality":
            assert len(good & after.keys()) >= 0.97 * len(good & {r.doc_id for r in before})
        elif name == "lines":
            keys = {}
            for r in before:
                for line in r.text.split("\n"):
                    if len(k := line.strip(" \t\n\x0b\x0c\r").encode().translate(bpe_lower()).decode()) >= 40:
                        keys.setdefault(k, set()).add(r.doc_id)
            for r in before:
                kept = [x for x in r.text.split("\n") if len(own := keys.get(x.strip(" \t\n\x0b\x0c\r").encode().translate(bpe_lower()).decode(), ())) < 5 or max(own) == r.doc_id]
                assert after[r.doc_id].text == "\n".join(kept)
        elif name == "near_duplicates":
            rows = sorted(before, key=lambda r: r.doc_id)
            assert set(after) == {rows[i].doc_id for i in set(brute_groups([r.text for r in rows]))}
        elif name == "decontamination":
            for r in before:
                n, hit, _ = brute_hits(r.text, items, 10)
                assert (r.doc_id in after) == (hit <= 0.5 * n)
                if r.doc_id in after:
                    assert (after[r.doc_id].text == r.text) == (hit == 0)
        else:
            for r in before:
                ids = library.encode(r.text, add_special_tokens=False).ids
                own = after[r.doc_id]
                assert own.ids == ids and own.n_tokens == len(ids)
                assert own.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        seen[name] = len(after)
    assert len(seen) == 5


def bpe_lower():
    from hirelake.llm.common import LOWER

    return LOWER
