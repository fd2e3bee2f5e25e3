"""Every trusted id serves, however many are held at once."""

import random

from hirelake.llm import kn_quality


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_every_trusted_id_serves(spark, tmp_path):
    rng = random.Random(22)
    spark.createDataFrame([(i, prose(rng, 30), "en") for i in range(120)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    trusted = docs.where("doc_id < 100").select("doc_id")
    # The argument after the order says how many ids are held at once.
    few, all_ = (
        {(r.doc_id, round(r.perplexity, 6), r.calibrates) for r in kn_quality.perplexities(docs, trusted, "doc_id", "text", "lang", 4, n).collect()}
        for n in (15, 1000)
    )
    assert few == all_
