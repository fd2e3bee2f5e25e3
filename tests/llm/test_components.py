"""Components without a job for each step of each round, joins that leave the driver alone."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import readwriter

from hirelake.llm.common import BROADCAST, SMALL, Stages
from hirelake.llm.components import components, stars
from hirelake.llm.near_copies import near_copies


def _links():
    rng = random.Random(4)
    chain = list(range(100, 400))
    rng.shuffle(chain)
    return [*zip(chain, chain[1:], strict=False), *((rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(300))]


def _least(links):
    least = {x: x for e in links for x in e}
    while any(least[u] != least[v] for u, v in links):
        for u, v in links:
            least[u] = least[v] = min(least[u], least[v])
    return {x: r for x, r in least.items() if x != r}


@pytest.mark.parametrize("whole", [10**6, 599, 40])
def test_any_block_gives_the_same(spark, whole):
    links = _links()
    rows = spark.createDataFrame(links, "u long, v long").repartition(6)
    assert {r.node: r.root for r in components(rows, whole=whole).collect()} == _least(links)


def test_few_links_take_few_jobs(spark):
    """Each round's jobs leave plans and compiled code on the driver."""
    rows = spark.createDataFrame(_links(), "u long, v long")
    spark.sparkContext.setJobGroup("components", "components")
    try:
        components(rows)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("components")
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert 0 < len(jobs) <= 8


def test_a_long_chain_takes_few_steps():
    n = 200_000
    order = np.random.default_rng(1).permutation(n)
    assert (stars(n, order[1:], order[:-1]) == 0).all()


def test_joins_on_the_way_broadcast_little(spark, monkeypatch):
    asked, write = [], readwriter.DataFrameWriter.parquet
    monkeypatch.setattr(readwriter.DataFrameWriter, "parquet", lambda self, path: asked.append(spark.conf.get(BROADCAST)) or write(self, path))
    before = spark.conf.get(BROADCAST)
    try:
        for given, used in (("64m", str(SMALL)), ("10k", "10240"), ("-1", "-1")):
            spark.conf.set(BROADCAST, given)
            components(spark.range(3).selectExpr("id as u", "id + 1 as v"))
            assert set(asked) == {used} and spark.conf.get(BROADCAST) == given
            asked.clear()
        Stages(spark).add(spark.range(1), "plain")
        assert asked == ["-1"]
    finally:
        spark.conf.set(BROADCAST, before)


def test_repeated_names_are_not_broadcast(spark, monkeypatch):
    """Spark sizes a component's name once, but it is repeated for each salt."""
    plans, write = {}, readwriter.DataFrameWriter.parquet

    def spy(self, path):
        plans[path.rsplit("/", 1)[-1].split("-")[0]] = self._df._jdf.queryExecution().executedPlan().toString()
        return write(self, path)

    monkeypatch.setattr(readwriter.DataFrameWriter, "parquet", spy)
    docs = spark.createDataFrame([(i, " ".join(f"w{i % 5}x{k}" for k in range(40))) for i in range(20)], "doc_id long, text string")
    assert {r.doc: r.component for r in near_copies(docs).collect()} == {i: i % 5 for i in range(20)}
    assert re.search(r"SortMergeJoin \[root#\d+L, salt#\d+\]", plans["alike"]) and "Generate explode" in plans["alike"]
