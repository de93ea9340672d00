"""The pipeline and the registered queries."""

from collections import Counter

import pytest
from llm_helpers import SF
from oracle_harness import duck, duck_rows, spark_rows

import __spark_entry__ as entry
import corpus_pipeline
from tabletrust.llm import ngram_join
from tabletrust.llm.components import components


def test_all_operators_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op") and n[2].isdigit()))
def test_queries_match_their_sql(spark, name):
    con = duck(SF)
    assert spark_rows(entry.queries()[name](spark, SF)) == duck_rows(con, entry.oracle_sql()[name])


def test_stages_in_turn(spark, odd, tmp_path):
    docs, kept = odd, None
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == odd.columns
        if name == "language ID":
            assert docs.where("text is null or text = ''").count() == 0
        if name == "n-gram Jaccard join":
            classes = ngram_join.ngram_links(before)
            assert docs.count() == classes.select("class_key").distinct().count()
            kept = docs
        if name == "mixing sources":
            assert Counter(r.source for r in docs.collect()).keys() <= Counter(r.source for r in kept.collect()).keys()
    ends = docs.where("start + length = doc_tokens").count()
    assert ends == spark.read.parquet(str(tmp_path / "3")).count()


def test_components_against_union_find(spark):
    import random
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5), (None, 3), (7, None)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    root = {x: x for e in edges if None not in e for x in e}

    def up(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in (e for e in edges if None not in e):
        a, b = sorted((up(a), up(b)))
        root[b] = a
    assert got == {x: up(x) for x in root}
    assert components(spark.createDataFrame([], "a int, b int"), "a", "b").collect() == []


