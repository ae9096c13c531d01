"""The pipeline's stages on odd rows, and the choice of one document of each group."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from galewright.llm import simhash

PROSE = "the committee met in the old hall and spoke for hours about the bridge, the river and the road to the north"
OTHER = "Recipes for bread differ from town to town; some bakers add honey, while others swear by salt and long rests"


def kept(spark, rows, **columns):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({k: F.lit(v) for k, v in columns.items()})
    return sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(df.repartition(3)).collect()), key=repr)


def test_unrelated_texts_with_one_id_both_stay(spark):
    assert kept(spark, [(1, PROSE), (1, OTHER)]) == [(1, OTHER), (1, PROSE)]


def test_copies_without_id_become_one(spark):
    assert kept(spark, [(None, PROSE), (None, PROSE), (None, OTHER)]) == [(None, OTHER), (None, PROSE)]
    assert kept(spark, [(None, PROSE), (7, PROSE + " ")]) == [(7, PROSE + " ")]


def test_the_smallest_id_of_a_group_stays(spark):
    near = PROSE.upper()
    assert kept(spark, [(5, PROSE), (3, near), (9, PROSE), (3, near), (4, OTHER)]) == [(3, near), (4, OTHER)]


def test_an_id_may_head_two_groups_and_lie_in_a_third(spark):
    rows = [(1, PROSE), (1, OTHER), (2, PROSE), (0, OTHER), (1, None), (2, "")]
    assert kept(spark, rows) == [(0, OTHER), (1, PROSE), (1, None)]


def test_clashing_columns_come_through(spark, no_rows):
    names = {c: "clash" for c in ("row", "row_digest", "fp", "node", "component", "group", "copies", "id")}
    assert kept(spark, [(1, PROSE), (2, PROSE)], **names) == [(1, PROSE)]
    assert simhash.keep_one(no_rows).collect() == []


@pytest.fixture(scope="module")
def stages():
    import corpus_pipeline

    return corpus_pipeline.STAGES


def test_stages_take_edge_rows_and_clashing_columns(spark, sf, docs, edges, stages):
    """Edge rows among documents: the stages keep the columns, and never add a row."""
    rows = edges.unionByName(docs.withColumns({c: F.lit("clash") for c in edges.columns if c not in docs.columns}))
    for name, stage in stages[:-1]:
        out = stage(spark, rows, sf)
        assert out.columns == rows.columns, name
        assert out.exceptAll(rows).isEmpty(), name
        rows = out
    packed = stages[-1][1](spark, rows, sf)
    assert packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 2048
    assert packed.where("piece = 0").count() == rows.count()


def test_stages_take_an_empty_table(spark, sf, no_rows, stages):
    for name, stage in stages:
        assert stage(spark, no_rows, sf).count() == 0, name
