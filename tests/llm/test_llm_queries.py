"""Queries of the subpackage beside their SQL, and the pipeline, on the smallest tables."""

import os

import pytest

from checks import compare
from meterweave.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, key):
    got = QUERIES[key](spark, SF_DIR).toPandas()
    want = compare.duck(SF_DIR).sql(ORACLES[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert compare.rows_of(got) == compare.rows_of(want)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
def test_pipeline_keeps_what_its_stages_keep(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.stored(stage(spark, docs, SF_DIR), f"test-{i}")
        assert out.columns[: len(names)] == names
        docs = out
    assert docs.columns == [*names, "shard", "slot"] and not docs.isEmpty()
