"""The registered text queries: checking SQL where there is some, and the pipeline's stages."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lumetra.llm.oracles import ORACLES
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_checking_sql(spark, sf_dir, name):
    assert compare(connect(sf_dir), ORACLES[name], entry.queries()[name](spark, sf_dir)) is None


def test_stages_keep_the_columns_and_every_token_has_a_place(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
        assert docs.columns == columns and 0 < docs.count() <= n
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == n
