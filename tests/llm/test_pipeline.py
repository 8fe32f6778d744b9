"""The registered text queries and the stages of the pipeline."""

import public_tokenizers
import pytest

import check
import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from intervalcast.llm import bpe
from intervalcast.llm.common import documents

TABLES = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names}


@pytest.mark.parametrize("name", ["op1_mixing", "op6_exact_dedup"])
def test_equal_to_sql(spark, name):
    con = check.connect(TABLES)
    assert check.differences(queries()[name](spark, TABLES), con, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["op5_pii", "op7_repeats", "op8_edit_counts", "op9_toxicity", "op10_quality_rules"])
def test_a_row_per_document(spark, name):
    rows = queries()[name](spark, TABLES)
    assert rows.select("doc_id").distinct().count() == documents(spark, TABLES).count() == rows.count()


def test_stages(spark):
    docs = documents(spark, TABLES)
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, TABLES), name)
        sizes.append(docs.count())
        if name != "bpe":
            assert docs.columns == columns
        if name in ("exact_dedup", "near_dedup"):
            assert docs.select("doc_id").distinct().count() == sizes[-1] <= sizes[-2]
    assert sizes[3] <= sizes[4] <= 2 * sizes[3] and sizes[4] == sizes[5]
    encoder, _ = bpe.encoding(public_tokenizers.path(bpe.RANK_FILE), public_tokenizers.PATTERN)
    row = docs.first()
    assert row.n_tokens == len(encoder.encode_ordinary(row.text))
