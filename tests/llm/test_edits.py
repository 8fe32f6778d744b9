"""Counts of the query's own edits against encoding the cleaned texts whole."""

import public_tokenizers
from pyspark.sql import functions as F

from intervalcast.llm import bpe, edit_counts
from intervalcast.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"


def expected(text):
    encoder, _ = bpe.encoding(public_tokenizers.path(bpe.RANK_FILE), public_tokenizers.PATTERN)
    clean, n = edit_counts.CLEANED.subn(lambda m: m[0][0], text)
    count = lambda x: len(encoder.encode_ordinary(x))
    return count(text), n, count(clean), len(clean)


def test_query_equals_whole_encoding(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    found = QUERIES["op8_edit_counts"](spark, TABLES)
    names = ["n_tokens_before", "n_edits", "n_tokens", "n_chars_after"]
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count() and any(r.n_edits for r in rows)
    for row in rows:
        assert tuple(row[n] for n in names) == expected(row.text or "")


def test_edits_found_in_awkward_texts(spark):
    texts = [None, "", "!!", "1234", "é!!\t\t漢字 12345  !!!" * 300, "no edits", "  " * 5000]
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text STRING, edits INT")
    rows = edit_counts.recounted(docs, edit_counts.cleaning_edits).orderBy("edits").collect()
    for row, text in zip(rows, texts, strict=True):
        found = (row.n_tokens_before, row.n_edits, row.n_tokens, row.n_chars_after)
        assert found == expected(text or "")
    assert edit_counts.recounted(docs.filter(F.lit(False)), edit_counts.cleaning_edits).count() == 0
