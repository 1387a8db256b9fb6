"""Registered text queries against their oracle SQL, and the pipeline against its stages."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from oracle_check import compare

import corpus_pipeline
from millrace.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables absent")


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_oracle(spark, name):
    rows, difference = compare(spark, SF_DIR, QUERIES[name], ORACLE[name])
    assert difference == "" and rows > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    if name.startswith("op5"):
        wanted = set(spark.read.parquet(f"{SF_DIR}/conversations.parquet").toPandas().conv_id) | {-7}
        assert set(found.conv_id) == wanted and len(found) == len(wanted)
    else:
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()
        assert sorted(found.doc_id) == sorted(docs.doc_id)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR).cache()
        assert after.columns == docs.columns
        assert {r[0] for r in after.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
        before = after
    text = {r["doc_id"]: r["text"] for r in before.collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in found} == set(text)
    for r in found:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(text[r["doc_id"]], add_bos=True, add_eos=True)
