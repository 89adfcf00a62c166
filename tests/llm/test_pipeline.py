"""The pipeline against plain versions of its stages."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from lanewright.llm import bpe, queries, secrets, toxicity
from lanewright.llm.shared import stored
from tests.llm import test_decontaminate, test_ngram_join

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    return corpus_pipeline.run(spark, SF).collect()


def test_result(spark, result):
    docs = queries.table(spark, SF, "documents")
    model = toxicity.train(docs, queries.table(spark, SF, "labels"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows = [r for r in rows if model.scores([r[1]], {})[0] < toxicity.THRESHOLD]
    least = {i: c for i, _, c in test_ngram_join.brute(rows)}
    rows = [r for r in rows if least[r[0]] == r[0]]
    items = [(str(r.item_id), r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    found = test_decontaminate.brute([t for _, t in rows], items, 10)
    rows = [r for r, (_, hit, _) in zip(rows, found) if not hit]
    path, library = public_tokenizers.path("byte_bpe_50k.tiktoken"), Tokenizer.from_file(bpe.default_vocabulary())
    expected = []
    for i, text in rows:
        ids = library.encode(secrets.masked(text, path), add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, result)) == sorted(expected)
    assert 0 < len(expected) < docs.count()


def test_stages_keep_columns(spark):
    docs = queries.table(spark, SF, "documents").limit(30)
    odd = spark.createDataFrame([(None, None, None, None, None), (500, "", "en", "s", 0), (500, "", "en", "s", 0)], docs.schema)
    docs = stored(docs.unionByName(odd).selectExpr("*", "'x' as score", "1 as component_id", "2 as spans", "3 as owner"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert out.filter("doc_id = 500").count() == 2 and out.filter("doc_id is null").count() == 1
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names} >= {f"op{k}" for k in range(1, 11)} and "pipeline" in names
