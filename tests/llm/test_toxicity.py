"""Toxicity: held-out accuracy, unseen spellings, edge cases."""

import random
import zlib

import numpy as np
import pytest

from lanewright.llm import queries, toxicity


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    y = np.asarray(labels, dtype=bool)
    return (rank[y].mean() - (y.sum() - 1) / 2) / (~y).sum()


def made(rng, toxic, words=60):
    text = ["".join(rng.choices(["ka", "lo", "mi", "ren", "sto", "vu"], k=rng.randrange(1, 4))) for _ in range(words)]
    if toxic:
        for _ in range(2):
            text[rng.randrange(len(text))] = "idiot" + "".join(rng.choices(["ka", "lo", "mi", "zz", "x", "qu"], k=2))
    return " ".join(text)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(4)
    labels = [int(k % 5 == 0) for k in range(600)]
    return toxicity.trained([made(rng, y, rng.choice([8, 60, 400])) for y in labels], labels)


def test_unseen_spellings_in_long_and_short_texts(model):
    rng = random.Random(5)
    for words in (10, 100, 3000):
        labels = [int(k % 2) for k in range(60)]
        scores = model.scores([made(rng, y, words) for y in labels], {})
        assert auc(scores, labels) > 0.98
        assert all((s >= 0.3) == bool(y) for s, y in zip(scores, labels))


def test_small_training_sets():
    assert toxicity.trained([], []).scores(["x"], {})[0] < 0.01
    assert toxicity.trained(["a b"], [0]).scores(["a b"], {})[0] < 0.01
    assert toxicity.trained(["a b"], [1]).scores(["a b"], {})[0] > 0.99
    assert 0 <= toxicity.trained(["", "x"], [0, 1]).scores([""], {})[0] <= 1


def test_words_do_not_depend_on_their_batch(model):
    words = ["idiotka", "lo", "x" * 64, "é", "mi"]
    assert np.allclose(model.word_scores(words), [model.word_scores([w])[0] for w in words])


def test_repeated_words_count_once():
    mean, a, b = toxicity.worst(np.array([1.0] * 40 + [3.0]))
    assert (mean, a, b) == (2.0, 0, 41)


def test_frames(spark, model):
    rng = random.Random(6)
    rows = [(1, made(rng, 1)), (1, made(rng, 1)), (2, made(rng, 0)), (3, None), (4, ""), (None, "ka lo"), (5, "x" * 300_000), (6, "12 34")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' as score", "1 as id")
    got = {(r.doc_id, r.score >= 0.3) for r in toxicity.score(docs, model).collect()}
    assert got == {(1, True), (2, False), (3, False), (4, False), (None, False), (5, False), (6, False)}
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and clean.count() == 6
    assert toxicity.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels.limit(0)).bias == -30
    toxicity.train(docs, labels)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op6_toxicity(spark, sf).collect()
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect())
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    judged = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert auc(*zip(*judged)) > 0.9


def test_trains_in_a_task(spark, monkeypatch):
    rng, here, real = random.Random(8), [], toxicity.trained
    labels = [int(k % 5 == 0) for k in range(60)]
    rows = [(k, made(rng, y, 20)) for k, y in enumerate(labels)]
    used = [k for k in range(60) if zlib.crc32(str(k).encode()) % 4 != 2]

    def spy(*args):
        here.append(1)  # a task has a list of its own
        return real(*args)

    monkeypatch.setattr(toxicity, "trained", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int"))
    assert not here
    expected = real([rows[k][1] for k in used], [labels[k] for k in used], sum(labels[k] for k in used) / len(used))
    assert model.bias == expected.bias and (model.weights == expected.weights).all()


def test_new_words_are_scored_some_at_a_time(model, monkeypatch):
    rng, sizes, real = random.Random(9), [], toxicity.subwords
    texts = [made(rng, k % 2, 300) for k in range(20)]
    expected = model.scores(texts, {})
    monkeypatch.setattr(toxicity, "subwords", lambda words: sizes.append(len(words)) or real(words))
    monkeypatch.setattr(toxicity, "WORDS", 50, raising=False)
    assert model.scores(texts, {}) == expected
    assert max(sizes) <= 50
