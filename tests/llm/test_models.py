"""Classifiers: held-out accuracy, exact neighbours, awkward rows."""

import numpy as np
import pyarrow as pa
import pytest

from accesslens.llm import arrays, labelled, quality, toxicity
from tests.llm.cases import SCHEMA, awkward, rows

SF = "/root/testdata/sf0.01"


def held_out(spark, module, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = module.query(spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    return out.where("held_out").join(labels, "doc_id").select("score", "predicted", label).toPandas()


def test_quality_on_held_out_rows(spark):
    x = held_out(spark, quality, "quality")
    assert (x.predicted == x.quality).mean() >= 0.95
    assert x.score.between(0, 1).all()


def test_toxicity_on_held_out_rows(spark):
    x = held_out(spark, toxicity, "toxic")
    assert (x.predicted == x.toxic).mean() >= 0.88
    assert x[x.toxic == 1].score.mean() > 4 * x[x.toxic == 0].score.mean()


def test_samples_are_bounded_and_learn_no_held_out_row(spark):
    docs = spark.createDataFrame(rows(awkward()), SCHEMA)
    labels = spark.createDataFrame([(i, i % 3, None) for i in range(130)] + [(3, 1, None), (None, 1, None), (5, None, None)], "doc_id long, toxic int, text string")
    sample = labelled.training_sample(docs, labels, "toxic", labelled.remainder("doc_id", 4) != 2, 9).collect()
    assert len({r.id for r in sample}) <= 9 and {r.label for r in sample} <= {0, 1}
    import zlib
    assert all(zlib.crc32(str(r.id).encode()) % 4 != 2 for r in sample)


def test_gradients():
    rng = np.random.default_rng(0)
    x, before, labels = rng.normal(size=(9, 5)), np.array([0, 3, 4, 9]), np.array([1.0, 0.0, 1.0])
    model = quality.Attention(5)
    grads = model.gradients(x, before, labels, 0.0)

    def loss():
        y = model.forward(x, before)[-1]
        return -(labels * np.log(y) + (1 - labels) * np.log(1 - y)).mean()

    for name, part in model.parts.items():
        at = tuple(0 for _ in part.shape)
        old, step = part[at], 1e-6
        part[at] = old + step
        up = loss()
        part[at] = old - step
        down = loss()
        part[at] = old
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), rel=1e-4, abs=1e-8)
    weights = model.attention(x, before)
    assert np.allclose(np.add.reduceat(weights, before[:-1]), 1)


def test_quality_of_awkward_rows(spark):
    model = quality.train(np.zeros((0, quality.SHAPES + quality.PAIRS)), np.array([0]), np.zeros(0))
    docs = spark.createDataFrame(rows(awkward()), SCHEMA)
    out = quality.score(docs, model)
    assert sorted(out.columns) == sorted(docs.columns)
    assert {r.score for r in out.collect()} == {0.5}
    assert quality.score(docs.limit(0), model).collect() == []
    x, before = quality.passages(pa.array([None, "", "a b", "w " * 100]))
    assert before.tolist() == [0, 1, 2, 3, 6] and np.isfinite(x).all()


def test_neighbours_are_exact():
    rng = np.random.default_rng(4)
    n, terms = 300, 40
    dense = rng.random((n, terms)) * (rng.random((n, terms)) < 0.1)
    dense[150:] = dense[:150]  # ties
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    owners, numbers = np.nonzero(dense)
    index = toxicity.Examples(np.arange(n), rng.integers(0, 2, n), owners, numbers, dense[owners, numbers], terms)
    for _ in range(60):
        query = rng.random(terms) * (rng.random(terms) < 0.1)
        at = np.flatnonzero(query)
        weights = (query[at] / max(np.linalg.norm(query), 1e-12)).astype(np.float32)
        places, cosines = index.nearest(at, weights, 12)
        whole = index.dense[:, at] @ weights
        want = [i for i in np.lexsort((np.arange(len(whole)), -whole)) if whole[i] > 1e-9][:12]
        assert np.allclose(cosines, whole[want], atol=1e-6) and len(places) == len(want)
        assert np.allclose(whole[places], cosines, atol=1e-6)


def test_equal_examples_are_not_all_opened(monkeypatch):
    # 3000 examples of term 0 alone, 3000 of terms 0 and 1: ties fill 94 blocks each.
    n, terms = 6000, 3
    dense = np.zeros((n, terms))
    dense[::2, 0] = 1
    dense[1::2, :2] = 0.8, 0.6
    owners, numbers = np.nonzero(dense)
    index = toxicity.Examples(np.arange(n), np.arange(n) % 2, owners, numbers, dense[owners, numbers], terms)
    merges, sort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda *a: merges.append(1) or sort(*a))
    for without in (-1, 3):
        places, cosines = index.nearest(np.array([0]), np.ones(1, np.float32), 12, without)
        whole = index.dense[:, 0].copy()
        whole[max(without, 0)] *= without < 0
        assert places.tolist() == sort((np.arange(len(whole)), -whole))[:12].tolist() and set(cosines) == {1.0}
    assert len(merges) == 2
    places, cosines = index.nearest(np.array([0, 1]), np.array([0.8, 0.6], np.float32), 12)
    whole = index.dense[:, :2] @ np.array([0.8, 0.6], np.float32)
    assert np.allclose(cosines, np.sort(whole)[::-1][:12]) and np.allclose(whole[places], cosines)


def test_terms_are_words_and_their_first_bytes():
    texts = ["Abcdefgh abcd, abcde", None, "", "\u00e4\u00e4\u00e4 x", "q" * 3_000_000 + " abcdefg", "word " * 400_000]
    rows, found = toxicity.terms(pa.array(texts))

    def one(word, size):
        data = np.frombuffer(word, np.uint8)
        return int(arrays.word_hashes(data, np.array([0]), np.array([len(data)]))[0]) ^ size

    want = []
    for row, text in enumerate(texts):
        for word in (text or "").lower().replace(",", "").encode().split():
            sizes = [p for p in toxicity.PREFIXES if len(word) > p]
            want += [(row, word, 0)] + [(row, word[:p], p) for p in sizes]
    hashes = {(w, p): one(w, p) for _, w, p in set(want)}
    assert sorted(zip(rows.tolist(), found.tolist())) == sorted((r, hashes[w, p]) for r, w, p in want)
    vocabulary = np.sort(np.array([one(b"abcd", 4), one(b"abcd", 0), one(b"word", 0), 7, 1 << 63], np.uint64))
    owners, numbers, counts = toxicity.term_counts(pa.array(texts), vocabulary)
    got = sorted((r, int(vocabulary[t]), c) for r, t, c in zip(owners.tolist(), numbers.tolist(), counts.tolist()))
    assert got == sorted([(0, one(b"abcd", 4), 2), (0, one(b"abcd", 0), 1), (4, one(b"abcd", 4), 1), (5, one(b"word", 0), 400_000)])


def test_toxicity_of_awkward_rows(spark):
    docs = spark.createDataFrame(rows(awkward()), SCHEMA)
    nothing = spark.createDataFrame([], "id long, text string, label int")
    model = toxicity.fit(docs.select("text"), nothing)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(awkward()) and all(0 <= r.score <= 1 and r.evidence == [] for r in out)
    sample = spark.createDataFrame([(i, f"bad{i % 3} words here" if i % 2 else "good words", i % 2) for i in range(60)], "id long, text string, label int")
    model = toxicity.fit(sample.select("text"), sample)
    scored = {r.doc_id: r for r in toxicity.score(spark.createDataFrame([(1, "so bad1 this"), (2, "good words"), (3, None)], "doc_id long, text string"), model).collect()}
    assert scored[1].score > 0.5 > scored[2].score and scored[1].evidence and not scored[3].evidence
