"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and their first 4, 5 and 6 bytes, as hashes. The terms that a bounded labelled sample
associates most with the label (chi-squared) are the vocabulary; their document counts come from all
documents. The sample's documents with such terms are the examples. Their inverted index lists the
examples of each term by blocks, with the largest weight of every block; a query opens blocks in the order
of their bounds until no bound exceeds the k-th best cosine. Votes weighted by cosine, and the best cosine,
go through a logistic curve fitted on the examples, each left out in turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm import arrays
from accesslens.llm.labelled import remainder, training_sample

SAMPLE = 20_000  # labelled documents to learn from, at most
TERMS = 1024
EXAMPLES = 4096  # of the sample, at most
NEIGHBOURS = 12
BLOCK = 32
PREFIXES = (4, 5, 6)


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) for every word and prefix of each text, repeated as they repeat."""
    data, offsets = arrays.flat(column)
    low = arrays.lower_table()[data]
    starts, ends, firsts = arrays.borders(low, offsets, arrays.alphanumeric())
    rows = arrays.rows_of(firsts)
    found, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for words, size, hashes in arrays.prefix_hashes(low, starts, ends, PREFIXES):
        found.append(hashes ^ np.uint64(size))
        owners.append(rows[words])
    return np.concatenate(owners), np.concatenate(found)


def term_counts(column: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term number, count) of the vocabulary's terms in each text, by row."""
    rows, found = terms(column)
    if not len(vocabulary):
        return (np.zeros(0, np.int64),) * 3
    # Few terms of a text are known, and most others differ from all of these in their first 16 bits.
    first = np.zeros(1 << 16, bool)
    first[vocabulary >> np.uint64(48)] = True
    some = np.flatnonzero(first[found >> np.uint64(48)])
    rows, found = rows[some], found[some]
    at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
    known = vocabulary[at] == found
    pairs, counts = np.unique(rows[known] * len(vocabulary) + at[known], return_counts=True)
    return pairs // len(vocabulary), pairs % len(vocabulary), counts


def vectors(column: pa.Array, vocabulary: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term number, weight): TF-IDF with logarithmic counts, each row of length 1."""
    rows, numbers, counts = term_counts(column, vocabulary)
    weights = (1 + np.log(np.maximum(counts, 1))) * idf[numbers] if len(rows) else np.zeros(0)
    length = np.sqrt(np.bincount(rows, weights**2, minlength=len(column)))
    return rows, numbers, weights / np.maximum(length[rows], 1e-12)


class Examples:
    """The block-max inverted index of labelled vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, owners: np.ndarray, numbers: np.ndarray, weights: np.ndarray, n_terms: int):
        # Examples with the same strongest term lie side by side, so blocks have tight bounds.
        strongest = np.zeros(len(ids), np.int64)
        order = np.argsort(weights, kind="stable")
        strongest[owners[order]] = numbers[order]
        place = np.lexsort((ids, strongest))
        rank = np.empty(len(ids), np.int64)
        rank[place] = np.arange(len(ids))
        self.ids, self.labels = ids[place], labels[place].astype(np.float64)
        owners = rank[owners]
        self.blocks = -(-len(ids) // BLOCK)
        dense = np.zeros((self.blocks * BLOCK, n_terms), np.float32)
        dense[owners, numbers] = weights
        # Postings of every term, block by block, so that what one term has in a block lies side by side.
        self.postings = dense.T.reshape(n_terms, self.blocks, BLOCK).copy()
        self.most = self.postings.max(2)

    @property
    def dense(self) -> np.ndarray:
        """The weights, examples by terms; the last block is filled up with zeros."""
        return self.postings.reshape(len(self.postings), self.blocks * BLOCK).T

    def nearest(self, numbers: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples with a cosine above 0; ties go to the lower place."""
        bounds = weights @ self.most[numbers]
        order = np.argsort(-bounds, kind="stable")
        falling = -bounds[order].astype(np.float64)
        end = int(np.searchsorted(falling, -1e-9))
        # Rounding may lift a sum of several products above its bound, but not a single product.
        slack = 1e-6 if len(numbers) > 1 else 0.0
        places, cosines = np.zeros(0, np.int64), np.zeros(0)
        at, width = 0, 4
        while at < end:
            opened = order[at : min(at + width, end)]
            rows = (opened[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            got = np.ascontiguousarray(self.postings[numbers[:, None], opened].reshape(len(numbers), -1).T) @ weights
            keep = (got > 1e-9) & (rows != without)
            if len(cosines) >= k:
                keep &= got >= cosines[k - 1]
            keep = np.flatnonzero(keep)
            places, cosines = np.concatenate([places, rows[keep]]), np.concatenate([cosines, got[keep]])
            best = np.lexsort((places, -cosines))[:k]
            places, cosines = places[best], cosines[best]
            at, width = at + width, width * 2
            if len(cosines) >= k:
                # A bound that equals the k-th best may hide a tie at a lower place, so it's opened too; among equal
                # bounds the blocks are in order, and a block behind the k-th best's place has no lower one.
                end = min(end, int(np.searchsorted(falling, slack - cosines[k - 1], "right")))
                if not slack:
                    equal = int(np.searchsorted(falling, -cosines[k - 1]))
                    end = min(end, equal + int(np.searchsorted(order[equal:end], places[k - 1] // BLOCK, "right")))
        return places, cosines

    def features(self, places: np.ndarray, cosines: np.ndarray) -> tuple[float, float]:
        """The votes for the label, weighted by cosine, and the best cosine."""
        return float(cosines @ self.labels[places] / cosines.sum()), float(cosines[0])


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression (the last is the intercept), by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """Vocabulary, examples and calibration; its size is bounded by the parameters."""

    def __init__(self, vocabulary: np.ndarray, idf: np.ndarray, examples: Examples, curve: np.ndarray, otherwise: float):
        self.vocabulary, self.idf, self.examples, self.curve, self.otherwise = vocabulary, idf, examples, curve, otherwise

    def score(self, column: pa.Array, k: int) -> Iterator[tuple[float, list[int], list[float]]]:
        """For each text its score, and its nearest examples with their cosines. Without any near: the share of
        the label among such documents of the sample."""
        rows, numbers, weights = vectors(column, self.vocabulary, self.idf)
        cuts = np.searchsorted(rows, np.arange(len(column) + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            near = self.examples.nearest(numbers[a:b], weights[a:b].astype(np.float32), k) if b > a else None
            if near is None or not len(near[0]):
                yield self.otherwise, [], []
                continue
            z = float(np.array([*self.examples.features(*near), 1.0]) @ self.curve)
            yield 1 / (1 + np.exp(-min(max(z, -30.0), 30.0))), self.examples.ids[near[0]].tolist(), near[1].tolist()


def _vocabulary(sample: DataFrame, most: int) -> np.ndarray:
    """The terms of the sample that are most associated with label 1, by chi-squared."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.blocks(batches, "text"):
            rows, found = terms(batch.column("text"))
            label = batch.column("label").to_numpy()
            order = np.lexsort((rows, found))
            rows, found = rows[order], found[order]
            fresh = np.r_[True, (np.diff(found) != 0) | (np.diff(rows) != 0)][: len(rows)]
            rows, found = rows[fresh], found[fresh]
            begin = np.flatnonzero(np.r_[True, np.diff(found) != 0][: len(found)])
            if len(begin):
                yield pa.RecordBatch.from_arrays([
                    pa.array(found[begin].view(np.int64)), pa.array(np.add.reduceat(label[rows].astype(np.int64), begin)),
                    pa.array(np.diff(begin, append=len(found)).astype(np.int64)),
                ], ["term", "ones", "total"])

    size = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    n, ones = float(size[0]), float(size[1])
    counts = sample.mapInArrow(count, "term long, ones long, total long").groupBy("term").agg(
        F.sum("ones").alias("ones"), F.sum("total").alias("total")).where(F.col("ones") >= min(3.0, ones / 10))
    share = ones / max(n, 1.0)
    expected = F.col("total") * share
    chi = (F.col("ones") - expected) ** 2 / (expected * (1 - share) * (1 - F.col("total") / F.lit(n)) + 1e-9)
    # The largest value is n, for a term that is the label itself: of few rows a tenth of that is asked for.
    best = counts.where((F.col("ones") > expected) & (chi > min(15.0, n / 10))).orderBy(chi.desc(), "term").limit(most).select("term").collect()
    return np.sort(np.array([r[0] for r in best], np.int64).view(np.uint64))


def _idf(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """The inverse document frequency of each term among all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in arrays.blocks(batches, "text"):
            total += np.bincount(term_counts(batch.column("text"), vocabulary)[1], minlength=len(vocabulary))
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.arange(len(vocabulary)), -1]), pa.array(np.r_[total, n])], ["term", "n"])

    rows = docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # one a term
    counts = {r[0]: r[1] for r in rows}
    return np.log((1 + counts.get(-1, 0)) / (1 + np.array([counts.get(i, 0) for i in range(len(vocabulary))], np.float64)))


def fit(docs: DataFrame, sample: DataFrame, most_terms: int = TERMS, most_examples: int = EXAMPLES, k: int = NEIGHBOURS) -> Model:
    """The model of a sample (id, text, label); document counts are those of all ``docs`` (column text)."""
    vocabulary = _vocabulary(sample, most_terms)
    idf = _idf(docs, vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.blocks(batches, "text"):
            rows, numbers, weights = vectors(batch.column("text"), vocabulary, idf)
            cuts = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            pairs = list(zip(cuts[:-1], cuts[1:]))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("label"),
                pa.array([numbers[a:b].tolist() for a, b in pairs], pa.list_(pa.int64())),
                pa.array([weights[a:b].tolist() for a, b in pairs], pa.list_(pa.float64())),
            ], ["id", "label", "numbers", "weights"])

    coded = sample.mapInArrow(encode, "id long, label int, numbers array<long>, weights array<double>")
    bare = coded.where(F.size("numbers") == 0).agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    otherwise = (bare[1] + 0.1) / (bare[0] + 1)
    some = coded.where(F.size("numbers") > 0).orderBy(F.xxhash64("id"), "id", "numbers").limit(most_examples).collect()
    examples = Examples(
        np.array([r.id for r in some], np.int64), np.array([r.label for r in some], np.int64),
        np.repeat(np.arange(len(some)), [len(r.numbers) for r in some]).astype(np.int64),
        np.array([x for r in some for x in r.numbers], np.int64), np.array([x for r in some for x in r.weights]), len(vocabulary))
    x, y = [], []
    for place in range(len(some)):
        weights = examples.dense[place]
        numbers = np.flatnonzero(weights)
        places, cosines = examples.nearest(numbers, weights[numbers], k, without=place)
        if len(places):
            x.append(examples.features(places, cosines))
            y.append(examples.labels[place])
    return Model(vocabulary, idf, examples, fit_curve(np.array(x).reshape(-1, 2), np.array(y)), otherwise)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", k: int = NEIGHBOURS) -> DataFrame:
    """key, score, evidence: every text's score, and its nearest examples (id, cosine), nearest first.

    Null and empty texts, and texts without a term of the vocabulary, get the share of label 1 among such
    documents of the sample, and no evidence. Rows that repeat score alike; a null key stays null.
    """
    fetch = arrays.shared(docs.sparkSession, model)  # bounded by terms times examples
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fetch()
        for batch in arrays.blocks(batches, "text"):
            scores, ids, cosines = zip(*model.score(batch.column("text"), k))
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            near = pa.StructArray.from_arrays(
                [pa.array(chain.from_iterable(x), t) for x, t in ((ids, pa.int64()), (cosines, pa.float64()))], ["id", "cosine"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores, pa.float64()), pa.ListArray.from_arrays(ends, near)],
                ["id", "score", "evidence"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    schema = "id long, score double, evidence array<struct<id: long, cosine: double>>"
    return rows.mapInArrow(task, schema).withColumnRenamed("id", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sample = training_sample(docs, labels, "toxic", remainder("doc_id", 4) != 2, SAMPLE)
    model = fit(docs.select("text"), sample)
    return score(docs, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.get("evidence", F.lit(0))["id"].alias("nearest"))
