"""Quality classifier: attention over the passages of a document (multiple-instance learning).

A document is a bag of passages of ``PASSAGE`` words. Every passage becomes a vector: shares of kinds of
bytes, word lengths, repetition, and hashed pairs of neighbouring bytes. An encoder, gated attention weights
and the classifier over the weighted passage vector are learnt together from document labels alone,
from a bounded sample. Scoring walks through all passages of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from accesslens.llm import arrays
from accesslens.llm.components import named
from accesslens.llm.labelled import remainder, training_sample

SAMPLE = 4000  # labelled documents to learn from, at most
SAMPLE_PASSAGES = 60_000  # and passages of theirs
PASSAGE = 48
PAIRS = 256  # hashed byte pairs
HIDDEN, GATE = 24, 12
SHAPES = 16


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of all passages, and how many passages come before each text (one more than texts).

    The last passage of a text may be shorter. A text without words is one passage of zeros.
    """
    data, offsets = arrays.flat(column)
    starts, ends, firsts = arrays.borders(data, offsets, arrays.not_space())
    words = np.diff(firsts)
    bags = np.maximum(1, -(-words // PASSAGE))
    before = np.r_[0, np.cumsum(bags)]
    n = int(before[-1])
    rows = arrays.rows_of(firsts)
    own = before[rows] + (np.arange(len(rows)) - firsts[rows]) // PASSAGE  # the passage of each word
    # The passage of each byte: that of the word it belongs to, or follows.
    marks = np.zeros(len(data), np.int32)
    marks[starts] = 1
    at = np.cumsum(marks, dtype=np.int32) - 1
    owner_row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    near = np.where(at >= 0, own[np.maximum(at, 0)] if len(own) else 0, 0)
    of_byte = np.clip(near, before[owner_row], before[owner_row + 1] - 1)

    def share(of: np.ndarray, which: np.ndarray, least: np.ndarray) -> np.ndarray:
        return np.bincount(of[which], minlength=n) / least

    sizes = np.maximum(np.bincount(of_byte, minlength=n), 1)
    counts = np.maximum(np.bincount(own, minlength=n), 1)
    upper = (data >= 0x41) & (data <= 0x5A)
    lower = (data >= 0x61) & (data <= 0x7A)
    digit = (data >= 0x30) & (data <= 0x39)
    space = ~arrays.not_space()[data]
    wide = data >= 0x80
    sign = ~(upper | lower | digit | space | wide)
    lengths = ends - starts
    hashes = arrays.word_hashes(data, starts, ends)
    pair = np.lexsort((hashes, own))
    fresh = np.r_[True, (np.diff(hashes[pair]) != 0) | (np.diff(own[pair]) != 0)][: len(pair)]
    twice = np.zeros(len(hashes), bool)
    twice[1:] = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
    out = np.zeros((n, SHAPES + PAIRS), np.float32)
    shapes = [
        share(of_byte, upper, sizes), share(of_byte, digit, sizes), share(of_byte, sign, sizes), share(of_byte, wide, sizes),
        share(of_byte, space, sizes), share(of_byte, data == 0x0A, counts), np.bincount(own, lengths, n) / counts / 10,
        np.sqrt(np.maximum(np.bincount(own, lengths.astype(float) ** 2, n) / counts - (np.bincount(own, lengths, n) / counts) ** 2, 0)) / 10,
        np.bincount(own[pair[fresh]], minlength=n) / counts, np.bincount(own[twice], minlength=n) / counts,
        share(own, lengths == 1, counts), share(own, sign[ends - 1] if len(ends) else np.zeros(0, bool), counts),
        share(own, upper[starts] if len(starts) else np.zeros(0, bool), counts), share(of_byte, (data == 0x2E) | (data == 0x21) | (data == 0x3F), counts),
        np.log1p(np.bincount(own, minlength=n)) / 4, np.log1p(np.repeat(words, bags)) / 8,
    ]
    for i, values in enumerate(shapes):
        out[:, i] = values
    if len(data) > 1:
        code = arrays.lower_table()[data].astype(np.int64)
        bucket = ((code[:-1] * 257 + code[1:]) * 2654435761 >> 12) % PAIRS
        pairs = np.bincount(of_byte[:-1] * PAIRS + bucket, minlength=n * PAIRS).reshape(n, PAIRS)
        out[:, SHAPES:] = np.sqrt(pairs / sizes[:, None])
    return out, before


class Attention:
    """h = tanh(x W + b); weights of passages: softmax of (tanh(h V) * sigmoid(h U)) w; score: sigmoid(c z + d)."""

    def __init__(self, size: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        shapes = {"W": (size, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "d": (1,)}
        self.parts = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s) for k, s in shapes.items()}
        self.mean, self.scale = np.zeros(size), np.ones(size)

    def forward(self, x: np.ndarray, before: np.ndarray) -> tuple:
        p = self.parts
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        e = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(before) - 1), np.diff(before))
        a = np.exp(e - np.maximum.reduceat(e, before[:-1])[bag])
        a /= np.add.reduceat(a, before[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, before[:-1])
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return h, t, g, bag, a, z, y

    def gradients(self, x: np.ndarray, before: np.ndarray, labels: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        p = self.parts
        h, t, g, bag, a, z, y = self.forward(x, before)
        dy = (y - labels) / len(labels)
        dz = dy[:, None] * p["c"]
        da = (dz[bag] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, before[:-1])[bag])
        dt, dg = de[:, None] * g * p["w"] * (1 - t**2), de[:, None] * t * p["w"] * g * (1 - g)
        dh = a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - h**2)
        found = {"W": x.T @ dx, "b": dx.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ dy, "d": dy.sum(keepdims=True)}
        return {k: v + decay * p[k] for k, v in found.items()}

    def scores(self, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        return self.forward((x - self.mean) / self.scale, before)[-1]

    def attention(self, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The weight of each passage in its document."""
        return self.forward((x - self.mean) / self.scale, before)[4]


def train(x: np.ndarray, before: np.ndarray, labels: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 3e-3,
          decay: float = 1e-4, seed: int = 0) -> Attention:
    """Learns from bags of passages by Adam. Without labelled bags every score is a half."""
    model = Attention(x.shape[1], seed)
    if not len(labels):
        model.parts["c"][:] = 0
        return model
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-3
    x = (x - model.mean) / model.scale
    rng = np.random.default_rng(seed)
    first, second, step = {k: 0.0 for k in model.parts}, {k: 0.0 for k in model.parts}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        pace = rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            sizes = np.diff(before)[chosen]
            own = np.r_[0, np.cumsum(sizes)]
            rows = np.repeat(before[chosen] - own[:-1], sizes) + np.arange(own[-1])
            grads, step = model.gradients(x[rows], own, labels[chosen], decay), step + 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                model.parts[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(sample: DataFrame, most_passages: int = SAMPLE_PASSAGES) -> Attention:
    """The model of a sample (id, text, label), which its maker bounds.

    Vectors are made in tasks. In order of their hash documents are taken up to the first whose passages would go beyond
    ``most_passages``, so the sample doesn't lean to short texts; the driver gets their vectors, and trains.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.blocks(batches, "text", 2 << 20):
            x, before = passages(batch.column("text"))
            half = x.astype(np.float16)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("label"), pa.array(np.diff(before), pa.int64()),
                pa.array([half[a:b].tobytes() for a, b in zip(before[:-1], before[1:])], pa.binary()),
            ], ["id", "label", "n", "x"])

    order = Window.orderBy(F.xxhash64("id"), "id", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    coded = sample.mapInArrow(encode, "id long, label int, n long, x binary").withColumn("total", F.sum("n").over(order))
    rows = coded.where(F.col("total") <= most_passages).orderBy("total", "id").select("label", "x").toArrow()
    size = SHAPES + PAIRS
    labels = rows.column("label").to_numpy().astype(np.float64)
    bags = [np.frombuffer(x.as_buffer(), np.float16).reshape(-1, size) for x in rows.column("x")]  # views, not copies
    before = np.r_[0, np.cumsum([len(b) for b in bags])].astype(np.int64)
    x = np.concatenate(bags, dtype=np.float32, casting="unsafe") if bags else np.zeros((0, size), np.float32)
    del bags, rows
    model = train(x, before, labels)
    del x
    arrays.release()  # the driver lives on
    return model


def score(docs: DataFrame, model: Attention, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and a score of this name, from 0 to 1: how likely label 1 is for each whole text.

    Null and empty texts score as one passage of zeros. Rows that repeat score alike; other columns, whatever
    their names or types, pass through. A column that has the score's name is replaced.
    """
    names = docs.columns
    fetch = arrays.shared(docs.sparkSession, model)  # a few thousand numbers

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = fetch()
        for texts in batches:
            whole = pa.RecordBatch.from_arrays([texts], ["text"])
            out = [model.scores(*passages(block.column("text"))) for block in arrays.blocks(iter([whole]), "text", 2 << 20)]
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    scored = docs.withColumn(name, F.arrow_udf(scores, "double", ArrowUDFType.SCALAR_ITER)(F.col(text).cast("string")))
    return scored.select(*map(named, [*names, name])) if name not in names else scored


def fitted(docs: DataFrame, labels: DataFrame) -> Attention:
    """The model learnt from documents and their labels, without the held-out fifth."""
    return fit(training_sample(docs, labels, "quality", remainder("doc_id", 5) != 0, SAMPLE))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, fitted(docs, labels)).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
