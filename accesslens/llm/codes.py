"""Vector code compression: product quantisation in whole numbers, by exact matrix products.

Components become integers. The products of ``numpy``'s float64 BLAS are exact while every partial sum
stays below 2^53, so integers are broken into limbs of as few bits as that takes; the products of limbs are
put together in int64. Distances, and so the codes, don't depend on the order in which BLAS adds.

Codebooks are small and bounded by the parameters: they are broadcast each round. Tasks add up the parts of
every entry, Spark adds the tasks' sums, and the driver gets one row an entry.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm import arrays
from accesslens.llm.components import cut
from accesslens.llm.skew import attached

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
EXACT_BITS = 53  # of float64
ROWS = 4096  # worked on together


def bits(values: np.ndarray) -> int:
    """Of the largest magnitude."""
    return int(max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))).bit_length()


def limbs(values: np.ndarray, size: int) -> list[np.ndarray]:
    """Signed integers as float64 limbs of ``size`` bits, lowest first; only the last may be negative."""
    out = []
    while bits(values) > size:
        high = values >> size
        out.append((values - (high << size)).astype(np.float64))
        values = high
    return [*out, values.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices, exact if the result fits into int64."""
    room = EXACT_BITS - max(1, a.shape[1]).bit_length()  # for the product of two limbs
    if bits(a) + bits(b) <= room:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    size, out = room // 2, np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, size)
    for i, x in enumerate(limbs(a, size)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (size * (i + j))
    return out


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the nearest entries for each row, and the squared distance.

    Where a distance might leave int64, Python's integers take over.
    """
    width = parts.shape[1]
    if 2 * (max(bits(parts), bits(entries)) + 1) + max(1, width).bit_length() > 62:
        parts, entries = parts.astype(object), entries.astype(object)
        far = (parts * parts).sum(1)[:, None] - 2 * parts.dot(entries.T) + (entries * entries).sum(1)[None, :]
        best = np.array([min(range(len(row)), key=row.__getitem__) for row in far.tolist()], np.int64)
        return best, far[np.arange(len(far)), best]
    parts, entries = parts.astype(np.int64), entries.astype(np.int64)
    far = (entries * entries).sum(1)[None, :] - 2 * exact_products(parts, entries)
    best = far.argmin(1)  # the first one
    return best, far[np.arange(len(far)), best] + (parts * parts).sum(1)


def whole_numbers(column: pa.Array, size: int, scale: int) -> np.ndarray:
    """floor(scale * x) for every component; object integers where int64 doesn't hold them."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not (np.abs(scaled) < 2.0**62).all():
        exact = [math.floor(x * scale) if abs(x) < 2.0**52 else int(x) * scale for x in values.ravel().tolist()]
        return np.array(exact, object).reshape(-1, size)
    return scaled.astype(np.int64)


class Codebooks:
    """Entries of every part: parts x entries x width integers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    def assigned(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each part its slice of the rows, the entries chosen and the squared distances."""
        for part, own in zip(np.split(rows, len(self.entries), axis=1), self.entries, strict=True):
            yield part, *nearest(part, own)

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Entries replaced by the floored mean of their rows; unused ones stay."""
        now = self.entries.astype(object)
        for (part, entry), (n, total) in sums.items():
            if None in total:
                raise ValueError("components add up to more than 38 digits")
            now[part, entry] = [int(t) // n for t in total]
        return Codebooks(now if bits(now) > 62 else now.astype(np.int64))

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """id, v, label of rows whose vector isn't null and has finite components only."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return vectors.where(F.col(vector).isNotNull() & ~bad).select(F.col(key).cast("long").alias("id"), v.alias("v"), F.col(label).alias("label"))


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[Codebooks, int]:
    """Codebooks of rows (id, v), and the vectors' length: that of the smallest id's vector, null ids last.

    The first codebooks are the parts of the ``entries`` smallest ids' rows, equal ids in order of their vectors.
    """
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).select("v").collect()
    size = len(first[0].v) if first else 0
    if size % parts:
        raise ValueError(f"vectors of {size} components can't be cut into {parts} equal parts")
    rows = rows.where(F.size("v") == size).select("id", "v")
    start = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").toArrow().column("v").combine_chunks()
    if not len(start) or not size:
        return Codebooks(np.zeros((parts, min(len(start), 1), 0), np.int64)), size
    books = Codebooks(np.stack(np.split(whole_numbers(start, size, scale), parts, axis=1)))
    width = size // parts
    for _ in range(rounds):
        fetch = arrays.shared(rows.sparkSession, books)  # parts x entries x width numbers

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = fetch()
            counts: dict[tuple[int, int], int] = {}
            sums: dict[tuple[int, int], np.ndarray] = {}
            for block in _blocks(batches):
                found = whole_numbers(block.column("v"), size, scale)
                for part, (own, best, _) in enumerate(books.assigned(found)):
                    order = np.argsort(best, kind="stable")
                    begin = np.flatnonzero(np.diff(best[order], prepend=-1))
                    totals = np.add.reduceat(own[order].astype(object) if bits(own) > 48 else own[order], begin)
                    for entry, n, total in zip(best[order][begin].tolist(), np.diff(begin, append=len(best)).tolist(), totals):
                        at = (part, entry)
                        counts[at] = counts.get(at, 0) + n
                        sums[at] = sums.get(at, 0) + total.astype(object)
            keys = sorted(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([p for p, _ in keys], pa.int32()), pa.array([e for _, e in keys], pa.int32()),
                pa.array([counts[k] for k in keys], pa.int64()),
                pa.array([[str(int(x)) for x in sums[k]] for k in keys], pa.list_(pa.string())),
            ], ["part", "entry", "n", "sums"])

        partial = rows.select("v").mapInArrow(added, "part int, entry int, n long, sums array<string>")
        totals = [F.try_sum(F.col("sums")[i].try_cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        found = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect()  # parts x entries rows
        books = books.moved({(r.part, r.entry): (r.n, [r[f"s{i}"] for i in range(width)]) for r in found})
    return books, size


def encode(rows: DataFrame, books: Codebooks, size: int, scale: int = SCALE) -> DataFrame:
    """id, label, code, error (decimal) of the rows with vectors of this length."""
    fetch = arrays.shared(rows.sparkSession, books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = fetch()
        for block in _blocks(batches):
            if size:
                found = list(books.assigned(whole_numbers(block.column("v"), size, scale)))
                codes = np.stack([best for _, best, _ in found], axis=1)
                error = [str(sum(x)) for x in zip(*(far.tolist() for *_, far in found))]
            else:
                codes, error = np.zeros((block.num_rows, len(books.entries)), np.int64), ["0"] * block.num_rows
            text = codes.astype(np.uint8).tobytes().hex()
            step = 2 * codes.shape[1]
            yield pa.RecordBatch.from_arrays([
                block.column("id"), block.column("label"),
                pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()), pa.array(error, pa.string()),
            ], ["id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    out = rows.where(F.size("v") == size).mapInArrow(coded, f"id long, label {kind}, code string, error string")
    return out.withColumn("error", F.col("error").try_cast("decimal(38,0)"))


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """key, code, error, label_error, codebooks_sha256 of every usable vector.

    Vectors that are null, or hold null or non-finite components, are left out, and so are those whose length isn't
    that of the smallest key's. ``entries`` is 256 at most (two hex digits). Null keys come last among the first
    entries; rows that repeat are coded each and count each. Fewer rows than entries make a smaller codebook;
    vectors without components have code 0. Errors beyond a long come out null;
    components that add up to more than 38 digits raise.
    An empty table gives no rows. Labels may be null (one label together) or of any plain type.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries has to be 1 to 256")
    rows = usable(vectors, key, vector, label)
    books, size = fit(rows, parts, entries, rounds, scale)
    coded = cut(encode(rows, books, size, scale).select(
        "id", "code", "error", F.struct(F.col("label").isNull().alias("none"), "label").alias("label")).withColumn("tag", F.to_json("label")))
    facts = coded.groupBy("tag").agg(F.count("*").alias("n"), F.try_sum("error").alias("label_error"))
    long = lambda c: F.col(c).try_cast("long").alias(c)
    return attached(coded.select("id", "code", "error", "tag"), facts, ["tag"], "id").select(
        F.col("id").alias(key), "code", long("error"), long("label_error"), F.lit(books.digest()).alias("codebooks_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> str:
    """One CTE an assignment and one a new codebook."""
    assigned = """a{r} AS MATERIALIZED (
    SELECT part, row, min_by(entry, far * 1000 + entry) AS entry, min(far) AS far FROM (
        SELECT part, row, entry, sum((x.v - c.v) * (x.v - c.v)) AS far FROM x JOIN c{r} c USING (part, pos) GROUP BY ALL)
    GROUP BY ALL
)"""
    moved = """c{n} AS MATERIALIZED (
    SELECT c.part, c.entry, c.pos, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
        SELECT part, entry, pos, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS v
        FROM x JOIN a{r} USING (part, row) GROUP BY ALL) m USING (part, entry, pos)
)"""
    steps = [assigned.format(r=0)]
    for r in range(rounds):
        steps += [moved.format(r=r, n=r + 1), assigned.format(r=r + 1)]
    return f"""
WITH k AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, embedding AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), x AS MATERIALIZED (
    SELECT row, (i - 1) // (len(v) // {parts}) AS part, (i - 1) % (len(v) // {parts}) AS pos, floor(1024 * v[i]::DOUBLE)::BIGINT AS v
    FROM (SELECT row, v, unnest(range(1, len(v) + 1)) AS i FROM k)
), c0 AS MATERIALIZED (
    SELECT part, row - 1 AS entry, pos, v FROM x WHERE row <= {entries}
), {", ".join(steps)}, e AS (
    SELECT row, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM a{rounds} GROUP BY row
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
FROM k JOIN e USING (row)
"""


SQL = _sql()
