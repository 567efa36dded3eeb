"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last ``ROLL`` lines ends a chunk where it is 0 modulo ``DIVISOR``; of borders
that follow each other line by line the first holds, so a chunk has two lines at least. Borders depend on nearby
lines only and move with them. Every line of a text of two lines or more lies in one chunk.

Chunks whose hash stands twice in the corpus are compared byte by byte with the first one, their keeper; the others
go. A chunk that goes takes lines around it along, as far as the lines around its keeper are equal by their bytes: a
repeated block loses its borders too, though they lie in chunks that aren't repeated as a whole. What is removed
always stays somewhere in one piece: chunks don't overlap, a keeper's lines stay, and so do the lines around a
keeper that others were compared with.

Chunk rows are slim; texts are shuffled by their row once, for the comparison and the cut alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from accesslens.llm import arrays
from accesslens.llm.components import cut, named
from accesslens.llm.skew import attached

ROLL = 2
DIVISOR = 4
SALT_ROWS = 500  # occurrences that meet one copy of their keeper


def rolled(hashes: np.ndarray, rows: np.ndarray, roll: int) -> np.ndarray:
    """A hash over each line and the ``roll`` - 1 lines before it in its text."""
    total = np.zeros(len(hashes), np.uint64)
    for back in range(roll):
        part = np.zeros(len(hashes), np.uint64)
        part[back:] = hashes[: len(hashes) - back] * np.uint64(pow(arrays.SEEDS[0], back + 1, 1 << 64))
        part[back:][rows[back:] != rows[: len(rows) - back]] = 0
        total += part
    return arrays.mixed(total)


def chunk_ends(hashes: np.ndarray, rows: np.ndarray, roll: int, divisor: int) -> np.ndarray:
    """Whether a chunk ends after each line."""
    border = rolled(hashes, rows, roll) % np.uint64(divisor) == 0
    last = np.r_[rows[1:] != rows[:-1], True][: len(rows)]
    first = np.r_[True, last[:-1]][: len(rows)]
    after = np.r_[False, border[:-1]][: len(rows)] & ~first  # the line before has a border
    before = np.r_[last[1:], False][: len(rows)] & ~last  # only one line is left
    return border & ~first & ~after & ~before | last


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line (parted by \\n), and how many lines come before each text."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    return starts, ends, np.searchsorted(breaks, offsets) + np.arange(len(offsets))


class Texts:
    """The lines of a column of texts, and their chunks of two lines or more that aren't blank."""

    def __init__(self, column: pa.Array, roll: int, divisor: int):
        data, offsets = arrays.flat(column)
        self.starts, self.ends, self.firsts = lines_of(data, offsets)
        self.data, owner = data.tobytes(), arrays.rows_of(self.firsts)
        last = np.flatnonzero(chunk_ends(arrays.word_hashes(data, self.starts, self.ends), owner, roll, divisor))
        self.begin = np.r_[0, last[:-1] + 1][: len(last)]
        self.size = last - self.begin + 1
        seen = np.r_[0, np.cumsum(arrays.not_space()[data])]
        self.counts = (self.size > 1) & (seen[self.ends[last]] > seen[self.starts[self.begin]])
        self.row = owner[self.begin]

    def lines(self, begin: int, size: int) -> bytes:
        return self.data[self.starts[begin] : self.ends[begin + size - 1]] if size else b""


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """rest (the other columns), id, text and row: the MD5 of key and text, which rows that repeat share."""
    others = [F.col(named(c)) for c in docs.columns if c != text]
    rows = docs.select(
        F.struct(*others).alias("rest"), F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    tag = F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))))
    return rows.withColumn("row", F.coalesce(F.unhex(tag), F.lit(bytearray())))


def _chunks(rows: DataFrame, roll: int, divisor: int) -> DataFrame:
    """row, id, begin, size, hash of all chunks."""
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("size", pa.int32()), ("hash", pa.binary())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.blocks(batches, "text"):
            found = Texts(batch.column("text"), roll, divisor)
            begin, size, row = (x[found.counts] for x in (found.begin, found.size, found.row))
            digests = [hashlib.blake2b(found.lines(b, n), digest_size=16).digest() for b, n in zip(begin.tolist(), size.tolist())]
            fields = [pa.array(x, pa.int32()) for x in (begin - found.firsts[row], size)]
            out = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32()),
                pa.StructArray.from_arrays([*fields, pa.array(digests, pa.binary())], fields=list(kind.value_type)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), out], ["row", "id", "chunks"])

    listed = rows.select("row", "id", "text").mapInArrow(task, "row binary, id long, chunks array<struct<begin: int, size: int, hash: binary>>")
    return listed.select("row", "id", F.explode("chunks").alias("c")).select("row", "id", "c.begin", "c.size", "c.hash")


PLACED = "hash binary, n long, keeper boolean, row binary, begin int, size int, body binary, before binary, n_before int, after binary, n_after int"


def _placed(texts: DataFrame, roll: int, divisor: int) -> DataFrame:
    """The bytes of repeated chunks, and of the lines around them that may repeat too: those of the chunk next to it if
    that isn't repeated, around a keeper also those of another keeper."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.blocks(batches, "text"):
            found, out = Texts(batch.column("text"), roll, divisor), []
            cuts = np.searchsorted(found.row, np.arange(batch.num_rows + 1)).tolist()
            for i, (row, marks) in enumerate(zip(batch.column("row").to_pylist(), batch.column("marks").to_pylist())):
                first, own = found.firsts[i], {m["begin"]: m for m in marks}
                borders = [*(found.begin[cuts[i] : cuts[i + 1]] - first).tolist(), int(found.firsts[i + 1] - first)]
                place = {b: k for k, b in enumerate(borders)}
                for m in marks:
                    def around(begin: int, end: int, keeper: bool = m["keeper"]) -> tuple[bytes, int]:
                        other = own.get(begin)
                        if begin == end or other and not (keeper and other["keeper"]):
                            return b"", 0
                        return found.lines(first + begin, end - begin), end - begin

                    k, end = place[m["begin"]], m["begin"] + m["size"]
                    before = around(borders[k - 1], m["begin"]) if k else (b"", 0)
                    after = around(end, borders[k + 2]) if k + 2 < len(borders) else (b"", 0)
                    out.append((m["hash"], m["n"], m["keeper"], row, m["begin"], m["size"], found.lines(first + m["begin"], m["size"]), *before, *after))
            if out:
                types = [pa.binary(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [f.split()[0] for f in PLACED.split(", ")])

    return texts.mapInArrow(task, PLACED)


def _split(lines: bytes, n: int) -> list[bytes]:
    return lines.split(b"\n") if n else []


def _equal(a: list[bytes], b: list[bytes]) -> int:
    """How many items at the start are equal."""
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


GROWN = "row binary, begin int, size int, up int, down int, keeper_row binary, keeper_begin int"


def _grown(placed: DataFrame) -> DataFrame:
    """row, begin, size of each chunk equal to its keeper; how many lines above and below it are equal too; the keeper."""
    salts = F.ceil(F.col("n") / SALT_ROWS)
    keepers = placed.where("keeper").select(
        "hash", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.col("row").alias("keeper_row"),
        F.col("begin").alias("keeper_begin"), *[F.col(c).alias(f"k_{c}") for c in ("body", "before", "n_before", "after", "n_after")]).dropDuplicates(["hash", "salt"])
    others = placed.where("NOT keeper").withColumn("salt", F.pmod(F.xxhash64("row", "begin"), salts))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["body"] != r["k_body"]:
                    continue  # another text with the same hash
                up = _equal(_split(r["before"], r["n_before"])[::-1], _split(r["k_before"], r["k_n_before"])[::-1])
                down = _equal(_split(r["after"], r["n_after"]), _split(r["k_after"], r["k_n_after"]))
                out.append((r["row"], r["begin"], r["size"], up, down, r["keeper_row"], r["keeper_begin"]))
            if out:
                types = [pa.binary(), *[pa.int32()] * 4, pa.binary(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [f.split()[0] for f in GROWN.split(", ")])

    return others.drop("keeper").join(keepers, ["hash", "salt"]).mapInArrow(task, GROWN)


def _without(text: str | None, gone: list[dict] | None, held: list[dict] | None) -> tuple[str, int, int]:
    """The text without what goes, how many lines it had, and how many went. Chunks that go take lines along up to the
    first that is held."""
    lines = (text or "").split("\n")
    if not gone:
        return text or "", len(lines), 0
    stays, kept = np.ones(len(lines), bool), np.zeros(len(lines), bool)
    for h in held or ():
        kept[h["begin"] - h["up"] : h["begin"] + h["size"] + h["down"]] = True
    for g in gone:
        begin, end = g["begin"], g["begin"] + g["size"]
        stays[begin:end] = False
        for at in range(begin - 1, begin - 1 - g["up"], -1):
            if kept[at]:
                break
            stays[at] = False
        for at in range(end, end + g["down"]):
            if kept[at]:
                break
            stays[at] = False
    return "\n".join([x for x, s in zip(lines, stays.tolist()) if s]), len(lines), int((~stays).sum())


def _cut(docs: DataFrame, key: str, text: str, roll: int, divisor: int) -> DataFrame:
    """rest (the other columns of ``docs``), id, text, done (kept, n_lines, n_removed)."""
    rows = _rows(docs, key, text)
    chunks = cut(_chunks(rows, roll, divisor))
    place = F.struct("id", "row", "begin")
    repeated = chunks.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    found = attached(chunks, repeated, ["hash"], "row").where("n IS NOT NULL")
    marks = cut(found.groupBy("row").agg(F.collect_set(F.struct(
        "begin", "size", "hash", "n", place.eqNullSafe(F.col("first")).alias("keeper"))).alias("marks")))
    placed = _placed(rows.join(marks, "row").select("row", "text", "marks"), roll, divisor)
    grown = cut(_grown(placed))
    none = F.lit(0)
    held = grown.groupBy(F.col("keeper_row").alias("row"), F.col("keeper_begin").alias("begin"), "size").agg(F.max("up").alias("up"), F.max("down").alias("down"))
    keepers = marks.select("row", F.explode("marks").alias("m")).where("m.keeper").select("row", "m.begin", "m.size", none.alias("up"), none.alias("down"))
    piece = F.struct("begin", "size", "up", "down")
    goes = grown.groupBy("row").agg(F.collect_set(piece).alias("gone"))
    stays = held.unionByName(keepers).groupBy("row").agg(F.collect_set(piece).alias("held"))
    both = goes.join(stays, "row", "left")

    def remove(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("kept", pa.string()), ("n_lines", pa.int64()), ("n_removed", pa.int64())])
        for texts, gone, held in batches:
            out = [_without(*x) for x in zip(texts.to_pylist(), gone.to_pylist(), held.to_pylist())]
            columns = list(zip(*out)) or [()] * 3
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))

    done = F.arrow_udf(remove, "kept string, n_lines long, n_removed long", ArrowUDFType.SCALAR_ITER)
    return rows.join(both, "row", "left").select("rest", "id", "text", done("text", "gone", "held").alias("done"))


def remove_repeated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", roll: int = ROLL, divisor: int = DIVISOR,
) -> DataFrame:
    """key, kept, n_lines, n_removed: each text without its repeated chunks, and its lines before and gone.

    Lines are parted by \\n. Of equal chunks the one with the smallest key stays, then the earliest (rows with one key
    and different texts come in the order of their digests); a null key is the smallest. Kept lines are joined by \\n.
    A chunk whose hash belongs to different bytes stays. Texts of one line and blank chunks stay. Null and empty
    texts are one empty line; kept is then empty. Rows that repeat with one key and text share their fate. An empty
    table gives no rows.
    """
    return _cut(docs, key, text, roll, divisor).select(F.col("id").alias(key), "done.*")


def cleaned(
    docs: DataFrame, key: str = "doc_id", text: str = "text", roll: int = ROLL, divisor: int = DIVISOR,
) -> DataFrame:
    """All columns of ``docs`` with the text as ``remove_repeated`` keeps it; unchanged texts, null ones too, stay
    as they are. Documents of which no line but blank ones is left by the removal go."""
    found = _cut(docs, key, text, roll, divisor)
    kept, gone = F.col("done.kept"), F.col("done.n_removed")
    left = found.where((gone == 0) | (F.trim(F.translate(kept, "\n\t\r", "   ")) != ""))
    now = F.when(gone > 0, kept).otherwise(F.col("text"))
    return left.select(*[now.alias(c) if c == text else F.col("rest")[c].alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
