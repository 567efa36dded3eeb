"""Substring dedup: level-wise doubling of repeated windows.

Documents are dealt into parts by their key, and each part keeps its documents in one order, so a word
has a number in its part. At every level but the last only some windows are tested: of the windows of
the level's length inside each full-length window, the one with the smallest hash. The choice depends on
words alone, so copies of a full-length window choose alike, and a window survives a level only if its
chosen part repeats. Survivors go on to twice the length; at the last level each of them is tested itself.

A test shuffles distinct hashes per part, with the word's number, into buckets; a bucket sends back the
numbers whose hash stands more than once. What repeats inside a part needs no answer, so a window that
is everywhere costs one hash a part. The texts are shuffled once; all levels read that one shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm import arrays

WINDOW = 35
FIRST = 9
PART_BYTES = 6 << 20

TESTS = "part int, bucket int, hashes binary, more binary, numbers binary, again binary"
TEST_NAMES = ["part", "bucket", "hashes", "more", "numbers", "again"]
ANSWERS = "part int, numbers binary"


def levels(window: int, first: int) -> list[int]:
    """The lengths: from ``first``, doubled, up to ``window``."""
    found = [min(first, window)]
    while found[-1] < window:
        found.append(min(2 * found[-1], window))
    return found


class _Part:
    """The words of a part's documents, in order of key and text."""

    def __init__(self, table: pa.Table):
        table = table.select(["id", "text"]).sort_by([("id", "ascending"), ("text", "ascending")]).combine_chunks()
        self.ids = table.column("id").combine_chunks()
        self.data, self.offsets = arrays.flat(table.column("text").combine_chunks())
        self.starts, self.ends, self.firsts = arrays.borders(self.data, self.offsets, arrays.not_space())
        self.hashes = arrays.word_hashes(self.data, self.starts, self.ends)
        self.rows = arrays.rows_of(self.firsts)

    def full(self, window: int) -> np.ndarray:
        """Whether a full-length window of one document starts at each word."""
        found = np.zeros(len(self.rows), bool)
        if len(found) >= window:
            found[: len(found) - window + 1] = self.rows[: len(found) - window + 1] == self.rows[window - 1 :]
        return found

    def chosen(self, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all windows of a length, and for each word which window its full one chooses."""
        hashes = arrays.windows(self.hashes, length)
        if len(self.rows) < window:  # no full-length window
            return hashes, np.zeros(len(self.rows), np.int64)
        if length == window:
            return hashes, np.arange(len(self.rows))
        # 32 bits of the hash, then the place: the leftmost of the smallest.
        key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        width, have = window - length + 1, 1
        least = key
        while 2 * have <= width:
            least = np.minimum(least[: len(least) - have], least[have:])
            have *= 2
        if have < width:
            least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
        where = np.zeros(len(self.rows), np.int64)
        where[: len(least)] = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        return hashes, where


class _Level:
    """A level's windows in a part: distinct tested places, their hashes, and which repeat in the part."""

    def __init__(self, part: _Part, alive: np.ndarray, length: int, window: int):
        hashes, where = part.chosen(length, window)
        self.alive, self.where = alive, where
        self.places = np.unique(where[alive])
        self.hashes = hashes[self.places]
        self.more = np.zeros(0, np.uint32)
        if length == window and len(self.places):  # 96 bits decide the last level
            other = arrays.windows(arrays.mixed(part.hashes ^ np.uint64(arrays.SEEDS[1])), length, arrays.SEEDS[1])
            self.more = (other[self.places] >> np.uint64(32)).astype(np.uint32)
        self.order = np.lexsort((self.more, self.hashes)) if len(self.more) else np.argsort(self.hashes, kind="stable")
        same = np.diff(self.hashes[self.order]) == 0
        if len(self.more):
            same &= np.diff(self.more[self.order]) == 0
        self.fresh = np.r_[True, ~same][: len(self.places)]  # first of its hash, in order
        self.again = np.zeros(len(self.places), bool)
        self.again[self.order[1:]] |= same
        self.again[self.order[:-1]] |= same

    def after(self, numbers: np.ndarray) -> np.ndarray:
        """Which full-length windows go on, given the places that repeat in other parts."""
        repeated = np.zeros(len(self.alive), bool)
        repeated[self.places[self.again]] = True
        repeated[numbers] = True
        return self.alive & repeated[self.where]


def _numbers(table: pa.Table | None) -> np.ndarray:
    if table is None or not table.num_rows:
        return np.zeros(0, np.int64)
    return np.frombuffer(b"".join(table.column("numbers").to_pylist()), np.uint32).astype(np.int64)


def _survivors(table: pa.Table, answers: list[np.ndarray], lengths: list[int]) -> tuple[_Part, np.ndarray]:
    """The part, and its windows that survived the levels so far answered."""
    part = _Part(table)
    alive = part.full(lengths[-1])
    for length, numbers in zip(lengths, answers):
        alive = _Level(part, alive, length, lengths[-1]).after(numbers)
    return part, alive


def _tests(number: int, level: _Level, buckets: int) -> pa.Table:
    """One row a bucket: each distinct hash once, with its place, and whether the part holds it again."""
    first = level.order[level.fresh]
    hashes, places, again = level.hashes[first], level.places[first], level.again[first]
    bucket = (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))  # hashes are in order, and so are buckets
    some = np.flatnonzero(np.diff(cuts))
    more = level.more[first] if len(level.more) else None
    rows = []
    for b in some.tolist():
        at = np.arange(cuts[b], cuts[b + 1])
        at = at[np.argsort(places[at])]  # places in order compress better
        rows.append((number, b, hashes[at].tobytes(), b"" if more is None else more[at].tobytes(),
                     places[at].astype(np.uint32).tobytes(), np.packbits(again[at]).tobytes()))
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=TEST_NAMES)


def _answer(bucket: pa.Table) -> pa.Table:
    """For each part the places whose hash another part or another place of this one holds too."""
    rows = bucket.select(["part", "hashes", "more", "numbers", "again"]).to_pylist()
    hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
    more = np.concatenate([np.frombuffer(r["more"], np.uint32) for r in rows])
    places = np.concatenate([np.frombuffer(r["numbers"], np.uint32) for r in rows])
    counts = [len(r["numbers"]) // 4 for r in rows]
    again = np.concatenate([np.unpackbits(np.frombuffer(r["again"], np.uint8))[:n] for r, n in zip(rows, counts)])
    parts = np.repeat([r["part"] for r in rows], counts)
    order = np.lexsort((more, hashes)) if len(more) else np.argsort(hashes, kind="stable")
    same = np.diff(hashes[order]) == 0
    if len(more):
        same &= np.diff(more[order]) == 0
    repeated = np.zeros(len(hashes), bool)
    repeated[order[1:]] |= same
    repeated[order[:-1]] |= same
    repeated &= again == 0  # the part knows of the others itself
    found = np.flatnonzero(repeated)
    found = found[np.argsort(parts[found], kind="stable")]
    cuts = np.flatnonzero(np.diff(parts[found], prepend=-1))
    out = [(int(parts[f[0]]), places[f].tobytes()) for f in np.split(found, cuts[1:]) if len(f)]
    return pa.table([pa.array([p for p, _ in out], pa.int32()), pa.array([n for _, n in out], pa.binary())],
                    names=["part", "numbers"])


def _dealt(docs: DataFrame, key: str, text: str, part_bytes: int) -> tuple[DataFrame, int]:
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-size // part_bytes))
    return rows.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)).cast("int")), parts


def remove_repeated(docs: DataFrame, window: int = WINDOW, first: int = FIRST, key: str = "doc_id", text: str = "text",
                    part_bytes: int = PART_BYTES, with_text: bool = True) -> DataFrame:
    """key, n_words, n_removed, kept_sha256 and, if wanted, kept: words of repeated windows removed.

    Words are ``[^\\x20\\x09-\\x0D]+``. Every word that is covered by a window of ``window`` words whose words
    also start anywhere else, in any document, goes, in all its places; kept words are joined by one
    space. Windows are those of the input. Null and empty texts have no words; shorter texts lose none. Rows
    that repeat are documents of their own and so repeat each other. An empty table
    gives no rows. Hashes decide: 96 bits at the last level.
    """
    lengths = levels(window, first)
    dealt, parts = _dealt(docs, key, text, part_bytes)
    by_part = dealt.groupBy("part")
    history: DataFrame | None = None
    for depth, length in enumerate(lengths):
        if history is None:
            tests = by_part.applyInArrow(_tester(lengths, depth, parts), TESTS)
        else:
            tests = by_part.cogroup(history.groupBy("part")).applyInArrow(_later_tester(lengths, depth, parts), TESTS)
        answer = tests.groupBy("bucket").applyInArrow(_answer, ANSWERS).withColumn("level", F.lit(depth))
        history = answer if history is None else history.unionByName(answer)

    def finish(table: pa.Table, before: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _empty(with_text)
        part, alive = _survivors(table, _by_level(before, len(lengths)), lengths)
        return _kept(part, alive, window, with_text)

    schema = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    out = by_part.cogroup(history.groupBy("part")).applyInArrow(finish, schema)
    return out.withColumnRenamed("id", key)


def _later_tester(lengths: list[int], depth: int, parts: int):
    def test(table: pa.Table, before: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _nothing()
        part, alive = _survivors(table, _by_level(before, depth), lengths)
        return _tests(table.column("part")[0].as_py(), _Level(part, alive, lengths[depth], lengths[-1]), parts)

    return test


def _tester(lengths: list[int], depth: int, parts: int):
    later = _later_tester(lengths, depth, parts)

    def test(table: pa.Table) -> pa.Table:
        return later(table, None)

    return test


def _by_level(before: pa.Table | None, depth: int) -> list[np.ndarray]:
    if before is None:
        return [np.zeros(0, np.int64)] * depth
    level = before.column("level").to_numpy()
    return [_numbers(before.filter(pa.array(level == d))) for d in range(depth)]


def _nothing() -> pa.Table:
    return pa.table([pa.array([], t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())],
                    names=TEST_NAMES)


def _empty(with_text: bool) -> pa.Table:
    names = ["id", "n_words", "n_removed", "kept_sha256", "kept"][: 4 + with_text]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.table([pa.array([], t) for t, _ in zip(types, names)], names=names)


def _kept(part: _Part, alive: np.ndarray, window: int, with_text: bool) -> pa.Table:
    n = len(part.rows)
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(alive)
    edge[at] += 1
    np.add.at(edge, at + window, -1)
    gone = np.cumsum(edge)[:n] > 0
    stay = np.flatnonzero(~gone)
    leading = np.ones(len(stay), bool)  # first kept word of its document
    leading[1:] = part.rows[stay[1:]] != part.rows[stay[:-1]]
    # Of each kept word its bytes, and the byte before it as the joining space.
    mark = np.zeros(len(part.data) + 1, np.int8)
    begin = part.starts[stay] - ~leading
    np.add.at(mark, begin, 1)
    np.add.at(mark, part.ends[stay], -1)
    taken = np.cumsum(mark[:-1], dtype=np.int8) > 0
    data = part.data.copy()
    data[part.starts[stay[~leading]] - 1] = 0x20
    out = data[taken].tobytes()
    cuts = np.r_[0, np.cumsum(taken)][part.offsets].tolist()
    texts = [out[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    removed = np.diff(np.r_[0, np.cumsum(gone)][part.firsts])
    columns = [part.ids, pa.array(np.diff(part.firsts), pa.int64()), pa.array(removed, pa.int64()),
               pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
    if with_text:
        columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
    return pa.table(columns, names=["id", "n_words", "n_removed", "kept_sha256", "kept"][: len(columns)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False)


SQL = r"""
WITH d AS (
    SELECT doc_id, CASE WHEN w = [''] THEN [] ELSE w END AS w FROM (
        SELECT doc_id, regexp_split_to_array(regexp_replace(regexp_replace(coalesce(text, ''),
            '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS w FROM documents)
), win AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 34), ' ') AS win FROM d, unnest(range(1, len(w) - 33)) AS t(i)
), again AS (
    SELECT win FROM win GROUP BY win HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, j FROM win JOIN again USING (win), unnest(range(i, i + 35)) AS t(j)
), words AS (
    SELECT doc_id, j, w[j] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(j)
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
