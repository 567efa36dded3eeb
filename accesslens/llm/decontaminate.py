"""Benchmark decontamination: an FM-index per shard of documents.

A shard is a block of documents in a task. Its words become symbols: numbers of the benchmark's words,
0 for all others. Runs of numbered words that are too short for any window are left out; the rest is
one text with 0 between the runs. Of it a suffix array, its BWT, a wavelet matrix over the BWT and every
``SAMPLED``-th suffix position are kept. All windows of the benchmark are searched backward at once;
their occurrences are located by walking to the next sampled position, and merged into removal spans.
Nothing is shuffled. The benchmark is a stated query set: it reaches the tasks in blocks of at most
``block_words`` words, and each block is another pass over the rows in the same stage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accesslens.llm import arrays
from accesslens.llm.components import cut, named

WINDOW = 10
SAMPLED = 8
BLOCK_WORDS = 1_000_000
SHARD_BYTES = 2 << 20  # of texts under one index


class Windows:
    """The windows of a block of items, as numbers of their words."""

    def __init__(self, items: list[tuple[str | None, str]], width: int = WINDOW):
        column = pa.array([text for _, text in items], pa.string())
        data, offsets = arrays.flat(column)
        low = arrays.lower_table()[data]
        starts, ends, firsts = arrays.borders(low, offsets, arrays.alphanumeric())
        hashes = arrays.word_hashes(low, starts, ends)
        self.words = np.unique(hashes)
        symbols = np.searchsorted(self.words, hashes) + 1
        found: dict[tuple, set[int]] = {}
        for item, (a, b) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist())):
            own = symbols[a:b].tolist()
            for at in range(max(1, len(own) - width + 1) if own else 0):
                found.setdefault(tuple(own[at : at + width]), set()).add(item)
        self.names = [name for name, _ in items]
        self.sizes = np.array([len(w) for w in found], np.int64)
        self.patterns = np.zeros((len(found), width), np.int64)  # aligned at the right end
        for i, w in enumerate(found):
            self.patterns[i, width - len(w) :] = w
        self.items = np.array([x for xs in found.values() for x in sorted(xs)], np.int64)
        self.first_item = np.cumsum([0, *(len(xs) for xs in found.values())])
        self.shortest = int(self.sizes.min()) if len(found) else 0

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, 0 for words that no item has."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, 0)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling; every 0 ends a suffix and is unlike any other."""
    n = len(text)
    zeros = np.flatnonzero(text == 0)
    rank = text + len(zeros)
    rank[zeros] = np.arange(len(zeros))
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        changed = np.ones(n, bool)
        changed[1:] = rank[order[1:]] != rank[order[:-1]]
        begins = np.flatnonzero(changed)
        if len(begins) == n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.repeat(begins, np.diff(begins, append=n))
        sizes = np.repeat(np.diff(begins, append=n), np.diff(begins, append=n))
        open_ = np.flatnonzero(sizes > 1)  # only suffixes that are not alone are sorted again
        rows = order[open_]
        then = np.where(rows + width < n, rank[np.minimum(rows + width, n - 1)], -1)
        by = np.lexsort((then, rank[rows]))
        order[open_] = rows[by]
        keys, seconds = rank[rows][by], then[by]
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (seconds[1:] != seconds[:-1])]
        rank[order[open_]] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))]
        width *= 2


class Wavelet:
    """Ranks and symbols of a sequence, one bit array a level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels, self.zeros, self.bits = max(1, int(symbols - 1).bit_length()), [], []
        self.ones = []
        for level in reversed(range(self.levels)):
            bit = (sequence >> level) & 1
            self.bits.append(bit)
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(len(bit) - int(bit.sum()))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        self.begin = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, ones in enumerate(self.ones):
            one = (symbol >> (self.levels - 1 - k)) & 1
            up = ones[at]
            at = np.where(one == 1, self.zeros[k] + up, at - up)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._down(symbol, at) - self.begin[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and its rank there."""
        symbol = np.zeros(len(at), np.int64)
        for k, ones in enumerate(self.ones):
            one = self.bits[k][at]
            symbol = 2 * symbol + one
            at = np.where(one == 1, self.zeros[k] + ones[at], at - ones[at])
        return symbol, at - self.begin[symbol]


class Index:
    """The FM-index of a text in which 0 separates runs; it begins and ends with 0."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_array(text)
        self.bwt = Wavelet(text[order - 1], symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])  # smaller symbols
        # Every SAMPLED-th position, and the first of each run: no walk crosses a separator.
        kept = (order % SAMPLED == 0) | (text[order - 1] == 0)
        self.sampled, self.which = kept, np.cumsum(kept) - 1
        self.positions = order[kept]

    def search(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pattern the range of suffixes that begin with it. Patterns end in the last column."""
        width = patterns.shape[1]
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.before[-1])
        alive = np.arange(len(patterns))
        for step in range(width):
            alive = alive[(sizes[alive] > step) & (high[alive] > low[alive])]
            if not len(alive):
                break
            symbol = patterns[alive, width - 1 - step]
            low[alive] = self.before[symbol] + self.bwt.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.bwt.rank(symbol, high[alive])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each suffix, by walking left to a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        far = np.flatnonzero(~self.sampled[rows])
        while len(far):
            symbol, rank = self.bwt.access(rows[far])
            rows[far] = self.before[symbol] + rank
            steps[far] += 1
            far = far[~self.sampled[rows[far]]]
        return self.positions[self.which[rows]] + steps


def occurrences(symbols: np.ndarray, rows: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(word, pattern) for every window that stands anywhere in the shard, within one row."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(symbols) or not windows.shortest:
        return nothing
    known = np.concatenate([[0], (symbols > 0).astype(np.int8), [0]])
    edges = np.diff(known)
    split = np.flatnonzero((rows[1:] != rows[:-1]) & (symbols[1:] > 0) & (symbols[:-1] > 0)) + 1
    begins = np.sort(np.concatenate([np.flatnonzero(edges == 1), split]))
    ends = np.sort(np.concatenate([np.flatnonzero(edges == -1), split]))
    long = ends - begins >= windows.shortest
    begins, sizes = begins[long], (ends - begins)[long]
    if not len(begins):
        return nothing
    # The runs one after another, a 0 before each and one at the end; where[i]: the word at place i.
    places = np.cumsum(sizes + 1) - sizes
    where = np.full(int(sizes.sum()) + len(sizes) + 1, -1)
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    where[np.repeat(places, sizes) + inner] = np.repeat(begins, sizes) + inner
    text = np.where(where >= 0, symbols[where], 0)
    index = Index(text, len(windows.words) + 1)
    low, high = index.search(windows.patterns, windows.sizes)
    counts = high - low
    pattern = np.repeat(np.arange(len(counts)), counts)
    suffix = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + low[pattern]
    return where[index.locate(suffix)], pattern


WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _blocks(benchmark: DataFrame, item: str, text: str, width: int, most: int) -> Iterator[Windows]:
    """The items with words, at most so many words (one item at least) in a block. Spark counts the words and deals the
    items into portions of about half a block, of which the driver holds one at a time."""
    rows = benchmark.select(benchmark[item].cast("string").alias("item"), benchmark[text].cast("string").alias("words"))
    lowered = F.translate("words", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sized = cut(rows.withColumn("n", F.size(F.regexp_extract_all(lowered, F.lit(WORDS), F.lit(0)))).where("n > 0"))
    portions = max(1, -(-2 * (sized.agg(F.sum("n")).first()[0] or 0) // most))
    items, size = [], 0
    for number in range(portions):
        own = sized.where(F.pmod(F.xxhash64("item", "words"), F.lit(portions)) == number)
        for row in own.orderBy("item", "words").toLocalIterator():
            if items and size + row.n > most:
                yield Windows(items, width)
                items, size = [], 0
            items.append((row[0], row[1]))
            size += row.n
    if items:
        yield Windows(items, width)


def _with_last(blocks: Iterator[Windows], width: int) -> Iterator[tuple[Windows, bool]]:
    """Each block, and whether it is the last one; without any, an empty one."""
    held = next(blocks, None)
    for block in blocks:
        yield held, False
        held = block
    yield held or Windows([], width), True


NAMES = ["rest", "id", "text", "n_words", "spans", "items"]


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
         item_text: str = "text", width: int = WINDOW, block_words: int = BLOCK_WORDS, keep_text: bool = True, rest: bool = False) -> DataFrame:
    """key, text (unless told otherwise), n_words, spans, items: where items of the benchmark stand in each document.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is ``width``
    consecutive words of an item, or the whole item if it has fewer; spans are the merged word ranges
    [start, end) of all occurring windows, in order; items are the distinct ids, as sorted strings, of the
    items that occurring windows come from (a null id marks words but is not listed). Null and empty
    texts have no words, nor windows. Rows that repeat are judged each; a null key stays null. Empty
    tables give no rows, or rows without spans. With ``rest`` the other columns go along as a struct of this name.
    """
    others = [docs[named(c)] for c in docs.columns if c != text] if rest else [F.lit(0).alias("none")]
    rows = docs.select(
        F.struct(*others).alias("rest"), docs[named(key)].cast("long").alias("id"), docs[named(text)].cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"),
        F.array().cast("array<string>").alias("items"))
    whole = rows.schema
    for block, last in _with_last(_blocks(benchmark, item, item_text, width, block_words), width):
        fetch = arrays.shared(docs.sparkSession, block)  # bounded by block_words
        text_too = keep_text or not last
        rows = rows.mapInArrow(_task(fetch, text_too), whole if text_too else StructType([f for f in whole if f.name != "text"]))
    return (rows if rest else rows.drop("rest")).withColumnRenamed("id", key)


def _task(fetch, text_too: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, lower, keep = fetch(), arrays.lower_table(), arrays.alphanumeric()
        for batch in arrays.blocks(batches, "text", SHARD_BYTES):
            data, offsets = arrays.flat(batch.column("text"))
            low = lower[data]
            starts, ends, firsts = arrays.borders(low, offsets, keep)
            counts = np.diff(firsts)
            owner = arrays.rows_of(firsts)
            symbols = windows.symbols(arrays.word_hashes(low, starts, ends)) if windows.shortest else np.zeros(0, np.int64)
            word, pattern = occurrences(symbols, owner, windows)
            size = windows.sizes[pattern]
            spans = [[] for _ in range(batch.num_rows)]
            items = [set() for _ in range(batch.num_rows)]
            if len(word):
                cover = np.zeros(len(symbols) + 1, np.int64)
                np.add.at(cover, word, 1)
                np.add.at(cover, word + size, -1)
                hit = np.concatenate([[0], (np.cumsum(cover)[:-1] > 0).astype(np.int8), [0]])
                # A span that runs over the border of two rows is cut there.
                edges = np.diff(hit)
                cuts = firsts[1:-1]
                cuts = cuts[(cuts > 0) & (cuts < len(symbols))]
                cuts = np.unique(cuts[(hit[1:-1][cuts] == 1) & (hit[1:-1][cuts - 1] == 1)])
                for a, b in zip(np.sort(np.r_[np.flatnonzero(edges == 1), cuts]).tolist(),
                                np.sort(np.r_[np.flatnonzero(edges == -1), cuts]).tolist()):
                    row = owner[a]
                    spans[row].append((a - int(firsts[row]), b - int(firsts[row])))
                pairs = np.unique(owner[word] * len(windows.sizes) + pattern)
                for pair in pairs.tolist():
                    row, p = divmod(pair, len(windows.sizes))
                    items[row].update(windows.items[windows.first_item[p] : windows.first_item[p + 1]].tolist())
            names = [{windows.names[i] for i in own} - {None} for own in items]
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            joined = [(_merged([(s["start"], s["end"]) for s in old] + new), sorted({*had, *more}))
                      for (old, had), new, more in zip(before, spans, names)]
            out = pa.RecordBatch.from_arrays([
                batch.column("rest"), batch.column("id"), batch.column("text"), pa.array(counts, pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in s] for s, _ in joined],
                         pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([i for _, i in joined], pa.list_(pa.string())),
            ], NAMES)
            yield out if text_too else out.drop_columns("text")

    return task


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges joined, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def clean(found: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``find`` with their spans cut out of the text, from the first to the last byte of a
    span's words. Texts without spans, null ones too, stay as they are."""
    names = found.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, keep = arrays.lower_table(), arrays.alphanumeric()
        for batch in arrays.blocks(batches, text, SHARD_BYTES):
            texts, spans = batch.column(text).to_pylist(), batch.column("spans").to_pylist()
            data, offsets = arrays.flat(batch.column(text))
            starts, ends, firsts = arrays.borders(lower[data], offsets, keep)
            for row, own in enumerate(spans):
                if own:
                    whole, at, parts = data[offsets[row] : offsets[row + 1]].tobytes(), 0, []
                    for span in own:
                        parts.append(whole[at : starts[firsts[row] + span["start"]] - offsets[row]])
                        at = ends[firsts[row] + span["end"] - 1] - offsets[row]
                    texts[row] = b"".join([*parts, whole[at:]]).decode()
            columns = [pa.array(texts, pa.string()) if n == text else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return found.mapInArrow(task, found.schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All columns of ``docs`` with the benchmark's spans cut out of the text; texts without spans stay as they
    are, and documents that have no word left go."""
    found = clean(find(docs, benchmark, key, text, rest=True, **options), text).where(f"size(spans) = 0 OR ({HIT}) < n_words")
    return found.select(*[F.col(text) if c == text else F.col("rest")[c].alias(c) for c in docs.columns])


#: Words inside spans.
HIT = "aggregate(spans, 0L, (n, s) -> n + s.end - s.start)"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                 keep_text=False)
    hit = F.expr(HIT)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


SQL = r"""
WITH doc AS (
    SELECT doc_id, regexp_split_to_array(trim(regexp_replace(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w
    FROM documents
), d AS (
    SELECT doc_id, CASE WHEN w = [''] THEN [] ELSE w END AS w FROM doc
), item AS (
    SELECT item_id, regexp_split_to_array(trim(regexp_replace(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, list_slice(w, i, least(i + 9, len(w))) AS win
    FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE w <> ['']
), sizes AS (
    SELECT DISTINCT len(win) AS n FROM win
), place AS (
    SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
), hit AS (
    SELECT doc_id, i, n, item_id FROM place JOIN win USING (win)
), words AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
