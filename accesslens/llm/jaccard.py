"""N-gram Jaccard join by a token-group matrix.

The matrix has a row for every group of similar documents and a column for every token; a group's row is
the union of its members' tokens. A document can only link to a member of a group whose union holds enough
of its own tokens, and only such groups are opened.

The matrix is kept sparse by columns: tokens are dealt into parts by their hash, finely enough that two
linked sets agree in a part that isn't empty. (With sizes a and b they differ in at most 15 (a + b) / 185
tokens at a threshold of 85 in 100, so of n parts more than that, n have no differing token.) The parts'
fingerprints lead from a document to the groups worth bounding. The steps:

1. Documents with equal sets are one class; only its smallest id goes on.
2. Fingerprints are shared out in buckets. Classes that share enough of them with the smallest class that has
   them are compared with it, one comparison for a class and fingerprint at most.
3. Classes with the same smallest leader are a group, of ``CHUNK`` members or so. For fingerprints that
   stand in several components so far, each class that shares enough with a group is bounded by the group's
   union, and qualifying groups are opened.

All decisions compare the sets themselves. Sets are of 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm import arrays
from accesslens.llm.components import components, cut, named

PERCENT = 85
WORDS = 4
CHUNK = 256  # members of a group, which is one row of the matrix
QUERIES = 512  # bounded by a chunk in one task
BLOCK_BYTES = 2 << 20  # of texts worked on together
PACK = 400_000  # fingerprints worked on together in a task
PACK_BUCKET = 400_000  # fingerprints of a bucket, about
FILTER_BITS = 1 << 23
DEALS = 3  # finer and finer, before every token becomes a part of its own


def sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of every text, distinct, by row and shingle. Fewer words than ``words``: one shingle."""
    data, offsets = arrays.flat(column)
    low = arrays.lower_table()[data]
    starts, ends, firsts = arrays.borders(low, offsets, arrays.not_space())
    hashes, rows = arrays.word_hashes(low, starts, ends), arrays.rows_of(firsts)
    counts = np.diff(firsts)
    grams = arrays.windows(hashes, words)
    whole = rows[: len(grams)] == rows[words - 1 :] if len(grams) else np.zeros(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < words))
    own = np.concatenate([rows[: len(grams)][whole], short])
    found = np.concatenate([grams[whole], arrays.ranges(hashes, firsts[short], firsts[short + 1], arrays.SEEDS[1])])
    order = np.lexsort((found, own))
    own, found = own[order], found[order]
    fresh = np.r_[True, (np.diff(found) != 0) | (np.diff(own) != 0)][: len(found)]
    return own[fresh], found[fresh]


class Scheme:
    """Classes of set sizes, and into how many parts the sets of each class are dealt."""

    def __init__(self, percent: int, spread: float, largest: int = 1 << 40, alone: bool = False):
        self.percent = percent
        ratio = max(1.41, 1.02 * 100 / percent)  # linked sets lie in one class or in neighbouring ones
        low = [1]
        while low[-1] <= largest:
            low.append(max(low[-1], int(ratio * low[-1])) + 1)
        self.low = np.array(low, np.int64)
        top = self.differing(self.low[1:] - 1, self.low[1:] - 1)
        needed = (top + 1) // 4 + 1  # parts in which linked sets agree at least, as many more are shown
        # Where sets would have to show most of their tokens, each token is a part of its own: a set shows the first ones,
        # all if it has no more. Linked sets agree in as many, or in all that they share.
        least = -(-self.low[:-1] * percent // 100)
        shared = -(-2 * percent * least // (100 + percent))
        self.alone = np.r_[(4 * (self.differing(least, self.low[1:] - 1) + needed) > 3 * least) | alone, True]
        self.needed = np.r_[np.where(self.alone[:-1], np.maximum(1, np.minimum(needed, shared)), needed), 1]
        self.parts = np.where(self.alone, 1, np.r_[np.ceil(spread * (top + needed)).astype(np.int64) + 3, 1])

    def differing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many tokens linked sets of these sizes differ at most."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def _steps(self, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For a set's own class and the next one: the class, whether the set shows parts there, and how many."""
        own = np.searchsorted(self.low, sizes, "right") - 1
        largest = sizes * 100 // self.percent
        for step in (0, 1):
            kind = np.maximum(own, 0) + step
            differ = self.differing(sizes, np.minimum(largest, self.low[kind + 1] - 1))
            # Sets that can't differ from any partner are classes already.
            yield kind, (sizes > 0) & (differ > 0) & (largest >= self.low[kind]), differ + self.needed[kind]

    def _part(self, spread: np.ndarray, kind: np.ndarray) -> np.ndarray:
        return ((spread >> np.uint64(32)) * self.parts[kind].astype(np.uint64) >> np.uint64(32)).astype(np.int64)

    def enough(self, rows: np.ndarray, tokens: np.ndarray, n_rows: int) -> np.ndarray:
        """Whether each set has as many parts that aren't empty as it has to show."""
        spread = arrays.mixed(tokens ^ np.uint64(arrays.SEEDS[1]))
        out = np.ones(n_rows, bool)
        for kind, takes, most in self._steps(np.bincount(rows, minlength=n_rows)):
            dealt = takes & ~self.alone[kind]
            parts = np.where(dealt, self.parts[kind], 0)
            at = np.flatnonzero(dealt[rows])
            r = rows[at]
            filled = np.zeros(int(parts.sum()), bool)
            filled[(np.cumsum(parts) - parts)[r] + self._part(spread[at], kind[r])] = True
            out &= ~dealt | (np.bincount(np.repeat(np.arange(n_rows), parts)[filled], minlength=n_rows) >= most)
        return out

    def fingerprints(self, rows: np.ndarray, tokens: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(row, fingerprint) of the parts that each set has to show, and how many sets have too few parts.

        A set shows, in the deal of its own class and of the next one if it can link there, its first parts
        that aren't empty: as many as tokens can differ, and ``needed`` more, in which links agree. The last 7
        bits of a fingerprint tell the deal.
        """
        sizes = np.bincount(rows, minlength=n_rows)
        spread = arrays.mixed(tokens ^ np.uint64(arrays.SEEDS[1]))
        weight = arrays.mixed(tokens)
        out_rows, out, lacking = [], [], 0
        for kind, takes, most in self._steps(sizes):
            at = np.flatnonzero((takes & self.alone[kind])[rows])
            if len(at):
                order = np.lexsort((spread[at], rows[at]))
                r, w = rows[at][order], weight[at][order]
                first = np.searchsorted(r, np.arange(n_rows + 1))
                shown = np.arange(len(r)) - first[r] < most[r]
                out_rows.append(r[shown])
                deal = kind[r[shown]].astype(np.uint64)
                out.append(arrays.mixed(w[shown] + arrays.mixed(deal << np.uint64(40))) & ~np.uint64(127) | deal)
            dealt = takes & ~self.alone[kind]
            at = np.flatnonzero(dealt[rows])
            if not len(at):
                continue
            r = rows[at]
            part = self._part(spread[at], kind[r])
            cell = r * (int(self.parts[kind[dealt]].max()) + 1) + part
            order = np.argsort(cell, kind="stable")
            cell, r, part, w = cell[order], r[order], part[order], weight[at][order]
            begin = np.flatnonzero(np.r_[True, np.diff(cell) != 0])
            sums, r, part = np.add.reduceat(w, begin), r[begin], part[begin]
            first = np.searchsorted(r, np.arange(n_rows + 1))
            shown = np.arange(len(r)) - first[r] < most[r]
            lacking += int((np.diff(first)[dealt] < most[dealt]).sum())
            out_rows.append(r[shown])
            deal = kind[r[shown]].astype(np.uint64)
            prints = arrays.mixed(sums[shown] + arrays.mixed(deal << np.uint64(40) | part[shown].astype(np.uint64)))
            out.append(prints & ~np.uint64(127) | deal)
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), lacking
        return np.concatenate(out_rows), np.concatenate(out), lacking


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))


def _schemes(percent: int, spread: float) -> list[Scheme]:
    """The deals, finer and finer; in the last one every token is a part of its own, which suits all sets."""
    return [Scheme(percent, spread * 2**deal, alone=deal == DEALS) for deal in range(DEALS + 1)]


def _slim(rows: DataFrame, words: int, schemes: list[Scheme]) -> DataFrame:
    """id, n, a 128-bit digest of each set, and a bit for each deal in which the set has enough parts."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.blocks(batches, "text", BLOCK_BYTES):
            own, tokens = sets(batch.column("text"), words)
            deals = sum(s.enough(own, tokens, batch.num_rows).astype(np.int32) << i for i, s in enumerate(schemes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.bincount(own, minlength=batch.num_rows).astype(np.int64)),
                 pa.array(_digests(own, tokens, batch.num_rows), pa.binary()), pa.array(deals, pa.int32())], ["id", "n", "digest", "deals"])

    return rows.mapInArrow(task, "id long, n long, digest binary, deals int")


def _digests(rows: np.ndarray, tokens: np.ndarray, n_rows: int) -> list[bytes]:
    out = np.zeros((n_rows, 2), np.uint64)
    begin = np.flatnonzero(np.r_[True, np.diff(rows) != 0][: len(rows)])
    for i, seed in enumerate(arrays.SEEDS):
        if len(begin):
            out[rows[begin], i] = np.add.reduceat(arrays.mixed(tokens ^ np.uint64(seed)), begin)
    whole = out.tobytes()
    return [whole[16 * i : 16 * i + 16] for i in range(n_rows)]


def _shown(rows: DataFrame, words: int, scheme: Scheme) -> DataFrame:
    """digest, id and fingerprints of every set, one row a digest."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.blocks(batches, "text", BLOCK_BYTES):
            own, tokens = sets(batch.column("text"), words)
            r, prints, _ = scheme.fingerprints(own, tokens, batch.num_rows)
            order = np.argsort(r, kind="stable")
            r, prints = r[order], prints[order]
            cuts = np.searchsorted(r, np.arange(batch.num_rows + 1)).tolist()
            digests = _digests(own, tokens, batch.num_rows)
            keep = [i for i in range(batch.num_rows) if cuts[i + 1] > cuts[i] and batch.column("id")[i].is_valid]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digests[i] for i in keep], pa.binary()), batch.column("id").take(pa.array(keep, pa.int64())),
                 pa.array([prints[cuts[i] : cuts[i + 1]].tobytes() for i in keep], pa.binary())], ["digest", "id", "prints"])

    shown = rows.mapInArrow(task, "digest binary, id long, prints binary")
    return shown.groupBy("digest").agg(F.min("id").alias("id"), F.first("prints").alias("prints"))


SHARED = "print long, leader long, id long"
PACKED = "bucket int, prints binary, ids binary, print long, leader long, id long"
PACKED_NAMES = ["bucket", "prints", "ids", "print", "leader", "id"]
PACKED_TYPES = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def _starred(prints: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries sorted by fingerprint and id, the smallest id beside each, and whether others share its fingerprint."""
    order = np.lexsort((ids, prints))
    prints, ids = prints[order], ids[order]
    begin = np.flatnonzero(np.r_[True, np.diff(prints) != 0][: len(prints)])
    sizes = np.diff(begin, append=len(prints))
    return prints, ids, np.repeat(ids[begin], sizes), np.repeat(sizes > 1, sizes)


def _shared(shown: DataFrame, buckets: int) -> DataFrame:
    """(print, leader, id) for every fingerprint that several classes show; a leader's own row has leader = id.

    A pack of rows sends a fingerprint to its bucket once, with the smallest id of the pack; the others of
    the pack are led by that id. So a fingerprint that is everywhere costs a bucket one entry a pack.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for one, raw in zip(batch.column("id").to_pylist(), batch.column("prints").to_pylist()):
                prints = np.frombuffer(raw, np.uint64)
                held.append((prints, np.full(len(prints), one)))
                size += len(prints)
                if size >= PACK:
                    yield from _sent(held, buckets)
                    held, size = [], 0
        if held:
            yield from _sent(held, buckets)

    packed = shown.select("id", "prints").mapInArrow(pack, PACKED)
    return packed.groupBy("bucket").applyInArrow(_bucket, SHARED)


def _sent(held: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    prints, ids, leaders, many = _starred(np.concatenate([p for p, _ in held]), np.concatenate([i for _, i in held]))
    alone = ids == leaders
    p, i = prints[alone], ids[alone]
    bucket = ((p >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        at = np.arange(cuts[b], cuts[b + 1])
        at = at[np.argsort(i[at], kind="stable")]  # ids in order, as differences, compress
        rows.append((b, p[at].tobytes(), np.diff(i[at], prepend=0).tobytes(), None, None, None))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PACKED_TYPES)], PACKED_NAMES)
    led = np.flatnonzero(many)
    if len(led):  # to any bucket: they only pass through, their leader's own row too
        n = len(led)
        yield pa.RecordBatch.from_arrays([
            pa.array((ids[led] % buckets).astype(np.int32)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
            pa.array(prints[led].view(np.int64)), pa.array(leaders[led]), pa.array(ids[led])], PACKED_NAMES)


def _bucket(table: pa.Table) -> pa.Table:
    passed = table.filter(table.column("print").is_valid()).select(["print", "leader", "id"])
    rest = table.filter(table.column("prints").is_valid())
    raw, ids = rest.column("prints").to_pylist(), rest.column("ids").to_pylist()
    if not raw:
        return passed
    prints, ids, leaders, many = _starred(
        np.concatenate([np.frombuffer(p, np.uint64) for p in raw]), np.concatenate([np.cumsum(np.frombuffer(i, np.int64)) for i in ids]))
    own = pa.table([pa.array(prints[many].view(np.int64)), pa.array(leaders[many]), pa.array(ids[many])], names=["print", "leader", "id"])
    return pa.concat_tables([own, passed])


def _filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the ids, of a fixed size; where ids are many it passes more, never fewer."""
    places = ids.select(F.explode(F.array(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(FILTER_BITS)) for i in range(3)])).alias("p"))
    words = places.groupBy(F.floor(F.col("p") / 62).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(p % 62 AS INT))")).alias("bits"))
    out = np.zeros(FILTER_BITS // 62 + 1, np.int64)
    rows = words.toArrow()  # FILTER_BITS / 62 rows at most
    out[rows.column("w").to_numpy()] = rows.column("bits").to_numpy()
    return out


def _tokens(rows: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """id and tokens (sorted 64-bit values) of documents that may be among the ids; others are left out mostly."""
    bits = _filter(ids)
    fetch = arrays.shared(rows.sparkSession, bits)
    places = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(FILTER_BITS)).alias(f"p{i}") for i in range(3)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = fetch()
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for i in range(3):
                p = batch.column(f"p{i}").to_numpy()
                ok &= (bits[p // 62] >> (p % 62)) & 1 == 1
            for block in arrays.blocks(iter([batch.filter(pa.array(ok))]), "text", BLOCK_BYTES):
                own, tokens = sets(block.column("text"), words)
                cuts = np.searchsorted(own, np.arange(block.num_rows + 1)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [block.column("id"), pa.array([tokens[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], ["id", "tokens"])

    return rows.where("id IS NOT NULL").select("id", "text", *places).mapInArrow(task, "id long, tokens binary")


def _links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets (sorted) have the Jaccard similarity."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            ok = [_links(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent) for p, q in zip(x, y)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left, right = tokens.select(F.col("id").alias("a"), F.col("tokens").alias("x")), tokens.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(task, "a long, b long")


def _opened(queries: pa.Table, members: pa.Table, percent: int) -> pa.Table:
    """(a, b): queries that link to members of one matrix row in another component; the row's union bounds each
    query first, and only then are its postings opened."""
    if not queries.num_rows or not members.num_rows:
        return pa.table([pa.array([], pa.int64())] * 2, names=["a", "b"])
    sets_ = [np.frombuffer(t, np.uint64) for t in members.column("tokens").to_pylist()]
    ids, parts, sizes = members.column("id").to_numpy(), members.column("g").to_numpy(), np.array([len(x) for x in sets_])
    tokens, owners = np.concatenate(sets_), np.repeat(np.arange(len(sets_)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    begin = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    union, end = tokens[begin], np.append(begin[1:], len(tokens))
    found, top = [], {}

    def root(g: int) -> int:
        while (up := top.get(g, g)) != g:
            top[g] = top.get(up, up)
            g = up
        return g

    for q, own, raw in zip(*(queries.column(n).to_pylist() for n in ("q", "own", "held"))):
        asked = np.frombuffer(raw, np.uint64)
        at = np.minimum(np.searchsorted(union, asked), len(union) - 1)
        at = at[union[at] == asked]
        if 100 * len(at) < percent * len(asked):
            continue
        counts = end[at] - begin[at]
        inside = np.repeat(begin[at] - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
        both = np.bincount(owners[inside], minlength=len(ids))
        ok = (100 * both >= percent * (len(asked) + sizes - both)) & (parts != own) & (ids != q)
        for m, other in zip(ids[ok].tolist(), parts[ok].tolist()):
            if (x := root(own)) != (y := root(other)):  # links inside what is joined already add nothing
                top[max(x, y)] = min(x, y)
                found.append((q, m))
    return pa.table([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])


def _enough(rows: DataFrame, keys: list[str], scheme: Scheme) -> DataFrame:
    """The keys that have as many fingerprints of one deal as links have at least."""
    needed = F.array(*[F.lit(int(n)) for n in scheme.needed])
    counts = rows.groupBy(*keys, (F.col("print").bitwiseAND(127)).cast("int").alias("deal")).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= needed[F.col("deal")]).select(*keys).distinct()


def _between(shared: DataFrame, groups: DataFrame, tokens: DataFrame, scheme: Scheme, percent: int) -> DataFrame:
    """Links between classes of different components so far.

    A row of the matrix holds up to about ``CHUNK`` classes that have the same smallest leader.
    """
    cluster = shared.groupBy("id").agg(F.min("leader").alias("cluster"))
    chunks = cluster.groupBy("cluster").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    rows = cut(cluster.join(chunks, "cluster").select("id", "cluster", F.pmod(F.xxhash64("id"), "chunks").alias("chunk")).join(
        groups.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "id", "cluster", "chunk", F.coalesce("component", "id").alias("g")))
    entries = shared.select("print", "id").distinct().join(rows, "id")
    several = entries.groupBy("print").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low < high").select("print")
    entries = cut(entries.join(several, "print", "left_semi"), "zstd")
    places = entries.groupBy("print", "cluster", "chunk").agg(F.min("g").alias("low"), F.max("g").alias("high"))
    asking = entries.select("print", F.col("id").alias("q"), F.col("g").alias("own"), F.struct("cluster", "chunk").alias("at"))
    # Of two rows the later one asks the earlier; a fingerprint counts where others than the own component show it.
    met = asking.join(places, "print").where((F.col("at") >= F.struct("cluster", "chunk")) & ~((F.col("low") == F.col("own")) & (F.col("high") == F.col("own"))))
    asked = cut(_enough(met, ["q", "own", "cluster", "chunk"], scheme))
    portions = asked.groupBy("cluster", "chunk").agg(F.ceil(F.count("*") / QUERIES).alias("portions"))
    keys = ["cluster", "chunk", "portion"]
    members = rows.join(portions, ["cluster", "chunk"]).join(tokens, "id").select(
        "cluster", "chunk", "g", "id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1)).alias("portion"))
    queries = asked.join(portions, ["cluster", "chunk"]).join(tokens.select(F.col("id").alias("q"), F.col("tokens").alias("held")), "q").select(
        "cluster", "chunk", "q", "own", "held", F.pmod(F.xxhash64("q"), "portions").alias("portion"))
    return queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(lambda q, m: _opened(q, m, percent), "a long, b long")


def link(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, key: str = "doc_id", text: str = "text",
         spread: float = 1.3) -> DataFrame:
    """key, n_shingles, component_id: documents joined by links of Jaccard similarity ``percent`` / 100 or more.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a set holds the distinct ``words``-word shingles, or
    the whole sequence if it is shorter. component_id is the smallest key reachable by links, the own one
    included. Null, empty and blank texts have an empty set and link with nothing; a null key links with
    nothing and has a null component. Rows that repeat with one key are one document; rows with one key
    and different texts join what both link to. An empty table gives no rows.
    """
    rows = _source(docs, key, text)
    schemes = _schemes(percent, spread)
    slim = cut(_slim(rows, words, schemes))
    doubled = cut(slim.where("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select("id"))
    if doubled.isEmpty():
        linked, groups, between = _found(rows, slim, percent, words, schemes)
        final = groups if between.isEmpty() else components(linked.unionByName(between))
    else:
        final = _found_by_text(rows, doubled, percent, words, schemes)
    return slim.join(final.select(F.col("node").alias("id"), "component"), "id", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(
            F.col("id")).alias("component_id"))


def _found_by_text(rows: DataFrame, doubled: DataFrame, percent: int, words: int, schemes: list[Scheme]) -> DataFrame:
    """Components where some ids have several sets: each text of these ids goes under a name of its own, and the names
    of an id are joined at the end."""
    for seed in range(8):
        name = -(F.lit(1 << 62) + F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(1 << 62)))
        renamed = rows.join(doubled.withColumn("several", F.lit(True)), "id", "left").select(
            F.col("id").alias("whole"), F.when(F.col("several"), name).otherwise(F.col("id")).alias("id"), "text", "several")
        same = cut(renamed.where("several").select("whole", "id", F.md5("text").alias("print")).distinct())
        clash = same.groupBy("id").agg(F.min("print").alias("a"), F.max("print").alias("b"), F.min("whole").alias("c"), F.max("whole").alias("d")).where("a <> b OR c <> d")
        taken = rows.select("id").join(same.select("id"), "id", "left_semi")
        if clash.isEmpty() and taken.isEmpty():
            break
    else:
        raise ValueError("ids take up the names that texts would get")
    own = renamed.select("id", "text")
    linked, _, between = _found(own, cut(_slim(own, words, schemes)), percent, words, schemes)
    edges = linked.unionByName(between).unionByName(same.select(F.col("whole").alias("a"), F.col("id").alias("b")))
    found = cut(components(edges).join(same.select(F.col("id").alias("node"), F.lit(True).alias("name")), "node", "left"))
    least = found.groupBy("component").agg(F.min(F.when(F.col("name").isNull(), F.col("node"))).alias("least"))
    return found.where("name IS NULL").join(least, "component").select("node", F.col("least").alias("component"))


def _found(rows: DataFrame, slim: DataFrame, percent: int, words: int, schemes: list[Scheme]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b), the components they make, and the links between those. An id has one set."""
    spark = rows.sparkSession
    total, deals = slim.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.bit_and("deals"), F.lit(1))).first()
    scheme = next(s for i, s in enumerate(schemes) if deals >> i & 1)  # the first in which no set has too few parts
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(0.4 * total) // PACK_BUCKET))
    whole = slim.where("n > 0 AND id IS NOT NULL")
    classes = whole.groupBy("digest").agg(F.min("id").alias("class"))
    member = cut(whole.select("digest", "id").distinct().join(classes, "digest").select("id", "class"))
    shared = cut(_shared(_shown(rows, words, scheme), buckets), "zstd")
    shared = cut(shared.join(_enough(shared, ["id"], scheme), "id", "left_semi"), "zstd")
    pairs = _enough(shared.where("leader <> id").select(F.col("leader").alias("a"), F.col("id").alias("b"), "print"), ["a", "b"], scheme)
    tokens = cut(_tokens(rows, shared.select("id").distinct(), words).dropDuplicates(["id"]), "zstd")
    same = member.where("id <> class").select(F.col("id").alias("a"), F.col("class").alias("b"))
    linked = cut(_verified(pairs, tokens, percent).unionByName(same))
    groups = cut(components(linked))
    return linked, groups, cut(_between(shared, groups, tokens, scheme, percent))


def one_each(docs: DataFrame, percent: int, words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the documents that stay: of each component the one with the smallest key. Null keys stay."""
    linked = link(docs, percent, words, key, text)
    others = linked.where(F.col(key) != F.col("component_id")).select(key).distinct()
    return docs.join(others, key, "left_anti").select(*map(named, docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, CASE WHEN w = [''] THEN [] ELSE w END AS w FROM (
        SELECT doc_id, regexp_split_to_array(regexp_replace(regexp_replace(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS w FROM documents)
), s AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
    FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
    SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), r AS (
    SELECT doc_id AS node, doc_id AS low FROM d UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.node
), c AS (
    SELECT node, min(low) AS component_id FROM r GROUP BY node
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id
"""
