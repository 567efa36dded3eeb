"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes, counted over the corpus.

Both tokenizers cut at the white space between words, so a text is dealt into chunks (a run of white space and
what follows it) that are aligned once and then looked up. Inside a chunk the byte offsets where tokens of both
end cut it into groups, and two tokens are linked where their bytes overlap.

First pass: every task stores its documents' ids and adds up its id pairs, dealt into ``SLOTS`` slots by hash. A tree of merges makes the
distinct pairs of each slot, over which a minimal perfect hash is built; the tasks' counts become dense vectors
indexed by that hash, and a second tree adds the vectors. Second pass: documents are aligned again from their ids, their pairs are
hashed, the key that lies there is verified, and its count is read. No group holds more than ``FAN`` tasks' rows of
a slot, and a slot can't hold more pairs than the vocabularies allow.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm import arrays, bpe
from accesslens.llm.components import cut

SLOTS = 256
FAN = 64  # rows of a slot merged or added up by one task
KEPT_BYTES = 96 << 20  # of chunks kept by a task, about; beyond, it starts anew
BLOCK_BYTES = 4 << 20  # of texts, or of a tokenizer's ids, worked on together
ID = np.dtype("<u4")
PACK_BYTES = 32 << 20  # of keys and counts in one broadcast
SPACE = "▁"  # fixed: how the second tokenizer writes a space
#: White space by any definition that isn't ASCII's; no chunk begins there, or right behind it.
_ODD = "\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if it is printable in Latin-1, else
    the next unused one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merge_ranks(first: bytes) -> dict[bytes, int] | None:
    """Ranks that give the same ids as a byte-level tokenizer's list of merges, for a faster encoder; None if it can't
    be shown that they do.

    They do if tokens are numbered as merges follow each other, and each token's bytes, encoded with the merges before
    it, end in the two halves of its merge: then no other two tokens with these bytes ever lie side by side.
    """
    made = json.loads(first)
    split = made.get("pre_tokenizer") or {}
    if made.get("normalizer") or made["model"].get("type") != "BPE" or split.get("type") != "ByteLevel":
        return None
    if split.get("add_prefix_space") or not split.get("use_regex", True) or made["model"].get("ignore_merges"):
        return None
    letters, vocabulary = byte_alphabet(), made["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
    plain = lambda token: bytes(letters[c] for c in token)
    ranks = {plain(c): vocabulary[c] for c in letters if c in vocabulary}
    last = max(ranks.values(), default=0)
    for left, right in merges:
        token, rank = left + right, vocabulary[left + right]
        if rank <= last or bpe.one_by_one(plain(token), ranks) != [vocabulary[left], vocabulary[right]]:
            return None
        ranks[plain(token)] = last = rank
    return ranks if len(ranks) == len(letters) + len(merges) else None


class Pair:
    """Both tokenizers, loaded in every task that needs them: from the files' bytes, the first one from its
    ``merge_ranks`` if it has them."""

    def __init__(self, first: bytes, second: bytes, ranks: dict[bytes, int] | None = None):
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        if ranks:
            import tiktoken

            self.a = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode_a = lambda found: list(map(self.a.encode_ordinary, found))
            self.a_bytes = [b""] * (max(ranks.values()) + 1)
            for token, i in ranks.items():
                self.a_bytes[i] = token
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
            import tokenizers

            self.a = tokenizers.Tokenizer.from_buffer(first)
            self.a.encode_special_tokens = True
            self.encode_a = lambda found: [e.ids for e in self.a.encode_batch(found, add_special_tokens=False)]
            letters, vocabulary = byte_alphabet(), self.a.get_vocab()
            self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
            for token, i in vocabulary.items():
                self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.lone = self.b.piece_to_id(SPACE)
        # A piece may hold white space (such as "\r" at its end); it may not be cut before that.
        held = {c for i, p in enumerate(map(self.b.id_to_piece, range(len(self.b_bytes)))) if not self.b.is_byte(i) for c in p.lstrip(SPACE)}
        joins = "".join(c for c in "\t\n\v\f\r" if c in held) + (" " if SPACE in held else "")
        self.split = re.compile(rf"\s*(?:\S+|[{_ODD}{joins}]\s*)*").findall

    def chunks(self, text: str) -> list[str]:
        """A space and the text, cut before each run of white space that follows something else, of which neither
        tokenizer makes a token across the cut."""
        return [c for c in self.split(" " + text) if c]

    def encode_b(self, found: list[str]) -> list[list[int]]:
        """The second tokenizer puts a space in front by itself: it gets chunks without their first one. A chunk with
        other white space in front gets a token for a space that isn't there."""
        coded = self.b.encode([c[1:] if c[0] == " " else c for c in found], num_threads=1)
        out = []
        for c, ids in zip(found, coded):
            if c[0] != " ":
                ids = ids[1:] if ids[:1] == [self.lone] else [-1]
            elif c == " ":
                ids = [self.lone]
            out.append(ids)
        return out


def linked(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers of both sides of every link, and whether each token ends where one of the other side does.

    Two cuts of the same bytes: a link ends wherever either of its tokens does.
    """
    mark = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, np.uint8)
    mark[ends_a] = 1
    mark[ends_b] |= 2
    mark = mark[mark > 0]
    in_a, in_b = (mark & 1).astype(np.int64), (mark >> 1).astype(np.int64)
    return np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b, mark[in_a > 0] == 3, mark[in_b > 0] == 3


class Chunks:
    """Chunks met so far. ``a`` and ``b`` are their ids as bytes, ``fine`` whether both tokenizers keep their bytes."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.size_a, self.size_b = (np.array([len(x) for x in names]) for names in (pair.a_bytes, pair.b_bytes))
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[str, int] = {}
        self.a: list[bytes] = []
        self.b: list[bytes] = []
        self.fine: list[bool] = []
        self.links: list[np.ndarray] = []  # of the chunks met together, as pairs
        self.sizes: list[np.ndarray] = []  # how many links each chunk has
        self.held = 0

    def _kept(self, names: list[bytes], sizes: np.ndarray, coded: list[list[int]], raw: list[bytes]) -> list[bool]:
        """Whether the ids of each chunk spell its bytes."""
        flat = list(chain.from_iterable(coded))
        spelt = names.__getitem__
        if -1 not in flat and b"".join(map(spelt, flat)) == b"".join(raw):
            before = np.r_[0, np.cumsum(sizes[np.array(flat, np.int64)])][np.cumsum([0, *map(len, coded)])]
            if np.array_equal(np.diff(before), [len(x) for x in raw]):
                return [True] * len(raw)
        return [-1 not in ids and b"".join(map(spelt, ids)) == x for ids, x in zip(coded, raw)]

    def meet(self, new: list[str]) -> None:
        """Aligns chunks that aren't known yet, all at once."""
        pair, raw = self.pair, [c.encode() for c in new]
        a, b = pair.encode_a(new), pair.encode_b(new)
        fine = [x and y and SPACE not in c for x, y, c in zip(
            self._kept(pair.a_bytes, self.size_a, a, raw), self._kept(pair.b_bytes, self.size_b, b, raw), new)]
        a, b = ([x if ok else [] for x, ok in zip(side, fine)] for side in (a, b))
        (ids_a, cut_a), (ids_b, cut_b) = (
            (np.array(list(chain.from_iterable(side)), np.int64), np.cumsum([0, *map(len, side)])) for side in (a, b))
        at_a, at_b, *_ = linked(np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b]))
        self.links.append(ids_a[at_a] << 32 | ids_b[at_b])
        self.sizes.append(np.bincount(np.searchsorted(cut_a, at_a, "right") - 1, minlength=len(new)))
        for out, ids, cuts in ((self.a, ids_a, cut_a), (self.b, ids_b, cut_b)):
            whole, cuts = ids.astype(ID).tobytes(), (cuts * ID.itemsize).tolist()
            out += [whole[x:y] for x, y in zip(cuts[:-1], cuts[1:])]
        self.fine += fine
        self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new))))
        self.held += sum(map(len, raw)) * 8 + 300 * len(new)

    def of(self, texts: list[str | None]) -> list[list[int]]:
        """The numbers of each text's chunks."""
        split = [self.pair.chunks(t) if t else [] for t in texts]
        if new := list({c for cs in split for c in cs}.difference(self.numbers)):
            self.meet(new)
        look = self.numbers.__getitem__
        return [list(map(look, cs)) for cs in split]

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """The links of all chunks, and how many each chunk has."""
        return np.concatenate(self.links or [np.zeros(0, np.int64)]), np.concatenate(self.sizes or [np.zeros(0, np.int64)])


# ---------------------------------------------------------------- minimal perfect hash

def slot_of(pairs: np.ndarray) -> np.ndarray:
    return (arrays.mixed(pairs.view(np.uint64) ^ np.uint64(arrays.SEEDS[1])) % np.uint64(SLOTS)).astype(np.int64)


class PerfectHash:
    """Maps n keys to 0 .. n-1. In level after level, keys alone at their hashed place take it, the others go on; a key's
    number is the rank of its place among all places taken."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # which places are taken
        self.ranks = [np.r_[0, np.cumsum(x)] for x in levels]
        self.first = np.r_[0, np.cumsum([x.sum() for x in levels])].astype(np.int64)

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seeded = keys.view(np.uint64) + np.uint64((level + 1) * arrays.SEEDS[0] & 0xFFFFFFFFFFFFFFFF)
        return (arrays.mixed(seeded) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = 2 * len(keys) + 1
            at = cls.place(keys, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; some number, or -1, for a key that it wasn't made of."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (taken, rank) in enumerate(zip(self.levels, self.ranks)):
            at = self.place(keys[left], level, len(taken))
            here = taken[at]
            out[left[here]] = self.first[level] + rank[at[here]]
            left = left[~here]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(x) for x in self.levels], "<i8")
        return len(sizes).to_bytes(8, "little") + sizes.tobytes() + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        n = int.from_bytes(raw[:8], "little")
        at, levels = 8 + 8 * n, []
        for size in np.frombuffer(raw, "<i8", n, 8).tolist():
            step = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, step, at), count=size).astype(bool))
            at += step
        return cls(levels)


# ---------------------------------------------------------------- first pass

FIRST = "id long, known boolean, a binary, b binary, slot int, task long, pairs binary, counts binary"
FIRST_TYPES = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
FIRST_NAMES = ["id", "known", "a", "b", "slot", "task", "pairs", "counts"]


def _first_pass(texts: DataFrame, fetch) -> DataFrame:
    """Two kinds of rows. Documents: id, known (true), and their ids by both tokenizers (null where there are no tokens).
    Each task's distinct pairs and how many links hold them: slot, task, pairs, counts."""
    def rows(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in zip(FIRST_NAMES, FIRST_TYPES)], FIRST_NAMES)

    def sent(found: Chunks, times: np.ndarray) -> pa.RecordBatch:
        links, sizes = found.table()
        weight = np.repeat(np.pad(times, (0, len(sizes) - len(times))), sizes)
        pairs, at = np.unique(links[weight > 0], return_inverse=True)
        counts = np.bincount(at, weight[weight > 0], len(pairs)).astype(np.int64)
        slot = slot_of(pairs)
        order = np.argsort(slot, kind="stable")  # pairs stay in order
        pairs, counts = pairs[order], counts[order]
        cuts = np.searchsorted(slot[order], np.arange(SLOTS + 1))
        some = np.flatnonzero(np.diff(cuts)).tolist()
        return rows(
            len(some), slot=some, task=[TaskContext.get().partitionId()] * len(some),
            pairs=[pairs[cuts[s] : cuts[s + 1]].tobytes() for s in some], counts=[counts[cuts[s] : cuts[s + 1]].tobytes() for s in some])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, times = Chunks(Pair(*fetch())), np.zeros(0, np.int64)
        for batch in arrays.blocks(batches, "text", BLOCK_BYTES):
            if found.held > KEPT_BYTES:
                yield sent(found, times)
                found.reset()
                times = np.zeros(0, np.int64)
            texts = found.of(batch.column("text").to_pylist())
            fine, a, b = found.fine.__getitem__, found.a.__getitem__, found.b.__getitem__
            ok = [bool(own) and all(map(fine, own)) for own in texts]
            inside = np.array(list(chain.from_iterable(own for own, good in zip(texts, ok) if good)), np.int64)
            times = np.pad(times, (0, len(found.fine) - len(times))) + np.bincount(inside, minlength=len(found.fine))
            yield rows(
                len(ok), id=batch.column("id"), known=[True] * len(ok),
                a=[b"".join(map(a, own)) if good else None for own, good in zip(texts, ok)],
                b=[b"".join(map(b, own)) if good else None for own, good in zip(texts, ok)])
        yield sent(found, times)

    return texts.mapInArrow(task, FIRST)


def _groups(rows: DataFrame, fan: int) -> int:
    """How many groups of ``fan`` rows the fullest slot makes."""
    most = rows.groupBy("slot").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    return -(-most // fan)


def _longs(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int64) for x in column.to_pylist()]


def _hashed(partials: DataFrame, fan: int) -> DataFrame:
    """slot, hash, keys: the perfect hash over a slot's distinct pairs, and the pairs in the order of their numbers."""
    def union(table: pa.Table) -> pa.Table:
        found = np.unique(np.concatenate(_longs(table.column("pairs"))))
        return pa.table({"slot": table.column("slot")[:1], "task": table.column("task")[:1], "pairs": pa.array([found.tobytes()], pa.binary())})

    def built(table: pa.Table) -> pa.Table:
        found = np.unique(np.concatenate(_longs(table.column("pairs"))))
        own = PerfectHash.of(found)
        keys = np.empty_like(found)
        keys[own.numbers(found)] = found
        return pa.table({"slot": table.column("slot")[:1], "hash": pa.array([own.dump()], pa.binary()), "keys": pa.array([keys.tobytes()], pa.binary())})

    rows = partials.select("slot", "task", "pairs")
    while (groups := _groups(rows, fan)) > 1:
        rows = cut(rows.groupBy("slot", F.pmod("task", F.lit(groups)).alias("g")).applyInArrow(union, "slot int, task long, pairs binary"))
    return cut(rows.groupBy("slot").applyInArrow(built, "slot int, hash binary, keys binary"))


def _added(partials: DataFrame, hashed: DataFrame, fan: int) -> DataFrame:
    """slot, hash, keys, counts: the tasks' counts as dense vectors, added up in a tree."""
    def dense(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"slot": pa.array([], pa.int32()), "task": pa.array([], pa.int64()), "counts": pa.array([], pa.binary())})
        own = PerfectHash.load(right.column("hash")[0].as_py())
        out = np.zeros(int(own.first[-1]), np.int64)
        for pairs, counts in zip(_longs(left.column("pairs")), _longs(left.column("counts"))):
            out[own.numbers(pairs)] += counts  # a task's pairs are distinct
        return pa.table({"slot": left.column("slot")[:1], "task": left.column("task")[:1], "counts": pa.array([out.tobytes()], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        return pa.table({"slot": table.column("slot")[:1], "task": table.column("task")[:1], "counts": pa.array([sum(_longs(table.column("counts"))).tobytes()], pa.binary())})

    groups = max(1, _groups(partials, fan))
    number = F.pmod("task", F.lit(groups)).alias("g")
    copies = hashed.select("slot", "hash", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))
    rows = cut(partials.select("slot", "task", "pairs", "counts", number).groupBy("slot", "g").cogroup(
        copies.groupBy("slot", "g")).applyInArrow(dense, "slot int, task long, counts binary"))
    while (groups := _groups(rows, fan)) > 1 or _groups(rows, 1) > 1:
        key = F.pmod("task", F.lit(groups)).alias("g")
        rows = cut(rows.groupBy("slot", key).applyInArrow(total, "slot int, task long, counts binary"))
    return cut(hashed.join(rows.select("slot", "counts"), "slot"))


class Counts:
    """Counts of id pairs, in packs of slots that a task fetches as it needs them."""

    def __init__(self, spark: SparkSession, table: DataFrame, pack_bytes: int = PACK_BYTES):
        held: list[tuple[int, bytes, bytes, bytes]] = []
        self.packs, self.slots = [], []
        size = 0
        # One slot at a time comes through the driver.
        for r in table.orderBy("slot").toLocalIterator():
            if held and size + len(r.keys) + len(r.counts) > pack_bytes:
                self._close(spark, held)
                held, size = [], 0
            held.append((r.slot, bytes(r.hash), bytes(r.keys), bytes(r.counts)))
            size += len(r.keys) + len(r.counts)
        if held:
            self._close(spark, held)

    def _close(self, spark: SparkSession, held: list) -> None:
        self.packs.append(arrays.shared(spark, held))
        self.slots.append([s for s, *_ in held])

    def of(self, pairs: np.ndarray) -> np.ndarray:
        """The count of each pair. Raises KeyError for one that the corpus doesn't have."""
        slots, out = slot_of(pairs), np.zeros(len(pairs), np.int64)
        order = np.argsort(slots, kind="stable")
        cuts = np.searchsorted(slots[order], np.arange(SLOTS + 1))
        done = 0
        for fetch, own in zip(self.packs, self.slots):
            if not any(cuts[s] < cuts[s + 1] for s in own):
                continue
            for slot, raw, keys, counts in fetch():
                at = order[cuts[slot] : cuts[slot + 1]]
                if len(at):
                    number = PerfectHash.load(raw).numbers(pairs[at])
                    if (number < 0).any() or (np.frombuffer(keys, np.int64)[number] != pairs[at]).any():
                        raise KeyError("an id pair that wasn't counted")
                    out[at] = np.frombuffer(counts, np.int64)[number]
                    done += len(at)
        if done != len(pairs):
            raise KeyError("an id pair that wasn't counted")
        return out


def _best(table: DataFrame, size: int) -> np.ndarray:
    """The highest count of any pair with each second id: an array as long as that vocabulary."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size, np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                np.maximum.at(out, np.frombuffer(keys, np.int64) & 0xFFFFFFFF, np.frombuffer(counts, np.int64))
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], ["b", "n"])

    rows = table.select("keys", "counts").mapInArrow(task, "b long, n long").groupBy("b").agg(F.max("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows.column("b").to_numpy()] = rows.column("n").to_numpy()
    return out


def pair_counts(partials: DataFrame, fan: int = FAN) -> DataFrame:
    """slot, hash, keys, counts: how many links of the corpus hold each id pair (first id times 2^32 plus second), from the
    tasks' rows (slot, task, pairs, counts)."""
    return _added(partials, _hashed(partials, fan), fan)


DOCUMENT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _spellings(sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes, and how many, of every id in decimal digits with what follows it: a comma inside its group, a bar or a
    semicolon at its end. First ids with a comma, with a bar, then second ids with a comma, with a semicolon."""
    words = [f"{i}{end}".encode() for size, last in zip(sizes, "|;") for end in (",", last) for i in range(size)]
    lengths = np.array([len(w) for w in words])
    width = lengths.max()
    return np.frombuffer(b"".join(w.ljust(width) for w in words), np.uint8).reshape(-1, width), lengths


def align(docs: DataFrame, first: bytes, second: bytes, key: str = "doc_id", text: str = "text", fan: int = FAN,
          pack_bytes: int = PACK_BYTES, spelled: bool = False) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (with ``spelled``) or groups_sha256 of every document.

    ``first`` is the file of a byte-level tokenizer (applied to a space and the text), ``second`` that of a piece
    model, which puts the space there itself. Strings of special tokens are ordinary text. A document whose text is
    null or empty, or isn't given back by both tokenizers byte for byte, has no tokens: zeros and an empty string. Rows
    that repeat count each. A null key stays null; other columns aren't read; an empty table gives no rows.
    """
    spark, ranks = docs.sparkSession, merge_ranks(first)
    pair = Pair(first, second, ranks)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    passed = cut(_first_pass(rows, arrays.shared(spark, (b"" if ranks else first, second, ranks))), "zstd")  # the vocabularies
    table = pair_counts(passed.where("slot IS NOT NULL").select("slot", "task", "pairs", "counts"), fan)
    n_a, n_b = len(pair.a_bytes), len(pair.b_bytes)
    vocabulary = arrays.shared(spark, (
        *(np.array([len(x) for x in names]) for names in (pair.a_bytes, pair.b_bytes)), _best(table, n_b)))
    known = Counts(spark, table, pack_bytes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size_a, size_b, highest = vocabulary()
        letters, lengths = _spellings((n_a, n_b))
        for batch in arrays.blocks(batches, "a", BLOCK_BYTES):
            (ids_a, cut_a), (ids_b, cut_b) = (
                (x.view(ID).astype(np.int64), before // ID.itemsize) for x, before in (arrays.flat(batch.column(c)) for c in "ab"))
            at_a, at_b, last_a, last_b = linked(np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b]))
            pairs, back = np.unique(ids_a[at_a] << 32 | ids_b[at_b], return_inverse=True)
            counts = known.of(pairs)
            best = counts == highest[pairs & 0xFFFFFFFF]
            cuts = np.searchsorted(at_a, cut_a)  # the links of each document
            per = lambda values, borders: np.diff(np.r_[0, np.cumsum(values)][borders])
            sums = [np.diff(cut_a), np.diff(cut_b), per(last_a, cut_a), np.diff(cuts), per(best[back], cuts), per(counts[back], cuts)]
            # Tokens in the order of their groups, those of the first tokenizer in front.
            code = np.r_[ids_a + n_a * last_a, ids_b + n_b * last_b + 2 * n_a]
            order = np.argsort(np.r_[2 * (np.cumsum(last_a) - last_a), 2 * (np.cumsum(last_b) - last_b) + 1], kind="stable")
            code = code[order]
            whole = letters[code][np.arange(letters.shape[1]) < lengths[code][:, None]].tobytes()
            begin = np.r_[0, np.cumsum(lengths[code])][cut_a + cut_b].tolist()
            spelt = (whole[x : max(x, y - 1)] for x, y in zip(begin[:-1], begin[1:]))
            out = [s.decode() if spelled or not s else hashlib.sha256(s).hexdigest() for s in spelt]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x.astype(np.int64)) for x in sums), pa.array(out, pa.string())], ["id", *DOCUMENT, "groups"])

    fields = ", ".join(f"{c} long" for c in DOCUMENT)
    found = passed.where("known").select("id", "a", "b").mapInArrow(task, f"id long, {fields}, groups string")
    return found.select(F.col("id").alias(key), *DOCUMENT, F.col("groups").alias("groups" if spelled else "groups_sha256"))


def read_file(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def query(spark: SparkSession, sf_dir: str, first: str = "byte_bpe_50k.json", second: str = "piece_bpe_32k.model") -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"), read_file(first), read_file(second))
