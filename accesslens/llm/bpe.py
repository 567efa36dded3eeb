"""Byte-level BPE by merge replay.

A task collects the distinct words of its documents, a block at a time. The bytes of the words it hasn't
met yet lie in one doubly linked list, and an inverted index leads from every mergeable token pair, by
its rank, to the positions where it stands. The lowest rank is replayed first, at all its positions; a
merge touches its two neighbours only, whose new pairs enter the index. Documents are then looked up
word by word. No text is shuffled; the words kept by a task are bounded by ``KEPT_BYTES``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from accesslens.llm import arrays

KEPT_BYTES = 32 << 20  # of words and their ids kept by a task; beyond, it starts anew
BLOCK_BYTES = 2 << 20  # of texts whose words are replayed together
SCHEMA = "id long, n_tokens long, ids binary, decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Merges:
    """What a vocabulary merges: the rank of every pair of tokens whose bytes together are a token.

    Ids are ranks. ``keys`` is sorted: left id times ``span`` plus right id; ``ranks`` goes with it.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ids, self.span = ranks, max(ranks.values(), default=0) + 1
        found = [
            (ranks[token[:i]] * self.span + ranks[token[i:]], rank)
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        ]
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        self.keys, self.ranks = pairs[:, 0].copy(), pairs[:, 1].copy()
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it isn't mergeable."""
        keys = left * self.span + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1) if len(self.keys) else np.full(len(keys), -1)


def one_by_one(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word by the definition: the leftmost pair of the lowest rank, again and again."""
    parts = [word[i : i + 1] for i in range(len(word))]
    after, before = [*range(1, len(parts)), -1], list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, bytes]] = []

    def enter(at: int) -> None:
        if at != -1 and after[at] != -1 and (rank := ranks.get(both := parts[at] + parts[after[at]])) is not None:
            heappush(heap, (rank, at, both))

    for at in range(len(parts)):
        enter(at)
    while heap:
        _, at, both = heappop(heap)
        nxt = after[at]
        if not parts[at] or nxt == -1 or parts[at] + parts[nxt] != both:
            continue  # the pair that stood here is gone
        parts[at], parts[nxt], after[at] = both, b"", after[nxt]
        if after[at] != -1:
            before[after[at]] = at
        enter(before[at])
        enter(at)
    return [ranks[p] for p in parts if p]


def replay(words: Iterable[bytes], merges: Merges) -> list[bytes]:
    """The ids of each word, as little-endian unsigned 32-bit integers.

    Raises KeyError where the vocabulary lacks a byte of a word.
    """
    words = list(words)
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    token = merges.single[data]  # -1 once merged into the left neighbour
    if len(token) and token.min() < 0:
        raise KeyError("the vocabulary lacks a byte")
    after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
    after[ends[sizes > 0] - 1] = before[(ends - sizes)[sizes > 0]] = -1
    index: dict[int, list[np.ndarray]] = {}  # rank of a pair: positions of its left half
    waiting: list[int] = []  # ranks that have positions
    odd: list[np.ndarray] = []  # positions in words where a merge made a pair of lower rank

    def enter(places: np.ndarray, below: int = -1) -> None:
        ranks = merges.of(token[places], token[after[places]])
        some = ranks >= 0
        places, ranks = places[some], ranks[some]
        if len(early := places[ranks < below]):
            odd.append(early)
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, group in zip(ranks[np.r_[0, cuts]].tolist() if len(ranks) else [], np.split(places, cuts)):
            if rank in index:
                index[rank].append(group)
            else:
                index[rank] = [group]
                heappush(waiting, rank)

    enter(np.flatnonzero(after != -1))
    while waiting:
        rank = heappop(waiting)
        groups = index.pop(rank)
        places = np.sort(np.concatenate(groups))
        places = places[np.diff(places, prepend=-1) > 0]
        places = places[(token[places] >= 0) & (after[places] != -1)]
        places = places[merges.of(token[places], token[after[places]]) == rank]  # others are gone
        if not len(places):
            continue
        # Of overlapping pairs, as in a run of one token, every second one from the left.
        linked = np.r_[False, after[places[:-1]] == places[1:]]
        if linked.any():
            run = np.arange(len(places)) - np.maximum.accumulate(np.where(linked, 0, np.arange(len(places))))
            places = places[run % 2 == 0]
        gone = after[places]
        far = after[gone]
        near = far != -1
        soon = merges.of(np.full(near.sum(), rank), token[far[near]])  # pairs that this batch itself takes apart
        odd.append(places[near][(soon >= 0) & (soon < rank)])
        token[places], token[gone] = rank, -1
        after[places] = far
        before[far[near]] = places[near]
        left = before[places]
        enter(np.concatenate([left[left != -1], places[near]]), rank)
    left = token >= 0
    counts = np.zeros(len(words) + 1, np.int64)
    counts[1:] = np.r_[0, np.cumsum(left)][ends] if len(words) else 0
    flat = token[left].astype("<u4").tobytes()
    found = [flat[4 * a : 4 * b] for a, b in zip(counts[:-1].tolist(), counts[1:].tolist())]
    # There the order of merges within a word matters: by the definition.
    for i in np.unique(np.searchsorted(ends, np.concatenate(odd), "right")).tolist() if odd else ():
        found[i] = np.array(one_by_one(words[i], merges.ids), "<u4").tobytes()
    return found


class Encoder:
    """Encodes texts, with ids of the words it has met."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.split, self.ids, self.size = merges, regex.compile(pattern).findall, {}, 0

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text. What the pattern doesn't match has none."""
        words = [self.split(t) for t in texts]
        new = list({w for ws in words for w in ws}.difference(self.ids))
        if self.size > KEPT_BYTES:
            self.ids, self.size = {}, 0
            new = list({w for ws in words for w in ws})
        for w, ids in zip(new, replay([w.encode() for w in new], self.merges), strict=True):
            self.ids[w] = ids
            self.size += len(w) + len(ids) + 150
        look = self.ids.__getitem__
        for ws in words:
            yield b"".join(map(look, ws))


class Decoder:
    """Decodes ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}

    def decode(self, ids: bytes) -> bytes:
        """Raises KeyError for an id that the vocabulary lacks."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _coded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str, text: str, schema: str, made) -> DataFrame:
    fetch = arrays.shared(docs.sparkSession, Merges(ranks))  # bounded by the vocabulary

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = fetch()
        encoder, decoder = Encoder(merges, pattern), Decoder(merges.ids)
        for batch in arrays.blocks(batches, "text", BLOCK_BYTES):
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(*made(batch.column("id"), list(encoder.encode(texts)), decoder))

    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(task, schema).withColumnRenamed("id", key)


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids (little-endian unsigned 32-bit), decoded (bytes decoded from the ids).

    Every match of the pattern is encoded by itself; strings of special tokens are ordinary text. A
    null or empty text has no tokens. Rows that repeat are encoded each. A null key stays null.
    """
    def made(ids, coded, decoder):
        counts = pa.array([len(x) // 4 for x in coded], pa.int64())
        return [ids, counts, pa.array(coded, pa.binary()), pa.array(map(decoder.decode, coded), pa.binary())], SCHEMA_NAMES

    return _coded(docs, ranks, pattern, key, text, SCHEMA, made)


SCHEMA_NAMES = ["id", "n_tokens", "ids", "decoded"]
DIGEST_NAMES = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]


def encode_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode_decode``, with SHA-256 digests in place of the ids and the decoded bytes."""
    def made(ids, coded, decoder):
        counts = pa.array([len(x) // 4 for x in coded], pa.int64())
        digests = [hashlib.sha256(x).hexdigest() for x in coded]
        decoded = [hashlib.sha256(decoder.decode(x)).hexdigest() for x in coded]
        return [ids, counts, pa.array(digests, pa.string()), pa.array(decoded, pa.string())], DIGEST_NAMES

    return _coded(docs, ranks, pattern, key, text, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string", made)


def query(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    ranks = read_ranks(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks)
